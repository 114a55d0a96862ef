"""Small documents with every awkward case, and plain re-implementations to test against."""

import random
import re

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])
AZ = {c: c + 32 for c in range(65, 91)}


def prose(n, seed, vocabulary=400):
    rnd = random.Random(seed)
    names = ["".join(rnd.choice(["ta", "ri", "on", "é", "sel", "um", "ka"]) for _ in range(rnd.randint(1, 4)))
             for _ in range(vocabulary)]
    return " ".join(rnd.choice(names) for _ in range(n))


def awkward():
    """(doc_id, text): nulls, empties, whitespace, ties, repeated rows, a very long text, copies and near copies."""
    base = prose(120, 1)
    words = base.split(" ")
    near = " ".join([*words[:60], "changed", *words[61:]])
    far = " ".join(reversed(words))
    return [(1, None), (2, ""), (3, " \t\n\r "), (4, "one"), (5, "one two"), (6, "One TWO"), (7, base), (8, base),
            (8, base), (9, base + "  "), (10, near), (11, far), (12, prose(30_000, 2)), (13, "É é ß 😀 \u0085 x"),
            (None, base), (None, None), (14, "a " * 300), (15, "a " * 301), (16, base.upper()), (17, prose(80, 3)),
            (18, prose(80, 3) + " tail")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)


def with_clashes(df, *names):
    """df with extra columns of the given names, holding text."""
    from pyspark.sql import functions as F
    return df.withColumns({n: F.lit("clash") for n in names})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(AZ))


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(AZ))

"""Exact deduplication by skew-safe combining (native).

Texts are equal when identical after deleting the characters
``[\\x20\\x09-\\x0D]``.  Copies meet in three stages, each of which groups by
the digest *and* the whole normalised text, so two texts that share a digest
are never merged:

1. locally: Spark's partial aggregation leaves one row per distinct text and
   map task;
2. salted: those rows are merged per (digest, salt), the salt coming from the
   map task, so a text that holds a third of all rows meets in ``salts`` tasks;
3. globally: the salt winners of a text are combined, ``salts`` rows a text
   at most.

The winner of a text is one decimal (code points, then smallest id), so the
aggregates stay in fixed-width hash buffers and only the text itself is wide.

Defined results: ids are whole numbers; null text counts as empty; null ids lose to any id and
``keep_id`` is null only if all ids of the group are; of rows that agree in
id and length exactly one is kept; an empty table gives no rows.  Columns of
the input beyond the id and the text are ignored by ``groups`` and carried
by ``keep_first``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.llm.registry import query, table

SALTS = 16
_WIDE = "decimal(38,0)"
_SPAN = "18446744073709551616"   # 2^64
_TOP = "9223372036854775807"     # 2^63 - 1


def normalised(text: Column) -> Column:
    """The text without space, tab, newline, vertical tab, form feed and return."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def sha256_hex(norm: Column) -> Column:
    return F.sha2(F.encode(norm, "UTF-8"), 256)


def _rank(doc_id: Column, n_points: Column) -> Column:
    """Larger is better: more code points, then the smaller id; null id last."""
    return (n_points.cast(_WIDE) * F.lit(_SPAN).cast(_WIDE)
            + F.coalesce(F.lit(_TOP).cast(_WIDE) - doc_id.cast("long").cast(_WIDE) + F.lit(1).cast(_WIDE),
                         F.lit(0).cast(_WIDE))).cast(_WIDE)


def _rows(docs: DataFrame, id_col: str, text_col: str, digest, salts: int) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), normalised(F.col(text_col)).alias("norm"),
                        F.char_length(text).cast("long").alias("points"))
            .select("doc_id", "norm", "points", digest(F.col("norm")).alias("digest"),
                    F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
            .withColumn("rank", _rank(F.col("doc_id"), F.col("points"))))


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_hex,
            salts: int = SALTS) -> DataFrame:
    """One row per distinct normalised text: digest, norm, group_size, rank of the row that stays."""
    merged = (_rows(docs, id_col, text_col, digest, salts).groupBy("digest", "norm", "salt")
              .agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("rank")))
    return merged.groupBy("digest", "norm").agg(F.sum("n").alias("group_size"), F.max("rank").alias("rank"))


def _named(won: DataFrame) -> DataFrame:
    """Winners by (digest, second 64-bit hash of the text), which name a text without carrying it."""
    low = F.pmod(F.col("rank"), F.lit(_SPAN).cast(_WIDE))
    keep = F.when(low > 0, (F.lit(_TOP).cast(_WIDE) + 1 - low).cast("long"))
    return won.select("digest", F.xxhash64("norm").alias("mark"), "group_size", "rank", keep.alias("keep_id"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_hex,
           salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, digest.

    The lookup of a row's group is salted by id: a group of several rows is
    offered under every salt, a group of one under the salt of its only id.
    """
    def spread(doc_id: str) -> Column:
        return F.pmod(F.xxhash64(doc_id), F.lit(salts)).cast("int")

    named = _named(winners(docs, id_col, text_col, digest, salts))
    offered = named.withColumn("part", F.explode(
        F.when(F.col("group_size") > 1, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(spread("keep_id")))))
    each = (_rows(docs, id_col, text_col, digest, salts)
            .select("digest", F.xxhash64("norm").alias("mark"), "doc_id", F.col("rank").alias("own"))
            .groupBy("digest", "mark", "doc_id", "own").agg(F.count(F.lit(1)).alias("m"))
            .withColumn("part", spread("doc_id")))
    out = each.join(offered, ["digest", "mark", "part"])
    copy = F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))).alias("copy")
    return out.select("doc_id", "keep_id", "group_size", "own", "rank", "digest", copy).select(
        "doc_id", "keep_id", "group_size",
        ((F.col("own") == F.col("rank")) & (F.col("copy") == 1)).alias("kept"), "digest")


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256_hex,
               salts: int = SALTS) -> DataFrame:
    """The rows that stay, with all their columns, whatever their names; one row per distinct normalised text."""
    norm = normalised(F.col(text_col))
    points = F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long")
    keys = [_unused(docs, n) for n in ("__digest", "__mark", "__rank")]
    number = _unused(docs, "__n")
    named = _named(winners(docs, id_col, text_col, digest, salts)).select(
        *[F.col(c).alias(k) for c, k in zip(("digest", "mark", "rank"), keys)])
    tagged = docs.withColumns(dict(zip(keys, (digest(norm), F.xxhash64(norm), _rank(F.col(id_col), points)))))
    one = Window.partitionBy(*keys).orderBy(F.lit(0))
    return (tagged.join(named, keys, "left_semi").withColumn(number, F.row_number().over(one))
            .filter(F.col(number) == 1).select(*[F.col(f"`{c}`") for c in docs.columns]))


SQL = r"""
WITH r AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS n
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY n) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(n) AS text_sha256
FROM r
WINDOW w AS (PARTITION BY n ORDER BY length(t) DESC, doc_id)
"""


@query("op9_exact_dedup", SQL)
def op9_exact_dedup(spark, sf_dir):
    return groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))

import hashlib
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fathom.llm import exact_dedup
from tests.llm.fixtures import awkward, frame, with_clashes


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((i, len(t or "")))
    out = []
    for norm, members in groups.items():
        keep, size = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        left = 1
        for i, n in members:
            kept = (i, n) == (keep, size) and left > 0
            left -= kept
            out.append((i, keep, len(members), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("salts", [1, 16])
def test_groups_equal_brute_force(spark, salts):
    rows = awkward()
    df = with_clashes(frame(spark, rows).repartition(3), "digest", "norm", "salt", "rank", "keep_id")
    assert sorted(map(tuple, exact_dedup.groups(df, salts=salts).collect()), key=str) == brute(rows)


def test_texts_that_share_a_digest_stay_apart(spark):
    """A digest of one hexadecimal digit: full content decides at every stage."""
    rows = awkward()
    weak = lambda norm: F.substring(exact_dedup.sha256_hex(norm), 1, 1)
    got = exact_dedup.groups(frame(spark, rows).repartition(4), digest=weak)
    assert sorted([tuple(r)[:4] for r in got.collect()], key=str) == [r[:4] for r in sorted(
        brute(rows), key=lambda r: str(r[:4]))]


def test_keep_first_carries_all_columns(spark):
    rows = awkward()
    df = with_clashes(frame(spark, rows), "digest", "kept")
    kept = exact_dedup.keep_first(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in brute(rows) if r[3])


def test_large_group_of_copies(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("same text"), F.when(F.col("id") % 3 == 0, " ").otherwise(F.lit(""))).alias("text"))
    got = exact_dedup.groups(df.repartition(7)).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(0, 3000)} and sum(r.kept for r in got) == 1


def test_empty_table(spark):
    df = frame(spark, [])
    assert exact_dedup.groups(df).count() == 0 and exact_dedup.keep_first(df).count() == 0


def test_keep_first_takes_columns_of_any_name(spark):
    names = ("__n", "__digest", "__mark", "__rank", "__n_", "norm", "digest")
    df = with_clashes(frame(spark, awkward()), *names)
    out = exact_dedup.keep_first(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r.doc_id) for r in exact_dedup.keep_first(frame(spark, awkward())).collect())
    assert all(r[n] == "clash" for r in rows for n in names)

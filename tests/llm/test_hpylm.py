import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fathom.llm import hpylm as h
from fathom.llm.labelled import fold
from tests.llm.fixtures import awkward, frame, prose, with_clashes, words


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


def rows():
    return awkward() + [(i, prose(40 + i, 9, vocabulary=60)) for i in range(300, 360)]


def base(data):
    counts = collections.Counter()
    for i, t in data:
        if not held_out(i):
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    return sorted((str(i), len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), None]), n,
                   round(sum(math.log10((counts[w] + .5) / (n + .5 * (v + 1))) for w in [*words(t), None]), 6))
                  for i, t in data)


@pytest.mark.parametrize("head,buckets", [(1024, 4), (20, 7), (1, 1)])
def test_base_scores_equal_brute_force(spark, head, buckets):
    df = with_clashes(frame(spark, rows()).repartition(3), "mark", "train", "rows", "score")
    got = h.score_texts(df, fold(F.col("doc_id")) != 1, head_words=head, buckets=buckets)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got.collect()) == base(rows())


def test_head_and_bucket_parts_agree(spark):
    """The same contexts, words counted as head or as packed entries: scores differ by sampling only."""
    df, train = frame(spark, rows()), fold(F.col("doc_id")) != 1
    a, b = (sorted((str(r.doc_id), r.n_tokens, r.score) for r in h.score_texts(
        df, train, head_words=30, buckets=n).collect()) for n in (1, 5))
    assert [x[:2] for x in a] == [x[:2] for x in b]
    assert abs(sum(x[2] for x in a) / sum(x[2] for x in b) - 1) < 0.01


def test_held_out_perplexity_beats_the_base(spark):
    """A corpus in which the next word depends on the one before."""
    rnd = np.random.default_rng(5)
    texts = []
    for i in range(400):
        w, at = [], int(rnd.integers(50))
        for _ in range(60):
            at = (at * 7 + int(rnd.integers(3))) % 50
            w.append(f"w{at}")
        texts.append((i, " ".join(w)))
    got = h.score_texts(frame(spark, texts), fold(F.col("doc_id")) != 1).withColumn("held_out", fold(F.col("doc_id")) == 1)
    p = {r.held_out: (r.perplexity, r.base_perplexity) for r in h.perplexity(got).collect()}
    assert p[True][0] < 6 and p[True][1] > 30


def exact_weights(c, b, d):
    s = [[0.0] * (c + 2) for _ in range(c + 1)]
    s[1][1] = 1.0
    for n in range(1, c):
        for t in range(1, n + 2):
            s[n + 1][t] = s[n][t - 1] + (n - d * t) * s[n][t]
    w = np.array([s[c][t] * b ** t for t in range(1, c + 1)])
    return w / w.sum()


@pytest.mark.parametrize("c,b,d", [(2, 0.3, 0.5), (7, 2.0, 0.8), (30, 0.05, 0.4)])
def test_tables_are_drawn_from_the_exact_weights(c, b, d):
    t = h.sample_tables(np.full(40_000, c), np.full(40_000, b), d, h.log_stirling(d, 96), np.random.default_rng(1))
    seen = np.bincount(t, minlength=c + 1)[1:] / len(t)
    assert np.abs(seen - exact_weights(c, b, d)).max() < 0.012


def test_large_counts_use_a_close_approximation():
    c, b, d = 90, 1.5, 0.6
    w = exact_weights(c, b, d)
    mean = w @ np.arange(1, c + 1)
    t = h.sample_tables(np.full(20_000, c), np.full(20_000, b), d, h.log_stirling(d, 20), np.random.default_rng(2))
    assert abs(t.mean() / mean - 1) < 0.06
    assert h.sample_tables(np.array([10**7, 1, 0]), np.array([1e-9, 5.0, 1.0]), 0.5, h.log_stirling(0.5, 4),
                           np.random.default_rng(3)).tolist()[1:] == [1, 0]


def test_probabilities_sum_to_one(spark):
    """Over the vocabulary and the unseen word, in a context seen and one unseen."""
    dishes = h.Dishes(np.array([0, 0, 1, 2]), np.array([0, 1, 0, 1]), np.array([5, 2, 1, 9]), 3)
    model = h.Model(3, 17, 0.5, 0.4, np.array([6, 11, 0]))
    s = h.log_stirling(0.5, 96), h.log_stirling(0.4, 96)
    first = dishes.sums(3)
    dishes.sweep(model, h.Totals(first[:3], int(first[3]), int(first[4])), s, np.random.default_rng(0))
    got = dishes.sums(3)
    of = h.Totals(got[:3], int(got[3]), int(got[4]))
    shared = np.append(model.shared(dishes.c_shared, dishes.t_shared, of), model.shared(np.zeros(1), np.zeros(1), of))
    assert math.isclose(shared.sum(), 1.0)
    for ctx in range(3):
        c, t = np.zeros((2, 4))
        here = dishes.ctx == ctx
        c[dishes.word[here]], t[dishes.word[here]] = dishes.count[here], dishes.t[here]
        assert math.isclose(model.word(np.full(4, ctx), c, t, shared, of).sum(), 1.0)


def test_empty_table_and_no_training_rows(spark):
    assert h.score_texts(frame(spark, []), F.lit(True)).count() == 0
    got = h.score_texts(frame(spark, awkward()[:8]), F.lit(False)).collect()
    assert {(r.train_tokens, r.n_known, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)}


def test_scores_leave_a_bucket_packed_by_block(spark):
    """At most a row a block, whatever the number of texts; the blocks give every text its sums."""
    data = [(i, prose(i, 12, vocabulary=80)) for i in range(200)] + [(-5, "a b"), (-5, "b a b"), (None, "a b")]
    docs = frame(spark, data).select("doc_id", "text", F.xxhash64("text").alias("mark"), F.lit(True).alias("train"))
    top = spark.sparkContext.broadcast(np.zeros(0, dtype=np.uint64))
    payloads = collections.defaultdict(list)
    for r in h.packed_entries(docs, top, 3).collect():
        payloads[r.bucket].append(bytes(r.payload))
    tables = []
    for z in payloads.values():
        b = h.Bucket(z, 0)
        one = np.ones(len(b.pairs))
        tables.append(b.scores(one / 10, one * 0.5, one, 4))
        assert tables[-1].num_rows <= 4 < len(b.ids)
    rows = [(k, z) for t in tables for k, z in zip(t["block"].to_pylist(), t["payload"].to_pylist())]
    got = []
    for k in {k for k, _ in rows}:
        got += h.texts_of_block(h.pa.table({"payload": h.pa.array([z for j, z in rows if j == k], h.pa.binary())})).to_pylist()
    assert sorted((str(r["doc_id"]), r["n_known"], r["base_score"], round(r["score"], 9)) for r in got) == sorted(
        (str(i), n, n * 0.5, -float(n)) for i, t in data for n in [len(words(t)) + 1])

"""Lags and last-N sums over range partitions, and the last-N stream, against plain loops."""

import random

import pytest
from pyspark.sql import functions as F

from fathom.operators import drift, halo
from fathom.plans.streams import last_n_scores
from fathom.streaming import in_order
from fathom.streaming import monitor


def _rows(n, groups, seed=0):
    rnd = random.Random(seed)
    rows = [(rnd.choice(groups), i, rnd.randrange(50) if rnd.random() > .1 else None) for i in range(n)]
    rnd.shuffle(rows)
    return rows


def _series(rows):
    out = {}
    for g, t, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1])):
        out.setdefault(g, []).append((t, x))
    return out


@pytest.mark.parametrize("partitions,lags", [(1, [1, 7]), (5, [1, 7, 48]), (40, [1, 24, 48])])
def test_lags_cross_partitions(spark, partitions, lags):
    """Also partitions smaller than the lag, a NULL group, and a group with most of the rows."""
    rows = _rows(300, ["a", "a", "a", "a", "b", None])
    df = spark.createDataFrame(rows, "g string, t int, x int")
    got = {(r.g, r.t): r for r in halo.lagged(df, ["t"], "x", lags, ["g"], num_partitions=partitions).collect()}
    assert len(got) == 300
    for g, series in _series(rows).items():
        for i, (t, x) in enumerate(series):
            assert got[g, t].x == x
            assert [got[g, t][f"lag_{k}"] for k in lags] == [series[i - k][1] if i >= k else None for k in lags]


@pytest.mark.parametrize("partitions,n", [(1, 10), (6, 10), (40, 100), (3, 1)])
def test_last_sums_cross_partitions(spark, partitions, n):
    rows = _rows(260, ["a", "a", "b"], seed=2)
    df = spark.createDataFrame(rows, "g string, t int, x int")
    got = halo.last_sums(df, ["t"], {"s": F.col("x"), "odd": (F.col("x") % 2).cast("long")}, n, ["g"], partitions).collect()
    got = {(r.g, r.t): (r.n_rows, r.s, r.odd) for r in got}
    for g, series in _series(rows).items():
        for i, (t, _) in enumerate(series):
            last = [x for _, x in series[max(0, i - n + 1):i + 1]]
            assert got[g, t] == (len(last), sum(x or 0 for x in last), sum((x or 0) % 2 for x in last))


def test_empty_table(spark):
    df = spark.createDataFrame([], "g string, t int, x int")
    assert halo.lagged(df, ["t"], "x", [1], ["g"]).count() == 0
    assert [r.acf for r in halo.autocorrelation(df, ["t"], "x", 3).collect()] == [None] * 3


def test_autocorrelation_of_a_known_series(spark):
    rows = [(t, float(t % 24)) for t in range(480)]
    acf = {r.lag: r.acf for r in halo.autocorrelation(spark.createDataFrame(rows, "t int, x double"), ["t"], "x", 48).collect()}
    mean = 11.5
    want = {k: sum((rows[i][1] - mean) * (rows[i - k][1] - mean) for i in range(k, 480)) / sum((x - mean) ** 2 for _, x in rows)
            for k in (1, 12, 24, 48)}
    assert all(abs(acf[k] - w) < 1e-12 for k, w in want.items()) and acf[24] > 0.9


def test_last_n_psi_batch_and_stream_agree(spark):
    """Any number of files and batch size gives the batch scores; values beyond the profile count, NULLs don't."""
    import datetime
    rnd = random.Random(3)
    start = datetime.datetime(2024, 1, 1)
    rows = [(f, i, start + datetime.timedelta(seconds=rnd.randrange(200_000)), rnd.gauss(0, 1 + i / 200) if rnd.random() > .1 else None)
            for f in ("p", "q") for i in range(160)]
    cur = spark.createDataFrame(rows, "feature string, event_id long, ts timestamp, x double")
    ref = spark.createDataFrame([(f, rnd.gauss(0, 1)) for f in ("p", "q", "unused") for _ in range(300)], "feature string, x double")
    profile = drift.bin_profile(ref).cache()
    batch = {(r.feature, r.event_id): (r.n_window, round(r.psi, 9)) for r in drift.last_n_psi(
        cur, profile, ["ts", "event_id"], 20, keep=["event_id"]).collect()}
    values = {f: sum(1 for r in rows if r[0] == f and r[3] is not None) for f in ("p", "q")}
    assert len(batch) == sum(v - 9 for v in values.values()) and {n for n, _ in batch.values()} == set(range(10, 21))
    for files, per_batch in ((1, 1), (5, 2)):
        got = last_n_scores(cur, profile, 20, files, per_batch, "10 days").collect()
        assert {(r.feature, r.event_id): (r.n_window, round(r.psi, 9)) for r in got} == batch


def test_missing_rules_first_match(spark):
    from fathom.operators.profile import MissingRule, missing_taxonomy
    report = spark.createDataFrame([("a", 5, .5), ("b", 1, .001), ("c", 0, 0.), ("d", 9, .9)], "column_name string, n_missing int, missing_rate double")
    rules = [MissingRule("rare", "drop", below=.01), MissingRule("named", "ask", columns=("a", "b")), MissingRule("low", "fill", below=.6)]
    got = {r.column_name: (r.reason, r.remedy) for r in missing_taxonomy(report, rules).collect()}
    assert got == {"a": ("named", "ask"), "b": ("rare", "drop"), "d": (None, None)}


@pytest.mark.parametrize("files,per_batch", [(1, 1), (6, 2)])
def test_online_learner_equals_a_loop(spark, files, per_batch):
    """Steps over two keys with unfinished last batches, in event-time order."""
    import datetime
    import numpy as np
    rnd = random.Random(7)
    start = datetime.datetime(2024, 1, 1)
    rows = [("ab"[i % 3 == 0], i, start + datetime.timedelta(seconds=rnd.randrange(90_000)), [rnd.gauss(0, 1), rnd.gauss(0, 1)], rnd.gauss(2, 1))
            for i in range(230)]
    df = spark.createDataFrame(rows, "key string, id long, event_time timestamp, x array<double>, y double")
    learner = in_order.OnlineLinear(2, size=20, rate=0.1, l2=0.01)
    got = {(r.key, r.step): r.weights for r in in_order.replayed(df, learner, files, per_batch, "10 days").collect()}
    for key in "ab":
        mine = sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[1]))
        w = np.zeros(3)
        for step in range(1, len(mine) // 20 + 1):
            batch = mine[20 * (step - 1):20 * step]
            x, y = np.array([[1.0, *r[3]] for r in batch]), np.array([r[4] for r in batch])
            w = w - 0.1 / step ** 0.25 * (x.T @ (x @ w - y) / 20 + 0.01 * np.array([0, w[1], w[2]]))
            assert got[key, step] == pytest.approx(w.tolist(), rel=1e-9)
    assert len(got) == sum(sum(1 for r in rows if r[0] == k) // 20 for k in "ab")


def test_latency_of_counts_is_exact_for_many_values(spark):
    rnd = random.Random(1)
    rows = [(w, float(rnd.randrange(30_000))) for w in ("x", "x", "x", "y") for _ in range(8000)]
    counts = spark.createDataFrame(rows, "w string, v double").groupBy("w", "v").agg(F.count(F.lit(1)).alias("value_n"))
    got = {r.w: r for r in monitor.latency_of_counts(counts, "v", [0.5, 0.95, 0.99]).collect()}
    for w in ("x", "y"):
        values = sorted(v for k, v in rows if k == w)
        assert got[w].n == len(values) and got[w].mean == pytest.approx(sum(values) / len(values))
        assert got[w].q == [values[-(-len(values) * p // 100) - 1] for p in (50, 95, 99)]


def test_a_retried_batch_is_written_once(spark, tmp_path):
    """The batch whose commit is lost runs again and overwrites what it wrote."""
    import os
    df = spark.createDataFrame([(i, float(i % 4)) for i in range(40)], "i int, value double")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    root = str(tmp_path / "out")
    for again in (False, True):
        monitor.validation_sinks(stream(), F.col("value") < 1.0, root).awaitTermination()
        if not again:
            last = max(int(e.name) for e in os.scandir(f"{root}/chk/commits") if e.name.isdigit())
            for name in (str(last), f".{last}.crc"):
                os.remove(f"{root}/chk/commits/{name}")
    read = lambda n: sorted(r.i for r in spark.read.parquet(f"{root}/{n}").collect())
    assert read("quarantine") == list(range(0, 40, 4)) and read("accepted") == [i for i in range(40) if i % 4]


def test_long_conversations_become_several_requests(spark, tmp_path):
    from fathom.plans.streams import request_explode
    rows = [(c, t, "user", "x" * (t % 7)) for c, n in ((1, 1100), (2, 3), (3, 512)) for t in range(n)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = sorted(tuple(r) for r in request_explode(spark, str(tmp_path)).collect())
    assert got == sorted((c, t, t, "user", t % 7) for c, t, _, _ in rows)


def test_last_n_state_equals_a_loop_over_several_days(spark, monkeypatch):
    """Rows of one key over days, files and packed entries, with rows outside all bins."""
    import datetime
    monkeypatch.setattr(in_order, "SMALL", 10)
    rnd = random.Random(9)
    start = datetime.datetime(2024, 1, 1)
    rows = [("a", i, start + datetime.timedelta(seconds=rnd.randrange(400_000)), rnd.randrange(-1, 4)) for i in range(700)]
    df = spark.createDataFrame(rows, "key string, id long, event_time timestamp, bin int")
    got = {r.id: (r.n_window, list(r.counts)) for r in in_order.replayed(df, in_order.LastN(30, 4), 5, 2, "10 days").collect()}
    mine = sorted(rows, key=lambda r: (r[2], r[1]))
    want = {}
    for i, r in enumerate(mine):
        last = [b[3] for b in mine[max(0, i - 29):i + 1]]
        if len(last) >= 15:
            want[r[1]] = (len(last), [last.count(b) for b in range(4)])
    assert got == want


def test_waiting_rows_are_packed(monkeypatch):
    """One call of the state for many rows of a key, not one value for each."""
    import numpy as np
    import pandas as pd

    class Entries(dict):
        updateValue, getValue, removeKey = dict.__setitem__, dict.__getitem__, dict.__delitem__

    class Values(list):
        appendValue = list.append

    class Handle:
        def getListState(self, *_):
            return Values()

        def getMapState(self, *_):
            return Entries()

        def getValueState(self, *_):
            return None

        def registerTimer(self, _):
            pass

    class Times:
        def getCurrentWatermarkInMs(self):
            return 0
    p = in_order.OnlineLinear(2)
    p.init(Handle())
    n = 30_000
    chunk = pd.DataFrame({"ts_us": np.arange(n) * 10_000_000, "id": np.arange(n), "x": [[1.0, float(i)] for i in range(n)], "y": np.arange(n) * 2.0})
    p.handleInputRows(("k",), iter([chunk]), Times())
    assert len(p.waiting) == 4                                            # days
    cols = in_order._joined([p._unpacked(p.waiting[h][0]) for h in sorted(p.waiting)])
    assert [c.tolist() for c in cols[:2]] == [chunk["ts_us"].tolist(), chunk["id"].tolist()] and cols[2][-1].tolist() == [1.0, n - 1.0]

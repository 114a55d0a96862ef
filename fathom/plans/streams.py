"""Streaming queries (T1-T8, D6, M11, S8, S9): batch twins with DuckDB oracles,
and stream runs (availableNow) checked by rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions.hashing import bucket, sql_bucket, sql_key_text
from fathom.functions.numeric import rnd, sql_rnd
from fathom.operators import windows
from fathom.operators.ordered import exact_quantiles, row_numbers
from fathom.plans.common import events_features
from fathom.plans.drift import LAST_N, SQL_LAST_N, last_n_report
from fathom.plans.registry import ORACLES, query
from fathom.session import small_side
from fathom.sources.tables import Tables, table_path
from fathom.streaming import in_order
from fathom.streaming import monitor as S

LIMIT = 5
REQUEST_ROWS = 512   # fixed value: the largest request


@query("trailing_rate", ["T5"], sql=f"""
WITH t AS (SELECT user_id, count(*) OVER (PARTITION BY user_id ORDER BY ts
                  RANGE BETWEEN INTERVAL 60 SECONDS PRECEDING AND CURRENT ROW) AS trailing_n FROM events)
SELECT user_id, count(*) AS n_events, max(trailing_n) AS max_trailing,
       count(*) FILTER (WHERE trailing_n > {LIMIT}) AS n_over_limit FROM t GROUP BY user_id
""")
def trailing_rate(spark, sf_dir):
    e = Tables(spark, sf_dir).events.select("user_id", "ts")
    t = windows.trailing_counts(e, "user_id", "ts", 60)
    return t.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_events"), F.max("trailing_n").alias("max_trailing"),
                                    F.count(F.when(F.col("trailing_n") > LIMIT, 1)).alias("n_over_limit"))


@query("stream_counters", ["T3"], sql="""
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n
FROM events GROUP BY ALL
""")
def stream_counters(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    return e.groupBy(F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                     "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("latency_windows", ["T2"], sql=f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS window_start, count(value) AS n, {sql_rnd('avg(value)', 6)} AS mean,
       {sql_rnd('quantile_cont(value, 0.95)', 6)} AS p95, {sql_rnd('quantile_cont(value, 0.99)', 6)} AS p99
FROM events GROUP BY 1
""")
def latency_windows(spark, sf_dir):
    e = Tables(spark, sf_dir).events
    e = e.select(F.date_format(F.date_trunc("day", "ts"), "yyyy-MM-dd").alias("window_start"), "value")
    sums = e.groupBy("window_start").agg(F.count("value").alias("n"), rnd(F.avg("value"), 6).alias("mean"))
    q = exact_quantiles(e, "value", [0.95, 0.99], ["window_start"], out="q").select(
        "window_start", *[rnd(F.col("q")[i], 6).alias(c) for i, c in enumerate(("p95", "p99"))])
    return sums.join(q, "window_start", "left")


@query("request_explode", ["S9"], sql="""
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, turn, role,
       CAST(length(text) AS INTEGER) AS n_chars FROM conversations
""")
def request_explode(spark, sf_dir):
    """Turns of a conversation as requests of at most 512 rows each, ordered arrays, and back to rows with positions."""
    c = Tables(spark, sf_dir).conversations.select("conv_id", "turn", "role", F.length("text").alias("n_chars"))
    numbered = row_numbers(c, ["turn"], ["conv_id"], name="__n").withColumn("part", F.floor((F.col("__n") - 1) / REQUEST_ROWS))
    req = numbered.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "n_chars"))).alias("instances"))
    ex = req.select("conv_id", "part", F.posexplode("instances").alias("pos", "r"))
    return ex.select("conv_id", (F.col("part") * REQUEST_ROWS + F.col("pos")).cast("int").alias("pos"), "r.turn", "r.role",
                     F.col("r.n_chars").cast("int").alias("n_chars"))


def _events_stream(spark, sf_dir):
    return S.event_stream(spark, table_path(sf_dir, "events"))


@query("stream_counters_live", ["T3", "S8"], sql=ORACLES["stream_counters"])
def stream_counters_live(spark, sf_dir):
    out = S.run_available_now(S.counters(_events_stream(spark, sf_dir), "event_type"), "counters", ["w", "event_type"])
    return out.select(F.date_format(F.col("w.start").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss").alias("window_start"),
                      "event_type", "n")


@query("latency_stream", ["T2"], sql=f"""
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS window_start, count(value) AS n, {sql_rnd('avg(value)', 6)} AS mean,
       {sql_rnd('quantile_disc(value, 0.95)', 6)} AS p95, {sql_rnd('quantile_disc(value, 0.99)', 6)} AS p99
FROM events GROUP BY 1
""")
def latency_stream(spark, sf_dir):
    """Per-window mean and exact quantiles, from a stream's counts per window and value."""
    counts = S.run_available_now(S.value_counts(_events_stream(spark, sf_dir), "value", "1 day", "1 day"), "latency", ["w", "value"])
    out = S.latency_of_counts(counts, "value", [0.95, 0.99])
    return out.select(F.date_format(F.col("w.start").cast("timestamp_ntz"), "yyyy-MM-dd").alias("window_start"), "n",
                      rnd("mean", 6).alias("mean"), *[rnd(F.col("q")[i], 6).alias(c) for i, c in enumerate(("p95", "p99"))])


EDGES = (0.0, 5.0, 10.0, 25.0, 50.0, 100.0, 1000.0)


@query("latency_histogram_stream", ["T4"], sql=f"""
WITH b AS (SELECT date_trunc('day', ts) AS d, CASE {" ".join(
    f"WHEN value >= {EDGES[i]}e0 AND value {'<=' if i == len(EDGES) - 2 else '<'} {EDGES[i + 1]}e0 THEN {i}"
    for i in range(len(EDGES) - 1))} END AS bin FROM events)
SELECT strftime(d, '%Y-%m-%d') AS window_start, CAST(bin AS INTEGER) AS bin, count(*) AS n FROM b
WHERE bin IS NOT NULL GROUP BY ALL
""")
def latency_histogram_stream(spark, sf_dir):
    out = S.run_available_now(S.bucket_histogram(_events_stream(spark, sf_dir), "value", EDGES, "1 day", "1 day"),
                              "histogram", ["w", "bin"])
    return out.select(F.date_format(F.col("w.start").cast("timestamp_ntz"), "yyyy-MM-dd").alias("window_start"), "bin", "n")


@query("validation_stream", ["T7"], sql="""
SELECT CASE WHEN value IS NULL OR value < 1.0e0 THEN 'quarantine' ELSE 'accepted' END AS sink, event_type, count(*) AS n
FROM events GROUP BY ALL
""")
def validation_stream(spark, sf_dir):
    """One stream into an accepted and a quarantine sink, both read back."""
    import uuid
    from fathom.session import ensure_checkpoint_dir
    root = f"{ensure_checkpoint_dir(spark)}/streams/valid-{uuid.uuid4().hex[:8]}"
    S.validation_sinks(_events_stream(spark, sf_dir), F.col("value") < 1.0, root).awaitTermination()
    both = [spark.read.parquet(f"{root}/{s}").select(F.lit(s).alias("sink"), "event_type") for s in ("accepted", "quarantine")]
    return both[0].unionByName(both[1]).groupBy("sink", "event_type").agg(F.count(F.lit(1)).alias("n"))


_REF_END = "2024-01-16 00:00:00"


@query("rolling_psi_stream", ["T1"], sql=f"""
WITH ref AS (SELECT value FROM events WHERE ts < TIMESTAMP '{_REF_END}' AND value IS NOT NULL),
rg AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 10 AS w, count(*) AS n FROM ref),
sh AS (SELECT g.bin, coalesce(c.n, 0) / (SELECT n FROM rg) AS share FROM (SELECT unnest(range(10)) AS bin) g LEFT JOIN (
  SELECT CASE WHEN value = hi THEN 9 ELSE CAST(floor((value - lo) / w) AS INTEGER) END AS bin, count(*) AS n
  FROM ref, rg GROUP BY 1) c ON c.bin = g.bin),
cur AS (SELECT date_trunc('day', ts) AS d, CASE WHEN value < lo OR value > hi THEN -1 WHEN value = hi THEN 9
               ELSE CAST(floor((value - lo) / w) AS INTEGER) END AS bin, count(*) AS n
        FROM events, rg WHERE value IS NOT NULL GROUP BY ALL),
tot AS (SELECT d, sum(n) AS t FROM cur GROUP BY 1),
j AS (SELECT tot.d, tot.t, sh.share + 1e-8 AS e, coalesce(cur.n, 0) / tot.t + 1e-8 AS a
      FROM tot CROSS JOIN sh LEFT JOIN cur ON cur.d = tot.d AND cur.bin = sh.bin)
SELECT strftime(d, '%Y-%m-%d') AS window_start, {sql_rnd('sum((a - e) * ln(a / e))', 6)} AS psi, CAST(max(t) AS BIGINT) AS n_current
FROM j GROUP BY d
""")
def rolling_psi_stream(spark, sf_dir):
    """Daily PSI of incoming values against the reference-half bin shares."""
    e = Tables(spark, sf_dir).events
    ref = e.where((F.col("ts") < F.lit(_REF_END).cast("timestamp_ntz")) & F.col("value").isNotNull())
    rng = ref.agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("value").alias("n")).first()  # three scalars
    lo, hi = float(rng["lo"]), float(rng["hi"])
    width = (hi - lo) / 10
    b = F.when(F.col("value") == hi, 9).otherwise(F.floor((F.col("value") - lo) / width).cast("int"))
    shares = ref.groupBy(b.alias("bin")).agg((F.count(F.lit(1)) / F.lit(rng["n"])).alias("share"))
    grid = spark.range(10).select(F.col("id").cast("int").alias("bin"))
    shares = grid.join(shares, "bin", "left").fillna({"share": 0.0})
    counts = S.run_available_now(S.window_bin_counts(_events_stream(spark, sf_dir), "value", lo, hi, 10), "psi", ["w", "bin"])
    out = S.psi_from_counts(counts, shares, 10)
    return out.select(F.date_format(F.col("w.start").cast("timestamp_ntz"), "yyyy-MM-dd").alias("window_start"),
                      rnd("psi", 6).alias("psi"), "n_current")


def last_n_scores(cur, profile, n, files=8, per_batch=3, lateness="60 days"):
    """(feature, event_id, n_window, psi) of (feature, event_id, ts, x), from the state of a stream."""
    from fathom.operators import drift
    rows = drift.binned(cur, profile).select(F.col("feature").alias("key"), F.col("event_id").alias("id"),
                                             F.col("ts").cast("timestamp").alias("event_time"), "bin")
    counts = in_order.replayed(rows, in_order.LastN(n, 10), files, per_batch, lateness)
    j = counts.withColumnsRenamed({"key": "feature", "id": "event_id"}).join(F.broadcast(profile), "feature")
    score = drift.psi_of_counts([F.get("counts", F.lit(i)) for i in range(10)], F.col("n_window"), F.col("shares"))
    return j.select("feature", "event_id", "n_window", score.alias("psi"))


@query("rolling_psi_last_n_stream", ["D6", "T1", "S8"], sql=SQL_LAST_N)
def rolling_psi_last_n_stream(spark, sf_dir):
    """The scores of ``rolling_psi_last_n`` from a stream over shuffled files, as keyed state."""
    from fathom.operators import drift
    lv = drift.long_values(events_features(spark, sf_dir), ["value", "k"], extra=["event_id", "ts", "half"])
    profile = small_side(drift.bin_profile(lv.where(F.col("half") == "reference")))
    return last_n_report(last_n_scores(lv.where(F.col("half") == "current"), profile, LAST_N))


@query("rate_limiter_stream", ["T5"])
def rate_limiter_stream(spark, sf_dir):
    """At most five allowed events of a user in a trailing minute, decided in event-time order over shuffled files."""
    e = Tables(spark, sf_dir).events
    rows = e.select(F.col("user_id").alias("key"), F.col("event_id").alias("id"), F.col("ts").cast("timestamp").alias("event_time"),
                    F.lit(1).alias("present"))
    out = in_order.replayed(rows, in_order.RateLimit(LIMIT, 60_000_000))
    return out.groupBy(F.col("key").alias("user_id")).agg(F.count(F.lit(1)).alias("n_events"),
                                                          F.count(F.when(~F.col("allowed"), 1)).alias("n_rejected"))


BATCH, RATE, DECAY, L2 = 20, 0.01, 0.25, 1e-4
_TEST = sql_bucket(sql_key_text("event_id"), "online", 5)


@query("online_learner_stream", ["T6", "M11"], sql=f"""
WITH RECURSIVE e AS (SELECT event_id, ts, value AS y, TRY_CAST(regexp_extract(props, '"k": (\\d+)', 1) AS DOUBLE) AS k, {_TEST} = 0 AS test FROM events),
f AS (SELECT * FROM e WHERE k IS NOT NULL AND y IS NOT NULL),
m AS (SELECT avg(k) AS mk, stddev_pop(k) AS sk FROM f WHERE NOT test),
z AS (SELECT event_id, ts, y, (k - mk) / sk AS x, test FROM f CROSS JOIN m),
r AS (SELECT *, (row_number() OVER (ORDER BY ts, event_id) - 1) // {BATCH} + 1 AS step FROM z WHERE NOT test),
g AS (SELECT step, max(event_id) AS any_id, sum(x) / {BATCH} AS sx, sum(x * x) / {BATCH} AS sxx, sum(y) / {BATCH} AS sy,
             sum(x * y) / {BATCH} AS sxy FROM r GROUP BY step HAVING count(*) = {BATCH}),
t AS (SELECT count(*) AS n, sum(x) AS x, sum(x * x) AS xx, sum(y) AS y, sum(x * y) AS xy, sum(y * y) AS yy FROM z WHERE test),
w AS (SELECT CAST(0 AS BIGINT) AS step, 0.0e0 AS a, 0.0e0 AS b
      UNION ALL
      SELECT g.step, a - {RATE}e0 / power(g.step, {DECAY}e0) * (a + b * sx - sy),
             b - {RATE}e0 / power(g.step, {DECAY}e0) * (a * sx + b * sxx - sxy + {L2!r} * b)
      FROM w JOIN g ON g.step = w.step + 1)
SELECT step, {sql_rnd('a', 6)} AS intercept, {sql_rnd('b', 6)} AS slope,
       {sql_rnd('sqrt((yy + n * a * a + b * b * xx - 2 * a * y - 2 * b * xy + 2 * a * b * x) / n)', 6)} AS test_rmse
FROM w CROSS JOIN t WHERE step > 0
""")
def online_learner_stream(spark, sf_dir):
    """A line of value on k, moved by a gradient step for every 20 training
    events in time order of a stream over shuffled files, and its RMSE on the
    test rows after each step, from their Gram matrix."""
    from fathom.operators import ml
    e = Tables(spark, sf_dir).events.select(
        "event_id", "ts", F.col("value").alias("y"), F.regexp_extract("props", r'"k": (\d+)', 1).try_cast("double").alias("k"),
        (bucket(F.col("event_id").cast("string"), "online", 5) == 0).alias("test")).dropna()
    m = e.where(~F.col("test")).agg(F.avg("k").alias("mk"), F.stddev_pop("k").alias("sk"))
    z = e.crossJoin(F.broadcast(m)).select("event_id", "ts", "y", ((F.col("k") - F.col("mk")) / F.col("sk")).alias("x"), "test")
    rows = z.where(~F.col("test")).select(F.lit("line").alias("key"), F.col("event_id").alias("id"),
                                          F.col("ts").cast("timestamp").alias("event_time"), F.array("x").alias("x"), "y")
    steps = in_order.replayed(rows, in_order.OnlineLinear(1, BATCH, RATE, DECAY, L2))
    g = ml.gram(z.where("test"), ["x"], ["y"])
    a, b = F.col("weights")[0], F.col("weights")[1]
    sse = g["yy"][0] + float(g["n"]) * a * a + b * b * float(g["xx"][1, 1]) - 2 * a * float(g["xy"][0, 0]) \
        - 2 * b * float(g["xy"][1, 0]) + 2 * a * b * float(g["xx"][0, 1])
    return steps.select("step", rnd(a, 6).alias("intercept"), rnd(b, 6).alias("slope"),
                        rnd(F.sqrt(sse / float(g["n"])), 6).alias("test_rmse"))


@query("snapshot_report", ["T8"], sql=f"""
WITH c AS (SELECT event_type, count(*) AS requests FROM events GROUP BY 1),
l AS (SELECT date_trunc('day', ts) AS d, count(value) AS n, avg(value) AS mean, quantile_disc(value, 0.95) AS p95,
             quantile_disc(value, 0.99) AS p99 FROM events GROUP BY 1 QUALIFY row_number() OVER (ORDER BY d DESC) = 1),
s AS ({SQL_LAST_N}),
k AS (SELECT feature, drifted FROM s JOIN events USING (event_id) QUALIFY row_number() OVER (PARTITION BY feature ORDER BY ts DESC, event_id DESC) = 1)
SELECT event_type, requests, strftime(d, '%Y-%m-%d') AS latency_day, n AS latency_n, {sql_rnd('mean', 6)} AS latency_mean,
       {sql_rnd('p95', 6)} AS latency_p95, {sql_rnd('p99', 6)} AS latency_p99,
       (SELECT string_agg(feature, ',' ORDER BY feature) FROM k WHERE drifted) AS drifted_features
FROM c CROSS JOIN l
""")
def snapshot_report(spark, sf_dir):
    """Totals by status, the latest latency window and the features whose
    latest score drifted, joined from the outputs of the three streams."""
    counts = stream_counters_live(spark, sf_dir).groupBy("event_type").agg(F.sum("n").alias("requests"))
    latency = latency_stream(spark, sf_dir).orderBy(F.desc("window_start")).limit(1).select(
        F.col("window_start").alias("latency_day"), *[F.col(c).alias(f"latency_{c}") for c in ("n", "mean", "p95", "p99")])
    ids = Tables(spark, sf_dir).events.select("event_id", "ts")
    latest = rolling_psi_last_n_stream(spark, sf_dir).join(ids, "event_id").groupBy("feature").agg(
        F.max_by("drifted", F.struct("ts", "event_id")).alias("drifted"))
    flags = latest.where("drifted").agg(F.sort_array(F.collect_list("feature")).alias("l")) \
        .select(F.when(F.size("l") > 0, F.array_join("l", ",")).alias("drifted_features"))       # a few features
    return counts.crossJoin(F.broadcast(latency)).crossJoin(F.broadcast(flags))


MINI_BATCHES = 20


@query("incremental_fit_stream", ["T6"])
def incremental_fit_stream(spark, sf_dir):
    """Running least-squares line of value on k over MINI_BATCHES micro-batches
    (one file each), with the RMSE of the line on each new batch before it is
    absorbed: epoch, rows so far, slope, intercept, rmse."""
    import uuid
    from fathom.session import ensure_checkpoint_dir
    root = f"{ensure_checkpoint_dir(spark)}/streams/incfit-{uuid.uuid4().hex[:8]}"
    e = Tables(spark, sf_dir).events.withColumn(
        "k", F.regexp_extract("props", r'"k": (\d+)', 1).try_cast("double")).where(F.col("k").isNotNull())
    (e.select("k", "value", "ts", bucket(F.col("event_id").cast("string"), "minibatch", MINI_BATCHES).alias("b"))
     .repartition(MINI_BATCHES, "b").write.partitionBy("b").parquet(f"{root}/in"))
    schema = spark.read.parquet(f"{root}/in").schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    S.incremental_fit(s, "k", "value", root).awaitTermination()
    st = spark.read.parquet(f"{root}/stats")
    slope = F.try_divide(F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy"), F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    line = st.withColumn("slope", slope).select("epoch", "n", "slope", ((F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n")).alias("intercept"))
    return line.join(spark.read.parquet(f"{root}/log").select("epoch", "rmse"), "epoch", "left")

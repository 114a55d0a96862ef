import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.llm import decontaminate as d
from tests.llm.fixtures import awkward, frame, plain_words, prose, with_clashes

BENCH = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def items():
    rep = " ".join(["again"] * 20)
    return [(1, prose(40, 50)), (2, prose(13, 51)), (3, "Short Question here"), (4, prose(30, 52)), (10, prose(30, 52)),
            (5, None), (6, ""), (7, "..."), (8, rep), (9, "solo"), (11, prose(9, 53)), (None, prose(20, 54))]


def documents():
    a = prose(40, 50).split(" ")
    near = [*a[:14], "other", *a[15:]]
    return [r for r in awkward() if r[0] != 12] + [
        (200, prose(30, 60) + " " + prose(40, 50) + " " + prose(30, 61)), (201, prose(13, 51).upper()),
        (202, " ".join(a[:12])), (203, " ".join(a[5:18])), (204, "x " + "short question, here! " * 3), (205, " ".join(near)),
        (206, "again " * 60), (207, prose(30, 52) + ". " + prose(400, 62)), (208, "this is solo"), (209, prose(9, 53)),
        (210, prose(9, 53) + " y"), (200, prose(20, 70)), (211, prose(20, 54)), (211, prose(20, 54))]


def brute(docs, bench):
    windows = {}
    for i, t in bench:
        w = plain_words(t)
        n = min(13, len(w))
        for j in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[j:j + n]), set()).add(i)
    sizes = {len(k) for k in windows}
    out = []
    for i, t in docs:
        w, hit, found = plain_words(t), set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                got = windows.get(tuple(w[j:j + n]))
                if got is not None:
                    hit.update(range(j, j + n))
                    found |= got
        out.append((i, len(w), len(hit), sorted(str(x) for x in found if x is not None), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.mark.parametrize("gram,limit", [(6, 10**6), (6, 0), (1, 10**6), (13, 10**6), (4, 10**6)])
def test_equals_brute_force(spark, gram, limit):
    docs, bench = documents(), items()
    df = with_clashes(frame(spark, docs).repartition(3), "mark", "words", "at", "item_id")
    got = d.contamination(df, spark.createDataFrame(bench, BENCH), gram=gram, broadcast_rows=limit).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in got), key=str) == brute(
        docs, bench)


def test_filter_keeps_clean_rows_and_columns(spark):
    docs, bench = documents(), items()
    df = with_clashes(frame(spark, docs), "mark", "kept")
    left = d.without_contaminated(df, spark.createDataFrame(bench, BENCH))
    assert left.columns == df.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r[0]) for r in brute(docs, bench) if not r[4])


def test_very_long_text(spark):
    long = prose(60_000, 80, vocabulary=3000)
    inside = long + " " + prose(40, 50) + " " + long
    got = d.contamination(frame(spark, [(1, inside)]), spark.createDataFrame(items()[:1], BENCH)).first()
    assert (got.n_words, got.n_hit, got.contaminated) == (120_040, 40, False)


@pytest.mark.parametrize("limit", [10**6, 0])
def test_long_text_that_is_all_benchmark(spark, limit):
    """Work in proportion to its length: every place is a hit."""
    bench = prose(50_000, 81, vocabulary=5000)
    df = frame(spark, [(1, bench), (2, bench.replace(" ", ", ") + " and more"), (3, prose(50, 82))])
    got = {r.doc_id: (r.n_words, r.n_hit, r["items"], r.contaminated) for r in d.contamination(
        df, spark.createDataFrame([(7, bench)], BENCH), broadcast_rows=limit).collect()}
    assert got == {1: (50_000, 50_000, ["7"], True), 2: (50_002, 50_000, ["7"], True), 3: (50, 0, [], False)}


def test_empty_tables(spark):
    none = spark.createDataFrame([], BENCH)
    assert d.contamination(frame(spark, []), none).count() == 0
    got = d.contamination(frame(spark, documents()), none)
    assert got.filter("contaminated OR n_hit > 0").count() == 0 and got.count() == len(documents())


def test_no_python_in_the_plan(spark):
    plan = d.contamination(frame(spark, documents()), spark.createDataFrame(items(), BENCH)).select(
        F.sum("n_hit"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

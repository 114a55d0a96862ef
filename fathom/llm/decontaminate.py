"""Benchmark decontamination by winnowing (native).

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  A
benchmark *window* is ``WINDOW`` consecutive words of an item, or the whole
item if it has fewer; a document word inside any occurrence of a window is hit.

Winnowing: of the k-gram hashes inside each run of window length the smallest
is kept.  It depends on the run alone, so a document that holds a benchmark
window keeps the window's own fingerprint there: every shared window is found.
Documents' fingerprints, each with its place, are joined to those of the
benchmark, and each hit is extended to the run that it was kept for, whose words
are compared in full; the work is in proportion to a text's length, however much
of it is benchmark text.  The k-gram and minimum arrays are made by doubling (pairs, fours, ...),
so a position costs a few array steps whatever the window.

The fingerprints of the benchmark are broadcast if there are at most
``BROADCAST_ROWS``; beyond that narrow rows meet in a shuffle and only hit
documents are read again.  Items shorter than ``WINDOW`` get a pass of their
own length, for the lengths that occur.

The arrays are exploded in the outer form (rows without entries fall to the
join) because Spark turns the plain form into a filter on the array's size,
which it would push through, and so multiply, every step that made the array.

Defined results: null texts have no words and are never hit; an empty
benchmark hits nothing; null item ids count in no list; rows that agree in id
and text get equal results, each its own row; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.llm.registry import query, table
from fathom.session import small_side

WINDOW = 13
GRAM = 6
BROADCAST_ROWS = 200_000      # windows of some hundred bytes
_UPPER, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOW))
    return F.filter(F.split(low, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def _shifted(df: DataFrame, name: str, a: str, b: str, by: int, of) -> DataFrame:
    """Column ``name``: of(a[i], b[i + by]) for each i for which both are there."""
    n = F.greatest(F.least(F.size(a), F.size(b) - by), F.lit(0))
    return df.withColumn(name, F.zip_with(F.slice(a, 1, n), F.slice(b, by + 1, n), of))


def _runs(df: DataFrame, base: str, length: int, of, name: str) -> DataFrame:
    """Column ``name``: ``of`` folded over each run of ``length`` neighbours, by doubling."""
    have, size, last = {1: base}, 1, base
    while size * 2 <= length:
        df = _shifted(df, f"{name}{size * 2}", last, last, size, of)
        size, last = size * 2, f"{name}{size * 2}"
        have[size] = last
    done = size
    while done < length:
        step = max(s for s in have if s <= length - done)
        df = _shifted(df, f"{name}{done + step}x", last, have[step], done, of)
        done, last = done + step, f"{name}{done + step}x"
    return df.withColumn(name, F.col(last)).drop(*[c for c in df.columns if c.startswith(name) and c != base])


def fingerprints(df: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """df (with ``words``) plus ``kept``: the smallest k-gram hash of each run of ``window`` words."""
    k = min(gram, window)
    df = df.withColumn("__h", F.transform("words", lambda w: F.xxhash64(w)))
    df = _runs(df, "__h", k, lambda a, b: F.xxhash64(a, b), "__g")
    df = _runs(df, "__g", window - k + 1, lambda a, b: F.least(a, b), "__m")
    return df.withColumn("kept", F.col("__m")).drop("__h", "__g", "__m")


def _text_of(words_col: str, start: Column, length: int) -> Column:
    return F.array_join(F.slice(F.col(words_col), start + 1, length), " ")


def windows(benchmark: DataFrame, length: int, id_col: str = "item_id", text_col: str = "text",
            gram: int = GRAM) -> DataFrame:
    """kept, window, item_id of each benchmark window of ``length`` words."""
    items = benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text_col)).alias("words"))
    n = F.size("words")
    items = items.filter(n >= WINDOW if length == WINDOW else n == length)
    return (fingerprints(items, length, gram).select("item_id", "words", F.posexplode_outer("kept").alias("at", "kept"))
            .filter(F.col("kept").isNotNull()).select("kept", _text_of("words", F.col("at"), length).alias("window"), "item_id").distinct())


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"),
                       words(F.col(text_col)).alias("words"))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.mark") == F.col(f"{b}.mark"))


def occurrences(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                gram: int = GRAM, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, mark, at, length, item_id: benchmark windows found in documents."""
    n = F.size(words(F.col(text_col)))
    lengths = sorted(r[0] for r in benchmark.select(F.least(n, F.lit(WINDOW)).alias("n")).distinct().collect() if r[0])
    found = []
    for length in lengths:
        bench = windows(benchmark, length, "item_id", "text", gram)
        small = bench.count() <= broadcast_rows
        hint = F.broadcast if small else (lambda df: df)
        marks = hint(bench.select("kept").distinct())
        made = fingerprints(_keyed(docs, id_col, text_col), length, gram)
        at_each = F.posexplode_outer("kept").alias("at", "kept")
        if small:
            hits = made.select("doc_id", "mark", "words", at_each).join(marks, "kept", "left_semi")
        else:
            narrow = made.select("doc_id", "mark", F.explode_outer(F.array_distinct("kept")).alias("kept")).join(
                marks, "kept", "left_semi").distinct()
            hit_docs = made.dropDuplicates(["doc_id", "mark"]).alias("d").join(
                narrow.select("doc_id", "mark").distinct().alias("h"), _same("d", "h"), "left_semi")
            # a document's hits as one list, so that its words travel once
            places = hit_docs.select("doc_id", "mark", at_each).alias("d").join(
                narrow.alias("h"), _same("d", "h") & (F.col("d.kept") == F.col("h.kept"))).groupBy("d.doc_id", "d.mark").agg(
                F.collect_list(F.struct("d.at", "d.kept")).alias("places"))
            hits = hit_docs.alias("d").join(places.alias("h"), _same("d", "h")).select(
                "d.doc_id", "d.mark", "d.words", F.explode_outer("h.places").alias("p")).select(
                "doc_id", "mark", "words", "p.at", "p.kept")
        runs = hits.select("doc_id", "mark", "at", "kept", _text_of("words", F.col("at"), length).alias("window"))
        found.append(runs.join(hint(bench), ["kept", "window"]).select(
            "doc_id", "mark", "at", F.lit(length).alias("length"), "item_id"))
    if not found:
        return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark"), F.lit(0).alias("at"),
                           F.lit(0).alias("length"), F.lit(None).cast("long").alias("item_id")).filter(F.lit(False))
    return reduce(DataFrame.unionByName, found)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  gram: int = GRAM, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: doc_id, mark, n_words, n_hit, items (sorted as strings), contaminated."""
    spans = occurrences(docs, benchmark, id_col, text_col, gram, broadcast_rows).groupBy("doc_id", "mark").agg(
        F.collect_set(F.struct("at", "length")).alias("spans"),
        F.collect_set(F.col("item_id").cast("string")).alias("items"))
    covered = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(
        s["at"], s["at"] + s["length"] - 1))))
    spans = spans.select("doc_id", "mark", F.size(covered).cast("long").alias("n_hit"), F.sort_array("items").alias("items"))
    each = _keyed(docs, id_col, text_col).select("doc_id", "mark", F.size("words").cast("long").alias("n_words"))
    joined = each.alias("e").join(spans.alias("s"), _same("e", "s"), "left")
    n_hit = F.coalesce("s.n_hit", F.lit(0).cast("long"))
    return joined.select("e.doc_id", "e.mark", "e.n_words", n_hit.alias("n_hit"),
                         F.coalesce("s.items", F.array().cast("array<string>")).alias("items"),
                         ((n_hit > 0) & (20 * n_hit >= F.col("e.n_words"))).alias("contaminated"))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows of docs that are not contaminated, with all their columns."""
    bad = contamination(docs, benchmark, id_col, text_col).filter("contaminated").select("doc_id", "mark").distinct()
    return docs.alias("d").join(small_side(bad).alias("b"), F.col(f"d.{id_col}").eqNullSafe(F.col("b.doc_id"))
                                & (F.xxhash64(f"d.{text_col}") == F.col("b.mark")), "left_anti")


_WORDS_SQL = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOW}'), "
              r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
SQL = rf"""
WITH d AS (SELECT doc_id, {_WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {_WORDS_SQL} AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
    SELECT item_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i
    FROM (SELECT *, least(len(w), 13) AS n FROM b WHERE len(w) > 0))),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS t FROM (
    SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i
    FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
m AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (n, t)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query("op7_winnowing_decontamination", SQL)
def op7_winnowing_decontamination(spark, sf_dir):
    found = contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"), "contaminated")

"""Periodic runs of words in texts, and texts without the repeats.

A run is a stretch of words with smallest period q, at least ``power`` periods
and ``shortest`` words long, that cannot be extended.  In terms of *matches*,
places i where word i equals word i + q, it is a maximal interval of matches.

Periods are taken an octave [P, 2P) at a time, with boundaries at every P-th
word.  A long enough run has a first boundary inside it whose next words recur
q further on, so boundaries whose gram of a few words recurs at no distance of
the octave are passed over, in one comparison of a document's gram hashes.
Documents are exploded into tiles, overlapping stretches of words with the
boundaries that are left; each tile is solved by itself, wherever it lands: the
Z-function of the words after a boundary gives how far each period goes on and
whether it is the smallest, that of the reversed words before it how far back.
The intervals of matches found are fragments; those of one document and period
are put together where they touch, and checked for length.

The table is written once to the shared folder after the words have been read:
documents without tiles are finished there, the texts of the others and the
tiles are read from it, so texts are never shuffled for documents without
repeats, and a document of any length is spread over tasks by its tiles.

Defined results: a null or empty text has no words and no runs.  Rows are kept
apart even where all columns are equal.  Extra columns are carried, but for
those that have the name of a result, which are replaced; an empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.llm.registry import query, table
from fathom.llm.stored import stored
from fathom.llm.textbatch import mix

POWER, SHORTEST = 4, 6
TILE = 4096            # words between the first boundaries of two tiles of the short octaves
LONGEST_GRAM = 16
_BATCH_BYTES = 8 << 20
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_TILE = "__octave int, __first long, __start long, __codes binary, __bounds array<long>"


def _codes(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int32, count=len(words))


def _gram(octave: int, power: int, shortest: int) -> int:
    """Words that are sure to recur after the first boundary inside a run of the octave; a power of two."""
    matches = min(max(shortest - q, (power - 1) * q) for q in range(octave, 2 * octave))
    return 1 << (min(LONGEST_GRAM, matches - (octave - 1)).bit_length() - 1)


def _octaves(n: int, power: int, shortest: int) -> Iterator[int]:
    octave = 1
    while n >= shortest and octave * power <= n:
        yield octave
        octave *= 2


def boundaries(codes: np.ndarray, power: int = POWER, shortest: int = SHORTEST) -> Iterator[tuple[int, np.ndarray]]:
    """(octave, boundaries whose next words recur at a distance of the octave)."""
    n = len(codes)
    grams = {1: mix(codes)}
    for octave in _octaves(n, power, shortest):
        size = _gram(octave, power, shortest)
        while size not in grams:
            k = max(grams)
            grams[2 * k] = grams[k][:-k] * _FACTOR + mix(grams[k][k:])
        h = grams[size]
        rows = -(-len(h) // octave)
        if rows < 2:
            continue
        grid = np.zeros(rows * octave, dtype=np.uint64)
        grid[:len(h)] = h
        grid = grid.reshape(rows, octave)
        same = grid[1:] == grid[:-1, :1]
        same[-1, len(h) - (rows - 1) * octave:] = False
        found = np.flatnonzero(same[:, :n // power - octave + 1].any(axis=1))
        if len(found):
            yield octave, found * octave


def tiles(codes: np.ndarray, power: int = POWER, shortest: int = SHORTEST) -> Iterator[tuple[int, int, int, bytes, list[int]]]:
    """(octave, first boundary, first word, word numbers as bytes, boundaries) of each tile with a boundary left."""
    for octave, found in boundaries(codes, power, shortest):
        width, ahead = max(octave, TILE), 3 * octave + _gram(octave, power, shortest)
        for part in np.split(found, np.flatnonzero(np.diff(found // width)) + 1):
            first = int(part[0] // width) * width
            start = max(0, first - octave)
            yield octave, first, start, codes[start:first + width + ahead].tobytes(), part.tolist()


def z_function(s: list[int]) -> list[int]:
    """For each place, how many items from there on equal those from the start on."""
    n = len(s)
    z = [n] + [0] * (n - 1) if n else []
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def fragments(octave: int, start: int, codes: np.ndarray, bounds: list[int], power: int = POWER,
              shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(period, first match, end of matches) around the boundaries of a tile, joined where they touch."""
    gram = _gram(octave, power, shortest)
    reach = octave + gram                   # a match that follows another boundary's gram belongs to that one
    words = codes.tolist()
    found: dict[int, list[list[int]]] = {}
    for bound in bounds:
        at = bound - start
        ahead = words[at:at + reach + 2 * octave]
        z = z_function(ahead)
        top = min(2 * octave - 1, len(ahead) - gram)
        repeated = set()                    # periods that are multiples of a smaller one of the same words
        for d in range(1, top // 2 + 1):
            if z[d] >= d and z[d] + d >= octave:
                repeated.update(range(max(2, -(-octave // d)) * d, min(top, z[d] + d) + 1, d))
        periods = [q for q in range(octave, top + 1) if z[q] >= gram and q not in repeated]
        if not periods:
            continue
        behind = words[max(0, at - octave):at]
        back = z_function(behind[::-1] + [-1] + words[max(0, at - octave):at + 2 * octave][::-1])
        end = len(behind) + 1 + min(at + 2 * octave, len(words))
        for q in periods:
            before, after = back[end - at - q], min(z[q], reach)
            if before < len(behind) and after < reach and before + after < max(shortest - q, (power - 1) * q):
                continue                    # all of it is here, and too short
            low, high = bound - before, bound + after
            mine = found.setdefault(q, [])
            if mine and low <= mine[-1][1]:
                mine[-1][0], mine[-1][1] = min(low, mine[-1][0]), max(high, mine[-1][1])
            else:
                mine.append([low, high])
    return [(q, low, high) for q, spans in found.items() for low, high in spans]


def stitched(found: DataFrame, keys: list[str], power: int = POWER, shortest: int = SHORTEST) -> DataFrame:
    """Runs (keys, start, length, period) of fragments (keys, period, low, high)."""
    ordered = Window.partitionBy(*keys, "period").orderBy("low", "high")
    before = F.max("high").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    apart = found.withColumn("__new", (before.isNull() | (F.col("low") > before)).cast("int"))
    joined = apart.withColumn("__span", F.sum("__new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    spans = joined.groupBy(*keys, "period", "__span").agg(F.min("low").alias("start"), F.max("high").alias("__end"))
    length = F.col("__end") - F.col("start") + F.col("period")
    return spans.select(*keys, "start", length.alias("length"), "period") \
        .where(F.col("length") >= F.greatest(F.lit(shortest), power * F.col("period")))


def without_repeats(words: list[bytes], runs: list[dict]) -> list[bytes]:
    """The words that no run contains after its first period."""
    keep = np.ones(len(words), dtype=bool)
    for r in runs:
        keep[r["start"] + r["period"]:r["start"] + r["length"]] = False
    return [words[i] for i in np.flatnonzero(keep)]


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()     # exactly space and 0x09-0x0D


def collapse(df: DataFrame, text_col: str = "text", keep_text: bool = True, power: int = POWER,
             shortest: int = SHORTEST) -> DataFrame:
    """df without its text, with n_words, runs (array of start, length, period, by start and period),
    ``collapsed`` (the text without repeats, words joined by a space; null if ``keep_text`` is off) and its
    digest ``collapsed_sha256``.  ``power`` is at least 3."""
    if power < 3 or shortest < 1:
        raise ValueError("runs need a power of 3 and a length of 1 at least")
    results = ["n_words", "runs", "collapsed", "collapsed_sha256"]
    kept = [f for f in df.schema if f.name not in (*results, text_col)]
    inside = T.StructType([T.StructField("__key", T.LongType()), T.StructField("__text", T.StringType()),
                           T.StructField("n_words", T.LongType()), T.StructField("collapsed", T.StringType()),
                           T.StructField("collapsed_sha256", T.StringType()),
                           *T._parse_datatype_string(_TILE).fields])
    names = [f.name for f in kept]
    clash = {n for n in names if n.startswith("__") and n in [*inside.names, "__source"]}
    if clash:       # a name of ours: carry the column under another one
        away = {n: f"{n}_{i}" for i, n in enumerate(sorted(clash))}
        out = collapse(df.withColumnsRenamed(away), text_col, keep_text, power, shortest)
        return out.withColumnsRenamed({b: a for a, b in away.items()})

    def finish(words: list[bytes]) -> tuple[str | None, str]:
        joined = b" ".join(words)
        return joined.decode("utf-8", "surrogatepass") if keep_text else None, hashlib.sha256(joined).hexdigest()

    def scan(batches):
        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([*[batch.schema.field(n) for n in names], *_arrow(inside)])
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows, cut, size = [], [], 0
                for key, text in zip(part.column("__key").to_pylist(), part.column("__source").to_pylist()):
                    words = _split(text)
                    before = len(cut)
                    for octave, first, start, codes, bounds in tiles(_codes(words), power, shortest):
                        cut.append((key, None, None, None, None, octave, first, start, codes, bounds))
                        size += len(codes)
                        if size > _BATCH_BYTES:
                            yield _rows(schema, names, cut, inside)
                            cut, size, before = [], 0, -1
                    more = len(cut) != before
                    rows.append((key, text if more else None, len(words), *((None, None) if more else finish(words)),
                                 None, None, None, None, None))
                if cut:
                    yield _rows(schema, names, cut, inside)
                made = _rows(schema, [], rows, inside)
                yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], *made.columns[len(names):]], schema=schema)

    def solve(batches):
        for batch in batches:
            out = []
            for key, octave, start, codes, bounds in zip(*(c.to_pylist() for c in batch.columns)):
                out += [(key, q, low, high) for q, low, high in fragments(
                    octave, start, np.frombuffer(codes, dtype=np.int32), bounds, power, shortest)]
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in cols], names=["__key", "period", "low", "high"])

    def rewrite(batches):
        for batch in batches:
            made = [finish(without_repeats(_split(t), r or [])) for t, r in
                    zip(batch.column("__text").to_pylist(), batch.column("runs").to_pylist())]
            cols = {f.name: batch.column(f.name) for f in kept} | {n: batch.column(n) for n in ("n_words", "runs")}
            cols["collapsed"] = pa.array([c for c, _ in made], type=pa.string())
            cols["collapsed_sha256"] = pa.array([d for _, d in made], type=pa.string())
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    keyed = df.select(*[F.col(f"`{n}`") for n in names], F.monotonically_increasing_id().alias("__key"),
                      F.col(text_col).cast("string").alias("__source"))
    read = stored(keyed.mapInArrow(scan, T.StructType([*[T.StructField(f.name, f.dataType) for f in kept], *inside.fields])), "runs")
    spread = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    cut = read.where("__octave IS NOT NULL").select("__key", "__octave", "__first", "__start", "__codes", "__bounds") \
        .repartition(spread, "__key", "__octave", "__first").drop("__first")
    found = cut.mapInArrow(solve, "__key long, period long, low long, high long")
    shape = F.struct(F.col("start"), F.col("period"), F.col("length"))
    runs = stitched(found, ["__key"], power, shortest).groupBy("__key").agg(F.sort_array(F.collect_list(shape)).alias("runs")) \
        .select("__key", F.transform("runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"),
                                                                r["period"].alias("period"))).alias("runs"))
    docs = read.where("__octave IS NULL")
    plain = [F.col(f"`{n}`") for n in names]
    none = F.array().cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    done = docs.where("collapsed_sha256 IS NOT NULL").select(*plain, "n_words", none.alias("runs"), "collapsed", "collapsed_sha256")
    open_ = docs.where("collapsed_sha256 IS NULL").join(runs, "__key", "left") \
        .select(*plain, "n_words", "__text", F.coalesce("runs", none).alias("runs"))
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in kept], *done.select(*results).schema.fields])
    return done.unionByName(open_.mapInArrow(rewrite, T.StructType([T.StructField(f.name, f.dataType) for f in schema])))


def _arrow(fields: T.StructType) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_type
    return [pa.field(f.name, to_arrow_type(f.dataType)) for f in fields]


def _rows(schema: pa.Schema, names: list[str], rows: list[tuple], fields: T.StructType) -> pa.RecordBatch:
    """Rows of our own columns, the carried ones null."""
    own = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), _arrow(fields))]
    carried = [pa.nulls(len(rows), type=f.type) for f in list(schema)[:len(schema) - len(own)]]
    return pa.RecordBatch.from_arrays([*carried, *own], schema=schema)


def with_repeated_ends(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in which one document in ten repeats a stretch of its words to the end.

    Which, from which word and with what period the checksum of the id says; a null id repeats nothing.
    """
    def run(batches):
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            texts = []
            for text, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist()):
                words = _split(text) if h is not None and h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    text = b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode("utf-8", "surrogatepass")
                texts.append(text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, type=pa.string())], names=["doc_id", "text"])

    kind = docs.schema["doc_id"].dataType
    return docs.select("doc_id", "text", F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")).alias("h")) \
        .mapInArrow(run, T.StructType([T.StructField("doc_id", kind), T.StructField("text", T.StringType())]))


@query("op12_periodic_runs")
def op12_periodic_runs(spark, sf_dir):
    """The longest run of each document, digests of all runs and of the text without repeats."""
    found = collapse(with_repeated_ends(table(spark, sf_dir, "documents")), keep_text=False)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))))
    out = found.withColumn("__best", best)
    start, length, period = -F.col("__best.start"), F.col("__best.length"), -F.col("__best.period")
    return out.select("doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
                      period.alias("period"), F.expr("(1000 * __best.length) div (-__best.period)").alias("exponent_milli"),
                      F.sha2(F.encode(lines, "UTF-8"), 256).alias("runs_sha256"), "collapsed_sha256")

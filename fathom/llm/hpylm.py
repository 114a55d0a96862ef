"""Language-model scoring with a hierarchical Pitman-Yor model.

Words follow a restaurant per context (``G_u``, one for every word that comes
before, and one for the start of a text), whose base is one shared restaurant of
words (``G``), whose base is uniform over the vocabulary and one unseen word.
All training tokens are customers, whatever their word or context; contexts
grow with the vocabulary.

Chinese-restaurant seating is sampled by blocked Gibbs: given the parent's
probability of a dish, the number of tables t of its c customers has weight
S_d(c, t) * b^t (generalised Stirling numbers; b = (strength + d * tables of the
restaurant) * parent probability).  Up to ``EXACT`` customers it is drawn from
those weights, beyond that from their approximation at the saddle point of the
generating function (Poisson for few tables, normal for many).  The tables become the customers of the shared
restaurant, which is sampled the same way.  Restaurants' totals are those of
the sweep before, so all dishes can be sampled side by side.  Scores use the
predictive probabilities averaged over ``SAMPLES`` sweeps after ``BURN_IN``.
Discounts come from the counts of counts, n1 / (n1 + 2 n2).

How the work is spread: the ``HEAD`` most frequent words are the head.  Pairs of
a head context and a head word are a table of fixed size, sampled on the driver
and broadcast, so no task gathers a frequent pair's occurrences.  Every other
token has a rare word or, failing that, a rare context, each with less than
N / HEAD of the N training tokens, so hashing that one to buckets can't give a
hot bucket.  Text is read in chunks whose (word, context, document) entries are
packed by bucket and written once as a table bucketed by it; the number of
buckets follows the number of tokens, and a task holds one bucket at a time.

A bucket has all customers of its rare words, but those of a rare context lie in
many buckets.  So each sweep is one job that reads the counts of the buckets and
the seating of the sweep before, and writes the new seating and, for the bucket
that owns a context, the context's tables here; the owner adds them up and
answers every bucket that asked, by places agreed on once.  Only the totals of
the head reach the driver.  Contexts are told apart by the first bits of their
hash, ``SPARE_BITS`` more than the vocabulary's logarithm: less than one in ten
million shares its restaurant with another, at any size.  What a bucket adds to
the scores leaves it packed by block of texts; the blocks follow the number of
tokens as the buckets do.

Defined results: null and empty texts have the end token only; rows with a null
id are training rows; rows that repeat an id and text share their score, each
its own row; without training rows every score is 0 (one unseen word); other
columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathom.llm import textbatch
from fathom.llm.labelled import fold
from fathom.llm.registry import query, table
from fathom.llm.stored import bucketed
from fathom.session import cut_lineage

HEAD = 1024
BUCKETS = 24          # at least
BUCKET_TOKENS = 1_000_000   # training tokens a bucket of words, so that what a task holds does not grow with the corpus
BIN_BUCKETS = 16      # buckets in a bin of the stored tables, at most unless bins reach MOST_BINS
MOST_BINS = 100_000
SPARE_BITS = 24       # of a context's hash beyond the logarithm of the vocabulary
BLOCKS = 64           # of texts, at least: a block's sums come packed from every bucket, a row each
BLOCK_TOKENS = 2_000_000   # training tokens a block of texts
MARK_BITS = 32        # of a text's hash, which tell texts of one id apart
BURN_IN = 3
SAMPLES = 4
EXACT = 96
STRENGTH = 1.0
SEED = 20
END = np.uint64(0x0E17D0E17D0E17D1)
START = np.uint64(0x51A2751A2751A275)
_TINY = 1e-300


# ---- sampling ----------------------------------------------------------

def log_stirling(d: float, most: int) -> np.ndarray:
    """log S_d(c, t) for 1 <= t <= c <= most (minus infinity elsewhere)."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, most + 1)
    for c in range(1, most):
        with np.errstate(divide="ignore"):
            stay = out[c, 1:] + np.log(np.maximum(c - d * t, _TINY))
        out[c + 1, 1:] = np.logaddexp(stay, out[c, :-1])
        out[c + 1, c + 2:] = -np.inf
    return out


def sample_tables(c: np.ndarray, b: np.ndarray, d: float, stirling: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of c customers of one dish, with weights S_d(c, t) b^t, for many dishes."""
    t = np.minimum(c, 1).astype(np.int64)
    exact = stirling.shape[0] - 1
    small = np.flatnonzero((c > 1) & (c <= exact))
    order = small[np.argsort(c[small], kind="stable")]
    sizes, starts = np.unique(c[order], return_index=True)
    for n, lo, hi in zip(sizes, starts, [*starts[1:], len(order)]):
        n = int(n)
        step = max(1, 2_000_000 // n)
        for i in range(lo, hi, step):
            rows = order[i:min(i + step, hi)]
            w = stirling[n, 1:n + 1][None, :] + np.log(np.maximum(b[rows], _TINY))[:, None] * np.arange(1, n + 1)
            w = np.exp(w - w.max(axis=1, keepdims=True))
            run = np.cumsum(w, axis=1)
            t[rows] = 1 + (run < (rng.random(len(rows)) * run[:, -1])[:, None]).sum(axis=1)
    large = np.flatnonzero(c > exact)
    if len(large):
        n, a = c[large].astype(np.float64), np.maximum(b[large], 1e-12)
        lo, hi = np.zeros(len(n)), np.ones(len(n))
        for _ in range(60):               # x ((1 - d) / (1 - x) + a (1 - x)^(d-1)) = n - 1 rises in x
            x = (lo + hi) / 2
            y = np.maximum(1 - x, 1e-15)
            over = x * ((1 - d) / y + a * y ** (d - 1)) > n - 1
            lo, hi = np.where(over, lo, x), np.where(over, x, hi)
        y = np.maximum(1 - (lo + hi) / 2, 1e-15)
        rest = a * (1 - y ** d) / d       # tables besides that of a marked customer
        cov = a * (1 - y) * y ** (d - 1)
        spread = (1 - y) * ((1 - d) / y ** 2 + a * y ** (d - 2) * (1 - d * (1 - y)))
        var = np.maximum(rest - cov * cov / np.maximum(spread, 1e-9), 0.0)
        few = rng.poisson(np.minimum(rest, 50.0))
        many = np.rint(rest + np.sqrt(var) * rng.standard_normal(len(n)))
        t[large] = np.clip(1 + np.where(rest < 50, few, many), 1, c[large])
    return t


@dataclass
class Totals:
    """What all restaurants of a sweep share: tables of each context, customers and tables of the shared one."""

    tables: np.ndarray
    customers: int
    shared_tables: int


@dataclass
class Model:
    """Fixed numbers of a fit."""

    vocabulary: int
    tokens: int
    d_context: float
    d_shared: float
    customers: np.ndarray     # training tokens of each context
    strength: float = STRENGTH

    def shared(self, c: np.ndarray, t: np.ndarray, of: Totals) -> np.ndarray:
        """Probability of words with c customers at t tables of the shared restaurant."""
        free = (self.strength + self.d_shared * of.shared_tables) / (self.vocabulary + 1)
        return (np.maximum(c - self.d_shared * t, 0) + free) / (self.strength + of.customers)

    def word(self, ctx: np.ndarray, c: np.ndarray, t: np.ndarray, parent: np.ndarray, of: Totals) -> np.ndarray:
        free = self.strength + self.d_context * of.tables[ctx]
        return (np.maximum(c - self.d_context * t, 0) + free * parent) / (self.strength + self.customers[ctx])

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1)))


class Dishes:
    """Counts of (word, context) for a group of words, and their seating sweep by sweep."""

    def __init__(self, word: np.ndarray, ctx: np.ndarray, count: np.ndarray, n_words: int):
        self.word, self.ctx, self.count, self.n_words = word, ctx, count, n_words
        self.t = np.minimum(count, 1)
        self.c_shared = np.bincount(word, weights=self.t, minlength=n_words).astype(np.int64)
        self.t_shared = np.minimum(self.c_shared, 1)

    def sweep(self, model: Model, before: Totals, stirling: tuple[np.ndarray, np.ndarray], rng,
              head: np.ndarray | None = None) -> None:
        """Seat all customers anew; ``head``: probabilities of the first words, whose customers lie elsewhere too."""
        parent = model.shared(self.c_shared, self.t_shared, before)
        if head is not None:
            parent[:len(head)] = head
        b = (model.strength + model.d_context * before.tables[self.ctx]) * parent[self.word]
        self.t = sample_tables(self.count, b, model.d_context, stirling[0], rng)
        self.c_shared = np.bincount(self.word, weights=self.t, minlength=self.n_words).astype(np.int64)
        self.t_shared = shared_tables(model, before, self.c_shared, stirling[1], rng)

    def sums(self, n_ctx: int) -> np.ndarray:
        """Tables of each context, then customers and tables of the shared restaurant."""
        return np.concatenate([np.bincount(self.ctx, weights=self.t, minlength=n_ctx),
                               [self.c_shared.sum(), self.t_shared.sum()]]).astype(np.int64)


def shared_tables(model: Model, before: Totals, c: np.ndarray, stirling: np.ndarray, rng) -> np.ndarray:
    """Tables that words with c customers take in the shared restaurant."""
    free = (model.strength + model.d_shared * before.shared_tables) / (model.vocabulary + 1)
    return sample_tables(c, np.full(len(c), free), model.d_shared, stirling, rng)


# ---- reading text ------------------------------------------------------

class Reader:
    """Tokens of texts by their numbers: head words have their place, the start of a text comes
    after them, and any other word or context is -1 and known by its hash."""

    def __init__(self, head: np.ndarray):
        self.order = np.argsort(head)
        self.head, self.n = head[self.order], len(head)

    def place(self, h: np.ndarray) -> np.ndarray:
        """Index of each hash among the head words (in their sorted order), or -1."""
        if not self.n:
            return np.full(len(h), -1, dtype=np.int64)
        at = np.minimum(np.searchsorted(self.head, h), self.n - 1)
        return np.where(self.head[at] == h, at, -1)

    def tokens(self, texts: pa.Array):
        """(first text, texts, word place, context place, word, context, text) of slices of texts, the end token last."""
        for w in textbatch.words(texts):
            n = len(w.hash)
            starts = np.concatenate([[0], np.cumsum(w.count + 1)])
            h = np.full(int(starts[-1]), END, dtype=np.uint64)
            h[np.arange(n) + w.text] = w.hash
            place = self.place(h)
            before, u = np.empty_like(place), np.empty_like(h)
            before[1:], u[1:] = place[:-1], h[:-1]
            before[starts[:-1]], u[starts[:-1]] = self.n, START
            yield w.first, w.n_texts, place, before, h, u, np.repeat(np.arange(w.n_texts), w.count + 1)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    u, inverse = np.unique(k, return_inverse=True)
    return u, np.bincount(inverse, weights=c, minlength=len(u)).astype(np.int64)


def vocabulary(docs: DataFrame, limit: int = 1_000_000) -> DataFrame:
    """word, c: each training word (hash), the end token included, and its count."""
    def run(batches):
        keys, counts, size = [], [], 0

        def out():
            k, c = _merged(keys, counts)
            return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], names=["word", "c"])

        for b in batches:
            for w in textbatch.words(b.column(b.schema.get_field_index("text"))):
                k, c = np.unique(w.hash, return_counts=True)
                keys += [k, np.array([END])]
                counts += [c, np.array([w.n_texts])]
                size += len(k)
                if size > limit:
                    yield out()
                    keys, counts, size = [], [], 0
        if keys:
            yield out()

    return docs.filter("train").select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(
        F.sum("c").alias("c"))


def head_counts(docs: DataFrame, head) -> DataFrame:
    """pair, c: training counts of (head context, head word) as context * head size + word.

    A task adds up in one table of contexts x head words, whose size is fixed.
    """
    def run(batches):
        reader = Reader(head.value)
        total = np.zeros((reader.n + 1) * reader.n, dtype=np.int64)
        for b in batches:
            for _, _, place, before, _, _, _ in reader.tokens(b.column(b.schema.get_field_index("text"))):
                hit = (place >= 0) & (before >= 0)
                total += np.bincount(before[hit] * reader.n + place[hit], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["pair", "c"])

    return docs.filter("train").select("text").mapInArrow(run, "pair long, c long").groupBy("pair").agg(
        F.sum("c").alias("c"))


# ---- entries of all other pairs, packed by bucket ------------------------

_FIELD = struct.Struct("<2sq")
CHUNK_TOKENS = 1_000_000


def _small(a: np.ndarray) -> np.ndarray:
    """Numbers from 0 in their smallest type."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed byte string: type and length of each, then their bytes, the lowest of all numbers first."""
    heads = [_FIELD.pack(a.dtype.str[1:].encode(), len(a)) for a in arrays]
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes() if len(a) else b"" for a in arrays]
    return zlib.compress(b"".join([bytes([len(arrays)]), *heads, *planes]), 1)


def _unpack(z: bytes) -> list[np.ndarray]:
    data = zlib.decompress(z)
    fields = [_FIELD.unpack_from(data, 1 + i * _FIELD.size) for i in range(data[0])]
    out, at = [], 1 + data[0] * _FIELD.size
    for kind, n in fields:
        kind = np.dtype("<" + kind.decode())
        planes = np.frombuffer(data, dtype=np.uint8, count=n * kind.itemsize, offset=at).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return out


def _steps(a: np.ndarray) -> np.ndarray:
    """Differences of rising numbers, undone by a running sum."""
    return np.diff(a, prepend=a.dtype.type(0))


def owner(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a rare word or context; rises with the hash."""
    return (h >> np.uint64(32)).astype(np.int64) * buckets >> 32


def packed_entries(docs: DataFrame, head, buckets: int, bits: int = 64) -> DataFrame:
    """bucket, payload: the tokens with a rare word or context in a chunk of texts, all rows of docs.

    A payload has ids, marks and flags of documents, the sorted hashes of rare words and the first ``bits``
    of those of rare contexts (both numbered after the head and the start), and word, context and document of
    each entry; what is sorted is kept as differences.
    """
    shift = np.uint64(64 - bits)

    def packed(parts, ids, marks, flags, n):
        place, before, h, u, doc = (np.concatenate(x) for x in zip(*parts))
        of = owner(np.where(place < 0, h, u), buckets)
        order = np.argsort(of, kind="stable")
        cuts = np.searchsorted(of[order], np.arange(buckets + 1))
        rows, payloads = [], []
        for k in np.flatnonzero(np.diff(cuts)):
            i = order[cuts[k]:cuts[k + 1]]
            w, c = place[i].astype(np.int64), before[i].astype(np.int64)
            words, contexts = np.unique(h[i][w < 0]), np.unique(u[i][c < 0] >> shift)
            w = np.where(w < 0, n + 1 + np.searchsorted(words, h[i]), w)
            c = np.where(c < 0, n + 1 + np.searchsorted(contexts, u[i] >> shift), c)
            here, local = np.unique(doc[i], return_inverse=True)
            by = np.argsort(w << 32 | c, kind="stable")
            rows.append(k)
            payloads.append(_pack(ids[here], marks[here], flags[here], _steps(words), _steps(contexts),
                                  _small(_steps(w[by])), _small(c[by]), _small(local[by])))
        return pa.RecordBatch.from_arrays([pa.array(rows, pa.int32()), pa.array(payloads, pa.binary())],
                                          names=["bucket", "payload"])

    def run(batches):
        reader = Reader(head.value)
        for b in batches:
            ids = b.column(b.schema.get_field_index("doc_id"))
            flags = (b.column(b.schema.get_field_index("train")).to_numpy(zero_copy_only=False).astype(np.uint8)
                     + 2 * ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8))
            of_doc = (ids.fill_null(0).to_numpy(zero_copy_only=False),
                      b.column(b.schema.get_field_index("mark")).to_numpy(zero_copy_only=False),
                      flags.astype(np.uint8), reader.n)
            parts, size = [], 0
            for first, _, place, before, h, u, own in reader.tokens(b.column(b.schema.get_field_index("text"))):
                rest = (place < 0) | (before < 0)
                parts.append((place[rest].astype(np.int32), before[rest].astype(np.int32), h[rest], u[rest],
                              (own[rest] + first).astype(np.int32)))
                size += len(parts[-1][0])
                if size >= CHUNK_TOKENS:
                    yield packed(parts, *of_doc)
                    parts, size = [], 0
            if size:
                yield packed(parts, *of_doc)

    return docs.mapInArrow(run, "bucket int, payload binary")


class Bucket:
    """All entries of one bucket: its distinct pairs, and the training counts of those."""

    def __init__(self, payloads: list[bytes], n: int):
        got = [_unpack(z) for z in payloads]
        self.ids, self.marks, self.flags = (np.concatenate([a[i] for a in got]) for i in (0, 1, 2))
        names = [[np.cumsum(a[i], dtype=np.uint64) for a in got] for i in (3, 4)]
        words, self.contexts = (np.unique(np.concatenate(x)) for x in names)
        self.n_words = n + 1 + len(words)
        offsets = np.concatenate([[0], np.cumsum([len(a[0]) for a in got])]).astype(np.int64)
        self.doc = np.concatenate([(a[7] + offsets[i]).astype(np.int32) for i, a in enumerate(got)])
        pairs = []
        for a, w, c in zip(got, *names):       # numbers of the chunk to numbers of the bucket
            w, c = (np.concatenate([np.arange(n + 1), n + 1 + np.searchsorted(of, x)])
                    for of, x in ((words, w), (self.contexts, c)))
            pairs.append(w[np.cumsum(a[5], dtype=np.int64)] << 32 | c[a[6]])
        self.pairs, self.place = np.unique(np.concatenate(pairs), return_inverse=True)
        train = (self.flags & 1).astype(bool)[self.doc]
        self.count = np.bincount(self.place[train], minlength=len(self.pairs))
        self.word, self.ctx = self.pairs >> 32, self.pairs & 0xFFFFFFFF

    def counts(self) -> bytes:
        """Pairs and counts, without the entries."""
        return _pack(np.array([self.n_words]), _steps(self.contexts), _small(_steps(self.word)), _small(self.ctx),
                     _small(self.count))

    def seating(self, n: int) -> Seating:
        return Seating(self.n_words, self.contexts, self.word, self.ctx, self.count, n)

    def scores(self, p: np.ndarray, base: np.ndarray, known: np.ndarray, blocks: int) -> pa.Table:
        """block, payload: the sums over the entries of each text, a row for each block of texts."""
        add = lambda x: np.bincount(self.doc, weights=x[self.place], minlength=len(self.ids)).astype(np.float64)
        ids, valid = self.ids.astype(np.uint64), self.flags & 2
        mixed = (ids + self.marks.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        block = owner(mixed, blocks)
        order = np.lexsort((ids, block))
        cuts = np.searchsorted(block[order], np.arange(blocks + 1))
        sums = self.marks, valid, add(base), add(np.log10(np.maximum(p, _TINY))), _small(add(known).astype(np.int64))
        some = np.flatnonzero(np.diff(cuts))
        parts = [order[cuts[k]:cuts[k + 1]] for k in some]
        return pa.table([pa.array(some, pa.int32()), pa.array([_pack(_small(_steps(ids[i])), *[x[i] for x in sums]) for i in parts],
                                                              pa.binary())], names=["block", "payload"])


def texts_of_block(t: pa.Table) -> pa.Table:
    """doc_id, mark, base_score, score, n_known of the texts of a block, from what all buckets have of them."""
    got = [_unpack(z) for z in t.column("payload").to_pylist()]
    ids = np.concatenate([np.cumsum(a[0], dtype=np.uint64) for a in got]).astype(np.int64)
    marks, valid, base, score, known = (np.concatenate([a[i] for a in got]) for i in range(1, 6))
    order = np.lexsort((marks, ids, valid))
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for x in (marks, ids, valid):
        new[1:] |= np.diff(x[order]) != 0
    first = np.flatnonzero(new)
    at = order[first]
    add = lambda x: np.add.reduceat(x[order], first)
    return pa.table([pa.array(ids[at], mask=valid[at] == 0), pa.array(marks[at]), pa.array(add(base)), pa.array(add(score)),
                     pa.array(add(known.astype(np.int64)))], names=["doc_id", "mark", "base_score", "score", "n_known"])


# ---- seating by bucket ----------------------------------------------------

# what a row (bucket, kind, other, payload) of the seating tables holds
COUNTS, SEATS, ASK, ANSWER, PLACES, SUMS = range(6)
ROW = "bucket int, kind int, other int, payload binary"


def _rows(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) or [[]] * 4
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                    names=["bucket", "kind", "other", "payload"])


def _payloads(t: pa.Table, kind: int) -> list[tuple[int, list[np.ndarray]]]:
    """(other, arrays) of the rows of a kind, by other."""
    got = [(o, z) for k, o, z in zip(*(t.column(c).to_pylist() for c in ("kind", "other", "payload"))) if k == kind]
    return [(o, _unpack(z)) for o, z in sorted(got, key=lambda x: x[0])]


def _asks(bucket: int, cuts: np.ndarray, *values: np.ndarray, contexts=()) -> list[tuple[int, int, int, bytes]]:
    """Values of the contexts asked for, after their names where given, a row for each bucket that owns some of them."""
    parts = [slice(cuts[k], cuts[k + 1]) for k in range(len(cuts) - 1)]
    return [(bucket, ASK, int(k), _pack(*[_steps(c[parts[k]]) for c in contexts], *[v[parts[k]] for v in values]))
            for k in np.flatnonzero(np.diff(cuts))]


class Seating:
    """The dishes of a bucket and the rare contexts it has to ask for."""

    def __init__(self, n_words: int, contexts: np.ndarray, word: np.ndarray, ctx: np.ndarray, count: np.ndarray, n: int):
        self.contexts, self.n, self.n_ctx = contexts, n, n + 1 + len(contexts)
        self.dishes = Dishes(word.astype(np.int64), ctx.astype(np.int64), count.astype(np.int64), n_words)

    @staticmethod
    def stored(payload: list[np.ndarray], n: int) -> Seating:
        n_words, contexts, steps, ctx, count = payload
        return Seating(int(n_words[0]), np.cumsum(contexts, dtype=np.uint64), np.cumsum(steps, dtype=np.int64), ctx, count, n)

    def cuts(self, buckets: int, bits: int) -> np.ndarray:
        """Where the contexts of each owner begin."""
        return np.searchsorted(owner(self.contexts << np.uint64(64 - bits), buckets), np.arange(buckets + 1))

    def by_context(self, head: np.ndarray, answers: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([head, *answers]).astype(np.int64)

    def take(self, seats: list[np.ndarray]) -> None:
        d = self.dishes
        d.t, d.t_shared = (a.astype(np.int64) for a in seats)
        d.c_shared = np.bincount(d.word, weights=d.t, minlength=d.n_words).astype(np.int64)

    def tables(self) -> np.ndarray:
        return np.bincount(self.dishes.ctx, weights=self.dishes.t, minlength=self.n_ctx).astype(np.int64)

    def sums(self, tables: np.ndarray) -> np.ndarray:
        """Tables of head contexts, customers of head words, customers and tables of rare words."""
        d, n = self.dishes, self.n
        return np.concatenate([tables[:n + 1], d.c_shared[:n], [d.c_shared[n + 1:].sum(), d.t_shared[n + 1:].sum()]])


def first_seating(buckets: int, bits: int, n: int):
    """From the entries of a bucket: its counts, what it asks, and its sums with every pair at one table."""
    def run(key, t):
        k = key[0].as_py()
        b = Bucket(t.column("payload").to_pylist(), n)
        seating = b.seating(n)
        d, tables = seating.dishes, seating.tables()
        customers = np.bincount(d.ctx, weights=d.count, minlength=seating.n_ctx).astype(np.int64)
        rare = d.c_shared[n + 1:]
        sums = np.concatenate([seating.sums(tables), customers[:n + 1],
                               [(d.count == 1).sum(), (d.count == 2).sum(), (rare == 1).sum(), (rare == 2).sum()]])
        rest = slice(n + 1, None)
        cuts = seating.cuts(buckets, bits)
        return _rows([(k, COUNTS, k, b.counts()), (k, SEATS, k, _pack(_small(d.t), _small(d.t_shared))),
                      (k, SUMS, k, _pack(sums.astype(np.int64))),
                      *_asks(k, cuts, _small(tables[rest]), _small(customers[rest]), contexts=[seating.contexts])])

    return run


def first_answers(key, t):
    """By the bucket that owns them: tables and customers of contexts, and where each asker's contexts are among them."""
    k = key[0].as_py()
    got = _payloads(t.select(["bucket", "kind", "payload"]).rename_columns(["other", "kind", "payload"]), ASK)
    _, place = np.unique(np.concatenate([np.cumsum(a[0], dtype=np.uint64) for _, a in got]), return_inverse=True)
    cuts = np.cumsum([len(a[0]) for _, a in got])[:-1]
    total = [np.bincount(place, weights=np.concatenate([a[i] for _, a in got])).astype(np.int64) for i in (1, 2)]
    rows = []
    for (asker, _), at in zip(got, np.split(place, cuts)):
        rows += [(k, PLACES, asker, _pack(_small(at))), (k, ANSWER, asker, _pack(*[_small(v[at]) for v in total]))]
    return _rows(rows)


def answers(key, places, asks):
    """``first_answers`` of a later sweep, with the places agreed on."""
    k = key[0].as_py()
    at = dict(_payloads(places, PLACES))
    got = _payloads(asks.select(["bucket", "kind", "payload"]).rename_columns(["other", "kind", "payload"]), ASK)
    if not got:
        return _rows([])
    total = np.bincount(np.concatenate([at[o][0] for o, _ in got]), weights=np.concatenate([a[0] for _, a in got])).astype(np.int64)
    return _rows([(k, ANSWER, o, _pack(_small(total[at[o][0]]))) for o, _ in got])


def one_sweep(model: Model, before: Totals, head: np.ndarray, stirling, buckets: int, bits: int, n: int, number: int):
    """From a bucket's counts, its seats and the answers to it: the next seats, asks and sums."""
    def run(key, counts, state):
        k = key[0].as_py()
        seating = Seating.stored(_payloads(counts, COUNTS)[0][1], n)
        seating.take(_payloads(state, SEATS)[0][1])
        told = [a[0] for _, a in _payloads(state, ANSWER)]
        of = replace(before, tables=seating.by_context(before.tables, told))
        d = seating.dishes
        d.sweep(model, of, stirling, np.random.default_rng([SEED, k, number]), head)
        tables = seating.tables()
        return _rows([(k, SEATS, k, _pack(_small(d.t), _small(d.t_shared))), (k, SUMS, k, _pack(seating.sums(tables))),
                      *_asks(k, seating.cuts(buckets, bits), _small(tables[n + 1:]))])

    return run


def scored_bucket(model: Model, samples: list[tuple[int, Totals, np.ndarray]], base_head: np.ndarray, n: int, blocks: int):
    """From a bucket's entries and, for each sample, its seats and the answers: sums for each text, by block of texts."""
    def run(key, entries, state):
        b = Bucket(entries.column("payload").to_pylist(), n)
        seating = b.seating(n)
        number = np.asarray(state.column("sweep"))
        first = [a[1] for _, a in _payloads(state.filter(pa.array(number == 0)), ANSWER)]
        full = replace(model, customers=seating.by_context(model.customers, first))
        p, d = np.zeros(len(b.pairs)), seating.dishes
        for s, of, head in samples:
            mine = state.filter(pa.array(number == s))
            seating.take(_payloads(mine, SEATS)[0][1])
            told = [a[0] for _, a in _payloads(mine, ANSWER)]
            of = replace(of, tables=seating.by_context(of.tables, told))
            parent = full.shared(d.c_shared, d.t_shared, of)
            parent[:n] = head
            p += full.word(d.ctx, d.count, d.t, parent[d.word], of)
        c = np.bincount(d.word, weights=d.count, minlength=d.n_words).astype(np.int64)
        base = full.base(c)
        base[:n] = base_head
        known = c > 0
        known[:n] = True
        return b.scores(p / max(len(samples), 1), base[d.word], known[d.word].astype(np.float64), blocks)

    return run


def _discount(n1: int, n2: int) -> float:
    return float(np.clip(n1 / (n1 + 2 * n2), 0.1, 0.95)) if n1 + n2 else 0.5


def _added(rows: DataFrame, size: int) -> np.ndarray:
    """The arrays of SUMS rows added up, ``size`` numbers; tasks add up theirs first."""
    def run(batches):
        v = np.zeros(size, dtype=np.int64)
        for b in batches:
            for z in b.column(0):
                v += _unpack(z.as_py())[0]
        k = np.flatnonzero(v)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int64)), pa.array(v[k])], names=["k", "v"])

    got = rows.filter(F.col("kind") == SUMS).select("payload").mapInArrow(run, "k long, v long").groupBy("k").agg(
        F.sum("v").alias("v")).collect()
    out = np.zeros(size, dtype=np.int64)
    for r in got:
        out[r["k"]] = r["v"]
    return out


def score_texts(docs: DataFrame, train, id_col: str = "doc_id", text_col: str = "text", head_words: int = HEAD,
                buckets: int | None = None, burn_in: int = BURN_IN, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each text; ``train``: a condition on rows."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.shiftrightunsigned(F.xxhash64(F.col(text_col)), 64 - MARK_BITS).alias("mark"), F.coalesce(train, F.lit(True)).alias("train"))

    vocab = cut_lineage(vocabulary(docs))
    size, tokens = vocab.agg(F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0))).first()
    buckets = buckets or max(BUCKETS, -(-int(tokens) // BUCKET_TOKENS))
    top = vocab.orderBy(F.desc("c"), "word").limit(head_words).collect()
    head = np.array([r["word"] for r in top], dtype=np.int64).view(np.uint64)
    shared = sc.broadcast(head)
    reader = Reader(head)
    n = reader.n
    head_c = np.array([r["c"] for r in top], dtype=np.int64)[reader.order] if top else np.zeros(0, np.int64)

    found = head_counts(docs, shared).toArrow()            # at most (head words + 1) x head words rows
    pair = np.array(found.column("pair"), dtype=np.int64)
    order = np.argsort(pair)
    pair, count = pair[order], np.array(found.column("c"), dtype=np.int64)[order]
    dense = Dishes(pair % max(n, 1), pair // max(n, 1), count, n)

    bits = min(64, max(32, int(size).bit_length() + SPARE_BITS))
    bins = min(max(-(-buckets // BIN_BUCKETS), int(spark.conf.get("spark.sql.shuffle.partitions"))), MOST_BINS)
    entries = bucketed(packed_entries(docs, shared, buckets, bits).repartition(bins, "bucket"), "entries", bins)
    start = bucketed(entries.groupBy("bucket").applyInArrow(first_seating(buckets, bits, n), ROW), "start", bins, ("kind",))
    told = bucketed(start.filter(F.col("kind") == ASK).groupBy(F.col("other")).applyInArrow(first_answers, ROW),
                    "told", bins, ("kind",))
    counts, places = start.filter(F.col("kind") == COUNTS), told.filter(F.col("kind") == PLACES)

    def to_asker(rows: DataFrame) -> DataFrame:
        return rows.select(F.col("other").alias("bucket"), "kind", F.col("bucket").alias("other"), "payload")

    got = _added(start, 3 * n + 8)
    model = Model(int(size), int(tokens), 0.5, 0.5, got[2 * n + 3:3 * n + 4]
                  + np.bincount(dense.ctx, weights=dense.count, minlength=n + 1).astype(np.int64))
    c_head = got[n + 1:2 * n + 1] + dense.c_shared
    t_head = np.minimum(c_head, 1)
    n1, n2 = (int(got[3 * n + 4 + i] + (dense.count == i + 1).sum()) for i in (0, 1))
    s1, s2 = (int(got[3 * n + 6 + i] + (c_head == i + 1).sum()) for i in (0, 1))
    model = replace(model, d_context=_discount(n1, n2), d_shared=_discount(s1, s2))
    stirling = log_stirling(model.d_context, EXACT), log_stirling(model.d_shared, EXACT)

    def totals() -> Totals:
        return Totals(got[:n + 1] + dense.sums(n + 1)[:n + 1], int(got[2 * n + 1] + c_head.sum()),
                      int(got[2 * n + 2] + t_head.sum()))

    seats = start.filter(F.col("kind") == SEATS)
    answer = to_asker(told.filter(F.col("kind") == ANSWER))
    kept = [answer.withColumn("sweep", F.lit(0))]
    of, used, table_p = totals(), [], np.zeros((n + 1, n))
    for s in range(1, burn_in + samples + 1):
        parent = model.shared(c_head, t_head, of)
        run = one_sweep(model, of, parent, stirling, buckets, bits, n, s)
        swept = cut_lineage(counts.groupBy("bucket").cogroup(seats.unionByName(answer).groupBy("bucket")).applyInArrow(run, ROW))
        answer = cut_lineage(to_asker(places.groupBy("bucket").cogroup(
            swept.filter(F.col("kind") == ASK).groupBy("other")).applyInArrow(answers, ROW)))
        rng = np.random.default_rng([SEED, buckets, s])
        dense.sweep(model, of, stirling, rng, parent)
        got = _added(swept, 2 * n + 3)
        c_head = got[n + 1:2 * n + 1] + dense.c_shared
        t_head = shared_tables(model, of, c_head, stirling[1], rng)
        of = totals()
        seats = swept.filter(F.col("kind") == SEATS)
        if s > burn_in:
            parent = model.shared(c_head, t_head, of)
            used.append((s, of, parent))
            kept.append(seats.unionByName(answer).withColumn("sweep", F.lit(s)))
            dense_c, dense_t = np.zeros((2, n + 1, n))
            dense_c[dense.ctx, dense.word], dense_t[dense.ctx, dense.word] = dense.count, dense.t
            table_p += model.word(np.arange(n + 1)[:, None], dense_c, dense_t, parent[None, :], of)
    logs = sc.broadcast(np.log10(np.maximum(table_p / max(samples, 1), _TINY)))
    base_head = model.base(head_c)

    def frequent(batches):
        mine = Reader(shared.value)
        for b in batches:
            ids, marks = b.column(b.schema.get_field_index("doc_id")), b.column(b.schema.get_field_index("mark"))
            for first, m, place, before, _, _, own in mine.tokens(b.column(b.schema.get_field_index("text"))):
                hit = (place >= 0) & (before >= 0)
                own_hit, p = own[hit], place[hit]
                add = lambda x: np.bincount(own_hit, weights=x, minlength=m).astype(np.float64)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, m), marks.slice(first, m), pa.array(add(base_head[p])),
                     pa.array(add(logs.value[before[hit], p])), pa.array(add(np.ones(len(p))).astype(np.int64)),
                     pa.array(np.bincount(own, minlength=m).astype(np.int64))],
                    names=["doc_id", "mark", "base_score", "score", "n_known", "n_tokens"])

    state = kept[0]
    for k in kept[1:]:
        state = state.unionByName(k)
    sums = "doc_id long, mark long, base_score double, score double, n_known long"
    blocks = max(BLOCKS, -(-int(tokens) // BLOCK_TOKENS))
    parts = entries.groupBy("bucket").cogroup(state.groupBy("bucket")).applyInArrow(
        scored_bucket(model, used, base_head, n, blocks), "block int, payload binary") \
        .groupBy("block").applyInArrow(texts_of_block, sums).withColumn("n_tokens", F.lit(0).cast("long")).withColumn("rows", F.lit(0))
    whole = docs.select("doc_id", "mark", "text").mapInArrow(frequent, sums + ", n_tokens long").withColumn("rows", F.lit(1))
    names = ("n_tokens", "n_known", "base_score", "score")
    out = parts.unionByName(whole).groupBy("doc_id", "mark").agg(
        *[F.sum(c).alias(c) for c in names], F.sum("rows").cast("int").alias("rows"))
    each = [(F.col(c) / F.col("rows")).cast("long" if c.startswith("n_") else "double").alias(c) for c in names]
    return out.select("doc_id", *each, F.explode(F.sequence(F.lit(1), F.col("rows"))).alias("copy")).drop(
        "copy").withColumn("train_tokens", F.lit(int(tokens)).cast("long"))


def perplexity(scored: DataFrame) -> DataFrame:
    """held_out, perplexity and base_perplexity per token of scored texts."""
    return scored.groupBy("held_out").agg(
        F.pow(F.lit(10.0), -F.sum("score") / F.sum("n_tokens")).alias("perplexity"),
        F.pow(F.lit(10.0), -F.sum("base_score") / F.sum("n_tokens")).alias("base_perplexity"))


@query("op10_hpylm_scoring")
def op10_hpylm_scoring(spark, sf_dir):
    held_out = fold(F.col("doc_id")) == 1
    scored = score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), ~held_out)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")

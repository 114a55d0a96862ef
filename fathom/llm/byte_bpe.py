"""Byte-level BPE encoding and decoding by prefix dynamic programming.

A run of tokens is what the merges give exactly if every two neighbours are
(``fits``), so each prefix of a piece has one valid last token: the token that
ends there and fits the last token of the prefix before it.  ``PrefixTable``
stores that token for each byte prefix.  Appending bytes only adds entries;
after an edit, entries are made anew from the edit on until as many of them as
the longest token has bytes agree with the old ones, and the rest stays.

Texts are split by the tokenizer's pattern first, and each piece is encoded by
itself; a piece that is a token is that token.  Special tokens are not read.

Defined results: null text is empty and has no tokens; extra columns are
carried; any ids decode to bytes, and the bytes of an encoded text are its
UTF-8 bytes.
"""

from __future__ import annotations

import base64
import sys
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.llm.registry import query, table

RANKS = "byte_bpe_50k.tiktoken"
CACHED_PIECES = 200_000
CACHED_PAIRS = 300_000
_NONE: dict = {}


class Vocabulary:
    """Ranks of byte strings, with the merges they stand for."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks), default=1)
        self.backwards: dict = {}      # tokens read from their last byte on: byte -> [token or -1, next bytes]
        for t, i in ranks.items():
            below = self.backwards
            for b in reversed(t):
                node = below.setdefault(b, [-1, {}])
                below = node[1]
            node[0] = i
        self._fits: dict[int, dict[int, bool]] = {}
        self._pairs = 0

    def merged(self, piece: bytes) -> list[int]:
        """The merges themselves, lowest rank and leftmost first; for short byte strings."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], sys.maxsize), i) for i in range(len(parts) - 1))
            if rank == sys.maxsize:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges of left's and right's bytes give these two tokens; left -1: the start."""
        known = self._fits.get(left, _NONE).get(right)
        if known is None:
            if self._pairs >= CACHED_PAIRS:
                self._fits.clear()
                self._pairs = 0
            before = self.tokens[left] if left >= 0 else b""
            known = self.merged(before + self.tokens[right]) == ([left, right] if left >= 0 else [right])
            self._fits.setdefault(left, {})[right] = known
            self._pairs += 1
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        known = self.ranks.get(piece)
        if known is not None:
            return [known]
        last = [-1]
        self.extend(piece, last, len(piece))
        return self.path(piece, last)

    def extend(self, data: bytes, last: list[int], stop: int) -> None:
        """Append to ``last`` the valid last token of each further prefix of data, up to ``stop`` bytes."""
        first, known = self.backwards, self._fits
        for end in range(len(last), stop + 1):
            below, at = first, end
            while at:
                at -= 1
                node = below.get(data[at])
                if node is None:
                    raise ValueError("the vocabulary lacks a byte of the text")
                token, below = node
                if token >= 0:
                    left = last[at]
                    try:
                        ok = known[left][token]
                    except KeyError:
                        ok = self.fits(left, token)
                    if ok:
                        last.append(token)
                        break
            else:
                raise ValueError("the vocabulary lacks a byte of the text")

    def path(self, data: bytes, last: list[int]) -> list[int]:
        """The tokens of all of data, from its prefixes' last tokens."""
        out, end, tokens = [], len(data), self.tokens
        while end:
            out.append(last[end])
            end -= len(tokens[out[-1]])
        return out[::-1]


class PrefixTable:
    """The valid last token of every prefix of a growing or edited byte string."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        self.data += more
        self.vocabulary.extend(self.data, self.last, len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Replace data[start:stop]; returns how many prefixes were worked out anew."""
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start + 1]
        same = 0
        for end in range(start + 1, len(self.data) + 1):
            self.vocabulary.extend(self.data, self.last, end)
            same = same + 1 if end > start + len(new) and old[end - shift] == self.last[end] else 0
            if same >= self.vocabulary.longest:
                self.last.extend(old[end - shift + 1:])
                return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        return self.vocabulary.path(self.data, self.last)


class _Pieces(dict):
    """Ids of pieces, as the bytes of 32-bit integers.

    When it is full it becomes the older half of the cache; pieces that are
    still in use come back from there, the others go with the next turn.
    """

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = np.array(self.vocabulary.encode_piece(piece.encode("utf-8", "surrogatepass")),
                           dtype=np.int32).tobytes()
        if len(piece) <= 64:
            if len(self) >= CACHED_PIECES:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    with open(path, "rb") as f:
        return Vocabulary({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


@lru_cache(maxsize=4)
def pieces(path: str) -> _Pieces:
    """The cache of a worker process; later tasks go on with it."""
    return _Pieces(load(path))


def _lists(parts: list[bytes]) -> pa.Array:
    counts = np.fromiter((len(p) // 4 for p in parts), dtype=np.int64, count=len(parts))
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), dtype=np.int32)))


_ROWS_AT_ONCE = 512


def _mapped(df: DataFrame, steps: list[tuple[str, T.DataType, str, object]], drop: tuple[str, ...] = ()) -> DataFrame:
    """df with one more column per step (name, type, source column, maker), a few hundred rows at a time.

    All steps run in one task, so the second reads what the first has made
    without another round through the engine.
    """
    names = [n for n, *_ in steps]
    kept = [f for f in df.schema if f.name not in names and f.name not in drop]

    def run(batches):
        made = [(name, source, maker()) for name, _, source, maker in steps]
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(i, _ROWS_AT_ONCE)
                cols = {f: part.column(j) for j, f in enumerate(part.schema.names)}
                for name, source, of in made:
                    cols[name] = of(cols[source])
                out = [*[f.name for f in kept], *names]
                yield pa.RecordBatch.from_arrays([cols[c] for c in out], names=out)

    return df.mapInArrow(run, T.StructType([*kept, *[T.StructField(n, t) for n, t, *_ in steps]]))


def _encoder(path: str | None, pattern: str):
    path = path or public_tokenizers.path(RANKS)

    def maker():
        get, split = pieces(path).__getitem__, regex.compile(pattern).findall
        return lambda texts: _lists([b"".join(map(get, split(t))) if t else b"" for t in texts.to_pylist()])

    return maker


def _decoder(path: str | None):
    path = path or public_tokenizers.path(RANKS)

    def maker():
        tokens = load(path).tokens
        top = max(tokens, default=-1) + 1
        size = np.zeros(top + 1, dtype=np.int64)
        size[list(tokens)] = [len(t) for t in tokens.values()]
        start = np.concatenate([[0], np.cumsum(size)])
        data = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(top)), dtype=np.uint8)

        def made(lists: pa.Array) -> pa.Array:
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            counts = np.array(lists.value_lengths().fill_null(0), dtype=np.int64)
            n = size[ids]
            ends = np.cumsum(n)
            total = int(ends[-1]) if len(ends) else 0
            out = data[np.arange(total) + np.repeat(start[ids] - (ends - n), n)]
            at = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(at), pa.py_buffer(out)])

        return made

    return maker


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", path: str | None = None,
           pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """df with the token ids of each whole text, as an array of int."""
    return _mapped(df, [(ids_col, T.ArrayType(T.IntegerType()), text_col, _encoder(path, pattern))])


def decode(df: DataFrame, ids_col: str = "ids", bytes_col: str = "decoded", path: str | None = None) -> DataFrame:
    """df with the bytes that the ids stand for; null ids are none."""
    return _mapped(df, [(bytes_col, T.BinaryType(), ids_col, _decoder(path))])


def round_trip(df: DataFrame, text_col: str = "text", path: str | None = None,
               pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """df without its text, with the ids of each text and the bytes decoded from those ids."""
    return _mapped(df, [("ids", T.ArrayType(T.IntegerType()), text_col, _encoder(path, pattern)),
                        ("decoded", T.BinaryType(), "ids", _decoder(path))], drop=(text_col,))


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, digest of the ids and of the bytes that they decode to, of texts encoded and decoded."""
    coded = round_trip(docs.select("doc_id", "text"))
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.encode(ids, "UTF-8"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query("op8_byte_bpe")
def op8_byte_bpe(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))

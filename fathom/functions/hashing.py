"""Deterministic row hashing for splits, folds, masks and fingerprints.

Every random-looking choice in the library comes from the md5 of a key's
text plus a salt, never from ``rand()``/``randomSplit`` (whose result
depends on partitioning).  The first 8 hex digits give an unsigned 32-bit
integer; the same expression exists in DuckDB, so splits are reproducible
outside Spark.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def key_text(*cols) -> Column:
    """Text of a (possibly composite) row key: parts joined by '-'."""
    return F.concat_ws("-", *[_c(c).cast("string") for c in cols])


def h32(text) -> Column:
    """Unsigned 32-bit hash from the first 8 hex digits of md5(text)."""
    return F.conv(F.substring(F.md5(_c(text).cast("string")), 1, 8), 16, 10).cast("bigint")


def salted_h32(text, salt: str) -> Column:
    return h32(F.concat(_c(text).cast("string"), F.lit(salt)))


def bucket(text, salt: str, modulus: int = 100) -> Column:
    """pmod(h32(text || salt), modulus): an integer in [0, modulus)."""
    return salted_h32(text, salt) % F.lit(modulus)


def unit_uniform(text, salt: str) -> Column:
    """A value in [0, 1) from the salted hash."""
    return salted_h32(text, salt) / F.lit(TWO_32)


# ---- the same hash of Arrow texts, for many salts a row ----

_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_SINES = [int(abs(math.sin(i + 1)) * 2 ** 32) & 0xFFFFFFFF for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def _md5_first(words: np.ndarray) -> np.ndarray:
    """First word of the md5 of single blocks (16 x n, uint32)."""
    a, b, c, d = (np.full(words.shape[1], v, np.uint32) for v in _START)
    for i in range(64):
        if i < 16:
            f, g = ((c ^ d) & b) ^ d, i
        elif i < 32:
            f, g = ((b ^ c) & d) ^ c, (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f += a
        f += words[g]
        f += np.uint32(_SINES[i])
        turn = _TURNS[i // 16][i % 4]
        left = f << np.uint32(turn)
        f >>= np.uint32(32 - turn)
        f |= left
        f += b
        a, d, c, b = d, c, b, f
    return a + np.uint32(_START[0])


def salted_h32_columns(texts: pa.Array, salts: Sequence[str]) -> Iterator[np.ndarray]:
    """``salted_h32(text, salt)`` of all texts, one uint32 array for each of the salts."""
    raw = texts.cast(pa.binary())
    sizes = np.diff(np.frombuffer(raw.buffers()[1], np.int32)[raw.offset:raw.offset + len(raw) + 1])
    ends = [s.encode() for s in salts]
    short = sizes + max(map(len, ends), default=0) <= 55            # padded to one block of md5
    rows = np.arange(int(short.sum()))
    at, blocks = sizes[short], np.zeros((len(rows), 64), np.uint8)
    kept = raw.filter(pa.array(short))
    begin = np.frombuffer(kept.buffers()[1], np.int32)[kept.offset:kept.offset + len(kept) + 1] if len(kept) else [0]
    if len(kept) and begin[-1] > begin[0]:
        blocks[np.arange(64) < at[:, None]] = np.frombuffer(kept.buffers()[2], np.uint8)[begin[0]:begin[-1]]
    long = [(i, raw[i].as_py()) for i in np.flatnonzero(~short).tolist()]
    for end in ends:
        block = blocks.copy()
        for j, byte in enumerate(end + b"\x80"):
            block[rows, at + j] = byte
        words = np.ascontiguousarray(block.view("<u4").T)
        words[14] = (at + len(end)) * 8
        out = np.empty(len(raw), np.uint32)
        out[short] = _md5_first(words).byteswap()
        for i, text in long:
            out[i] = int.from_bytes(hashlib.md5(text + end).digest()[:4], "big")
        yield out


# ---- the same expressions as SQL text (DuckDB dialect) for oracles ----

def sql_key_text(*cols: str) -> str:
    return "concat_ws('-', " + ", ".join(f"CAST({c} AS VARCHAR)" for c in cols) + ")"


def sql_h32(text_expr: str) -> str:
    return f"(('0x' || substr(md5({text_expr}), 1, 8))::BIGINT)"


def sql_salted_h32(text_expr: str, salt: str) -> str:
    return sql_h32(f"({text_expr}) || '{salt}'")


def sql_bucket(text_expr: str, salt: str, modulus: int = 100) -> str:
    return f"({sql_salted_h32(text_expr, salt)} % {modulus})"


def sql_unit_uniform(text_expr: str, salt: str) -> str:
    return f"({sql_salted_h32(text_expr, salt)} / 4294967296.0e0)"

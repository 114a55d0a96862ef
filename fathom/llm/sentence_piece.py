"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The normalised text starts as one symbol a character.  An agenda, a heap
ordered by score and then by place, holds every two neighbours whose join is a
piece; the best pair is joined and the pairs of the new symbol with its
neighbours go on the agenda, until it is empty.  Pairs of which a side has been
joined meanwhile are stale and skipped.

No join crosses a place where no piece of the vocabulary has these neighbours,
so a text is cut there first and each segment has an agenda of its own: before
a run of word marks that follows another character, if no piece has a mark
after another character, and around characters that no longer piece contains.
Segments are kept with their ids by each worker, and every segment that comes
new into an Arrow batch is encoded by the sentencepiece library too, the
segments of the batch at once; a difference ends the job (``check="segments"``).
``check="texts"`` compares whole texts, ``None`` nothing.  Normalising and
decoding are the library's own.

Defined results: null text is empty and has no tokens; extra columns are
carried, but for one that has the name of a column asked for, which is replaced;
null ids decode to an empty string; an empty table gives an empty table.
Vocabularies of another type, or with user-defined pieces, raise ValueError.
"""

from __future__ import annotations

import heapq
import re
from array import array
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as model_format

from fathom.llm.registry import query, table

MODEL = "piece_bpe_32k.model"
MARK = "▁"
CACHED_SEGMENTS = 400_000
CACHED_CHARS = 64
_ROWS_AT_ONCE = 256


class Vocabulary:
    """Pieces, scores and the rules for joining them, of one model file."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        proto = model_format.ModelProto.FromString(self.library.serialized_model_proto())
        kind = model_format.ModelProto.SentencePiece
        if proto.trainer_spec.model_type != model_format.TrainerSpec.BPE:
            raise ValueError("the vocabulary is not of the merge type")
        if any(p.type == kind.USER_DEFINED for p in proto.pieces):
            raise ValueError("user-defined pieces are not supported")
        self.ids, self.ranks, self.unused = {}, {}, set()    # ranks: scores with the best one lowest
        self.bytes = {}
        for i, p in enumerate(proto.pieces):
            if p.type in (kind.NORMAL, kind.UNUSED):
                self.ids[p.piece], self.ranks[p.piece] = i, -p.score
                if p.type == kind.UNUSED:
                    self.unused.add(p.piece)
            elif p.type == kind.BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
        self.unknown = self.library.unk_id()
        self.byte_fallback = proto.trainer_spec.byte_fallback
        self.segments = self._segment_pattern()

    def _segment_pattern(self) -> re.Pattern:
        """Runs of characters between which no piece of the vocabulary lies."""
        longer = [p for p in self.ids if len(p) > 1]
        pairs = {p[i:i + 2] for p in longer for i in range(len(p) - 1)}
        letters = {c for pair in pairs for c in pair if c.isalpha()}
        others = {c for pair in pairs for c in pair} - letters - {MARK}
        inner = [f"[{''.join(map(re.escape, sorted(s)))}]" if s else "(?!)" for s in (letters, others, letters | others)]
        apart = "".join(map(re.escape, sorted(letters | others | {MARK})))
        if any(b == MARK != a for a, b in pairs):           # a mark can follow: no cut before marks
            return re.compile(f"[{apart}]+|[^{apart}]+")
        if any(a in letters and b in others for a, b in pairs):
            return re.compile(f"{MARK}*{inner[2]}+|{MARK}+|[^{apart}]+")
        if any(a in others and b in letters for a, b in pairs):
            return re.compile(f"{MARK}*{inner[1]}*{inner[0]}+|{MARK}*{inner[1]}+|{MARK}+|[^{apart}]+")
        return re.compile(f"{MARK}*{inner[0]}+|{MARK}*{inner[1]}+|{MARK}+|[^{apart}]+")

    def symbols(self, text: str) -> list[str]:
        """The pieces that the agenda leaves of a normalised text."""
        rank, push, pop, n = self.ranks.get, heapq.heappush, heapq.heappop, len(text)
        stop, head = list(range(1, n + 1)), list(range(-1, n))  # end of the symbol that starts here, start of the one that ends here
        # (rank, start of the left symbol, of the right one, end of the right one)
        agenda = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := rank(text[i:i + 2])) is not None]
        heapq.heapify(agenda)
        passed = {}      # pieces that may only be passed through: where they were joined
        while agenda:
            _, left, right, end = pop(agenda)
            if stop[left] != right or stop[right] != end:
                continue     # stale: a side has been joined since
            stop[left], stop[right], head[end] = end, -1, left
            if self.unused and text[left:end] in self.unused:
                passed[left, end] = right
            if left:
                i = head[left]
                r = rank(text[i:end])
                if r is not None:
                    push(agenda, (r, i, left, end))
            if end < n:
                j = stop[end]
                r = rank(text[left:j])
                if r is not None:
                    push(agenda, (r, left, end, j))
        out, at = [], 0
        while at < n:
            waiting = [(at, stop[at])]
            while waiting:
                i, j = waiting.pop()
                if (i, j) in passed:
                    waiting += [(passed[i, j], j), (i, passed[i, j])]
                else:
                    out.append(text[i:j])
            at = stop[at]
        return out

    def encode_segment(self, segment: str) -> list[int]:
        """Ids of a normalised segment; a character outside the vocabulary is its bytes, or unknown."""
        pieces, out = self.symbols(segment), []
        try:
            return [self.ids[p] for p in pieces]
        except KeyError:
            pass
        for piece in pieces:
            i = self.ids.get(piece)
            if i is not None:
                out.append(i)
            elif self.byte_fallback:
                out += [self.bytes[b] for b in piece.encode("utf-8")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def checked(self, segments: dict[str, bytes]) -> None:
        """Compare ids of segments with the library's, each as a text that normalises to it.

        A segment without a mark in front never begins a text; it is put after a line break.
        """
        lead = np.array(self.encode_segment(MARK) + self.encode_segment("\n"), dtype=np.int32).tobytes()
        texts = [s[1:].replace(MARK, " ") if s.startswith(MARK) else f"\n{s}" for s in segments]
        normal = [s if s.startswith(MARK) else f"{MARK}\n{s}" for s in segments]
        same = [a == b for a, b in zip(self.library.normalize(texts), normal)]
        for text, ok, (s, own), other in zip(texts, same, segments.items(), self.library.encode(texts, num_threads=1)):
            if ok and (own if s.startswith(MARK) else lead + own) != np.array(other, dtype=np.int32).tobytes():
                raise AssertionError(f"the agenda and the library differ on {text!r}")


@lru_cache(maxsize=4)
def load(path: str) -> Vocabulary:
    return Vocabulary(path)


class _Segments(dict):
    """Ids of segments, as the bytes of 32-bit integers; the older half goes when it is full."""

    def __init__(self, vocabulary: Vocabulary, check: bool):
        super().__init__()
        self.vocabulary, self.check, self.older, self.new = vocabulary, check, {}, {}

    def __missing__(self, segment: str) -> bytes:
        ids = self.older.get(segment)
        if ids is None:
            ids = array("i", self.vocabulary.encode_segment(segment)).tobytes()
            if self.check:
                self.new[segment] = ids
        if len(segment) <= CACHED_CHARS:
            if len(self) >= CACHED_SEGMENTS:
                self.older = dict(self)
                self.clear()
            self[segment] = ids
        return ids

    def settle(self) -> None:
        """Compare what the batch brought with the library."""
        if self.new:
            new, self.new = self.new, {}
            self.vocabulary.checked(new)


@lru_cache(maxsize=4)
def _segments(path: str, check: bool) -> _Segments:
    """The cache of a worker process; later tasks go on with it."""
    return _Segments(load(path), check)


def _lists(parts: list[bytes]) -> pa.Array:
    counts = np.fromiter((len(p) // 4 for p in parts), dtype=np.int64, count=len(parts))
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), dtype=np.int32)))


def _encoder(path: str, check: str | None):
    if check not in ("segments", "texts", None):
        raise ValueError("check is 'segments', 'texts' or None")

    def maker():
        vocabulary, known = load(path), _segments(path, check == "segments")
        get, cut, normalize = known.__getitem__, vocabulary.segments.findall, vocabulary.library.normalize

        def made(texts: pa.Array) -> pa.Array:
            texts = [t or "" for t in texts.to_pylist()]
            out = [b"".join(map(get, cut(normalize(t)))) if t else b"" for t in texts]
            known.settle()
            if check == "texts":
                for ids, other in zip(out, vocabulary.library.encode(texts, num_threads=1)):
                    if np.frombuffer(ids, dtype=np.int32).tolist() != other:
                        raise AssertionError("the agenda and the library differ on a text")
            return _lists(out)

        return made

    return maker


def _decoder(path: str):
    def maker():
        decode = load(path).library.decode

        def made(lists: pa.Array) -> pa.Array:
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
            return pa.array([decode(ids[a:b]) if b > a else "" for a, b in zip(starts, ends)], type=pa.string())

        return made

    return maker


def _mapped(df: DataFrame, steps: list[tuple[str, T.DataType, str, object]], drop: tuple[str, ...] = ()) -> DataFrame:
    """df with one more column per step (name, type, source column, maker), some rows at a time, all steps in one task."""
    names = [n for n, *_ in steps]
    kept = [f for f in df.schema if f.name not in names and f.name not in drop]
    order = [*[f.name for f in kept], *names]

    def run(batches):
        made = [(name, source, maker()) for name, _, source, maker in steps]
        for batch in batches:
            for i in range(0, batch.num_rows, _ROWS_AT_ONCE):
                part = batch.slice(i, _ROWS_AT_ONCE)
                cols = dict(zip(part.schema.names, part.columns))
                for name, source, of in made:
                    cols[name] = of(cols[source])
                yield pa.RecordBatch.from_arrays([cols[c] for c in order], names=order)

    return df.mapInArrow(run, T.StructType([*kept, *[T.StructField(n, t) for n, t, *_ in steps]]))


def encode(df: DataFrame, text_col: str = "text", ids_col: str = "ids", path: str | None = None,
           check: str | None = "segments") -> DataFrame:
    """df with the token ids of each whole text, as an array of int, without begin or end ids."""
    path = path or public_tokenizers.path(MODEL)
    return _mapped(df, [(ids_col, T.ArrayType(T.IntegerType()), text_col, _encoder(path, check))])


def decode(df: DataFrame, ids_col: str = "ids", text_col: str = "decoded", path: str | None = None) -> DataFrame:
    """df with the text that the library decodes from the ids."""
    return _mapped(df, [(text_col, T.StringType(), ids_col, _decoder(path or public_tokenizers.path(MODEL)))])


def round_trip(df: DataFrame, text_col: str = "text", path: str | None = None,
               check: str | None = "segments") -> DataFrame:
    """df without its text, with the ids of each text and the text decoded from those ids."""
    path = path or public_tokenizers.path(MODEL)
    return _mapped(df, [("ids", T.ArrayType(T.IntegerType()), text_col, _encoder(path, check)),
                        ("decoded", T.StringType(), "ids", _decoder(path))], drop=(text_col,))


@query("op13_sentence_piece")
def op13_sentence_piece(spark, sf_dir):
    """doc_id, n_tokens, digest of the ids and of the text that they decode to, of every document."""
    coded = round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.encode(ids, "UTF-8"), 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))

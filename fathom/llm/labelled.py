"""What the trained classifiers share: the bounded sample of labelled rows,
feature rows that are fitted in one task, and scoring with broadcast weights."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int, held_out: int = 0) -> DataFrame:
    """doc_id, text, label of at most ``max_rows`` labelled documents outside the held-out fold.

    Ids are chosen by a hash, repeated labels count as their largest, and the
    chosen ids (``max_rows`` at most) are broadcast, so texts are not shuffled.
    """
    chosen = (labels.filter(F.col(label).isNotNull() & (fold(F.col("doc_id")) != held_out))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("__label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "__label")


class Stamps:
    """Distinct values of one text's codes, by a table that keeps each code's last place."""

    def __init__(self, size: int):
        self.at = np.zeros(size, dtype=np.int32)

    def distinct(self, codes: np.ndarray) -> np.ndarray:
        n = np.arange(len(codes), dtype=np.int32)
        self.at[codes] = n
        return codes[self.at[codes] == n]


Features = Callable[[pa.Array], Iterator[np.ndarray]]


def fit(sampled: DataFrame, features: Callable[[], Features],
        train: Callable[[list[np.ndarray], np.ndarray, list], bytes]) -> bytes:
    """Model bytes from the sample: features in parallel, the fit itself in one task over bounded rows."""
    def rows(batches):
        make = features()
        for b in batches:
            ids = [f.astype(np.int32).tobytes() for f in make(b.column(b.schema.get_field_index("text")))]
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("doc_id")), b.column(b.schema.get_field_index("__label")),
                 pa.array(ids, pa.binary())], names=["doc_id", "label", "ids"])

    def one(batches):
        got = [(d, y, np.frombuffer(x, dtype=np.int32)) for b in batches for d, y, x in zip(
            *(b.column(i).to_pylist() for i in range(3)))]
        got.sort(key=lambda r: (r[0], r[1], len(r[2])))
        model = train([r[2] for r in got], np.array([r[1] for r in got], dtype=np.int64), [r[0] for r in got])
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    made = sampled.mapInArrow(rows, T.StructType([sampled.schema["doc_id"], T.StructField("label", T.IntegerType()),
                                                  T.StructField("ids", T.BinaryType())]))
    return bytes(made.repartition(1).mapInArrow(one, "model binary").collect()[0][0])


def with_scores(df: DataFrame, fields: str, scorer: Callable[[], Callable[[pa.Array], list[np.ndarray]]],
                text_col: str = "text") -> DataFrame:
    """df plus the columns in ``fields`` (a DDL string), which the scorer gives for the texts of a batch."""
    extra = T._parse_datatype_string(fields) if hasattr(T, "_parse_datatype_string") else T.StructType.fromDDL(fields)
    kept = [f for f in df.schema if f.name not in extra.names]

    def run(batches):
        score = scorer()
        for b in batches:
            cols = score(b.column(b.schema.get_field_index(text_col)))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(b.schema.get_field_index(f.name)) for f in kept], *[pa.array(c) for c in cols]],
                names=[*[f.name for f in kept], *extra.names])

    return df.mapInArrow(run, T.StructType([*kept, *extra]))

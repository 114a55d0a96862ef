"""A cleaning pipeline over ``documents``: quality filter, exact and near
deduplication, benchmark decontamination, tokenisation.

Each stage takes what the stage before kept, as Parquet written to the shared
checkpoint folder and read again; all but the last return the columns of
``documents``.  Near duplicates are texts whose sets of five-word shingles have
a similarity of 0.8 or more.  SQL can't express the classifier or the encoding,
so the stages are tested one by one against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.llm import byte_bpe, decontaminate, exact_dedup, near_dedup, quality_nbsvm
from fathom.llm.registry import table
from fathom.llm.stored import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality_nbsvm.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality_nbsvm.score(docs, model, score_col="__score")
    return scored.filter(F.col("__score") >= quality_nbsvm.THRESHOLD).drop("__score")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs, k=5, percent=80, bands=21, rows=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a substantial share of benchmark text."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count, digests of ids and of the bytes they decode to, of each document that is left."""
    return byte_bpe.digests(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("decontamination", decontaminated),
    ("byte-level BPE", tokenised),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

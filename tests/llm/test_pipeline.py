"""Stage by stage against brute force on the small tables."""

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from fathom.llm import byte_bpe
from tests.conftest import SF_SMALL
from tests.llm.fixtures import awkward, frame
from tests.llm.test_decontaminate import brute as contaminated
from tests.llm.test_exact_dedup import brute as exact
from tests.llm.test_near_dedup import brute as near


@pytest.fixture(scope="module")
def docs(spark):
    given = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    extra = frame(spark, [(None if i is None else i + 10**6, t) for i, t in awkward()])
    return given.unionByName(extra).cache()


def ids(df):
    return sorted((r.doc_id for r in df.select("doc_id").collect()), key=str)


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "exact dedup", "near dedup", "decontamination", "byte-level BPE"]


def test_quality_keeps_columns_and_most_good_documents(spark, docs):
    kept = corpus_pipeline.quality(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    left = set(ids(kept))
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in left for i in good) >= 0.97 * len(good)


def test_exact_copies(spark, docs):
    kept = corpus_pipeline.exact_copies(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted((r[0] for r in exact(rows(docs)) if r[3]), key=str)


def test_near_copies(spark, docs):
    kept = corpus_pipeline.near_copies(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    want = [r[0] for r in near(rows(docs), 5, 80) if r[3]] + [i for i, _ in rows(docs) if i is None]
    assert ids(kept) == sorted(want, key=str)


def test_decontaminated(spark, docs):
    bench = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    kept = corpus_pipeline.decontaminated(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    assert ids(kept) == sorted((r[0] for r in contaminated(rows(docs), bench) if not r[4]), key=str)


def test_tokenised(spark, docs):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=byte_bpe.load(public_tokenizers.path(byte_bpe.RANKS)).ranks)
    got = sorted((str(r.doc_id), r.n_tokens) for r in corpus_pipeline.tokenised(spark, docs, SF_SMALL).collect())
    assert got == sorted((str(i), len(library.encode_ordinary(t or ""))) for i, t in rows(docs))


def test_run_applies_all_stages(spark):
    step = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, SF_SMALL)
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.columns == step.columns and ids(got) == ids(step)


def test_empty_documents(spark, docs):
    step = docs.filter(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, SF_SMALL)
    assert step.count() == 0

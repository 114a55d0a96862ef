"""The registered queries over the given tables: against their SQL, or against brute force."""

import hashlib
import math
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

from fathom.llm import ORACLES, QUERIES, byte_bpe
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.fixtures import plain_words, words
from tests.llm.test_hpylm import held_out
from tests.llm.test_near_dedup import brute as near_brute
from tests.oracle_compare import compare


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    ok, problems = compare(spark, name, QUERIES[name], ORACLES[name], SF_ORACLE)
    assert ok, problems


def test_near_dedup(spark, texts):
    got = sorted(tuple(r) for r in QUERIES["op3_superminhash_near_dedup"](spark, SF_SMALL).collect())
    assert got == near_brute(list(texts.items()), 3, 85)


def test_byte_bpe(spark, texts):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=byte_bpe.load(public_tokenizers.path(byte_bpe.RANKS)).ranks)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op8_byte_bpe"](spark, SF_SMALL).collect()}
    for i, t in texts.items():
        ids = library.encode_ordinary(t or "")
        assert got[i] == (len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode()))


def test_language_model_base_and_gain(spark, texts):
    counts = Counter()
    for i, t in texts.items():
        if not held_out(i):
            counts.update([*words(t), None])
    n, v = sum(counts.values()), len(counts)
    rows = QUERIES["op10_hpylm_scoring"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        w = [*words(texts[r.doc_id]), None]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (
            len(w), sum(counts[x] > 0 for x in w), n, held_out(r.doc_id))
        assert math.isclose(r.base_score, sum(math.log10((counts[x] + .5) / (n + .5 * (v + 1))) for x in w), rel_tol=1e-9)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_repeated_passages(spark, texts):
    """Each document with a run of 51 words that another document has is reported."""
    holders = defaultdict(set)
    for i, t in texts.items():
        w = plain_words(t)
        for j in range(len(w) - 50):
            holders[tuple(w[j:j + 51])].add(i)
    want = set().union(*(h for h in holders.values() if len(h) > 1))
    rows = QUERIES["op2_chained_passages"](spark, SF_SMALL).collect()
    assert want <= {r.doc_id for r in rows}
    for r in rows:
        assert r.n_words >= 50 and r.identity >= 0.8
        assert r.doc_id not in r.partner_ids or len(r.partner_ids) > 1


def test_toxic_rows_are_scored(spark, texts):
    rows = QUERIES["op1_ordinal_toxicity"](spark, SF_ORACLE).join(
        spark.read.parquet(f"{SF_ORACLE}/labels.parquet"), "doc_id").collect()
    clean = [r.toxic for r in rows if r[-1] == 0]
    assert len(rows) > 300 and sum(map(bool, clean)) < 0.05 * len(rows)

import itertools
import random

import numpy as np
import pytest

from fathom.llm import near_dedup, superminhash
from fathom.llm.stored import components
from tests.llm.fixtures import awkward, frame, prose, with_clashes, words


def shingles(text, k):
    w = words(text)
    return frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, (_, s)), (b, (_, t)) in itertools.combinations(enumerate(sets), 2):
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            parent[find(a)] = find(b)
    low = {}
    for a, (i, _) in enumerate(sets):
        low[find(a)] = min(i, low.get(find(a), i))
    return sorted((i, len(s), low[find(a)], i == low[find(a)]) for a, (i, s) in enumerate(sets))


def family(n, seed, edits):
    """Near copies of one text with up to ``edits`` words changed: a group around the threshold."""
    rnd, base = random.Random(seed), prose(150, seed).split(" ")
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"new{rnd.randrange(40)}"
        out.append((1000 * seed + i, " ".join(w)))
    return out


@pytest.mark.parametrize("k,percent,bands,rows", [(3, 85, 16, 4), (5, 80, 21, 3)])
def test_groups_equal_brute_force(spark, k, percent, bands, rows):
    data = awkward() + family(90, 5, 9) + family(60, 6, 4) + family(40, 7, 14)
    df = with_clashes(frame(spark, data).repartition(4), "n", "cls", "component_id", "bands")
    got = near_dedup.near_groups(df, k=k, percent=percent, bands=bands, rows=rows).collect()
    assert sorted(tuple(r) for r in got if r.doc_id is not None) == brute(data, k, percent)
    assert [(r.component_id, r.kept) for r in got if r.doc_id is None] == [(None, True)] * 2


def test_keep_one_carries_all_columns(spark):
    data = [r for r in awkward() if r[0] is not None]
    df = with_clashes(frame(spark, data), "kept", "component_id")
    kept = near_dedup.keep_one(df, k=3, percent=85)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r[0] for r in brute(data, 3, 85) if r[3])


def test_empty_table(spark):
    assert near_dedup.near_groups(frame(spark, [])).count() == 0


def test_signatures_estimate_the_similarity_with_less_variance_than_independent_hashes():
    rng, m, errors, plain = np.random.default_rng(1), 64, [], []
    for _ in range(200):
        both, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (12, 4, 4))
        sets = np.concatenate([both, a, both, b])
        sig = superminhash.signatures(sets, np.repeat([0, 1], [16, 16]), 2, m)
        errors.append((sig[0] == sig[1]).mean() - 12 / 20)
        plain.append(rng.binomial(m, 12 / 20) / m - 12 / 20)
    assert abs(np.mean(errors)) < 0.02 and np.var(errors) < np.var(plain)


def test_signature_of_one_element_is_a_permutation():
    sig = superminhash.signatures(np.array([123456789], dtype=np.uint64), np.array([0]), 1, 64)[0]
    assert sorted(sig >> np.uint64(32)) == list(range(64))


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 200)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200}

"""Periodic runs against a plain search for them, on small alphabets, long periods and awkward rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from fathom.llm import QUERIES, periodic_runs
from tests.conftest import SF_SMALL
from tests.llm.fixtures import awkward, frame, with_clashes


def brute(words, power=4, shortest=6):
    """(start, period, length) of every run: maximal stretches of matches at each distance, smallest period."""
    n, out = len(words), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(shortest, power * q):
                one = words[i:i + q]
                if not any(q % d == 0 and one == one[:d] * (q // d) for d in range(1, q)):
                    out.append((i, q, length))
            i = max(j, i + 1)
    return sorted(out)


def solved(words, power=4, shortest=6):
    """The operator's own tiles and fragments, put together here."""
    spans = {}
    for octave, _, start, codes, bounds in periodic_runs.tiles(periodic_runs._codes(words), power, shortest):
        for q, low, high in periodic_runs.fragments(octave, start, np.frombuffer(codes, np.int32), bounds, power, shortest):
            spans.setdefault(q, []).append((low, high))
    out = []
    for q, found in spans.items():
        joined = []
        for low, high in sorted(found):
            if joined and low <= joined[-1][1]:
                joined[-1][1] = max(joined[-1][1], high)
            else:
                joined.append([low, high])
        out += [(low, q, high - low + q) for low, high in joined if high - low + q >= max(shortest, power * q)]
    return sorted(out)


@pytest.mark.parametrize("power,shortest", [(4, 6), (3, 1), (5, 20)])
def test_tiles_find_every_run(monkeypatch, power, shortest):
    rnd = random.Random(power)
    for tile in (periodic_runs.TILE, 8):
        monkeypatch.setattr(periodic_runs, "TILE", tile)
        for _ in range(500):
            words = [b"%d" % rnd.randrange(rnd.choice([1, 2, 3, 30])) for _ in range(rnd.randrange(60))]
            for _ in range(rnd.randrange(3)):       # a repeated stretch, perhaps with an edit
                unit = [b"%d" % rnd.randrange(3) for _ in range(rnd.randrange(1, 30))]
                words += (unit * 9)[:rnd.randrange(1, 200)]
                if words and rnd.random() < .5:
                    words[rnd.randrange(len(words))] = b"x"
            assert solved(words, power, shortest) == brute(words, power, shortest)


def test_long_periods_cross_many_tiles():
    rnd = random.Random(8)
    unit = [b"%d" % rnd.randrange(10**6) for _ in range(3000)]
    words = [b"a", b"b"] * 40 + (unit * 5)[:14_321] + [b"z"] * 5000 + unit[:7] * 1000
    assert solved(words) == brute_periods(words, [1, 2, 7, 3000])


def brute_periods(words, periods):
    return sorted(r for q in periods for r in matches(words, q))


def matches(words, q):
    i, n = 0, len(words)
    while i + q < n:
        j = i
        while j + q < n and words[j] == words[j + q]:
            j += 1
        if j > i and j - i + q >= max(6, 4 * q) and len(set(words[i:j])) > (q > 1):
            yield (i, q, j - i + q)
        i = max(j, i + 1)


def collapsed(words, runs):
    drop = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def test_frame_with_awkward_rows(spark):
    rows = [*awkward(), (30, "go on " * 9), (30, "go on " * 9), (31, "x " * 6 + "a b c " * 5 + "\u0085   " * 5)]
    rows = [(i, t) for i, t in rows if len(t or "") < 20_000]
    df = with_clashes(frame(spark, rows), "runs", "__key", "collapsed", "__octave", "period")
    got = periodic_runs.collapse(df).collect()
    words = {t: (t or "").encode().split() for _, t in rows}
    want = {t: [(s, n, q) for s, q, n in brute(w)] for t, w in words.items()}
    def row(i, t):
        text = collapsed([x.decode() for x in words[t]], brute(words[t]))
        return str(i), len(words[t]), want[t], text, hashlib.sha256(text.encode()).hexdigest()
    assert sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed, r.collapsed_sha256) for r in got) \
        == sorted(row(i, t) for i, t in rows)
    assert {r["__key"] for r in got} == {"clash"} == {r.period for r in got} and got[0].lang == "en"
    assert periodic_runs.collapse(frame(spark, [])).count() == 0


def test_query(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    sha, some = lambda s: hashlib.sha256(s.encode()).hexdigest(), 0
    for d in docs:
        words = [w.decode() for w in (d.text or "").encode().split()]
        h, n = zlib.crc32(str(d.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 2500:
            continue
        runs, r = brute(words), got[d.doc_id]
        some += len(runs)
        assert r.n_runs == len(runs)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, q, m in runs))
        assert r.collapsed_sha256 == sha(collapsed(words, runs))
        best = min(runs, key=lambda x: (-x[2], x[0], x[1]), default=None)
        assert (r.start, r.period, r.length) == (best or (None,) * 3)
        assert r.exponent_milli == (1000 * best[2] // best[1] if best else None)
    assert some > 10

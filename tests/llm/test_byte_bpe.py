import base64
import random

import public_tokenizers
import pytest
import tiktoken

from fathom.llm import byte_bpe as b
from tests.llm.fixtures import awkward, frame, with_clashes

PATH = public_tokenizers.path(b.RANKS)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(n) for a, n in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_documents_equal_the_library_and_round_trip(spark, library):
    rows = awkward() + [(100, "<|endoftext|> it's WE'LL 12345 \x1c\x1f​  end  "), (101, "z" * 30_000), (102, " " * 5000)]
    df = with_clashes(frame(spark, rows), "ids", "decoded")
    got = b.decode(b.encode(df)).collect()
    assert len(got) == len(rows)
    want = sorted(((str(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t in rows))
    assert sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in got) == want


def test_pieces_at_random_equal_the_library(library):
    v, rnd = b.load(PATH), random.Random(3)
    for _ in range(3000):
        text = "".join(rnd.choice("abcdefgh étß中😀0-_.,'") for _ in range(rnd.randint(1, 30)))
        assert v.encode_piece(text.encode()) == library._encode_single_piece(text)


def test_append_and_edit_equal_a_fresh_table():
    v, rnd = b.load(PATH), random.Random(4)
    text = bytes(rnd.choice(b"the quick brown fox ") for _ in range(600))
    table = b.PrefixTable(v)
    for i in range(0, 600, 7):
        table.append(text[i:i + 7])
    assert table.last == b.PrefixTable(v, text).last
    fewest = 10**9
    for _ in range(60):
        start = rnd.randrange(len(table.data))
        stop = min(len(table.data), start + rnd.randrange(4))
        new = bytes(rnd.choice(b"abz ") for _ in range(rnd.randrange(4)))
        fewest = min(fewest, table.replace(start, stop, new))
        assert table.last == b.PrefixTable(v, table.data).last
    assert fewest < 300      # most prefixes were kept


def test_cache_gives_the_same_ids_when_it_overflows(library, monkeypatch):
    monkeypatch.setattr(b, "CACHED_PIECES", 5)
    cache, words = b._Pieces(b.load(PATH)), [" alpha", " beta", "gamma", " delta", "eps", " zeta", " eta", "theta"]
    for _ in range(4):
        for w in words:
            assert list(memoryview(cache[w]).cast("i")) == library.encode_ordinary(w)


def test_empty_table(spark):
    assert b.decode(b.encode(frame(spark, []))).count() == 0

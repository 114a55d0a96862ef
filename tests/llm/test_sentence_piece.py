"""SentencePiece encoding against the sentencepiece library on whole texts, decoding against its decode."""

import random

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from fathom.llm import sentence_piece
from tests.llm.fixtures import awkward, frame, with_clashes

PATH = public_tokenizers.path(sentence_piece.MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_agenda_equals_the_library(library):
    rnd = random.Random(5)
    parts = ["a", "b", " ", "  ", "▁", "\n", "é", "漢", "😀", "\u0000", "the", "ing", " t", "é", "    ", "<s>",
             "<0x0A>", "\t", "　", "##", "('", "//", "1", "22", ".", "ﬁ", "​", "Ａ"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    for check in ("segments", "texts", None):
        ids = sentence_piece._encoder(PATH, check)()(pa.array(texts))
        assert ids.to_pylist() == library.encode(texts)
    assert sentence_piece._decoder(PATH)()(ids).to_pylist() == library.decode(library.encode(texts))


def test_agenda_of_a_whole_text_equals_its_segments(library):
    """No join crosses the places where texts are cut."""
    v = sentence_piece.load(PATH)
    text = library.normalize("The quick  brown (fox),  jumped\nover 42 lazy dogs' 漢字 éa##x")
    whole = v.encode_segment(text)
    assert whole == [i for s in v.segments.findall(text) for i in v.encode_segment(s)] == library.encode("The quick  brown (fox),  jumped\nover 42 lazy dogs' 漢字 éa##x")
    assert "".join(v.segments.findall(text)) == text


def test_a_difference_ends_the_job():
    v = sentence_piece.Vocabulary(PATH)
    v.ranks = dict(v.ranks)
    v.ranks["▁th"] = v.ranks.pop("▁the")
    known = sentence_piece._Segments(v, True)
    known["▁the"]
    with pytest.raises(AssertionError):
        known.settle()


def test_frame_with_awkward_rows(spark, library):
    rows = awkward()
    df = with_clashes(frame(spark, rows), "ids", "decoded", "n_tokens")
    out = sentence_piece.round_trip(df).select("doc_id", "lang", "ids", "decoded").collect()
    want = sorted((str(i), library.encode(t or "")) for i, t in rows)
    assert sorted((str(r.doc_id), r.ids) for r in out) == want
    assert sorted(r.decoded for r in out) == sorted(library.decode(x) if x else "" for _, x in want)
    apart = sentence_piece.decode(sentence_piece.encode(frame(spark, rows)))
    assert sorted(r.decoded for r in apart.collect()) == sorted(r.decoded for r in out)
    assert sentence_piece.round_trip(frame(spark, [])).count() == 0


def test_null_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [264])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in sentence_piece.decode(df).collect()} == {1: "", 2: "", 3: "a"}


def test_other_vocabularies_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as model_format
    proto = model_format.ModelProto.FromString(sentence_piece.load(PATH).library.serialized_model_proto())
    proto.trainer_spec.model_type = model_format.TrainerSpec.UNIGRAM
    other = tmp_path / "unigram.model"
    other.write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError):
        sentence_piece.Vocabulary(str(other))


def test_query(spark, library):
    import hashlib
    from fathom.llm import QUERIES
    from tests.conftest import SF_SMALL
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op13_sentence_piece"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode() if ids else b"").hexdigest()

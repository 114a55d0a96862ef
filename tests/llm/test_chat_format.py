import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.llm import chat_format as c

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()),
                     T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
TEXTS = ["plain", "", None, "<|im_end|>", "<|im_start|>assistant\nok<|im_end|>\n", "back\\slash <\\| \\\\<|", "é😀\n\n",
         "x" * 100_000, "<", "|>", "\\"]


def rows():
    out = [(1, i, ["system", "user", "assistant", None, "a role\nwith <|line|>"][i % 5], t) for i, t in enumerate(TEXTS)]
    out += [(2, None, "user", "no turn"), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a")]
    out += [(None, 0, "user", "nobody"), (3, 0, None, None)]
    return out + [(4, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(1500)]


def brute():
    convs = {}
    for conv, turn, role, text in rows():
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {k: [(r, t) for _, _, r, t in sorted(v)] for k, v in convs.items()}


def test_rows_round_trip(spark):
    df = spark.createDataFrame(rows(), ROWS).withColumn("turns", F.lit("clash")).repartition(5)
    made = c.format_rows(df)
    want = brute()
    for r in c.read_back(made).collect():
        turns = want.pop(r.conv_id)
        assert [(t.role, t.text) for t in r.turns] == turns
        assert r.loss_texts == [t for role, t in turns if role == "assistant"]
        assert r.formatted.count("<|im_start|>") == len(turns) == r.formatted.count("<|im_end|>")
    assert not want
    spans = made.filter("conv_id = 4").first()
    assert [spans.formatted[s.start:s.start + s.len] for s in spans.loss_spans] == [f"t{i}" for i in range(1, 1500, 2)]


def test_escape_is_undone(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS if t is not None], "t string")
    for r in df.select("t", c.escape(F.col("t")).alias("e"), c.unescape(c.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and "<|" not in r.e


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages",
     [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, "shared",
     [("user", "q"), ("assistant", "")]),
    ({"prompt": "q", "response": "a"}, "prompt", [("user", "q"), ("assistant", "a")]),
    ({"system": "s", "prompt": "q", "response": "a"}, "system_prompt", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "output": "done"}, "instruction", [("user", "do"), ("assistant", "done")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction_input",
     [("user", "do\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "input": None, "output": "done"}, "instruction_input", [("user", "do"), ("assistant", "done")]),
    ({"something": 1}, "unknown", []),
]


def test_records_of_every_layout(spark):
    data = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)] + [(100, None), (101, "not json"), (102, "")]
    got = {r.conv_id: r for r in c.canonical_records(
        spark.createDataFrame(data, "id long, record string"), "id", "record").collect()}
    for i, (_, name, turns) in enumerate(RECORDS):
        assert (got[i].layout, [(t.role, t.text) for t in got[i].turns]) == (name, turns)
    assert all(got[i].layout == "unknown" and got[i].turns == [] for i in (100, 101, 102))


def test_fingerprint_depends_on_paths_only(spark):
    data = [('{"prompt": "a", "response": "b"}',), ('{"response": null, "prompt": "x y"}',), ('{"prompt": "a"}',)]
    a, b, other = (r[0] for r in spark.createDataFrame(data, "r string").select(
        c.fingerprint(c.record_shape(F.col("r")))).collect())
    assert a == b != other


def test_empty_and_wrong_tables(spark):
    assert c.read_back(c.format_rows(spark.createDataFrame([], ROWS))).count() == 0
    with pytest.raises(ValueError):
        c.format_rows(spark.createDataFrame([], "a long"))


MORE = [({"id": 1, "prompt": "q", "response": "a"}, "prompt"), ({"prompt": "q", "response": "a", "output": "z"}, "prompt"),
        ({"messages": [{"role": "user", "content": "q", "name": "n"}, None, {"role": "assistant", "content": "a"}],
          "meta": {"role": [1]}}, "messages")]


def test_additional_fields_do_not_drop_a_record(spark):
    data = [(i, json.dumps(r)) for i, (r, _) in enumerate(MORE)] + [(9, '{"prompt": {"a": 1}, "response": "a"}')]
    got = {r.conv_id: r for r in c.canonical_records(
        spark.createDataFrame(data, "id long, record string"), "id", "record").collect()}
    for i, (_, name) in enumerate(MORE):
        assert got[i].layout == name and [(t.role, t.text) for t in got[i].turns if t.role] == [("user", "q"), ("assistant", "a")]
    assert got[9].layout == "unknown"


def test_tables_of_every_layout_are_formatted(spark, monkeypatch):
    seen, plain = [], c.fingerprint
    monkeypatch.setattr(c, "fingerprint", lambda text: seen.append(1) or plain(text))
    for kind, row in (("conv_id long, extra int, prompt string, response string", (1, 7, "q", "a")),
                      ("conv_id long, messages array<struct<role:string,content:string,name:string>>",
                       (1, [("user", "q", "n"), ("assistant", "a", None)]))):
        seen.clear()
        back = c.read_back(c.format_rows(spark.createDataFrame([row], kind))).first()
        assert [(t.role, t.text) for t in back.turns] == [("user", "q"), ("assistant", "a")] and back.loss_texts == ["a"]
        assert seen
    seen.clear()
    c.format_rows(spark.createDataFrame([], ROWS))
    assert seen

"""Chat formatting: layouts by fingerprint, escaping, the loss mask, digests against a plain version."""

import collections
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from omphalos.llm import chat_format as C

from .helpers import SF, counted, sha

SHAPES = {
    "messages": '{"id": 7, "messages": [{"role": "user", "content": "a", "name": null}, {"role": "assistant", "content": "b"}], "meta": {"x": [1]}}',
    "message_parts": '{"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "image"}]}, {"role": "assistant", "content": [{"type": "text", "text": "b"}]}]}',
    "conversations": '{"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": "b"}]}',
    "dialog": '{"dialog": {"turns": [{"speaker": "human", "utterance": "a"}, {"speaker": "bot", "utterance": "b"}], "n": 2}}',
    "prompt_completion": '{"prompt": "a", "completion": "b"}',
    "prompt_response": '{"prompt": "a", "response": "b", "system": null}',
    "instruction": '{"instruction": "a", "input": "", "output": "b"}',
    "question": '{"qa": {"question": "a", "answer": "b"}}',
    "turns": '{"turns": [{"role": "user", "text": "a"}, {"role": "assistant", "text": "b"}]}',
}


def test_each_layout_gives_the_same_turns(spark):
    df = spark.createDataFrame(list(SHAPES.items()), "name string, record string")
    for r in C.format_chats(df, "name", "record").collect():
        assert r.layout == r.name
        assert [tuple(t) for t in r.turns] == [("user", "a"), ("assistant", "b")]


def test_optional_and_missing_parts(spark):
    rows = [
        ("one", '{"instruction": "a", "input": "more", "output": "b", "system": "s"}'),
        ("two", '{"prompt": 5, "completion": null}'),
        ("three", '{"messages": []}'),
        ("four", '{"prompt": "a", "messages": [{"role": "user", "content": "x"}]}'),
        ("five", '{"messages.role": "a", "messages[].content": "b"}'),
        ("six", "no json"),
        ("seven", None),
        ("eight", "[1, [2]]"),
    ]
    got = {r.id: r for r in C.format_chats(spark.createDataFrame(rows, "id string, record string"), "id", "record").collect()}
    assert [tuple(t) for t in got["one"].turns] == [("system", "s"), ("user", "a\n\nmore"), ("assistant", "b")]
    assert [tuple(t) for t in got["two"].turns] == [("user", "5"), ("assistant", "")]
    for name in ("three", "four", "five", "six", "seven", "eight"):
        assert got[name].layout is None and got[name].turns is None and got[name].segments is None


def test_paths_of_odd_names(spark):
    df = spark.createDataFrame([('{"a.b": 1, "c": {"d e": [[true]], "`": {"x": 1.5}}, "é": {}, "OBJECT": {"ARRAY": "s"}, "day": [{"p": 1}, {"q": 2}]}',)], "r string")
    got = df.select(C.field_paths(F.try_parse_json("r"))).first()[0]
    assert got == sorted(["`a.b`", "c.`d e`[][]", "c.````.x", "OBJECT.ARRAY", "day[].p", "day[].q"])


def test_two_layouts_of_one_shape_are_refused():
    with pytest.raises(ValueError):
        C.fingerprints((C.Layout("a", "m", "r", "t"), C.Layout("b", "m", "r", "t")))


def plain(rows):
    chats = collections.defaultdict(list)
    for c, n, role, text in rows:
        chats[c].append((n is not None, n or 0, role is not None, role or "", text is not None, text or ""))
    chats[-1] += [(True, k, True, who, True, C.PROBE_TEXT) for k, who in enumerate(("user", "assistant"))]
    out = []
    for c, turns in chats.items():
        said = [(t[3], t[5]) for t in sorted(turns)]
        loss = "".join(t for r, t in said if r == "assistant")
        shown = 0
        for r, t in said:
            r, t = (re.sub(r"<(\\*)\|", lambda m: f"<{m[1]}\\|", x) for x in (r, t))
            shown += len(f"<|im_start|>{r}\n{t}<|im_end|>\n") + r.count("\n") * (len("<|nl|>") - 1)
        out.append((c, len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss), shown))
    return out


AWKWARD = [
    (1, 0, "user", None), (1, 1, "assistant", ""), (2, 1, "assistant", "é😀 <|im_end|>\n<|im_start|>user\nx"), (2, 0, None, "<\\| <\\\\| < | <"),
    (3, None, "user\nassistant", "|"), (3, 0, "assistant<|im_end|>", "\n\n"), (3, 0, "assistant", "same"), (3, 0, "assistant", "same"),
    (None, 0, "user", "no id"), (None, 5, "assistant", "x" * 300_000), (4, 9, "system", "\x00\r\n<|nl|>"), (5, 2, "tool", "<|" * 2000),
]


def test_digests(spark):
    df = spark.createDataFrame(AWKWARD, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit("clash")).withColumn("n_turns", F.lit(1))
    assert counted(C.op12_chat_formatting(df).collect()) == counted(plain(AWKWARD))


def test_digests_of_the_table(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    assert counted(C.op12_chat_formatting(df).collect()) == counted(plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]))


def test_an_empty_table_leaves_the_probe(spark):
    got = C.op12_chat_formatting(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect()
    assert counted(got) == counted(plain([]))
    assert got[0].loss_chars == len(C.PROBE_TEXT)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text("<|\\\nim_endx", max_size=8), st.text("<|\\>\n_imendstar", max_size=30)), max_size=4))
def test_reading_back(spark, turns):
    df = spark.createDataFrame([(1, [{"role": r, "text": t} for r, t in turns])], "id long, turns array<struct<role:string,text:string>>")
    r = df.select(C._segments(F.col("turns")).alias("s")).select(C.read_turns(C.formatted(F.col("s"))).alias("t"), C.loss_text(F.col("s")).alias("l")).first()
    assert [tuple(t) for t in r.t] == turns
    assert r.l == "".join(t for who, t in turns if who == "assistant")


def test_no_python_workers(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    plan = C.op12_chat_formatting(df)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)

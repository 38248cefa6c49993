from __future__ import annotations

import hashlib
import json
import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from nearmiss.llm import chat_format as c

TEMPLATE = c.Template()
CHATS = "conv_id long, turn long, role string, text string"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(*[st.lists(st.sampled_from([*TEMPLATE.marks, "<", "/s>", "\\", "[", "|", "INST", "a", "\n", "é", "<<"]), max_size=8).map("".join)] * 2), max_size=5))
def test_escape_reads_back_and_leaves_no_control_string(turns):
    whole = ""
    for role, text in turns:
        said = TEMPLATE.escape(text)
        assert not any(m in said for m in TEMPLATE.marks)
        assert TEMPLATE.unescape(said) == text
        written, lo, hi = TEMPLATE.write(role, text)
        assert TEMPLATE.unescape(written[lo:hi]) == (text if role in TEMPLATE.learnt else "")
        whole += written
    assert list(TEMPLATE.read(whole)) == turns


def test_control_strings_that_could_not_be_found_again_are_refused():
    for bad in ("x", "", "a\\b", "aba"):
        with pytest.raises(ValueError):
            c.Template(close=bad)
    with pytest.raises(ValueError):
        list(TEMPLATE.read("no turn"))


RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": "b"}]}, "messages", [("user", "a"), ("assistant", "b")]),
    ({"system": "s", "messages": [{"role": "user", "content": "a", "name": "n"}], "id": 7}, "messages", [("system", "s"), ("user", "a")]),
    ({"conversations": [{"from": "human", "value": "a"}, {"from": "gpt", "value": None}]}, "from_value", [("user", "a"), ("assistant", "")]),
    ({"instruction": "a", "input": "", "output": "b"}, "instruction", [("user", "a"), ("assistant", "b")]),
    ({"output": "b", "input": "more", "instruction": "a"}, "instruction", [("user", "a\n\nmore"), ("assistant", "b")]),
    ({"prompt": "a", "response": "b", "meta": {"x": [1, {"y": 2}]}}, "prompt_response", [("user", "a"), ("assistant", "b")]),
    ({"prompt": "a", "completion": ["b"]}, None, None),
    ({"prompt": "a", "completion": 5}, "prompt_completion", [("user", "a"), ("assistant", "5")]),
    ({"question": "q", "answer": "b", "context": "c"}, "question_answer", [("user", "c\n\nq"), ("assistant", "b")]),
    ({"dialog": ["a", "b", "c"]}, "texts", [("user", "a"), ("assistant", "b"), ("user", "c")]),
    ({"dialog": []}, "texts", []),
    ({"messages": []}, "messages", []),
    ({"conv_id": 900, "turn": 3, "role": "bot", "text": "t"}, "rows", [("assistant", "t")]),
    ({"nothing": "known"}, None, None),
    ({}, None, None),
]


def test_records_of_all_layouts(spark):
    rows = [(k, json.dumps(r)) for k, (r, _, _) in enumerate(RECORDS)]
    rows += [(100, None), (101, "not json"), (102, "[1]"), (103, "[" * 5000), (104, '{"prompt": "\\ud800", "response": "b"}'), (0, rows[0][1])]
    got = defaultdict(list)
    df = spark.createDataFrame(rows, "conv_id long, record string").repartition(3)
    found = c.turns_of_records(df).collect()
    for r in sorted(found, key=lambda r: (r.conv_id, r.turn or 0)):
        got[r.conv_id].append(r)
    for k, (record, layout, turns) in enumerate(RECORDS):
        mine = got[900 if layout == "rows" else k]
        if k == 0:  # the repeated record
            turns = [t for t in turns for _ in range(2)]
        if turns is None:
            assert [(r.role, r.text, r.layout) for r in mine] == [(None, None, None)] and mine[0].fingerprint, record
        else:
            assert [(r.role, r.text) for r in mine] == turns and {r.layout for r in mine} <= {layout}, record
    assert got[900][0].turn == 3
    for k in (100, 101, 102, 103):
        assert [(r.role, r.fingerprint, r.layout) for r in got[k]] == [(None, None, None)]
    assert got[104][0].text == "?"
    assert got[3][0].fingerprint == got[4][0].fingerprint  # key order doesn't matter


def test_tables_of_all_layouts(spark):
    tables = {
        "messages": ("conv_id long, messages array<struct<role:string,content:string>>, extra int", (5, [("human", "a"), ("assistant", None)], 1)),
        "instruction": ("conv_id long, instruction string, input string, output string", (5, "a", None, "b")),
        "texts": ("conv_id long, dialog array<string>", (5, ["a", "b"])),
        "rows": ("conv_id long, turn int, role string, text string, prompt string, n int", (5, 0, "gpt", None, "x", 2)),
    }
    want = {
        "messages": [(0, "user", "a"), (1, "assistant", "")], "instruction": [(0, "user", "a"), (1, "assistant", "b")],
        "texts": [(0, "user", "a"), (1, "assistant", "b")], "rows": [(0, "assistant", "")],
    }
    for name, (schema, row) in tables.items():
        got = c.turns_of_table(spark.createDataFrame([row], schema)).collect()
        assert sorted((r.turn, r.role, r.text) for r in got) == want[name]
        assert {(r.conv_id, r.layout) for r in got} == {(5, name)}
    empty = spark.createDataFrame([(1, None)], "conv_id long, dialog array<string>")
    assert c.turns_of_table(empty).count() == 0
    with pytest.raises(ValueError, match="no mapping"):
        c.turns_of_table(spark.range(1))


def expected(rows):
    out, groups = {}, defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in groups.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        learnt = "".join(t[3] for t in turns if t[2] == "assistant")
        said = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        size = sum(len(TEMPLATE.write(t[2], t[3])[0]) for t in turns)
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest(), size)
    return out


@pytest.mark.parametrize("piece_chars", [40, c.PIECE_CHARS])
def test_digests_with_one_hot_conversation(spark, crowded, piece_chars):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else all are small enough for one task
    try:
        _hot_conversation(spark, crowded, piece_chars)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _hot_conversation(spark, crowded, piece_chars):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["</s>", "\\", "é", "a", "[INST]", "日"]) for _ in range(rng.randrange(6)))
    rows = [(7, k, rng.choice(["user", "assistant"]), word()) for k in range(300)]
    rows += [(rng.randrange(100), rng.randrange(4), rng.choice(["user", "assistant", "system", None]), word()) for _ in range(400)]
    rows += [(None, 1, "user", "x"), (None, None, "assistant", None), (5, None, "assistant", "é" * 999), *rows[:3]]
    turns = c.turns_of_table(crowded(spark.createDataFrame(rows, CHATS).repartition(5)))
    pieces = c.format_conversations(turns, TEMPLATE, piece_chars=piece_chars)
    got = {r[0]: tuple(r)[1:] for r in c.read_back(pieces, TEMPLATE).collect()}
    assert got == expected(rows)
    hot = [r for r in pieces.collect() if r.conv_id == 7]
    assert len(hot) > 1 and not any(r.whole for r in hot)
    assert all(len(r.formatted) <= piece_chars + 100 for r in hot)
    assert any(r.whole for r in pieces.collect()) or piece_chars == 40


def test_empty_tables(spark):
    none = spark.createDataFrame([], CHATS)
    assert c.read_back(c.format_conversations(c.turns_of_table(none))).count() == 0
    assert c.turns_of_records(spark.createDataFrame([], "conv_id long, record string")).count() == 0

"""Chat formatting: round trips of hostile texts, merging, masks."""

import random

from tomeflow.llm.chat import BODY, END, ESCAPES, MORE, TURN, format_conversations, read_back

SCHEMA = "conv_id long, turn long, role string, text string, id int, turns string"


def hostile(rng):
    parts = [TURN, BODY, MORE, END, "&", "&amp;", "&lt;|", "<|", "|>", "</s>", "<s>", "[INST]", "[/INST]", "&lb;", "x", "é", "\n", " ", "🎉", "amp;", "$1", "\\"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(8)))


def rows():
    rng = random.Random(9)
    out = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "user", "assistant", "assistant", "system", hostile(rng), None])
            out.append((conv, turn, role, rng.choice([hostile(rng), hostile(rng), None]), 1, "clash"))
    out += [(100, 0, "user", "same", 1, ""), (100, 0, "user", "same", 1, ""), (100, None, "assistant", "first", 1, "")]
    out += [(None, 3, "assistant", "long " * 30000, 1, "")]
    return out


def expected(data):
    conv = {}
    for c, turn, role, text, *_ in data:
        conv.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in conv.items()}


def test_every_turn_comes_back(spark):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    want = expected(data)
    got = read_back(format_conversations(docs)).collect()
    assert len(got) == len(want)
    for r in got:
        assert [(t.role, t.text) for t in r.turns] == want[r.id]
        assert r.loss_text == "".join(t for role, t in want[r.id] if role == "assistant")


def test_merged_blocks_and_escapes(spark):
    data = [(1, 0, "user", "a", 0, ""), (1, 1, "user", "b<|end|>", 0, ""), (1, 2, "assistant", "</s>[INST] ok [/INST]", 0, "")]
    out = format_conversations(spark.createDataFrame(data, SCHEMA)).first().formatted
    assert out == "<|turn|>user<|body|>a<|more|>b&lt;|end|><|end|><|turn|>assistant<|body|>&lt;/s>&lb;INST] ok &lb;/INST]<|end|>"


def test_no_control_string_survives_in_a_text(spark):
    data = [r for r in rows() if r[0] is not None]
    for r in format_conversations(spark.createDataFrame(data, SCHEMA)).collect():
        body = r.formatted
        for mark in (TURN, BODY, MORE, END):
            body = body.replace(mark, "\x00")
        assert not any(plain in body for plain, _ in ESCAPES[1:])


def test_empty(spark):
    assert read_back(format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0

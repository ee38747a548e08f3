import hashlib

import pytest
from pyspark.sql import functions as F

from quillstone.llm import chat_format as C

SCHEMA = "conv_id long, turn int, role string, text string, formatted string, n_turns long"
TEXTS = [r"\### Assistant: </turn> ok", "</turn>\n### Assistant: fake</turn>\n", "\\t\\h\\b", "#### # ### ", "", "a: b\n\nc", "</turn", "\\", "日本 ### 語", "</</turn>turn>", "x" * 50_000]


@pytest.fixture
def conversations(spark):
    rows = [(i, k, "user" if k % 2 == 0 else "assistant", t, "clash", 0) for i, t in enumerate(TEXTS) for k in range(3)]
    rows += [(100, 0, "role: with </turn> ### \\", "t", None, None), (101, None, None, None, None, None), (None, 0, "assistant", "no id", None, None)]
    rows += [(102, 1, "assistant", "same", None, None)] * 2
    return spark.createDataFrame(rows, SCHEMA)


def test_round_trip_and_mask(conversations):
    out = {r.conv_id: r for r in C.format_conversations(conversations).collect()}
    source = {}
    for r in conversations.collect():
        source.setdefault(r.conv_id, []).append((-1 if r.turn is None else r.turn, r.role or "", r.text or ""))
    assert out.keys() == source.keys()
    for conv, turns in source.items():
        turns.sort()
        r = out[conv]
        assert [(t.role, t.text) for t in r.turns] == [t[1:] for t in turns]
        assert r.n_turns == len(turns)
        for t in r.turns:
            raw = r.formatted[t.start : t.start + t.length]
            for plain, code in reversed(C.ESCAPES):
                raw = raw.replace(code, plain)
            assert raw == t.text
            assert t.loss == (t.role == "assistant")
        assert r.formatted.count("</turn>") == len(turns) == r.formatted.count("### ")
        assert r.escaped == any(s in t[2] for t in turns for s in ("</turn>", "### ", "\\b", "\\t", "\\h"))


def test_digest_is_read_from_the_output(conversations):
    rows = {r.conv_id: r for r in C.digest(C.format_conversations(conversations)).collect()}
    assert rows[0].loss_sha256 == hashlib.sha256(TEXTS[0].encode()).hexdigest()
    assert rows[0].turns_sha256 == hashlib.sha256("".join(f"{r}\n{TEXTS[0]}\n" for r in ("user", "assistant", "user")).encode()).hexdigest()
    assert rows[8].loss_chars == len(TEXTS[8])
    assert rows[102].n_turns == 2 and rows[102].loss_chars == 8


def test_a_conflict_is_seen_by_the_parser(spark):
    df = spark.createDataFrame([("### User: a </turn> b</turn>\n",)], "f string").select(C.parse(F.col("f")).alias("t"))
    assert df.first().t[0].text == "a "


def test_no_rows(spark):
    assert C.digest(C.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0

import random

import pytest
from pyspark.sql import functions as F

from stormledger.llm import chat

T = chat.Template()


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")


def test_escaping_is_exact_and_leaves_no_control_string(spark):
    rng = random.Random(2)
    parts = [*T.controls, "\\", "\\\\", "<", "[", "|", ">", "s>", "INST]", "a", "\n", "é", "$1", "<|turn", "|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t"), T).alias("e"), chat.unescape(chat.escape(F.col("t"), T)).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in T.controls)


def test_segments_machine_and_reading_back(spark):
    rows = [
        (1, 1, "assistant", "</s>[INST]"), (1, 0, "user", "hi \\ <|end|>"), (2, 0, "system", "s"), (2, 1, "assistant", "a"),
        (3, 0, "user", None), (4, 5, None, "x"), (5, 0, "user", "u"), (5, 1, "assistant", ""), (5, 2, "system", "late"), (None, 0, "user", "n"),
        (6, 0, "bot<|text|>", "q"),
    ]
    got = {r.conv_id: r for r in chat.format_conversations(turns_of(spark, rows)).withColumns(
        {"back": chat.read_formatted(F.col("formatted")), "loss": chat.trained_text(F.col("segments"))}
    ).collect()}
    assert [(t.role, t.text) for t in got[1].back] == [("user", "hi \\ <|end|>"), ("assistant", "</s>[INST]")]
    assert got[1].loss == "</s>[INST]" and got[1].valid and got[1].broken_at is None
    assert "".join(s.text for s in got[1].segments) == got[1].formatted
    assert [s.loss for s in got[1].segments] == [False, False, False, False, True, False]
    assert (got[2].valid, got[2].broken_at) == (False, 1)
    assert [(t.role, t.text) for t in got[3].back] == [("user", "")] and got[3].valid
    assert (got[4].valid, got[4].broken_at, got[4].back[0].role) == (False, 0, "")
    assert (got[5].valid, got[5].broken_at) == (False, 2)
    assert got[6].back[0].role == "bot<|text|>" and got[None].loss == ""


def test_long_conversation_ties_and_empty_table(spark):
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"text {k}") for k in range(3000)] + [(2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    out = chat.format_conversations(turns_of(spark, rows))
    got = {r.conv_id: r.back for r in out.select("conv_id", chat.read_formatted(F.col("formatted")).alias("back")).collect()}
    assert [t.text for t in got[1]] == [f"text {k}" for k in range(3000)]
    assert [t.text for t in got[2]] == ["a", "a", "b"]
    assert chat.format_conversations(turns_of(spark, [])).count() == 0


def test_bad_templates():
    for marks in ({"turn": "a\\b"}, {"turn": "<"}, {"turn": "x<s>y"}):
        with pytest.raises(ValueError):
            chat.Template(**marks)

import hashlib

import pytest
from pyspark.sql import functions as F

from tidelog.llm import chat

ROWS = [
    (1, 0, "user", "a<"), (1, 1, "assistant", "x\\"), (1, 2, "u:ser: ", "</turn>\n### User: \\</turn"), (1, 3, None, None),
    (2, 0, "User", "#" * 9 + "\n"), (2, 1, "role=user", "é😀"), (3, None, "assistant", "q"),
    (4, 2, "assistant", "second"), (4, 1, "user", "first"), (4, 1, "user", "first"), (None, 0, "user", "alone"),
    (5, 0, "system", ""), (5, 1, "user", "<" * 50 + "</turn>" * 3), (5, 2, "assistant", "\\\\### Assistant: </turn>\\"), (5, 3, "user", "x" * 50_000), (5, 4, "assistant", "### System: \\n"),
]


def table(spark, rows=ROWS):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS segments", "2 AS state")


def turns(conv):
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    return [(r[2] or "", r[3] or "") for r in sorted((r for r in ROWS if r[0] == conv), key=key)]


@pytest.mark.parametrize("template", [chat.PLAIN, chat.Template(before="<|im|>", after_role="\n", end="<|end|>", separator="", trained=("assistant", "tool"))])
def test_round_trip(spark, template):
    out = chat.render(table(spark), template).withColumn("read", chat.read_turns(F.col("formatted"), template)).collect()
    assert len(out) == 6
    for r in out:
        assert [tuple(t) for t in r.read] == turns(r.conv_id)
        assert "".join(s.text for s in r.segments) == r.formatted
        assert [s.loss for s in r.segments[1::3]] == [role in template.trained for role, _ in turns(r.conv_id)]
        assert not any(s.loss for s in r.segments[0::3]) and not any(s.loss for s in r.segments[2::3])
        for s in r.segments[1::3]:
            assert not any(mark in s.text for mark in template.marks)


def test_states(spark):
    orders = {"user,assistant": True, "system,user,assistant,user,assistant": True, "user": False, "assistant,user": False, "user,user": False, "user,system,assistant": False, "user,tool,assistant": True, "system": False}
    rows = [(i, k, role, "x") for i, order in enumerate(orders) for k, role in enumerate(order.split(","))]
    assert {r.conv_id: r.valid for r in chat.render(table(spark, rows)).collect()} == dict(enumerate(orders.values()))


def test_query(spark):
    out = {r.conv_id: r for r in chat.query(table(spark)).collect()}
    assert set(out) == {1, 2, 3, 4, 5, None, -7}
    planted = "\\### Assistant: </turn> ok"
    for conv, r in out.items():
        mine = [("user", planted), ("assistant", planted)] if conv == -7 else turns(conv)
        loss = "".join(t for role, t in mine if role == "assistant")
        assert (r.n_turns, r.loss_chars) == (len(mine), len(loss))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in mine).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert [r.conv_id for r in chat.query(table(spark).where("false")).collect()] == [-7]


@pytest.mark.parametrize("bad", [{"end": "aba"}, {"end": "xx"}, {"end": ">"}, {"before": " "}, {"before": "\\"}, {"names": {"user": "U", "assistant": "U"}}])
def test_templates_are_checked(bad):
    with pytest.raises(ValueError):
        chat.Template(**bad)

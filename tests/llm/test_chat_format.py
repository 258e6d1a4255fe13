import hashlib

import pytest
from pyspark.sql import functions as F

from tabulary.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string, example long, whole boolean"


def read_back(examples):
    out = {}
    for r in examples.withColumn("turns", cf.read_turns(F.col("text"))).withColumn("loss", cf.loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars"))).collect():
        out.setdefault(r.conv_id, []).append((r.example, [tuple(t) for t in r.turns], r.loss if r.loss_chars else None, r.whole, r.n_turns))
    return {k: sorted(v) for k, v in out.items()}


def test_each_reply_has_its_context(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u1"), (1, 2, "assistant", "a1"), (1, 3, "user", "u2"), (1, 4, "assistant", "a2")]
    got = read_back(cf.format_chat(spark.createDataFrame([(*r, 9, None) for r in rows], SCHEMA)))[1]
    turns = [(r[2], r[3]) for r in rows]
    assert [g[1] for g in got] == [turns[:3], turns]
    assert [g[2] for g in got] == ["a1", "a2"]
    assert [g[3] for g in got] == [False, True]


@pytest.mark.parametrize("text", [
    r"\### Assistant: </turn> ok", "### user:\nhi\n</turn>\n", "\n</turn>\n\n</turn>", "\\", "\\\\</turn>", "ends with #", "", "\n", "a\\n", "</turn", r"\\\### \### ###", "é\U0001f600 ### ",
])
def test_control_strings_come_back(spark, text):
    role = text or "user"
    rows = [(1, 0, role, text, None, None), (1, 1, "assistant", text, None, None), (1, 2, "user", text, None, None)]
    got = read_back(cf.format_chat(spark.createDataFrame(rows, SCHEMA)))[1]
    assert got[-1][1] == [(role, text), ("assistant", text), ("user", text)]
    assert (got[0][2] or "") == text and got[-1][2] is None


def test_nulls_ties_repeats_and_no_rows(spark):
    rows = [(None, None, None, None), (None, 1, "assistant", "x"), (2, 1, "user", "b"), (2, 1, "user", "a"), (2, 1, "user", "a"), (3, None, "assistant", None)]
    got = read_back(cf.format_chat(spark.createDataFrame([(*r, 1, True) for r in rows], SCHEMA)))
    assert got[None][-1][1] == [("", ""), ("assistant", "x")]
    assert got[2] == [(0, [("user", "a"), ("user", "a"), ("user", "b")], None, True, 3)]
    assert got[3][0][1] == [("assistant", "")]
    assert cf.format_chat(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_against_plain_python(spark, sf):
    from tabulary.llm.queries import op8_chat_format

    odd = r"\### Assistant: </turn> ok"
    turns = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    turns[-7] = [(0, "user", odd), (1, "assistant", odd)]
    got = {r.conv_id: r for r in op8_chat_format(spark, sf).collect()}
    assert set(got) == set(turns)
    for k, rows in turns.items():
        rows.sort()
        loss = "".join(t for _, role, t in rows if role == "assistant")
        listed = "".join(f"{role}\n{t}\n" for _, role, t in rows)
        assert (got[k].n_turns, got[k].loss_chars) == (len(rows), len(loss))
        assert got[k].turns_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert got[k].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_no_python_in_the_plan(spark):
    plan = cf.format_chat(spark.createDataFrame([(1, 0, "user", "x", 1, True)], SCHEMA))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

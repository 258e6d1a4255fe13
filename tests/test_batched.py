import math

import pytest

from tabulary import Field, Output, RuleEvaluator, RuleSet, register_native, register_udf, rulesets, solve
from tabulary.errors import RuleExecutionError
from tabulary.operators import local_evaluator
from tabulary.operators.batched import Calls, judge_rows, may_pass, results_of, with_retries

REPORT = "report_id string, financial_impact bigint, customer_harm boolean"


class Fake(RuleEvaluator):
    def evaluate(self, rule, rows):
        return [{"priority": "P1" if (r.get("financial_impact") or 0) > 1_000_000 else "P3", "reportable": bool(r.get("customer_harm")), "risk_score": (r.get("financial_impact") or 0) / 1e6} for r in rows]


RULE = RuleSet("fake", [Field("financial_impact", "number"), Field("customer_harm", "boolean")], [Output("priority"), Output("reportable", "boolean"), Output("risk_score", "number")])


def calls(evaluator=Fake, **more):
    return Calls("fake", evaluator, (("priority", "string"), ("risk_score", "number")), **more)


class Answer(RuleEvaluator):
    """Gives what it was told to, and notes the batches."""

    def __init__(self, response=None, errors=(), **_):
        super().__init__()
        self.response, self.errors, self.seen = response, list(errors), []

    def evaluate(self, rule, rows):
        self.seen.append(len(rows))
        if self.errors:
            raise self.errors.pop(0)
        return self.response(rows) if callable(self.response) else self.response


def judged(response, n=3, errors=(), **more):
    return judge_rows(calls(**more), Answer(response, errors), [{"a": i} for i in range(n)], sleep=lambda s: None)


def test_batches_and_order(spark):
    df = spark.createDataFrame([(f"R{i}", i * 100000, i % 2 == 0) for i in range(25)], REPORT).coalesce(1)
    out = solve(df, RULE, evaluator=Fake, batch_size=10, max_concurrent_requests_per_partition=1)
    assert out.columns == ["report_id", "financial_impact", "customer_harm", "priority", "reportable", "risk_score", "_rule_error"]
    got = out.collect()
    assert [r.report_id for r in got] == [f"R{i}" for i in range(25)]
    assert [r.priority for r in got] == ["P1" if i > 10 else "P3" for i in range(25)]
    answer = Answer(lambda rows: [{"priority": str(r["a"])} for r in rows])
    values, errors = judge_rows(calls(batch_size=10, concurrency=3), answer, [{"a": i} for i in range(25)])
    assert sorted(answer.seen) == [5, 10, 10] and values["priority"] == [str(i) for i in range(25)] and errors == [None] * 25


def test_short_long_and_odd_responses():
    assert judged([{"priority": "x"}])[1] == [None, "missing_response_for_row", "missing_response_for_row"]
    assert judged(None)[1] == ["missing_response_for_row"] * 3
    assert judged([{"priority": "x"}] * 9)[0]["priority"] == ["x"] * 3
    values, errors = judged([{"priority": "x"}, None, {"priority": "y", "error": "bad"}])
    assert values["priority"] == ["x", None, "y"] and errors == [None, "missing_response_for_row", "bad"]
    assert judged([{}, {}, {}])[1] == [None] * 3
    assert judged([{"priority": 1}], on_error="raise")[1][1] == "missing_response_for_row"
    with pytest.raises(RuleExecutionError, match="bad"):
        judged([{"error": "bad"}] * 3, on_error="raise")
    declared = Calls("r", Answer, (("error", "string"),))
    values, errors = judge_rows(declared, Answer([{"error": "mine"}]), [{}])
    assert values["error"] == ["mine"] and errors == [None]


def test_failed_batches_are_alone():
    def response(rows):
        if rows[0]["a"] == 2:
            raise ValueError("no")
        return [{"priority": "x"}] * len(rows)

    values, errors = judged(response, n=6, batch_size=2, concurrency=1)
    assert errors == [None, None, "ValueError: no", "ValueError: no", None, None] and values["priority"] == ["x", "x", None, None, "x", "x"]


def test_responses():
    class Item:
        def __init__(self):
            self.visible, self._hidden = "yes", "no"

    class Model:
        def model_dump(self):
            return {"a": 1}

    class Broken:
        """Methods that fail, or give no mapping, are passed over."""

        def __init__(self):
            self.b = 2

        def model_dump(self):
            raise TypeError

        def dict(self):
            return [1]

    class Wrapper:
        data = [{"x": 1}]

    assert list(results_of(None)) == [] and list(results_of({})) == [] and list(results_of({"only": 1})) == [{"only": 1}]
    assert list(results_of([{"a": 1}, Item(), Model(), Broken(), None, 3])) == [{"a": 1}, {"visible": "yes"}, {"a": 1}, {"b": 2}, None, None]
    assert list(results_of(Wrapper())) == [{"x": 1}]
    assert list(results_of({"data": [{"x": 1}]})) == [{"data": [{"x": 1}]}]


class Http(Exception):
    def __init__(self, status, text=""):
        super().__init__(text)
        self.status_code = status


@pytest.mark.parametrize("error,again", [
    (Http(503), True), (Http(408), True), (Http(404, "timeout"), False), (Exception("Connection reset by peer"), True), (Exception("HTTP 502 Bad Gateway"), True),
    (Exception("rate LIMIT"), True), (Exception("400 Bad Request"), False), (Exception("Invalid rule"), False),
])
def test_what_is_tried_again(error, again):
    assert may_pass(error) is again


def test_retries_wait_longer_each_time():
    slept = []
    answer = Answer([{}], errors=[Http(503)] * 7)
    with_retries(lambda: answer.evaluate("r", [{}]), 7, slept.append)
    assert slept == [1, 2, 4, 8, 16, 30, 30]
    with pytest.raises(Http):
        with_retries(lambda: Answer([], errors=[Http(503)] * 5).evaluate("r", []), 2, slept.append)
    slept.clear()
    with pytest.raises(Http):
        with_retries(lambda: Answer([], errors=[Http(400)]).evaluate("r", []), 5, slept.append)
    assert not slept


def test_calls_that_hang_time_out():
    import time

    tries = []

    def response(rows):
        tries.append(1)
        time.sleep(1 if len(tries) < 3 else 0)
        return [{"priority": "x"}]

    assert judged(response, n=1, timeout_seconds=0.1, max_retries=1)[1] == ["TimeoutError: timed out after 0.1 s"]
    assert judged(response, n=1, timeout_seconds=0.1, max_retries=2)[0]["priority"] == ["x"]


def test_values_pass_through_untouched(spark):
    df = spark.createDataFrame([(9007199254740993, math.nan, b"x"), (None, None, None)], "financial_impact bigint, x double, y binary").coalesce(1)
    got = solve(df, RULE, evaluator=Fake).collect()
    assert got[0].financial_impact == 9007199254740993 and math.isnan(got[0].x) and got[0].y == b"x" and got[0].risk_score == 9007199254740993 / 1e6


def test_native_and_batched_agree(spark):
    rule = rulesets.screening()
    df = spark.createDataFrame([(k, a) for k in ("purchase", "signup", "view", None) for a in (0.0, 50.0, 150.0, 300.5, None, math.nan)], "kind string, amount double")
    native, batched = (sorted(map(repr, solve(df, rule, evaluator=e).drop("amount").collect())) for e in (None, local_evaluator(rule)))
    assert native == batched


def test_empty_frames(spark):
    df = spark.createDataFrame([], REPORT)
    assert solve(df, RULE, evaluator=Fake).count() == 0 and solve(df, rulesets.triage()).count() == 0


def test_sql_functions(spark):
    rule = rulesets.screening()
    spark.createDataFrame([(1, "purchase", 400.0), (2, "signup", 60.0), (3, None, None), (4, "it's", math.nan)], "id int, kind string, amount double").createOrReplaceTempView("tx")
    schema, call = register_native(spark, "screen", rule)
    assert schema.fieldNames() == ["action", "fraud_score", "reason", "_rule_error"]
    native = spark.sql(f"SELECT id, r.* FROM (SELECT id, {call} r FROM tx)")
    assert "Python" not in native._jdf.queryExecution().executedPlan().toString()
    register_udf(spark, "screen_udf", rule)
    udf = spark.sql("SELECT id, r.* FROM (SELECT id, screen_udf(struct(*)) r FROM tx)")
    want = solve(spark.table("tx"), rule).drop("kind", "amount").collect()
    assert native.collect() == want == udf.collect()
    filtered = spark.sql("SELECT r.action FROM (SELECT screen_udf(struct(*)) r FROM tx) WHERE r._rule_error IS NULL")
    assert filtered._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_sql_function_has_the_errors_of_solve(spark):
    rule = RuleSet(
        "half", [Field("a", "number"), Field("b", "number")], [Output("q", "number"), Output("r", "number"), Output("s")],
        [], default={"s": "ok", "q": {"divide": [1, {"field": "a"}]}},
        derived={"r": {"if": {"field": "b", "op": ">=", "value": 0}, "then": {"add": [1, {"divide": [{"field": "a"}, {"field": "b"}]}]}, "else": None}},
    )
    spark.createDataFrame([(a, b) for a in (0.0, 2.0, None) for b in (-1.0, 0.0, 4.0, None, math.nan)], "a double, b double").createOrReplaceTempView("halves")
    _, call = register_native(spark, "half_rule", rule)
    native = spark.sql(f"SELECT r.* FROM (SELECT {call} r FROM halves)").collect()
    assert native == solve(spark.table("halves"), rule).drop("a", "b").collect()
    assert {r["_rule_error"] for r in native} == {None, "q: division by zero", "r: division by zero"}


@pytest.mark.parametrize("bad", [{"name": ""}, {"name": " "}, {"rule": ""}, {"batch_size": 0}, {"batch_size": 1001}])
def test_udf_arguments(spark, bad):
    with pytest.raises(ValueError):
        register_udf(spark, **({"name": "f", "rule": "r", "evaluator": Fake, "output_schema": RULE.schema} | bad))

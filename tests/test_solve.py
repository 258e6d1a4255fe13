import datetime as dt
import math
import random
from decimal import Decimal

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulary import Field, Output, Registry, Rule, RuleEngineError, RuleSet, SchemaConflictError, SchemaInferenceError, rulesets, solve
from tabulary.operators import register_native
from tabulary.operators.solve import spread_out
from tabulary.plans.local import evaluate_row

REPORT = "report_id string, financial_impact bigint, customer_harm boolean"
SIMPLE = RuleSet(
    "simple", [Field("financial_impact", "number"), Field("customer_harm", "boolean")],
    [Output("priority"), Output("reportable", "boolean"), Output("risk_score", "number")],
    [Rule({"field": "financial_impact", "op": ">", "value": 1_000_000}, {"priority": "P1"})],
    default={"priority": "P3"},
    derived={"reportable": {"condition": {"field": "customer_harm", "op": "==", "value": True}}, "risk_score": {"divide": [{"field": "financial_impact"}, 1_000_000]}},
)


def reports(spark):
    return spark.createDataFrame([("R1", 500000, False), ("R2", 2000000, True), ("R3", 1500000, True)], REPORT)


def test_outputs_follow_inputs(spark):
    out = solve(reports(spark), SIMPLE)
    assert out.columns == ["report_id", "financial_impact", "customer_harm", "priority", "reportable", "risk_score", "_rule_error"]
    assert [tuple(r)[3:] for r in out.orderBy("report_id").collect()] == [("P3", False, 0.5, None), ("P1", True, 2.0, None), ("P1", True, 1.5, None)]


def test_triage_tiers(spark):
    cases = [
        (6_000_000.0, False, 0, 99, "fiduciary_breach", "P1"), (1.0, False, 0, 99, "insider_activity", "P1"), (1_000_001.0, False, 0, 99, "x", "P2"),
        (5.0, True, 1001, 5, "x", "P2"), (5.0, True, 1000, 5, "x", "P3"), (100_001.0, None, None, 5, None, "P3"), (5.0, False, 0, 5, "x", "P4"), (None, None, None, None, None, "P4"),
    ]
    df = spark.createDataFrame([(i, *c[:5]) for i, c in enumerate(cases)], "id int, financial_impact double, customer_harm boolean, parties_affected int, days_open int, incident_type string")
    got = solve(df, rulesets.triage()).orderBy("id").collect()
    assert [r.priority for r in got] == [c[5] for c in cases]
    assert [r.reportable for r in got] == [True, True, True, True, True, False, False, False]
    assert got[0].rationale == "tier P1 for fiduciary_breach" and got[0].risk_score == 30.0


def test_collisions(spark):
    df = reports(spark).withColumn("Priority", F.lit("UNKNOWN")).select("Priority", "report_id", "financial_impact", "customer_harm")
    out = solve(df, SIMPLE)
    assert out.columns == ["report_id", "financial_impact", "customer_harm", "priority", "reportable", "risk_score", "_rule_error"]
    with pytest.raises(SchemaConflictError, match="Priority"):
        solve(df, SIMPLE, on_conflict="error")
    with pytest.raises(SchemaConflictError):
        solve(df, SIMPLE, error_column="priority")


def test_mapping(spark):
    df = spark.createDataFrame([("R1", 2000000, True)], "report_id string, `fin.impact` bigint, `ha``rm` boolean")
    out = solve(df, SIMPLE, input_mapping={"fin.impact": "financial_impact", "ha`rm": "customer_harm"})
    assert out.columns[:3] == ["report_id", "fin.impact", "ha`rm"] and out.collect()[0].priority == "P1"
    with pytest.raises(ValueError, match="input_mapping"):
        solve(df, SIMPLE, input_mapping={"nope": "x"})
    with pytest.raises(ValueError, match="several columns"):
        solve(reports(spark), SIMPLE, input_mapping={"report_id": "customer_harm"})


def test_large_integers_and_nan_pass_through(spark):
    df = spark.createDataFrame([(9007199254740993, math.nan), (None, 1.0)], "financial_impact bigint, x double").coalesce(1)
    got = solve(df, SIMPLE).collect()
    assert got[0].financial_impact == 9007199254740993 and math.isnan(got[0].x)


def test_nan_and_null_do_not_fire(spark):
    df = spark.createDataFrame([(math.nan,), (None,), (2e6,)], "financial_impact double")
    assert [r.priority for r in solve(df, SIMPLE).collect()] == ["P3", "P3", "P1"]


def test_missing_inputs(spark):
    df = spark.createDataFrame([(1,), (None,)], "other int")
    assert [r.priority for r in solve(df, SIMPLE).collect()] == ["P3", "P3"]
    with pytest.raises(ValueError, match="customer_harm"):
        solve(df, SIMPLE, on_missing_input="error")
    rule = RuleSet("d", [Field("a", "number", default=7)], [Output("b", "number")], derived={"b": {"field": "a"}})
    assert [r.b for r in solve(spark.createDataFrame([(1,), (None,)], "a int"), rule).collect()] == [1.0, 7.0]


RATIO = RuleSet("ratio", [Field("a", "number"), Field("b", "number")], [Output("r", "number"), Output("s")], default={"s": "ok"}, derived={"r": {"divide": [{"field": "a"}, {"field": "b"}]}})


def test_errors_stay_in_their_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (None, 0.0), (1.0, None)], "a double, b double")
    assert [tuple(r)[2:] for r in solve(df, RATIO).collect()] == [(0.5, "ok", None), (None, None, "r: division by zero"), (None, "ok", None), (None, "ok", None)]
    with pytest.raises(Exception, match="division by zero"):
        solve(df, RATIO, on_error="raise").select("s").collect()
    assert solve(df.where("b > 0"), RATIO, on_error="raise").collect()[0].r == 0.5


def test_unused_branch_does_not_raise(spark):
    rule = RuleSet("u", [Field("a", "number")], [Output("x", "number")], derived={"x": {"if": {"field": "a", "op": ">", "value": 0}, "then": {"divide": [1, {"field": "a"}]}, "else": 0}})
    got = solve(spark.createDataFrame([(0.0,), (2.0,)], "a double"), rule, on_error="raise").collect()
    assert [r.x for r in got] == [0.0, 0.5]


def test_chained_rules_keep_the_first_error(spark):
    once = solve(spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double"), RATIO)
    again = RuleSet("again", [Field("r", "number")], [Output("t", "number")], derived={"t": {"divide": [1, {"subtract": [{"field": "r"}, 0.5]}]}})
    got = solve(once, again)
    assert got.columns == ["a", "b", "r", "s", "t", "_rule_error"]
    assert [r._rule_error for r in got.collect()] == ["r: division by zero", "t: division by zero"]


def test_typed_outputs(spark):
    rule = RuleSet("t", [Field("a", "number")], [Output("n", "number"), Output("l", "list"), Output("j", "object")], default={"n": {"field": "a"}, "l": {"list": [{"field": "a"}, 2]}, "j": {"object": {"a": {"field": "a"}, "z": None}}})
    schema = T.StructType([T.StructField("n", T.LongType(), False), T.StructField("l", T.ArrayType(T.LongType())), T.StructField("j", T.StringType())])
    out = solve(spark.createDataFrame([(3.0,), (1.5,)], "a double"), rule, output_schema=schema)
    assert out.schema["n"].dataType == T.LongType() and out.schema["n"].nullable
    got = out.collect()
    assert (got[0].n, got[0].l) == (3, [3, 2]) and '"z":null' in got[0].j
    assert got[1].n is None and "can't be read as bigint" in got[1]._rule_error
    with pytest.raises(SchemaInferenceError):
        solve(spark.createDataFrame([(3.0,)], "a double"), rule, output_schema=T.StructType([T.StructField("n", T.DateType())]))


@pytest.mark.parametrize("bad", [
    {"batch_size": 0}, {"batch_size": 1001}, {"max_concurrent_requests_per_partition": 0}, {"on_conflict": "x"}, {"on_missing_input": "x"}, {"on_error": "x"}, {"max_retries": -1}, {"timeout_seconds": 0},
])
def test_arguments(spark, bad):
    with pytest.raises(ValueError):
        solve(reports(spark), SIMPLE, **bad)


def test_names_come_from_a_registry(spark):
    known = Registry(SIMPLE, load=lambda name: RuleSet.from_dict({"name": name, "responseSchema": [{"key": "x", "type": "number"}], "default": {"x": 1}}))
    assert solve(reports(spark), "simple", rules=known).collect()[0].priority == "P3"
    assert solve(reports(spark), "other", rules=known).collect()[0].x == 1.0
    with pytest.raises(SchemaInferenceError):
        solve(reports(spark), "missing", rules=Registry())


@pytest.mark.parametrize("change", [
    {"default": {"nope": 1}}, {"rules": [Rule({"field": "nope", "op": "==", "value": 1}, {})]}, {"rules": [Rule({"field": "a", "op": "~", "value": 1}, {})]},
    {"derived": {"x": {"output": "y"}, "y": 1}}, {"outputs": []}, {"outputs": [Output("x"), Output("x")]}, {"default": {"x": 1}, "derived": {"x": 2}}, {"inputs": [Field("a", "odd")]},
])
def test_rules_are_checked_when_made(change):
    with pytest.raises(RuleEngineError):
        RuleSet(**({"name": "r", "inputs": [Field("a")], "outputs": [Output("x"), Output("y")]} | change))


def test_json_round_trip():
    import json

    for rule in (rulesets.triage(), rulesets.screening(), rulesets.grid(5)):
        assert RuleSet.from_json(json.dumps(rule.to_dict())).to_dict() == rule.to_dict()


def random_rules(rng):
    def condition(depth=0):
        kind = rng.randrange(5 if depth < 3 else 2)
        if kind == 2:
            return {"all": [condition(depth + 1) for _ in range(rng.randrange(3))]}
        if kind == 3:
            return {"any": [condition(depth + 1) for _ in range(rng.randrange(3))]}
        if kind == 4:
            return {"not": condition(depth + 1)}
        return rng.choice([
            {"field": "n", "op": rng.choice(["==", "!=", "<", "<=", ">", ">="]), "value": rng.randrange(-2, 5)}, {"field": "x", "op": "between", "value": [-1, rng.randrange(3)]},
            {"field": "s", "op": rng.choice(["in", "not in"]), "value": rng.sample(["a", "bb", "c", "d d"], rng.randrange(3))}, {"field": "s", "op": rng.choice(["contains", "starts with", "ends with"]), "value": "b"},
            {"field": "b", "op": "==", "value": True}, {"field": rng.choice("nxsb"), "op": rng.choice(["is null", "is not null"])}, {"field": "x", "op": ">", "value": {"field": "n"}}, {"field": "s", "op": "matches", "value": "^[ab]+$"},
        ])

    return RuleSet(
        "random", [Field("n", "number"), Field("x", "number"), Field("s"), Field("b", "boolean")], [Output("hit", "number"), Output("v", "number"), Output("t")],
        [Rule(condition(), {"hit": i}) for i in range(6)], default={"hit": -1}, derived={"v": {"divide": [{"add": [{"field": "x"}, {"field": "b"}]}, {"field": "n"}]}, "t": {"template": "<{s}> {hit}"}},
    )


def native(spark, df, rule, name="ways", **options):
    """The rule as a SQL function, over the columns of ``df`` that it names."""
    types = {f.name: f.dataType for f in df.schema if f.name in {i.name for i in rule.inputs}}
    _, call = register_native(spark, name, rule, input_types=types, **options)
    df.createOrReplaceTempView("ways_rows")
    return spark.sql(f"SELECT *, {call} AS r FROM ways_rows").select(*df.columns, "r.*")


@pytest.mark.parametrize("seed", range(6))
def test_all_ways_agree(spark, seed):
    """Columns, SQL function and plain Python on the same rules and rows, nulls and NaN included."""
    rng = random.Random(seed)
    rule = random_rules(rng)
    pick = lambda *xs: rng.choice([None, *xs])
    rows = [(i, pick(0, 1, 2, 3, 9007199254740993), pick(-1.5, 0.0, 0.5, 2.0, math.nan), pick("a", "bb", "c", "", "d d"), pick(True, False)) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, n bigint, x double, s string, b boolean")
    columns = ["id", "hit", "v", "t", "_rule_error"]
    by_column, by_function = (sorted(map(tuple, made.select(*columns).collect())) for made in (solve(df, rule), native(spark, df, rule)))
    assert by_column == by_function
    for i, hit, v, _, error in by_column:
        want = evaluate_row(rule, dict(zip("nxsb", rows[i][1:])))
        assert error == want.get("error")
        if not error:
            assert hit == want["hit"] and (v == want["v"] or v == pytest.approx(want["v"]))


def hard_conditions():
    """Comparisons that are easily got wrong outside Spark's own expressions."""
    field = lambda f, op, value=None: {"field": f, "op": op, "value": value}
    return [
        field("big", "==", 9007199254740993), field("big", ">", 9007199254740992), field("price", "==", 0.1), field("price", "between", [{"field": "low"}, {"multiply": [{"field": "low"}, 3]}]),
        field("price", "<", {"field": "low"}), field("name", "matches", r"^\p{Lu}.*\d$"), field("name", "in", ["it's", "back\\slash", "Ü1"]), field("name", "not in", ["it's"]),
        field("due", ">=", "2024-05-01"), field("due", "between", ["2024-01-01", "2024-02-01"]), field("flag", "==", True), field("low", "is null"), field("name", "contains", "'"),
        {"not": {"any": [field("big", "is null"), field("name", "starts with", "it")]}}, field("code", "==", 7), field("big", "==", {"field": "big"}),
    ]


HARD = "id int, big bigint, price decimal(10,2), low double, name string, due date, flag boolean, code string"
HARD_ROWS = [
    (9007199254740993, 0.1, 0.05, "it's", "2024-05-01", True, "7"), (None, None, None, None, None, None, None), (9007199254740992, -5.0, math.nan, "back\\slash", "2024-01-15", False, "x"),
    (1, 99.99, 40.0, "Ü1", "2023-12-31", None, None), (0, 0.0, 0.0, "é2", None, True, "7.0"), (-1, 12.34, 12.34, "", "2024-02-01", False, " 7 "),
]


def hard_rows(spark):
    rows = [(i, b, None if p is None else Decimal(str(p)), w, n, None if d is None else dt.date.fromisoformat(d), f, c) for i, (b, p, w, n, d, f, c) in enumerate(HARD_ROWS)]
    return spark.createDataFrame(rows, HARD)


def hard_rule(conditions, spread=1):
    """A rule per condition, repeated behind rules that never fire."""
    never = [Rule({"field": "big", "op": "==", "value": -100 - k}, {"hit": -k, "label": "never"}) for k in range(spread)]
    return RuleSet(
        "hard", [Field("big", "number"), Field("price", "number"), Field("low", "number", default=5), Field("name"), Field("due", "date"), Field("flag", "boolean", default=False), Field("code", "number")],
        [Output("hit", "number"), Output("label"), Output("ratio", "number")],
        [*never, *(Rule(c, {"hit": 1000 + k, "label": f"rule {k}"}) for k, c in enumerate(conditions))], default={"hit": 0, "label": "none"},
        derived={"ratio": {"divide": [{"output": "hit"}, {"field": "low"}]}},
    )


def test_hard_comparisons_agree(spark):
    df = hard_rows(spark)
    for k, condition in enumerate(hard_conditions()):
        rule = hard_rule([condition])
        columns = ["id", "hit", "label", "ratio", "_rule_error"]
        assert sorted(map(tuple, solve(df, rule).select(*columns).collect())) == sorted(map(tuple, native(spark, df, rule).select(*columns).collect())), k
    got = {r.id: r.hit for r in solve(df, hard_rule([{"field": "big", "op": "==", "value": 9007199254740993}])).collect()}
    assert got == {0: 1000, 1: 0, 2: 0, 3: 0, 4: None, 5: 0}  # row 4 divides by zero


@pytest.mark.parametrize("spread", [0, 99, 100, 101, 400])
def test_the_size_of_a_table_changes_nothing(spark, spread):
    df, conditions = hard_rows(spark), hard_conditions()
    small = {r.id: (r.hit, r.label) for r in solve(df, hard_rule(conditions, 1)).collect()}
    large = solve(df, hard_rule(conditions, spread), matched_column="rule")
    assert {r.id: (r.hit, r.label) for r in large.collect()} == small
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    if spread == 101:
        assert sorted(map(tuple, native(spark, df, hard_rule(conditions, spread)).select("id", "hit", "label").collect())) == sorted((i, *x) for i, x in small.items())


def test_native_defaults_and_chains(spark):
    """Defaults count, a text that is no number fails no job, and chained outputs stay short."""
    chain = {"x0": {"field": "a"}} | {f"x{k}": {"add": [{"output": f"x{k - 1}"}, {"output": f"x{k - 1}"}]} for k in range(1, 13)}
    rule = RuleSet("chain", [Field("a", "number", default=2), Field("t")], [Output(n, "number") for n in [*chain, "n"]], default={"n": {"field": "t"}}, derived=chain)
    df = spark.createDataFrame([(1.0, "5"), (None, "nope"), (math.nan, None)], "a double, t string")
    got = sorted(map(str, native(spark, df, rule).select("x0", "x12", "n").collect()))
    assert got == sorted(map(str, solve(df, rule).select("x0", "x12", "n").collect()))
    assert "x12=4096.0" in got[0] and "x0=2.0" in got[1]
    assert len(spark.sql("DESCRIBE FUNCTION EXTENDED ways").toPandas().to_string()) < 20_000


def test_values_of_several_types(spark):
    """Branches of an output need not have one type."""
    rule = RuleSet(
        "mixed", [Field("a", "number")], [Output("s"), Output("n", "number")],
        [Rule({"field": "a", "op": ">", "value": 1}, {"s": 1, "n": "7"}), Rule({"field": "a", "op": ">", "value": 0}, {"s": "n/a", "n": "x"})],
        default={"s": True, "n": {"if": {"field": "a", "op": "is null"}, "then": "y", "else": 3}},
    )
    df = spark.createDataFrame([(2.0,), (0.5,), (-1.0,), (None,)], "a double")
    want = [(2.0, "1.0", 7.0), (0.5, "n/a", None), (-1.0, "true", 3.0), (None, "true", None)]
    for made in (solve(df, rule), native(spark, df, rule)):
        assert [tuple(r) for r in made.select("a", "s", "n").collect()] == want


def test_names_used_inside_may_be_columns(spark):
    df = reports(spark).withColumn("__fired", F.lit("x")).withColumn("__out_priority", F.lit("y")).withColumn("__error", F.lit("z"))
    got = solve(df, SIMPLE, matched_column="rule").where("report_id = 'R2'").collect()[0]
    assert (got["__fired"], got["__out_priority"], got["__error"], got.priority, got.rule) == ("x", "y", "z", "P1", 1)


def test_plan_prunes_and_pushes(spark, sf):
    scored = solve(spark.read.parquet(f"{sf}/orders.parquet"), rulesets.screening(), input_mapping={"o_orderstatus": "kind", "o_totalprice": "amount"})
    plan = scored.where("o_orderkey < 100").select("o_orderkey", "action")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "LessThan(o_orderkey,100)" in plan
    assert "o_orderdate" not in plan.split("ReadSchema")[1]


def test_spreading(spark):
    assert spread_out(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 8
    assert spread_out(spark.range(0, 10, 1, 3)).rdd.getNumPartitions() == 3
    assert solve(reports(spark).coalesce(1), SIMPLE, auto_repartition=True).count() == 3


def test_queries_of_the_engine_match_their_sql(spark, sf):
    import duckdb

    from tabulary import queries

    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    for name, run in queries.QUERIES.items():
        df = run(spark, sf)
        result = connection.execute(queries.ORACLE_SQL[name])
        columns = [d[0] for d in result.description]
        assert sorted(columns) == sorted(df.columns), name
        want = sorted(repr([row[columns.index(c)] for c in df.columns]) for row in result.fetchall())
        assert sorted(repr(list(r)) for r in df.collect()) == want, name


def test_raise_is_seen_as_a_spark_error(spark):
    from tabulary.operators import RuleEvaluator

    class Failing(RuleEvaluator):
        def evaluate(self, rule, rows):
            raise RuntimeError("boom")

    with pytest.raises(PythonException, match="boom"):
        solve(reports(spark), SIMPLE, evaluator=Failing, on_error="raise").collect()

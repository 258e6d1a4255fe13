"""The engine's queries: ``name -> f(spark, sf_dir)``, and DuckDB SQL that gives the same rows."""

from __future__ import annotations

import tempfile
import uuid
from types import SimpleNamespace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import rulesets
from .operators import ERROR_COLUMN, RuleEvaluator, local_evaluator, outside_domain, register_native, register_udf, solve
from .plans.definitions import loader
from .plans.rules import Field, Output, Registry, Rule, RuleSet
from .sources import tables
from .streaming.split import read_split, windowed_counts, write_split


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident reports made of orders, their customers and their lines."""
    lines = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("quantity"), F.max(F.col("l_returnflag") == "R").alias("harm")
    )
    orders, customers = _read(spark, sf_dir, "orders"), _read(spark, sf_dir, "customer")
    joined = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left").join(customers, orders["o_custkey"] == customers["c_custkey"])
    return joined.select(
        F.col("o_orderkey").alias("report_id"),
        F.col("c_name").alias("entity_name"),
        F.col("o_orderpriority").alias("incident_type"),
        (F.col("o_totalprice") * 20).alias("financial_impact"),
        F.coalesce("harm", F.lit(False)).alias("customer_harm"),
        F.coalesce(F.col("quantity") * 10, F.lit(0.0)).alias("parties_affected"),
        (F.col("o_orderkey") % 180).alias("days_open"),
    )


def _triaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return solve(reports(spark, sf_dir), rulesets.triage("1-URGENT"))


_REPORTS = """
WITH lines AS (
  SELECT l_orderkey, sum(l_quantity) AS quantity, bool_or(l_returnflag = 'R') AS harm FROM lineitem GROUP BY l_orderkey
), reports AS (
  SELECT o_orderkey AS report_id, c_name AS entity_name, o_orderpriority AS incident_type, o_totalprice * 20 AS financial_impact,
         coalesce(harm, false) AS customer_harm, coalesce(quantity * 10, 0) AS parties_affected, o_orderkey % 180 AS days_open
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey JOIN customer ON o_custkey = c_custkey
), tiers AS (
  SELECT *, CASE WHEN financial_impact > 5000000 OR incident_type = '1-URGENT' THEN 'P1'
                 WHEN financial_impact > 1000000 OR (customer_harm AND parties_affected > 1000) THEN 'P2'
                 WHEN financial_impact > 100000 OR customer_harm THEN 'P3' ELSE 'P4' END AS priority FROM reports
), triaged AS (
  SELECT *, priority IN ('P1', 'P2') OR (days_open <= 30 AND customer_harm) AS reportable,
         least(100, financial_impact / 200000 + 20 * CAST(customer_harm AS INT)) AS risk_score,
         'tier ' || priority || ' for ' || incident_type AS rationale, CAST(NULL AS VARCHAR) AS _rule_error FROM tiers
)
"""


def triage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _triaged(spark, sf_dir).groupBy("priority").agg(
        F.count("*").alias("n"), F.sum(F.col("reportable").cast("long")).alias("reportable"), F.round(F.avg("risk_score"), 1).alias("avg_risk")
    )


def triage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _triaged(spark, sf_dir).select("report_id", "entity_name", "priority", "reportable", F.round("risk_score", 6).alias("risk_score"), "rationale", ERROR_COLUMN)


def triage_high_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    high = _triaged(spark, sf_dir).where(F.col("priority").isin("P1", "P2") & F.col("customer_harm"))
    return high.select("report_id", "priority", F.round("risk_score", 6).alias("risk_score")).orderBy(F.desc("risk_score"), "report_id")


def triage_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 riskiest reports: a top-k, of which Spark sorts 50 a task."""
    return _triaged(spark, sf_dir).select("report_id", "priority", F.round("risk_score", 6).alias("risk_score")).orderBy(F.desc("risk_score"), "report_id").limit(50)


def triage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rule fired how often."""
    scored = solve(reports(spark, sf_dir), rulesets.triage("1-URGENT"), matched_column="matched_rule")
    return scored.groupBy("matched_rule").agg(F.count("*").alias("n"))


def event_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = solve(_read(spark, sf_dir, "events"), rulesets.screening(), input_mapping={"event_type": "kind", "value": "amount"})
    return scored.select("event_id", "event_type", "action", F.round("fraud_score", 9).alias("fraud_score"), "reason")


_ACTIONS = """
WITH acted AS (
  SELECT *, CASE WHEN value > 300 AND event_type IN ('purchase', 'error') THEN 'block'
                 WHEN value BETWEEN 150 AND 300 OR (event_type LIKE 'sign%' AND value > 50) THEN 'review' ELSE 'allow' END AS action FROM events
)
"""


def _priced() -> RuleSet:
    over = lambda v: {"field": "o_totalprice", "op": ">", "value": v}
    return RuleSet(
        "priced", [Field("o_totalprice", "number"), Field("o_orderpriority")], [Output("o_orderpriority")],
        [Rule(over(300_000), {"o_orderpriority": "big"}), Rule({"all": [over(150_000), {"field": "o_orderpriority", "op": "ends with", "value": "HIGH"}]}, {"o_orderpriority": "high"})],
        default={"o_orderpriority": {"field": "o_orderpriority"}},
    )


def collision_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return solve(_read(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice"), _priced())


def input_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = RuleSet(
        "discount", [Field("quantity", "number"), Field("discount", "number")], [Output("tier"), Output("bonus", "number")],
        [
            Rule({"all": [{"field": "quantity", "op": ">=", "value": 40}, {"field": "discount", "op": "<", "value": 0.05}]}, {"tier": "gold", "bonus": {"multiply": [{"field": "quantity"}, 0.5]}}),
            Rule({"field": "quantity", "op": ">=", "value": 20}, {"tier": "silver", "bonus": 2}),
        ],
        default={"tier": "none", "bonus": 0},
    )
    scored = solve(_read(spark, sf_dir, "lineitem"), rule, input_mapping={"l_quantity": "quantity", "l_discount": "discount"})
    return scored.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "tier", "bonus")


def coerce_number_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as numbers and booleans, those that are neither included."""
    n = F.col("event_id") % 10
    texts = ["3.14", " 2 ", "1e3", "1_000", "1d", "nope", "", "true", " YES ", "t"]
    text = F.element_at(F.array(*map(F.lit, texts)), (n + 1).cast("int"))
    rule = RuleSet("read", [Field("text")], [Output("as_number", "number"), Output("as_boolean", "boolean")], default={"as_number": {"field": "text"}, "as_boolean": {"field": "text"}})
    return solve(_read(spark, sf_dir, "events").select("event_id", text.alias("text")), rule)


def coerce_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderkey") % 5 == 0, F.date_format(day, "yyyy-MM-dd")).when(F.col("o_orderkey") % 5 == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(F.col("o_orderkey") % 5 == 2, F.date_format(day, "MM/dd/yyyy")).when(F.col("o_orderkey") % 5 == 3, F.date_format(day, "yyyyMMdd")).otherwise("not a date")
    )
    rule = RuleSet("dated", [Field("text")], [Output("due", "date")], default={"due": {"field": "text"}})
    scored = solve(_read(spark, sf_dir, "orders").select("o_orderkey", text.alias("text")), rule)
    return scored.select("o_orderkey", F.date_format("due", "yyyy-MM-dd HH:mm:ss").alias("due"))


def typed_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = RuleSet(
        "labels", [Field("p_brand"), Field("p_size", "number")], [Output("tags", "list"), Output("box", "object"), Output("json", "object"), Output("size", "number")],
        default={"tags": {"list": [{"field": "p_brand"}, "part"]}, "box": {"object": {"brand": {"field": "p_brand"}, "size": {"field": "p_size"}}}, "json": {"object": {"brand": {"field": "p_brand"}}}, "size": {"field": "p_size"}},
    )
    schema = T.StructType([T.StructField("tags", T.ArrayType(T.StringType())), T.StructField("box", T.StructType([T.StructField("brand", T.StringType()), T.StructField("size", T.LongType())])), T.StructField("json", T.StringType()), T.StructField("size", T.LongType())])
    scored = solve(_read(spark, sf_dir, "part"), rule, output_schema=schema)
    return scored.select("p_partkey", F.col("tags")[0].alias("first_tag"), F.size("tags").cast("long").alias("n_tags"), F.col("box.brand").alias("brand"), F.col("box.size").alias("box_size"), "json", "size")


def _balance() -> RuleSet:
    below = lambda v: {"field": "c_acctbal", "op": "<", "value": v}
    return RuleSet(
        "balance", [Field("c_acctbal", "number"), Field("c_mktsegment")], [Output("band"), Output("share", "number")],
        [Rule(below(0), {"band": "debt"}), Rule({"all": [below(3000), {"not": {"field": "c_mktsegment", "op": "in", "value": ["BUILDING", "MACHINERY"]}}]}, {"band": "low"})],
        default={"band": "fine"}, derived={"share": {"divide": [{"field": "c_acctbal"}, 1000]}},
    )


def sql_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule as a SQL function that Spark inlines."""
    _, call = register_native(spark, "balance_rule", _balance())
    _read(spark, sf_dir, "customer").createOrReplaceTempView("tabulary_customers")
    return spark.sql(f"""
        SELECT c_custkey, r.band AS band, round(r.share, 6) AS share
        FROM (SELECT c_custkey, {call} AS r FROM tabulary_customers) WHERE r.band <> 'fine'""")


def sql_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rule called with a whole row by an evaluator, once per row although filtered and projected."""
    register_udf(spark, "balance_udf", _balance())
    _read(spark, sf_dir, "customer").createOrReplaceTempView("tabulary_customers")
    return spark.sql("""
        SELECT c_custkey, r.band AS band, round(r.share, 6) AS share
        FROM (SELECT c_custkey, balance_udf(struct(*)) AS r FROM tabulary_customers) WHERE r.band <> 'fine'""")


def batched_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule judged by batches of calls, with the columns that pass through as they were."""
    rule = RuleSet(
        "rating", [Field("s_acctbal", "number"), Field("s_nationkey", "number")], [Output("rating"), Output("weight", "number")],
        [Rule({"field": "s_acctbal", "op": ">", "value": 5000}, {"rating": "A"}), Rule({"field": "s_nationkey", "op": "in", "value": [1, 2, 3]}, {"rating": "B"})],
        default={"rating": "C"}, derived={"weight": {"add": [{"field": "s_acctbal"}, {"field": "s_nationkey"}]}},
    )
    scored = solve(_read(spark, sf_dir, "supplier"), rule, evaluator=local_evaluator(rule), batch_size=32)
    return scored.select("s_suppkey", "s_name", "rating", F.round("weight", 6).alias("weight"), ERROR_COLUMN)


def _halves() -> RuleSet:
    return RuleSet(
        "halves", [Field("value", "number"), Field("event_id", "number")], [Output("ratio", "number"), Output("size")],
        [Rule({"field": "value", "op": ">", "value": 100}, {"size": "large"})], default={"size": "small"},
        derived={"ratio": {"divide": [{"field": "value"}, {"if": {"field": "event_id", "op": "<", "value": 100}, "then": 0, "else": 2}]}},
    )


def _shared_folder(spark: SparkSession) -> str:
    """A new folder that the driver and all executors reach."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    base = base or "file://" + tempfile.mkdtemp(prefix="tabulary-")
    return f"{base.rstrip('/')}/tabulary-{uuid.uuid4().hex}"


def stream_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of events scored; what fails goes to a place of its own."""
    base = _shared_folder(spark)
    schema = _read(spark, sf_dir, "events").schema
    stream = tables.file_stream(spark, f"{sf_dir}/event[s].parquet", schema).select("event_id", "value")
    query = write_split(solve(stream, _halves()), f"{base}/good", f"{base}/failed", f"{base}/checkpoint")
    query.awaitTermination()
    good, failed = read_split(spark, f"{base}/good"), read_split(spark, f"{base}/failed")
    columns = ["event_id", F.round("ratio", 9).alias("ratio"), "size"]
    return good.select(*columns, F.lit(None).cast("string").alias(ERROR_COLUMN)).unionByName(failed.select(*columns, ERROR_COLUMN))


def error_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A division by zero in some rows leaves the others as they are."""
    rule = RuleSet(
        "unit", [Field("l_extendedprice", "number"), Field("l_linenumber", "number")], [Output("unit_price", "number"), Output("seen")],
        default={"seen": "yes"}, derived={"unit_price": {"divide": [{"field": "l_extendedprice"}, {"subtract": [{"field": "l_linenumber"}, 3]}]}},
    )
    scored = solve(_read(spark, sf_dir, "lineitem"), rule)
    return scored.select("l_orderkey", "l_linenumber", F.round("unit_price", 6).alias("unit_price"), "seen", ERROR_COLUMN)


def chained_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second rule on the outcome of a first one; the first error stays."""
    first = solve(_read(spark, sf_dir, "events").select("event_id", "value"), _halves())
    second = RuleSet("level", [Field("ratio", "number")], [Output("level")], [Rule({"field": "ratio", "op": ">", "value": 100}, {"level": "top"}), Rule({"field": "ratio", "op": "is null"}, {"level": "unknown"})], default={"level": "usual"})
    return solve(first, second).select("event_id", "size", "level", ERROR_COLUMN)


def missing_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = RuleSet(
        "sized", [Field("n_regionkey", "number"), Field("population", "number", default=5)], [Output("class"), Output("population_used", "number")],
        [Rule({"all": [{"field": "population", "op": ">=", "value": 5}, {"field": "n_regionkey", "op": "<", "value": 2}]}, {"class": "near"})],
        default={"class": "far"}, derived={"population_used": {"field": "population"}},
    )
    return solve(_read(spark, sf_dir, "nation"), rule).select("n_nationkey", "class", "population_used")


def wide_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of 200 rules."""
    scored = solve(_read(spark, sf_dir, "lineitem"), rulesets.grid(), input_mapping={"l_quantity": "quantity", "l_extendedprice": "price"})
    return scored.select("l_orderkey", "l_linenumber", "cell")


def _never(n: int) -> list[Rule]:
    """Rules that no row fires, to make a table wide."""
    return [Rule({"all": [{"field": "key", "op": "<", "value": -k}, {"field": "key", "op": "is not null"}]}, {"cell": -k}) for k in range(n)]


def wide_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More than 200 comparisons on decimals, among them for equality with a value that floats can't hold."""
    cells = [Rule({"field": "price", "op": "==", "value": 0.1}, {"cell": 1}), Rule({"field": "price", "op": "<", "value": 0.5}, {"cell": 2}), Rule({"field": "price", "op": "between", "value": [1000.25, 2000]}, {"cell": 3})]
    rule = RuleSet("decimals", [Field("key", "number"), Field("price", "number")], [Output("cell", "number")], [*_never(100), *cells], default={"cell": 0})
    price = F.when(F.col("l_orderkey") % 7 == 0, F.col("l_discount")).otherwise(F.col("l_extendedprice")).cast("decimal(10,2)")
    rows = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_orderkey").alias("key"), price.alias("price"))
    return solve(rows, rule).select("l_orderkey", "l_linenumber", "cell")


def wide_operands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide table whose comparisons have fields, arithmetic, dates, patterns and large integers on the right."""
    field = lambda f, op, value: {"field": f, "op": op, "value": value}
    cells = [
        Rule(field("total", "between", [{"field": "low"}, {"multiply": [{"field": "low"}, 1.5]}]), {"cell": 1}), Rule(field("day", "<", "1995-06-01"), {"cell": 2}),
        Rule(field("priority", "matches", r"^\d-\p{Lu}+$"), {"cell": 3}), Rule(field("huge", "==", 9007199254740993), {"cell": 4}), Rule(field("total", ">", {"add": [{"field": "low"}, 100_000]}), {"cell": 5}),
    ]
    rule = RuleSet("operands", [Field("key", "number"), Field("total", "number"), Field("low", "number"), Field("day", "date"), Field("priority"), Field("huge", "number")], [Output("cell", "number")], [*_never(60), *cells], default={"cell": 0})
    huge = F.when(F.col("o_orderkey") % 3 > 0, F.lit(9007199254740992) + F.col("o_orderkey") % 3 - 1)
    rows = _read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("total"), (F.col("o_custkey") * 100.0).alias("low"), F.col("o_orderdate").alias("day"), F.col("o_orderpriority").alias("priority"), huge.alias("huge"))
    return solve(rows, rule).select("o_orderkey", "cell")


def native_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL function with defaults, field operands and chained outputs; a text that is no number fails no job."""
    rule = RuleSet(
        "native", [Field("amount", "number", default=7), Field("low", "number"), Field("text")], [Output("band"), Output("twice", "number"), Output("more", "number"), Output("read", "number")],
        [Rule({"field": "amount", "op": "between", "value": [{"field": "low"}, 400]}, {"band": "mid", "read": {"field": "text"}}), Rule({"field": "amount", "op": "in", "value": [7]}, {"band": "it's"})],
        default={"band": "none"}, derived={"twice": {"add": [{"field": "amount"}, {"field": "amount"}]}, "more": {"divide": [{"output": "twice"}, {"subtract": [{"field": "low"}, 3]}]}},
    )
    _, call = register_native(spark, "native_rule", rule)
    rows = _read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 > 0, F.col("value")).alias("amount"), (F.col("event_id") % 100).cast("double").alias("low"), F.concat(F.col("event_id") % 5, F.when(F.col("event_id") % 2 == 0, "x").otherwise("")).alias("text"))
    rows.createOrReplaceTempView("tabulary_native")
    return spark.sql(f"SELECT event_id, r.band, r.twice, round(r.more, 6) AS more, r.read, r.{ERROR_COLUMN} FROM (SELECT event_id, {call} AS r FROM tabulary_native)")


class _Odd(RuleEvaluator):
    """Answers of every shape: too short, objects, nulls, errors of a row, a batch that fails."""

    def evaluate(self, rule, rows):
        out = []
        for row in rows:
            k = int(row["key"])
            if k == 13:
                raise ValueError("no thirteen")
            out.append(None if k % 4 == 1 else {"error": "odd"} if k % 4 == 3 else type("Result", (), {"__init__": lambda self, k=k: setattr(self, "level", k * 2)})())
        return out[:-1] if len(out) == 1 and int(rows[0]["key"]) == 24 else out


def odd_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows judged one at a time by an evaluator that misbehaves."""
    rule = RuleSet("odd", [Field("key", "number")], [Output("level", "number")])
    scored = solve(_read(spark, sf_dir, "nation"), rule, evaluator=_Odd, input_mapping={"n_nationkey": "key"}, batch_size=1, max_retries=0)
    return scored.select("n_nationkey", "level", ERROR_COLUMN)


def raise_when_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where nothing fails and no column is replaced, the strict modes give the same rows."""
    fine = _read(spark, sf_dir, "events").where("event_id >= 100").select("event_id", "value")
    return solve(fine, _halves(), on_error="raise", on_conflict="error", on_missing_input="error").select("event_id", F.round("ratio", 9).alias("ratio"), "size")


def mixed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An output whose branches are of several types."""
    rule = RuleSet("mixed", [Field("r_regionkey", "number")], [Output("s"), Output("n", "number")], [Rule({"field": "r_regionkey", "op": ">", "value": 2}, {"s": "n/a", "n": "7"}), Rule({"field": "r_regionkey", "op": ">", "value": 1}, {"s": True, "n": "x"})], default={"s": {"field": "r_regionkey"}, "n": 3})
    return solve(_read(spark, sf_dir, "region").select("r_regionkey"), rule).select("r_regionkey", "s", "n")


class _Definitions:
    """A folder of definitions, as a client library would show it: pages of objects."""

    def list(self):
        return SimpleNamespace(data=[SimpleNamespace(slug="ranking", id=7)])

    def pull(self, id):
        field = lambda key, kind: SimpleNamespace(key=key, type=kind)
        return SimpleNamespace(requestSchema=[field("balance", "number")], responseSchema=[field("rank", "string"), field("half", "number"), field("positive", "boolean")])


class _Ranking(RuleEvaluator):
    """Out of order at its first call, as services are at times."""

    calls = 0

    def evaluate(self, rule, rows):
        self.calls += 1
        if self.calls == 1:
            raise ConnectionError("503 temporarily unavailable")
        return [{"rank": "high" if r["balance"] > 5000 else "low", "half": str(r["balance"] / 2), "positive": "yes" if r["balance"] > 0 else "no"} for r in rows]


def stored_definition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outputs told by a definition that is kept elsewhere, values by an evaluator that is asked again after a failure."""
    scored = solve(_read(spark, sf_dir, "supplier").coalesce(1), "ranking", rules=Registry(load=loader(_Definitions())), evaluator=_Ranking, input_mapping={"s_acctbal": "balance"}, max_concurrent_requests_per_partition=1)
    return scored.select("s_suppkey", "rank", F.round("half", 6).alias("half"), "positive", ERROR_COLUMN)


def domain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that a rule does not expect, and how often they come."""
    rule = RuleSet("segments", [Field("segment", values=("BUILDING", "MACHINERY")), Field("c_nationkey", "number", values=tuple(range(20))), Field("c_name")], [Output("o")])
    return outside_domain(_read(spark, sf_dir, "customer"), rule, {"c_mktsegment": "segment"})


class _NoRules:
    def list(self):
        return []

    def pull(self, id):
        raise KeyError(id)


def refusals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is refused, and by which error: before anything runs, but for a row's own failure."""
    events, nation = _read(spark, sf_dir, "events").select("event_id", "value"), _read(spark, sf_dir, "nation").select("n_nationkey")
    named = RuleSet("named", [Field("x")], [Output("N_NATIONKEY")])
    cases = {
        "failed row": lambda: solve(events, _halves(), on_error="raise").agg(F.sum("ratio")).collect(),
        "failed call": lambda: solve(nation, RuleSet("odd", [Field("key", "number")], [Output("level")]), evaluator=_Odd, input_mapping={"n_nationkey": "key"}, on_error="raise").collect(),
        "replaced column": lambda: solve(nation, named, on_conflict="error"),
        "output named as errors": lambda: solve(nation, RuleSet("named", [], [Output(ERROR_COLUMN)])),
        "missing input": lambda: solve(nation, named, on_missing_input="error"),
        "unknown mode": lambda: solve(nation, named, on_error="ignore"),
        "batch too large": lambda: solve(nation, named, batch_size=1001),
        "mapping of no column": lambda: solve(nation, named, input_mapping={"nowhere": "x"}),
        "unknown rule": lambda: solve(nation, "nobody", rules=Registry(load=loader(_NoRules()))),
        "no outputs": lambda: RuleSet("none", [], []),
        "unknown field": lambda: RuleSet("bad", [], [Output("o")], default={"o": {"field": "x"}}),
    }
    rows = []
    for case, call in cases.items():
        try:
            call()
            rows.append((case, "nothing"))
        except Exception as error:  # noqa: BLE001  Spark wraps what executors raise
            rows.append((case, "RuleExecutionError" if "RuleExecutionError" in str(error) else type(error).__name__))
    return tables.rows(spark, rows, "what string, error string")


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream's events counted by day and kind; late ones are waited for an hour."""
    events = tables.file_stream(spark, f"{sf_dir}/event[s].parquet", _read(spark, sf_dir, "events").schema)
    base = _shared_folder(spark)
    counts = windowed_counts(events, "ts", "event_type", "1 day", "1 hour").select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")
    writer = counts.writeStream.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{base}/counts")).outputMode("complete")
    writer.option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/counts")


def generated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions made from a range of ids, as a load test makes them."""
    kinds = F.array(*map(F.lit, ("purchase", "signup", "view")))
    rows = tables.generated(spark, 10_000, 8).select(
        F.concat(F.lit("T-"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("tx_id"), kinds[(F.col("id") % 3).cast("int")].alias("kind"), ((F.col("id") * 37) % 500).cast("double").alias("amount")
    )
    return solve(rows.repartition(8), rulesets.screening()).select("tx_id", "kind", "amount", "action", F.round("fraud_score", 9).alias("fraud_score"))


QUERIES = {f.__name__: f for f in (
    triage_summary, triage_rows, triage_high_priority, triage_top, triage_audit, event_action, collision_overwrite, input_mapping,
    coerce_number_bool, coerce_date, typed_outputs, sql_function, sql_udf, batched_parity, stream_dead_letter, error_isolation,
    chained_rules, missing_default, wide_table, wide_decimal, wide_operands, native_defaults, odd_responses, raise_when_fine, mixed_values,
    stored_definition, domain_report, refusals, stream_windows, generated_rows,
)}

_BALANCE = """
SELECT c_custkey, band, round(c_acctbal / 1000, 6) AS share FROM (
  SELECT *, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 3000 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'low' ELSE 'fine' END AS band FROM customer
) WHERE band <> 'fine'
"""

_HALVED = """
SELECT event_id, CASE WHEN event_id < 100 THEN NULL ELSE value / 2 END AS half, CASE WHEN event_id < 100 THEN NULL WHEN value > 100 THEN 'large' ELSE 'small' END AS size,
       CASE WHEN event_id < 100 THEN 'ratio: division by zero' END AS _rule_error FROM events
"""

ORACLE_SQL = {
    "triage_summary": _REPORTS + "SELECT priority, count(*) AS n, CAST(sum(CAST(reportable AS BIGINT)) AS BIGINT) AS reportable, round(avg(risk_score), 1) AS avg_risk FROM triaged GROUP BY priority",
    "triage_rows": _REPORTS + "SELECT report_id, entity_name, priority, reportable, round(risk_score, 6) AS risk_score, rationale, _rule_error FROM triaged",
    "triage_high_priority": _REPORTS + "SELECT report_id, priority, round(risk_score, 6) AS risk_score FROM triaged WHERE priority IN ('P1', 'P2') AND customer_harm",
    "triage_top": _REPORTS + "SELECT report_id, priority, round(risk_score, 6) AS risk_score FROM triaged ORDER BY round(risk_score, 6) DESC, report_id LIMIT 50",
    "triage_audit": _REPORTS + "SELECT CASE priority WHEN 'P1' THEN 1 WHEN 'P2' THEN 2 WHEN 'P3' THEN 3 END AS matched_rule, count(*) AS n FROM triaged GROUP BY 1",
    "event_action": _ACTIONS + "SELECT event_id, event_type, action, round(least(1, value / 400), 9) AS fraud_score, action || ' ' || event_type AS reason FROM acted",
    "collision_overwrite": """
SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice > 300000 THEN 'big' WHEN o_totalprice > 150000 AND o_orderpriority LIKE '%HIGH' THEN 'high' ELSE o_orderpriority END AS o_orderpriority,
       CAST(NULL AS VARCHAR) AS _rule_error FROM orders""",
    "input_mapping": """
SELECT l_orderkey, l_linenumber, l_quantity, l_discount,
       CASE WHEN l_quantity >= 40 AND l_discount < 0.05 THEN 'gold' WHEN l_quantity >= 20 THEN 'silver' ELSE 'none' END AS tier,
       CASE WHEN l_quantity >= 40 AND l_discount < 0.05 THEN l_quantity * 0.5::DOUBLE WHEN l_quantity >= 20 THEN 2::DOUBLE ELSE 0::DOUBLE END AS bonus FROM lineitem""",
    "coerce_number_bool": """
SELECT event_id, t AS text, n AS as_number, b AS as_boolean, CAST(NULL AS VARCHAR) AS _rule_error
FROM events JOIN (VALUES (0, '3.14', 3.14::DOUBLE, CAST(NULL AS BOOLEAN)), (1, ' 2 ', 2, NULL), (2, '1e3', 1000, NULL), (3, '1_000', 1000, NULL), (4, '1d', NULL, NULL), (5, 'nope', NULL, NULL),
  (6, '', NULL, NULL), (7, 'true', NULL, true), (8, ' YES ', NULL, true), (9, 't', NULL, NULL)) v(k, t, n, b) ON event_id % 10 = k""",
    "coerce_date": """
SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 5 = 1 THEN date_trunc('second', o_orderdate) WHEN o_orderkey % 5 < 4 THEN date_trunc('day', o_orderdate) END, '%Y-%m-%d %H:%M:%S') AS due FROM orders""",
    "typed_outputs": """
SELECT p_partkey, p_brand AS first_tag, CAST(2 AS BIGINT) AS n_tags, p_brand AS brand, CAST(p_size AS BIGINT) AS box_size, '{"brand":"' || p_brand || '"}' AS json, CAST(p_size AS BIGINT) AS size FROM part""",
    "sql_function": _BALANCE,
    "sql_udf": _BALANCE,
    "batched_parity": """
SELECT s_suppkey, s_name, CASE WHEN s_acctbal > 5000 THEN 'A' WHEN s_nationkey IN (1, 2, 3) THEN 'B' ELSE 'C' END AS rating, round(s_acctbal + s_nationkey, 6) AS weight, CAST(NULL AS VARCHAR) AS _rule_error FROM supplier""",
    "stream_dead_letter": f"SELECT event_id, round(half, 9) AS ratio, size, _rule_error FROM ({_HALVED})",
    "error_isolation": """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN round(l_extendedprice / (l_linenumber - 3), 6) END AS unit_price, CASE WHEN l_linenumber <> 3 THEN 'yes' END AS seen,
       CASE WHEN l_linenumber = 3 THEN 'unit_price: division by zero' END AS _rule_error FROM lineitem""",
    "chained_rules": f"SELECT event_id, size, CASE WHEN half > 100 THEN 'top' WHEN half IS NULL THEN 'unknown' ELSE 'usual' END AS level, _rule_error FROM ({_HALVED})",
    "missing_default": "SELECT n_nationkey, CASE WHEN n_regionkey < 2 THEN 'near' ELSE 'far' END AS class, 5::DOUBLE AS population_used FROM nation",
    "wide_table": """
WITH cells AS (SELECT i, 50 - i % 50 AS q, 1000 + 250 * i AS p FROM range(200) t(i)),
hits AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, row_number() OVER () AS k FROM lineitem)
SELECT any_value(l_orderkey) AS l_orderkey, any_value(l_linenumber) AS l_linenumber, CAST(coalesce(min(i), -1) AS DOUBLE) AS cell
FROM hits LEFT JOIN cells ON l_quantity >= q AND l_extendedprice < p GROUP BY k""",
    "wide_decimal": """
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN p = 0.10 THEN 1 WHEN p < 0.5 THEN 2 WHEN p BETWEEN 1000.25 AND 2000 THEN 3 ELSE 0 END AS DOUBLE) AS cell
FROM (SELECT *, CAST(CASE WHEN l_orderkey % 7 = 0 THEN l_discount ELSE l_extendedprice END AS DECIMAL(10, 2)) AS p FROM lineitem)""",
    "wide_operands": """
SELECT o_orderkey, CAST(CASE WHEN o_totalprice BETWEEN o_custkey * 100.0 AND o_custkey * 150.0 THEN 1 WHEN o_orderdate < DATE '1995-06-01' THEN 2 WHEN regexp_matches(o_orderpriority, '^[0-9]-[A-Z]+$') THEN 3
  WHEN o_orderkey % 3 = 2 THEN 4 WHEN o_totalprice > o_custkey * 100.0 + 100000 THEN 5 ELSE 0 END AS DOUBLE) AS cell FROM orders""",
    "native_defaults": """
SELECT event_id, CASE WHEN NOT bad THEN band END AS band, CASE WHEN NOT bad THEN 2 * amount END AS twice, CASE WHEN NOT bad THEN round(2 * amount / (low - 3), 6) END AS more,
       CASE WHEN NOT bad AND band = 'mid' AND event_id % 2 = 1 THEN CAST(event_id % 5 AS DOUBLE) END AS "read", CASE WHEN bad THEN 'more: division by zero' END AS _rule_error
FROM (SELECT *, low = 3 AS bad, CASE WHEN amount BETWEEN low AND 400 THEN 'mid' WHEN amount = 7 THEN 'it''s' ELSE 'none' END AS band
      FROM (SELECT event_id, CASE WHEN event_id % 3 > 0 THEN value ELSE 7 END AS amount, CAST(event_id % 100 AS DOUBLE) AS low FROM events))""",
    "odd_responses": """
SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 AND n_nationkey <> 24 THEN CAST(n_nationkey * 2 AS DOUBLE) END AS level,
       CASE WHEN n_nationkey = 13 THEN 'ValueError: no thirteen' WHEN n_nationkey % 4 = 1 OR n_nationkey = 24 THEN 'missing_response_for_row' WHEN n_nationkey % 4 = 3 THEN 'odd' END AS _rule_error FROM nation""",
    "raise_when_fine": "SELECT event_id, round(value / 2, 9) AS ratio, CASE WHEN value > 100 THEN 'large' ELSE 'small' END AS size FROM events WHERE event_id >= 100",
    "mixed_values": """
SELECT r_regionkey, CASE WHEN r_regionkey > 2 THEN 'n/a' WHEN r_regionkey > 1 THEN 'true' ELSE CAST(r_regionkey AS VARCHAR) END AS s, CASE WHEN r_regionkey > 2 THEN 7::DOUBLE WHEN r_regionkey > 1 THEN NULL ELSE 3::DOUBLE END AS n FROM region""",
    "stored_definition": """
SELECT s_suppkey, CASE WHEN s_acctbal > 5000 THEN 'high' ELSE 'low' END AS rank, round(s_acctbal / 2, 6) AS half, s_acctbal > 0 AS positive, CAST(NULL AS VARCHAR) AS _rule_error FROM supplier""",
    "domain_report": """
SELECT 'segment' AS field, c_mktsegment AS value, count(*) AS n FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') GROUP BY 2
UNION ALL SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer WHERE c_nationkey NOT BETWEEN 0 AND 19 GROUP BY 2""",
    "refusals": """
SELECT * FROM (VALUES ('failed row', 'RuleExecutionError'), ('failed call', 'RuleExecutionError'), ('replaced column', 'SchemaConflictError'), ('output named as errors', 'SchemaConflictError'),
  ('missing input', 'ValueError'), ('unknown mode', 'ValueError'), ('batch too large', 'ValueError'), ('mapping of no column', 'ValueError'), ('unknown rule', 'SchemaInferenceError'),
  ('no outputs', 'SchemaInferenceError'), ('unknown field', 'RuleEngineError')) t(what, error)""",
    "stream_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "generated_rows": """
SELECT 'T-' || lpad(CAST(id AS VARCHAR), 6, '0') AS tx_id, kind, amount,
       CASE WHEN amount > 300 AND kind IN ('purchase', 'error') THEN 'block' WHEN amount BETWEEN 150 AND 300 OR (kind LIKE 'sign%' AND amount > 50) THEN 'review' ELSE 'allow' END AS action,
       round(least(1, amount / 400), 9) AS fraud_score
FROM (SELECT id, CASE id % 3 WHEN 0 THEN 'purchase' WHEN 1 THEN 'signup' ELSE 'view' END AS kind, CAST((id * 37) % 500 AS DOUBLE) AS amount FROM range(10000) t(id))""",
}

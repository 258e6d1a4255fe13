"""Rules as SQL functions."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaConflictError
from ..plans.compiler import Value
from ..plans.rules import Registry, RuleSet, registry
from ..plans.sqltext import Staged, Text, name_text, text_functions
from ..rule_types import kind_of, spark_type
from ..shipping import ship
from .batched import Calls, RuleEvaluator, judge_rows, output_column, payloads
from .solve import ERROR_COLUMN, judged, typed_input


def register_udf(
    spark: SparkSession,
    name: str,
    rule: str | RuleSet,
    *,
    api_key: str | None = None,
    base_url: str | None = None,
    output_schema: T.StructType | None = None,
    batch_size: int = 500,
    evaluator: type[RuleEvaluator] | None = None,
    rules: Registry | None = None,
    error_column: str = ERROR_COLUMN,
) -> T.StructType:
    """Register ``name(struct)`` in the session; returns the type of its value.

    The function takes a struct of a row's columns, so ``name(struct(*))`` works
    on any table that has the rule's inputs, and gives a struct of the outputs
    and the error column. Evaluators are called from an Arrow UDF, one client a task, so that large
    integers next to nulls keep their digits. It is marked
    nondeterministic so that Spark calls it once however often it is used.
    Without one, rows are judged in Python; see :func:`register_native`, which SQL can optimise.
    """
    for what, value in (("name", name), ("rule", rule if not isinstance(rule, RuleSet) else rule.name)):
        if not isinstance(value, str) or not value.strip():
            raise ValueError(f"{what} must be a text that is not empty")
    if not isinstance(batch_size, int) or not 1 <= batch_size <= 1000:
        raise ValueError(f"batch_size must be from 1 to 1000, not {batch_size}")
    ruleset = rule if isinstance(rule, RuleSet) else None
    if ruleset is None and (output_schema is None or evaluator is None):
        ruleset = (rules or registry).get(rule)
    schema = output_schema or ruleset.schema
    kinds = tuple((f.name, kind_of(f.dataType)) for f in schema)
    result = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in schema), T.StructField(error_column, T.StringType(), True)])
    if evaluator is None:
        evaluator = local_evaluator(ruleset)
    calls = Calls(ruleset.name if ruleset else rule, evaluator, kinds, api_key=api_key, base_url=base_url, batch_size=batch_size, concurrency=1)
    ship(spark)

    types = {f.name: f.dataType for f in schema}
    zone = spark.conf.get("spark.sql.session.timeZone")

    def judge(rows: Iterator[pa.Array]) -> Iterator[pa.Array]:
        client = None
        for part in rows:
            client = client or calls.start()
            names = [f.name for f in part.type]
            batch = pa.RecordBatch.from_arrays(part.flatten(), names=names)
            values, errors = judge_rows(calls, client, payloads(batch, {n: n for n in names}, zone))
            made = [output_column(values[n], errors, n, types[n]) for n in types]
            yield pa.StructArray.from_arrays([*made, pa.array(errors, pa.string())], names=[*types, error_column])

    spark.udf.register(name, F.arrow_udf(judge, result).asNondeterministic())
    return result


def register_native(
    spark: SparkSession,
    name: str,
    rule: str | RuleSet,
    *,
    rules: Registry | None = None,
    input_types: dict[str, T.DataType] | None = None,
    output_schema: T.StructType | None = None,
    error_column: str = ERROR_COLUMN,
) -> tuple[T.StructType, str]:
    """Register ``name(input, ..)`` as a SQL function that Spark inlines.

    Returns the value's type and the text of a call with the rule's inputs as
    columns. The expressions are those of ``solve``, from the same compiler:
    outputs, errors, defaults and coercions are the same. SQL converts arguments
    to the function's types, which follow the inputs' kinds unless
    ``input_types`` names the columns' own; an integer beyond 2^53, say, is only
    told from its neighbours as a bigint.
    """
    ruleset = rule if isinstance(rule, RuleSet) else (rules or registry).get(rule)
    if not isinstance(name, str) or not name.replace("_", "a").isalnum():
        raise ValueError(f"not a name for a function: {name!r}")
    schema = output_schema or ruleset.schema
    for f in schema:
        kind_of(f.dataType)
    if error_column in schema.fieldNames():
        raise SchemaConflictError(f"an output has the name of the error column, {error_column}")
    taken = {f.name: (input_types or {}).get(f.name, spark_type(f.kind)) for f in ruleset.inputs}
    steps = Staged(name)
    typed = {f.name: typed_input(Text(name_text(f.name)), taken[f.name], f.kind, f.default) for f in ruleset.inputs}
    read = steps.stage([(f"in_{n}", v.column, v.dtype) for n, v in typed.items()])
    fields = {n: Value(x, v.dtype) for (n, v), x in zip(typed.items(), read)}
    _, outputs, error = judged(ruleset, fields, schema, steps.stage, text_functions)
    told = Text("CAST(NULL AS STRING)") if error is None else error
    kept = {n: x if error is None else text_functions.when(error.isNull(), x) for n, x in outputs.items()}
    result = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in schema), T.StructField(error_column, T.StringType(), True)])
    body = text_functions.struct(*(kept[f.name].cast(f.dataType).alias(f.name) for f in schema), told.alias(error_column))
    parameters = ", ".join(f"{name_text(n)} {t.simpleString()}" for n, t in taken.items())
    for statement in steps.functions(parameters, result.simpleString(), body.sql):
        spark.sql(statement)
    names = ", ".join(map(name_text, taken))
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name_text(name)}({parameters}) RETURNS {result.simpleString()} RETURN {steps.call.replace('{}', names)}")
    return result, f"{name_text(name)}({names})"


def local_evaluator(ruleset: RuleSet) -> type[RuleEvaluator]:
    """An evaluator that judges rows with the rule set itself, in Python."""
    from ..plans.local import evaluate_row

    class Local(RuleEvaluator):
        def evaluate(self, rule: str, rows: list[dict[str, Any]]) -> list[dict]:
            return [evaluate_row(ruleset, row) for row in rows]

    return Local


__all__ = ["register_native", "register_udf", "local_evaluator"]

"""Apply a rule set to every row of a DataFrame."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import SchemaConflictError, SchemaInferenceError
from ..functions.coerce import coerce, to_boolean, to_date, to_number
from ..plans.compiler import Compiler, Value, same_type
from ..plans.rules import Registry, RuleSet, registry, walk
from ..plans.sqltext import functions_of
from ..rule_types import kind_of
from .batched import RuleEvaluator, solve_batched

ERROR_COLUMN = "_rule_error"
#: Plain values of an output are looked up in an array beyond this many.
CASE_VALUES = 100


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _same(df: DataFrame):
    """How the session tells names apart."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    return (lambda s: s) if exact else str.lower


def check_arguments(batch_size: int, concurrency: int, on_conflict: str, on_missing_input: str, on_error: str, max_retries: int, timeout_seconds: float) -> None:
    if not isinstance(batch_size, int) or not 1 <= batch_size <= 1000:
        raise ValueError(f"batch_size must be from 1 to 1000, not {batch_size}")
    if not isinstance(concurrency, int) or concurrency < 1:
        raise ValueError(f"max_concurrent_requests_per_partition must be at least 1, not {concurrency}")
    for name, value, allowed in (("on_conflict", on_conflict, ("overwrite", "error")), ("on_missing_input", on_missing_input, ("default", "error")), ("on_error", on_error, ("continue", "raise"))):
        if value not in allowed:
            raise ValueError(f"{name} must be one of {allowed}, not {value!r}")
    if max_retries < 0:
        raise ValueError(f"max_retries must not be negative, not {max_retries}")
    if timeout_seconds is not None and timeout_seconds <= 0:
        raise ValueError(f"timeout_seconds must be positive, not {timeout_seconds}")


def check_mapping(df: DataFrame, mapping: dict[str, str] | None) -> dict[str, str]:
    mapping = dict(mapping or {})
    if missing := sorted(set(mapping) - set(df.columns)):
        raise ValueError(f"input_mapping names columns that the data lack: {missing}")
    taken = [mapping.get(c, c) for c in df.columns]
    if twice := sorted({t for t in mapping.values() if taken.count(t) > 1}):
        raise ValueError(f"input_mapping gives several columns to one field: {twice}")
    return mapping


def kept_columns(df: DataFrame, outputs: list[str], on_conflict: str, error_column: str) -> list[str]:
    """Inputs that stay in front of the outputs."""
    same = _same(df)
    made = {same(o) for o in outputs}
    if same(error_column) in made:
        raise SchemaConflictError(f"an output has the name of the error column, {error_column}")
    clash = sorted(c for c in df.columns if same(c) in made)
    if clash and on_conflict == "error":
        raise SchemaConflictError(f"outputs would replace the columns {clash}")
    return [c for c in df.columns if same(c) not in made and same(c) != same(error_column)]


def spread_out(df: DataFrame) -> DataFrame:
    """A single partition is dealt out to all cores, and more than 10,000 are drawn together to 1,000; streams stay."""
    if df.isStreaming:
        return df
    n, cores = df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, 8)) if n == 1 else df.coalesce(1000) if n > 10_000 else df


def typed_input(column: Column, dtype: T.DataType, kind: str, default: Any = None) -> Value:
    """A field as its kind asks, nulls as ``default``; numbers keep their Spark type, and NaN is null."""
    value = _typed(column, dtype, kind)
    if default is None:
        return value
    F = functions_of(column)
    return Value(F.coalesce(value.column, F.lit(default)), value.dtype)


def _typed(column: Column, dtype: T.DataType, kind: str) -> Value:
    F = functions_of(column)
    if kind == "number":
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            return Value(F.nanvl(column, F.lit(None).cast(dtype)), dtype)
        if isinstance(dtype, T.NumericType):
            return Value(column, dtype)
        return Value(to_number(column, dtype), T.DoubleType())
    if kind == "boolean":
        return Value(to_boolean(column, dtype), T.BooleanType())
    if kind == "date":
        return Value(to_date(column, dtype), T.TimestampType())
    if kind == "string":
        return Value(column.cast("string"), T.StringType())
    return Value(column, dtype)


def typed_inputs(df: DataFrame, ruleset: RuleSet, mapping: dict[str, str], on_missing: str) -> dict[str, Value]:
    """The rule's inputs by name, from the columns that the mapping or their names give them."""
    same = _same(df)
    by_field = {same(mapping.get(f.name, f.name)): f for f in df.schema}
    if on_missing == "error" and (missing := sorted(i.name for i in ruleset.inputs if same(i.name) not in by_field)):
        raise ValueError(f"{ruleset.name} needs columns that the data lack: {missing}")
    out = {}
    for item in ruleset.inputs:
        source = by_field.get(same(item.name))
        if source is None:
            value = typed_input(F.lit(None).cast("string"), T.StringType(), item.kind, item.default)
        else:
            value = typed_input(quoted(source.name), source.dataType, item.kind, item.default)
        out[item.name] = value
    return out


def _is_plain(part: Any) -> bool:
    return not isinstance(part, (dict, list, tuple))


def _table_value(ruleset: RuleSet, name: str, compiler: Compiler, index: Column) -> Value:
    """An output's value by the number of the rule that fired. Values of several types become texts, which are then read as the output's type."""
    F = compiler.F
    parts = [ruleset.default.get(name), *(r.then.get(name) for r in ruleset.rules)]
    values = same_type([compiler.value(p) for p in parts])
    dtype = next((v.dtype for v in values if not isinstance(v.dtype, T.NullType)), T.StringType())
    if all(map(_is_plain, parts)) and len(parts) > CASE_VALUES:
        return Value(F.element_at(F.array(*(v.column.cast(dtype) for v in values)), index + 1), dtype)
    column, error = None, None
    for i, v in enumerate(values[1:], 1):
        part = v.column.cast(dtype) if isinstance(v.dtype, T.NullType) else v.column
        column = F.when(index == i, part) if column is None else column.when(index == i, part)
    first = values[0].column.cast(dtype) if isinstance(values[0].dtype, T.NullType) else values[0].column
    for i, v in enumerate(values):
        if v.error is not None:
            error = F.when(index == i, v.error) if error is None else error.when(index == i, v.error)
    return Value(first if column is None else column.otherwise(first), dtype, error)


def judged(ruleset: RuleSet, fields: dict[str, Value], schema: T.StructType, stage, functions: Any) -> tuple[Column, dict[str, Column], Column | None]:
    """The number of the rule that fired, the outputs of ``schema``, and what failed (None: nothing can).

    ``stage`` names expressions, given as (name, expression, type), and returns
    what later expressions call them by. Columns and SQL text both go this way.
    """
    F, types = functions, {f.name: f.dataType for f in schema}
    compiler = Compiler(ruleset, fields, functions=F)
    (fired,) = stage([("fired", compiler.fired(), T.IntegerType())])
    values = {o.name: _table_value(ruleset, o.name, compiler, fired) for o in ruleset.outputs if o.name not in ruleset.derived}
    failed = [F.when(v.error.isNotNull(), F.concat(F.lit(f"{n}: "), v.error)) for n, v in values.items() if v.error is not None]
    named = stage([(f"out_{n}", v.column, v.dtype) for n, v in values.items()])
    ready = {n: Value(x, T.StringType() if isinstance(v.dtype, T.NullType) else v.dtype) for (n, v), x in zip(values.items(), named)}
    used = {name for part in ruleset.derived.values() for name in _outputs_in(part)}
    for name, part in ruleset.derived.items():
        value = Compiler(ruleset, fields, ready, F).value(part)
        if name in used:  # written once, however often later outputs use it
            (column,) = stage([(f"out_{name}", value.column, value.dtype)])
            ready[name] = Value(column, T.StringType() if isinstance(value.dtype, T.NullType) else value.dtype)
        else:
            ready[name] = value
        if value.error is not None:
            failed.append(F.when(value.error.isNotNull(), F.concat(F.lit(f"{name}: "), value.error)))
    final = {}
    for name, target in types.items():
        value = ready.get(name) or Value(F.lit(None).cast("string"), T.StringType())
        final[name] = coerce(value.column, value.dtype, target).cast(target)
        if isinstance(target, (T.IntegralType, T.DecimalType, T.FloatType)) and target != value.dtype:
            # a text that is no number is null, but a number that the type can't hold is an error
            lost = to_number(value.column, value.dtype).isNotNull() & final[name].isNull()
            failed.append(F.when(lost, F.lit(f"{name}: can't be read as {target.simpleString()}")))
    if not failed:
        return fired, final, None
    (error,) = stage([("error", F.coalesce(*failed), T.StringType())])
    return fired, final, error


def _outputs_in(part: Any) -> set[str]:
    """Outputs that a value refers to; names in templates may be inputs as well."""
    found = {node["output"] for node in walk(part) if "output" in node}
    for node in walk(part):
        found |= set(re.findall(r"\{(\w+)\}", node.get("template") or "")) if isinstance(node.get("template"), str) else set()
    return found


def solve_native(
    df: DataFrame,
    ruleset: RuleSet,
    mapping: dict[str, str],
    schema: T.StructType,
    on_conflict: str,
    on_missing_input: str,
    on_error: str,
    error_column: str,
    matched_column: str | None,
) -> DataFrame:
    """The rule set as projections: which rule fired, the table's outputs, derived outputs, coercion."""
    kept = kept_columns(df, [*schema.fieldNames(), *([matched_column] if matched_column else [])], on_conflict, error_column)
    types = {f.name: f.dataType for f in schema}
    same = _same(df)
    earlier = next((c for c in df.columns if same(c) == same(error_column)), None)
    mark = "__"
    while any(c.lower().startswith(mark) for c in df.columns):  # names that no column has
        mark += "_"
    staged = df

    def stage(made: list[tuple[str, Column, T.DataType]]) -> list[Column]:
        nonlocal staged
        staged = staged.select("*", *(x.cast(t if not isinstance(t, T.NullType) else "string").alias(mark + n) for n, x, t in made))
        return [quoted(mark + n) for n, _, _ in made]

    fired, final, own = judged(ruleset, typed_inputs(df, ruleset, mapping, on_missing_input), schema, stage, F)

    def guarded(column: Column, dtype: T.DataType) -> Column:
        if own is None:
            return column
        # only a row that failed reaches raise_error, in whichever output is read
        bad = F.raise_error(F.concat(F.lit("RuleExecutionError: "), own)).cast(dtype) if on_error == "raise" else F.lit(None).cast(dtype)
        return F.when(own.isNotNull(), bad).otherwise(column)

    told = F.lit(None).cast("string") if own is None else own
    text = told if earlier is None else F.coalesce(quoted(earlier).cast("string"), told)
    columns = [quoted(c) for c in kept] + [guarded(final[n], types[n]).alias(n) for n in final]
    if matched_column:
        columns.append(F.when(fired > 0, fired).alias(matched_column))
    if on_error == "raise":
        text = guarded(text, T.StringType())
    return staged.select(*columns, text.alias(error_column))


def solve(
    df: DataFrame,
    rule: str | RuleSet,
    *,
    api_key: str | None = None,
    base_url: str | None = None,
    batch_size: int = 500,
    max_concurrent_requests_per_partition: int = 4,
    input_mapping: dict[str, str] | None = None,
    output_schema: T.StructType | None = None,
    on_conflict: str = "overwrite",
    on_missing_input: str = "default",
    on_error: str = "continue",
    auto_repartition: bool = False,
    timeout_seconds: float = 60.0,
    max_retries: int = 3,
    evaluator: type[RuleEvaluator] | None = None,
    rules: Registry | None = None,
    error_column: str = ERROR_COLUMN,
    matched_column: str | None = None,
) -> DataFrame:
    """``df`` with the rule's outputs appended, and a text of what failed, if anything, last.

    ``rule`` is a rule set, or the name of one in ``rules`` (by default the
    module's registry). Rules are compiled to column expressions, so the result
    is lazy, works on batch and streaming data, and lets Spark prune columns
    and push filters. With ``evaluator``, rules are judged by calls of batches
    of rows instead; ``api_key``, ``base_url``, ``batch_size``, concurrency,
    timeout and retries are for that path.

    An output replaces an input of its name (``on_conflict="overwrite"``), which
    then stands among the outputs, or is refused (``"error"``). Names compare as
    the session does. ``input_mapping`` renames columns for the rule alone.
    Missing inputs, and nulls, take their field's default; ``"error"`` refuses
    missing ones before anything runs. Under ``on_error="continue"`` a row that
    fails has null outputs and its error; under ``"raise"`` the job fails as
    soon as an output of such a row is read. An error column that ``df`` has
    already is merged: the first error stays. ``output_schema`` types the
    outputs; a value that does not fit is null, with an error.
    ``matched_column`` adds the number of the rule that fired, null for none.
    """
    check_arguments(batch_size, max_concurrent_requests_per_partition, on_conflict, on_missing_input, on_error, max_retries, timeout_seconds)
    mapping = check_mapping(df, input_mapping)
    ruleset = rule if isinstance(rule, RuleSet) else None
    if ruleset is None and (evaluator is None or output_schema is None):
        ruleset = (rules or registry).get(rule)
    schema = output_schema or ruleset.schema
    for f in schema:
        kind_of(f.dataType)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    same = _same(df)
    if len({same(n) for n in schema.fieldNames()}) < len(schema):
        raise SchemaInferenceError("names of outputs must differ")
    if auto_repartition:
        df = spread_out(df)
    if evaluator is None:
        return solve_native(df, ruleset, mapping, schema, on_conflict, on_missing_input, on_error, error_column, matched_column)
    kept = kept_columns(df, schema.fieldNames(), on_conflict, error_column)
    name = ruleset.name if ruleset else rule
    wanted = [f.name for f in ruleset.inputs] if ruleset else None
    return solve_batched(
        df, name, evaluator, mapping, schema, kept, wanted,
        api_key=api_key, base_url=base_url, batch_size=batch_size, concurrency=max_concurrent_requests_per_partition,
        on_error=on_error, timeout_seconds=timeout_seconds, max_retries=max_retries, error_column=error_column,
    )

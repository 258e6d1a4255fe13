"""Inputs that a rule does not expect."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.compiler import Compiler
from ..plans.rules import RuleSet
from .solve import check_mapping, typed_inputs


def outside_domain(df: DataFrame, rule: RuleSet, input_mapping: dict[str, str] | None = None) -> DataFrame:
    """``field, value, n``: how often an input has a value that its field's ``values`` do not list.

    Nulls and columns that ``df`` lacks take defaults, as in ``solve``, and
    count only where that default is not listed. One pass over the listed
    columns; counts are summed before the shuffle.
    """
    limited = [f for f in rule.inputs if f.values]
    fields = typed_inputs(df, rule, check_mapping(df, input_mapping), "default")
    compiler = Compiler(rule, fields)
    odd = [
        F.when(compiler.condition({"field": f.name, "op": "not in", "value": list(f.values)}), F.struct(F.lit(f.name).alias("field"), fields[f.name].column.cast("string").alias("value")))
        for f in limited
    ]
    found = F.array(*odd) if odd else F.lit(None).cast("array<struct<field:string,value:string>>")
    seen = df.select(F.explode(found).alias("odd")).where("odd is not null")
    return seen.groupBy("odd.field", "odd.value").agg(F.count("*").alias("n"))

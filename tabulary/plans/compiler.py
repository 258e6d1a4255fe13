"""Rule sets as Catalyst expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions
from pyspark.sql import types as T

from ..errors import RuleEngineError
from ..functions.coerce import to_text
from .rules import ARITHMETIC, RuleSet
from .sqltext import functions_of


@dataclass
class Value:
    """A compiled value: the column, its type, and a text where it failed (else null)."""

    column: Column
    dtype: T.DataType
    error: Column | None = None


def _both(*errors: Column | None) -> Column | None:
    found = [e for e in errors if e is not None]
    return functions_of(*found).coalesce(*found) if found else None


def same_type(values: list[Value]) -> list[Value]:
    """Values of one type (nulls aside): as they are if they have one, numbers as doubles, else as texts."""
    kinds = [v.dtype for v in values if not isinstance(v.dtype, T.NullType)]
    if all(k == kinds[0] for k in kinds[1:]):
        return values
    numbers = all(isinstance(k, T.NumericType) for k in kinds)
    dtype = T.DoubleType() if numbers else T.StringType()

    def turned(v: Value) -> Value:
        if isinstance(v.dtype, T.NullType) or v.dtype == dtype:
            return v
        return Value(v.column.cast(dtype) if numbers else to_text(v.column, v.dtype), dtype, v.error)

    return [turned(v) for v in values]


def _python_type(x: Any) -> T.DataType:
    if isinstance(x, bool):
        return T.BooleanType()
    if isinstance(x, (int, float)):
        return T.DoubleType()
    return T.StringType()


class Compiler:
    """Compiles the conditions and values of one rule set.

    ``fields`` and ``outputs`` map names to compiled values. A float field is
    null where it is NaN, as Spark holds NaN to be above every number. With the
    functions of ``sqltext``, the same expressions come out as SQL text.
    """

    def __init__(self, ruleset: RuleSet, fields: dict[str, Value], outputs: dict[str, Value] | None = None, functions: Any = functions):
        self.ruleset, self.fields, self.outputs, self.F = ruleset, fields, outputs or {}, functions

    def _literal(self, x: Any) -> Value:
        dtype = _python_type(x)
        if isinstance(x, (int, float)) and not isinstance(x, bool):
            return Value(self.F.lit(float(x)), dtype)
        return Value(self.F.lit(x), dtype) if x is not None else Value(self.F.lit(None).cast("string"), T.NullType())

    def condition(self, part: dict) -> Column:
        """True, false or null; a null condition does not fire its rule."""
        if "all" in part:
            return reduce(lambda a, b: a & b, map(self.condition, part["all"]), self.F.lit(True))
        if "any" in part:
            return reduce(lambda a, b: a | b, map(self.condition, part["any"]), self.F.lit(False))
        if "not" in part:
            return ~self.condition(part["not"])
        if "op" not in part:
            raise RuleEngineError(f"{self.ruleset.name}: not a condition: {part}")
        left = self.value({k: part[k] for k in ("field", "output") if k in part})
        return self._compare(left, part["op"], part.get("value"))

    def _compare(self, left: Value, op: str, right: Any) -> Column:
        x = left.column
        if op == "is null":
            return x.isNull()
        if op == "is not null":
            return x.isNotNull()
        if op in ("in", "not in"):
            found = x.isin([self._operand(left, v).column for v in right]) if right else self.F.lit(False)
            return found if op == "in" else ~found
        if op == "between":
            low, high = (self._operand(left, v).column for v in right)
            return (x >= low) & (x <= high)
        y = self._operand(left, right).column
        if op == "contains":
            return x.contains(y)
        if op == "starts with":
            return x.startswith(y)
        if op == "ends with":
            return x.endswith(y)
        if op == "matches":
            return self.F.rlike(x, y)
        return {"==": x == y, "!=": x != y, "<": x < y, "<=": x <= y, ">": x > y, ">=": x >= y}[op]

    def _operand(self, left: Value, part: Any) -> Value:
        """The right side; a plain value is written in the left side's type, so that a column compares as it is stored."""
        if isinstance(part, dict):
            return self.value(part)
        if isinstance(left.dtype, T.IntegralType) and isinstance(part, (int, float)) and not isinstance(part, bool):
            return Value(self.F.lit(int(part)).cast(T.LongType() if abs(part) < 1 << 62 else T.DoubleType()), left.dtype) if float(part).is_integer() else self._literal(part)
        if isinstance(left.dtype, (T.TimestampType, T.DateType)) and isinstance(part, str):
            return Value(self.F.lit(part).try_cast(left.dtype), left.dtype)
        return self._literal(part)

    def value(self, part: Any) -> Value:
        if not isinstance(part, dict):
            if isinstance(part, (list, tuple)):
                return self.value({"list": list(part)})
            return self._literal(part)
        if set(part) == {"field"}:
            return self.fields[part["field"]]
        if set(part) == {"output"}:
            return self.outputs[part["output"]]
        if "template" in part:
            return self._template(part["template"])
        if "if" in part:
            yes, no = self.value(part["then"]), self.value(part.get("else"))
            holds = self.condition(part["if"])
            error = None
            if yes.error is not None or no.error is not None:
                error = self.F.when(holds, yes.error if yes.error is not None else self.F.lit(None)).otherwise(no.error if no.error is not None else self.F.lit(None))
            yes, no = same_type([yes, no])
            return Value(self.F.when(holds, yes.column).otherwise(no.column), no.dtype if isinstance(yes.dtype, T.NullType) else yes.dtype, error)
        if "condition" in part:
            return Value(self.F.coalesce(self.condition(part["condition"]), self.F.lit(False)), T.BooleanType())
        if "list" in part:
            items = same_type([self.value(v) for v in part["list"]])
            inner = items[0].dtype if items else T.StringType()
            return Value(self.F.array(*(v.column for v in items)), T.ArrayType(inner), _both(*(v.error for v in items)))
        if "object" in part:
            items = {k: self.value(v) for k, v in part["object"].items()}
            dtype = T.StructType([T.StructField(k, T.StringType() if isinstance(v.dtype, T.NullType) else v.dtype) for k, v in items.items()])
            return Value(self.F.struct(*(v.column.alias(k) for k, v in items.items())), dtype, _both(*(v.error for v in items.values())))
        for name in ARITHMETIC:
            if set(part) == {name}:
                return self._arithmetic(name, [self.value(v) for v in part[name]])
        raise RuleEngineError(f"{self.ruleset.name}: not a value: {part}")

    def _number(self, v: Value) -> Column:
        """A number for arithmetic; booleans are 1 and 0."""
        return v.column.cast("double") if isinstance(v.dtype, (T.BooleanType, T.NumericType)) else v.column.try_cast("double")

    def _arithmetic(self, name: str, args: list[Value]) -> Value:
        numbers, error = [self._number(a) for a in args], _both(*(a.error for a in args))
        if name in ("min", "max"):
            pick = self.F.least if name == "min" else self.F.greatest
            known = reduce(lambda a, b: a & b, (n.isNotNull() for n in numbers))
            column = self.F.when(known, pick(*numbers)) if len(numbers) > 1 else numbers[0]
        else:
            call = {"add": self.F.try_add, "subtract": self.F.try_subtract, "multiply": self.F.try_multiply, "divide": self.F.try_divide}[name]
            column = reduce(call, numbers)
            if name == "divide":
                zero = reduce(lambda a, b: a | b, (n == 0 for n in numbers[1:]))
                known = reduce(lambda a, b: a & b, (n.isNotNull() for n in numbers))
                error = _both(error, self.F.when(known & zero, self.F.lit("division by zero")))
        return Value(column, T.DoubleType(), error)

    def _template(self, text: str) -> Value:
        parts, errors = [], []
        for piece in re.split(r"(\{\w+\})", text):
            name = piece[1:-1] if piece.startswith("{") and piece.endswith("}") else None
            if name is None:
                if piece:
                    parts.append(self.F.lit(piece))
                continue
            v = self.outputs.get(name) or self.fields.get(name)
            if v is None:
                raise RuleEngineError(f"{self.ruleset.name}: {name} in a template is neither an output nor an input")
            parts.append(self.F.coalesce(v.column.cast("string"), self.F.lit("")))
            errors.append(v.error)
        return Value(self.F.concat(*parts) if parts else self.F.lit(""), T.StringType(), _both(*errors))

    def fired(self) -> Column:
        """Number of the first rule whose condition holds, from 1; 0 if none does."""
        if not self.ruleset.rules:
            return self.F.lit(0)
        out = None
        for i, rule in enumerate(self.ruleset.rules, 1):
            holds = self.condition(rule.when)
            out = self.F.when(holds, self.F.lit(i)) if out is None else out.when(holds, self.F.lit(i))
        return out.otherwise(self.F.lit(0))

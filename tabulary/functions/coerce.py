"""Coercions of rule outputs, as column expressions and for Python values.

The column forms stay inside Catalyst. They differ from bare casts where a cast
accepts more or less than a rule should: see each function.
"""

from __future__ import annotations

import datetime as dt
import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import types as T

from ..plans.sqltext import functions_of

_NUMBER_TYPES = (T.NumericType,)
#: Texts that are booleans, once trimmed and in lower case.
TRUE, FALSE = ("true", "yes", "1"), ("false", "no", "0")
#: Text forms of dates besides those that a cast reads.
DATE_FORMS = ("MM/dd/yyyy", "MMMM d, yyyy", "yyyyMMdd")


def to_number(x: Column, dtype: T.DataType) -> Column:
    """Double; booleans are 1 and 0, texts are read without a type suffix, the rest is null."""
    F = functions_of(x)
    if isinstance(dtype, T.BooleanType):
        return x.cast("double")
    if isinstance(dtype, T.NumericType):
        return x.cast("double")
    if isinstance(dtype, T.StringType):
        digits = F.regexp_replace(F.trim(x), r"(?<=\d)_(?=\d)", "")
        return F.when(~digits.rlike(r"[dDfF]$") | F.lower(digits).rlike(r"inf$"), digits.try_cast("double"))
    return F.lit(None).cast("double")


def to_boolean(x: Column, dtype: T.DataType) -> Column:
    """Numbers are true unless 0; of texts only true, yes, 1 and false, no, 0 count."""
    F = functions_of(x)
    if isinstance(dtype, T.BooleanType):
        return x
    if isinstance(dtype, T.NumericType):
        return x != F.lit(0)
    if isinstance(dtype, T.StringType):
        word = F.lower(F.trim(x))
        return F.when(word.isin(*TRUE), True).when(word.isin(*FALSE), False)
    return F.lit(None).cast("boolean")


def to_date(x: Column, dtype: T.DataType) -> Column:
    """Timestamp; texts that name a time alone are null, as their date would be today's."""
    F = functions_of(x)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return x.cast("timestamp")
    if isinstance(dtype, T.StringType):
        dated = F.when(~F.trim(x).rlike(r"^T?\d{1,2}:"), x)
        compact = F.trim(x).rlike(r"^\d{8}$")
        known = F.when(~compact, dated.try_cast("timestamp"))
        others = [F.try_to_timestamp(F.trim(dated), F.lit(f)) for f in DATE_FORMS]
        return F.coalesce(known, *others)
    return F.lit(None).cast("timestamp")


def to_text(x: Column, dtype: T.DataType) -> Column:
    """Text; containers are JSON that keeps null fields."""
    F = functions_of(x)
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(x, {"ignoreNullFields": "false"})
    return x.cast("string")


def coerce(x: Column, dtype: T.DataType, target: T.DataType) -> Column:
    """``x`` of type ``dtype`` as ``target``; what can't be converted is null."""
    F = functions_of(x)
    if isinstance(target, T.BooleanType):
        return to_boolean(x, dtype)
    if isinstance(target, T.TimestampType):
        return to_date(x, dtype)
    if isinstance(target, T.DoubleType):
        return to_number(x, dtype)
    if isinstance(target, (T.IntegralType, T.DecimalType, T.FloatType)):
        number = x if isinstance(dtype, T.NumericType) else to_number(x, dtype)
        whole = number.try_cast(target)
        if isinstance(target, T.IntegralType):
            return F.when(number.cast("double") == F.floor(number.cast("double")).cast("double"), whole)
        return whole
    if isinstance(target, T.ArrayType):
        if isinstance(dtype, T.StringType):
            return F.from_json(x, target)
        return x.try_cast(target) if isinstance(dtype, T.ArrayType) else F.lit(None).cast(target)
    if isinstance(target, T.StructType):
        if isinstance(dtype, T.StringType):
            return F.from_json(x, target)
        return x.try_cast(target) if isinstance(dtype, T.StructType) else F.lit(None).cast(target)
    return to_text(x, dtype)


# --- Python values, for evaluators -------------------------------------------


def _number(x: Any) -> float | None:
    try:
        return float(x)
    except (TypeError, ValueError):
        return None


def _boolean(x: Any) -> bool | None:
    if isinstance(x, (bool, int, float)):
        return bool(x)
    word = x.strip().lower() if isinstance(x, str) else None
    return True if word in TRUE else False if word in FALSE else None


def _date(x: Any) -> dt.datetime | None:
    if isinstance(x, str):
        import pandas as pd

        try:
            x = pd.Timestamp(x)
        except (ValueError, TypeError):
            return None
        return None if x is pd.NaT else x.to_pydatetime()
    if isinstance(x, dt.datetime):
        return x
    if isinstance(x, dt.date):
        return dt.datetime(x.year, x.month, x.day)
    return None


def _plain(x: Any) -> Any:
    """For ``json``: times in ISO form, array library values as Python's, anything else as text."""
    if isinstance(x, (dt.datetime, dt.date)):
        return x.isoformat()
    for name in ("tolist", "item"):
        if hasattr(x, name):
            return getattr(x, name)()
    return str(x)


def _text(x: Any) -> str:
    if isinstance(x, str):
        return x
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, (dict, list, tuple)):
        try:
            return json.dumps(x, default=_plain)
        except (TypeError, ValueError):
            return str(x)
    return str(x)


def coerce_value(x: Any, kind: str) -> Any:
    """A value that an evaluator returned, as its output's kind asks; null stays null."""
    if x is None:
        return None
    if kind == "number":
        return _number(x)
    if kind == "boolean":
        return _boolean(x)
    if kind == "date":
        return _date(x)
    if kind == "list_typed":
        return list(x) if isinstance(x, (list, tuple, set)) else None
    if kind == "struct_typed":
        return x if isinstance(x, dict) else None
    return _text(x)


def payload_value(x: Any) -> Any:
    """A column's value as an evaluator gets it: JSON-like, with NaN as null and times in ISO form without offset."""
    if x is None or x != x:  # noqa: PLR0124  NaN and NaT are unlike themselves
        return None
    if isinstance(x, dt.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, dt.date):
        return x.isoformat()
    return x

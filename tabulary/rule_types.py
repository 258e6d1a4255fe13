"""Types of rule outputs, and their Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

from .errors import SchemaInferenceError

# The type of each output kind. Numbers are doubles, dates are
# timestamps, and lists and objects are JSON texts unless a schema types them.
KINDS: dict[str, T.DataType] = {
    "number": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "date": T.TimestampType(),
    "list": T.StringType(),
    "object": T.StringType(),
}

_NUMBERS = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.DecimalType)


def spark_type(kind: str) -> T.DataType:
    """The Spark type of an output kind; unknown kinds are texts."""
    return KINDS.get(kind, T.StringType())


def kind_of(dtype: T.DataType) -> str:
    """How values are coerced into a column of this type."""
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, T.TimestampType):
        return "date"
    if isinstance(dtype, _NUMBERS):
        return "number"
    if isinstance(dtype, T.ArrayType):
        return "list_typed"
    if isinstance(dtype, T.StructType):
        return "struct_typed"
    if isinstance(dtype, T.StringType):
        return "string"
    raise SchemaInferenceError(f"rule outputs can't be of type {dtype.simpleString()}")


def output_schema(entries: list[dict]) -> T.StructType:
    """Outputs from ``{"key" or "name", "type"}`` entries; those without a name are left out."""
    fields = []
    for entry in entries:
        name = entry.get("key") or entry.get("name")
        if name:
            fields.append(T.StructField(str(name), spark_type(entry.get("type") or "string"), True))
    if not fields:
        raise SchemaInferenceError("the rule declares no outputs")
    return T.StructType(fields)

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulary.errors import SchemaInferenceError
from tabulary.functions.coerce import coerce, coerce_value, payload_value
from tabulary.rule_types import kind_of, output_schema, spark_type

TEXTS = {
    "number": [("3.14", 3.14), (" 2 ", 2.0), ("1e3", 1000.0), ("1_000", 1000.0), ("nope", None), ("", None), ("0x10", None), ("inf", float("inf")), ("-inf", float("-inf"))],
    "boolean": [("true", True), (" YES ", True), ("1", True), ("no", False), ("0", False), ("False", False), ("t", None), ("y", None), ("maybe", None), ("", None)],
    "date": [
        ("2026-04-16T10:30:00", dt.datetime(2026, 4, 16, 10, 30)), ("2026-04-16", dt.datetime(2026, 4, 16)), ("04/16/2026", dt.datetime(2026, 4, 16)), ("20260416", dt.datetime(2026, 4, 16)),
        ("April 16, 2026", dt.datetime(2026, 4, 16)), ("not a date", None), ("2026-13-01", None), ("", None),
    ],
    "string": [("x", "x"), ("", "")],
}


@pytest.mark.parametrize("kind", TEXTS)
def test_texts_in_columns_and_values(spark, kind):
    df = spark.createDataFrame([(a,) for a, _ in TEXTS[kind]], "x string")
    got = [r[0] for r in df.select(coerce(F.col("x"), T.StringType(), spark_type(kind))).collect()]
    assert got == [b for _, b in TEXTS[kind]]
    assert [coerce_value(a, kind) for a, _ in TEXTS[kind]] == [b for _, b in TEXTS[kind]]


def test_column_only_differences(spark):
    row = spark.createDataFrame([("1d", "10:30", "1F")], "a string, b string, c string").select(
        coerce(F.col("a"), T.StringType(), T.DoubleType()), coerce(F.col("b"), T.StringType(), T.TimestampType()), coerce(F.col("c"), T.StringType(), T.DoubleType())
    ).collect()[0]
    assert tuple(row) == (None, None, None)


@pytest.mark.parametrize("value,kind,want", [
    (True, "number", 1.0), (5, "number", 5.0), ([1], "number", None), (None, "number", None), (2, "boolean", True), (0.0, "boolean", False), ([], "boolean", None),
    (5, "date", None), (dt.date(2026, 1, 2), "date", dt.datetime(2026, 1, 2)), ([1, "a"], "list", '[1, "a"]'), ({"a": None}, "object", '{"a": null}'), (True, "string", "true"), (1.5, "string", "1.5"),
    ((1, 2), "list_typed", [1, 2]), ("x", "list_typed", None), ({"a": 1}, "struct_typed", {"a": 1}), ("x", "struct_typed", None), ({"t": dt.date(2026, 1, 2)}, "object", '{"t": "2026-01-02"}'),
])
def test_values(value, kind, want):
    assert coerce_value(value, kind) == want


def test_numbers_to_whole_types(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (None,), (1e30,)], "x double")
    assert [r[0] for r in df.select(coerce(F.col("x"), T.DoubleType(), T.LongType())).collect()] == [1, None, None, None]
    assert str(df.select(coerce(F.col("x"), T.DoubleType(), T.DecimalType(10, 2))).collect()[1][0]) == "1.50"


def test_containers_are_json_with_nulls(spark):
    row = spark.sql("SELECT named_struct('a', 1, 'b', CAST(NULL AS INT)) s, array(1, 2) l, '[1,2]' t").select(
        coerce(F.col("s"), T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())]), T.StringType()),
        coerce(F.col("l"), T.ArrayType(T.IntegerType()), T.StringType()), coerce(F.col("t"), T.StringType(), T.ArrayType(T.LongType())),
    ).collect()[0]
    assert tuple(row) == ('{"a":1,"b":null}', "[1,2]", [1, 2])


def test_payloads():
    assert payload_value(float("nan")) is None and payload_value(None) is None
    assert payload_value(dt.datetime(2026, 1, 2, 3, tzinfo=dt.timezone.utc)) == "2026-01-02T03:00:00"
    assert payload_value(dt.date(2026, 1, 2)) == "2026-01-02" and payload_value([1]) == [1]


def test_types():
    schema = output_schema([{"key": "a", "type": "number"}, {"name": "b"}, {"type": "date"}, {"key": "c", "type": "odd"}, {"key": "d", "type": "date"}])
    assert schema.simpleString() == "struct<a:double,b:string,c:string,d:timestamp>" and all(f.nullable for f in schema)
    with pytest.raises(SchemaInferenceError):
        output_schema([])
    for dtype in (T.DateType(), T.MapType(T.StringType(), T.StringType()), T.TimestampNTZType(), T.BinaryType()):
        with pytest.raises(SchemaInferenceError):
            kind_of(dtype)

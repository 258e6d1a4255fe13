"""Sources and sinks, batch and streaming."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def rows(spark: SparkSession, data: list[tuple], schema: str | T.StructType) -> DataFrame:
    """Rows at hand, with a schema that is not inferred."""
    return spark.createDataFrame(data, schema)


def table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog."""
    return spark.table(name)


def files(spark: SparkSession, path: str, form: str = "parquet", schema: str | T.StructType | None = None, **options: Any) -> DataFrame:
    """Files of a format that Spark reads; text formats should be given a schema."""
    reader = spark.read.format(form).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def generated(spark: SparkSession, n: int, partitions: int | None = None) -> DataFrame:
    """Ids from 0 to ``n``."""
    return spark.range(0, n, 1, partitions)


def rate_stream(spark: SparkSession, rows_per_second: int = 20) -> DataFrame:
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def file_stream(spark: SparkSession, path: str, schema: str | T.StructType, form: str = "parquet", **options: Any) -> DataFrame:
    """Files as they arrive. ``path`` is a folder or a pattern."""
    return spark.readStream.format(form).schema(schema).options(**options).load(path)


def stream(spark: SparkSession, form: str, **options: Any) -> DataFrame:
    """A stream of any format whose connector the session has, such as kafka or delta."""
    return spark.readStream.format(form).options(**options).load()


def save_table(df: DataFrame, name: str, mode: str = "overwrite", form: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Write a managed table."""
    writer = df.write.mode(mode).format(form)
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)


def create_table_as(spark: SparkSession, name: str, query: str, form: str = "parquet") -> None:
    """``CREATE TABLE .. AS SELECT``, in place of a table of that name."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING {form} AS {query}")


def stream_to_table(df: DataFrame, name: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append a stream to a table, every so often, or all there is now and then stop."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).toTable(name)

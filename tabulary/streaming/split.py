"""Streams whose failed rows go to a place of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.solve import ERROR_COLUMN, quoted


def split_failed(df: DataFrame, error_column: str = ERROR_COLUMN) -> tuple[DataFrame, DataFrame]:
    """The rows without an error (and without the column), and those with one."""
    error = quoted(error_column)
    return df.where(error.isNull()).drop(error_column), df.where(error.isNotNull())


def write_split(
    df: DataFrame,
    good: str,
    failed: str,
    checkpoint: str,
    every: str | None = None,
    error_column: str = ERROR_COLUMN,
    form: str = "parquet",
) -> StreamingQuery:
    """Write a scored stream to two places.

    Each micro-batch is evaluated once and kept while both are written, so an
    evaluator is not called twice for a row. Batches have folders of their own
    number, which a batch that runs again after a failure replaces. Without
    ``every``, all input there is now is worked off and the query ends.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            fine, bad = split_failed(batch, error_column)
            fine.write.mode("overwrite").format(form).save(f"{good}/batch={number}")
            bad.write.mode("overwrite").format(form).save(f"{failed}/batch={number}")
        finally:
            batch.unpersist()

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def read_split(spark, path: str) -> DataFrame:
    """What ``write_split`` wrote to one of its places."""
    return spark.read.parquet(path).drop("batch")


def windowed_counts(df: DataFrame, time: str, key: str, width: str, late: str) -> DataFrame:
    """Rows per key and window of event time; rows later than ``late`` are dropped once a window is out."""
    df = df.withColumn(time, quoted(time).cast("timestamp"))  # watermarks know no other type
    return df.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("n"))

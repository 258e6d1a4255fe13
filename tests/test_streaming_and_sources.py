from pyspark.sql import functions as F

from tabulary import rulesets, solve
from tabulary.queries import QUERIES, _halves
from tabulary.sources import tables
from tabulary.streaming.split import read_split, windowed_counts, write_split


def test_stream_equals_batch(spark, sf, tmp_path):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = tables.file_stream(spark, f"{sf}/event[s].parquet", schema)
    scored = solve(stream, rulesets.screening(), input_mapping={"event_type": "kind", "value": "amount"})
    tables.stream_to_table(scored, "scored_events", f"{tmp_path}/checkpoint").awaitTermination()
    batch = QUERIES["event_action"](spark, sf)
    got = spark.table("scored_events").select("event_id", "event_type", "action", F.round("fraud_score", 9).alias("fraud_score"), "reason")
    assert got.count() == batch.count() and got.exceptAll(batch).count() == 0
    spark.sql("DROP TABLE scored_events")


def test_failed_rows_are_split_off(spark, sf, tmp_path):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = tables.file_stream(spark, f"{sf}/event[s].parquet", schema)
    for _ in range(2):  # a restart with the same checkpoint adds nothing
        write_split(solve(stream, _halves()), f"{tmp_path}/good", f"{tmp_path}/failed", f"{tmp_path}/checkpoint").awaitTermination()
    good, failed = read_split(spark, f"{tmp_path}/good"), read_split(spark, f"{tmp_path}/failed")
    n = spark.read.parquet(f"{sf}/events.parquet").count()
    assert failed.count() == 100 and good.count() == n - 100 and "_rule_error" not in good.columns
    assert {r[0] for r in failed.select("_rule_error").distinct().collect()} == {"ratio: division by zero"}


def test_rate_stream_and_windows(spark, sf):
    stream = solve(tables.rate_stream(spark).withColumn("amount", F.col("value").cast("double")).withColumn("kind", F.lit("view")), rulesets.screening())
    assert stream.isStreaming and stream.columns[-1] == "_rule_error"
    events = tables.file_stream(spark, f"{sf}/event[s].parquet", spark.read.parquet(f"{sf}/events.parquet").schema)
    query = windowed_counts(events, "ts", "event_type", "1 day", "1 hour").writeStream.format("memory").queryName("per_day").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("per_day").agg(F.sum("n")).collect()[0][0] == spark.read.parquet(f"{sf}/events.parquet").count()


def test_tables(spark, tmp_path):
    df = tables.rows(spark, [(1, "a"), (2, "b")], "id int, name string")
    tables.save_table(df, "saved", partition_by=["id"])
    tables.create_table_as(spark, "made", "SELECT id, upper(name) AS name FROM saved")
    assert {tuple(r) for r in tables.table(spark, "made").collect()} == {(1, "A"), (2, "B")}
    df.write.json(f"{tmp_path}/x")
    assert tables.files(spark, f"{tmp_path}/x", "json", "id int, name string").count() == 2
    assert tables.generated(spark, 10).count() == 10
    for name in ("saved", "made"):
        spark.sql(f"DROP TABLE {name}")


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    names = set(entry.queries())
    assert set(entry.oracle_sql()) <= names and set(QUERIES) <= names

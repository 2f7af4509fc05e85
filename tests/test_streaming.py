"""Streams give what the batch forms give."""

from pyspark.sql import functions as F

from tidemark.operators import titres
from tidemark.streaming import events


def test_events_arrive_once_and_by_month(spark, data, tmp_path):
    source = tmp_path / "in"
    spark.read.parquet(f"{data}/events.parquet").repartition(3).write.parquet(f"file://{source}")
    query = events.to_partitions(events.read(spark, f"file://{source}"), f"file://{tmp_path}/out", f"file://{tmp_path}/cp")
    query.awaitTermination(120)
    stored = spark.read.parquet(f"file://{tmp_path}/out")
    assert stored.count() == stored.select("event_id").distinct().count() == spark.read.parquet(f"{data}/events.parquet").count()


def test_hourly_counts_equal_the_batch(spark, data, tmp_path):
    source = tmp_path / "in"
    spark.read.parquet(f"{data}/events.parquet").coalesce(1).write.parquet(f"file://{source}")
    stream = events.hourly(events.read(spark, f"file://{source}"))
    query = stream.writeStream.format("memory").queryName("hourly").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert spark.table("hourly").agg(F.sum("n")).first()[0] == spark.read.parquet(f"{data}/events.parquet").count()


def test_cells_merge_again_as_readings_arrive(spark, tmp_path):
    source, target = f"file://{tmp_path}/in", f"file://{tmp_path}/cells"
    merge = lambda rows: titres.merge_cells(titres.parsed(rows), ["cell"])
    for k, rows in enumerate(([("a", "40"), ("b", "<10")], [("a", "80")])):
        spark.createDataFrame(rows, "cell string, token string").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("cell string, token string").parquet(source)
        events.upsert_cells(stream, merge, ["cell"], target, f"file://{tmp_path}/cp").awaitTermination(120)
    got = {r["cell"]: r["value"] for r in events.current_cells(spark, target, ["cell"]).collect()}
    assert got == {"a": 57, "b": 10}

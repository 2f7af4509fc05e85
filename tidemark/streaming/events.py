"""Streaming forms of the counting and merging operators (an extension: the batch forms are the contract)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def read(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Event files as they arrive."""
    rows = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def hourly(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Counts and sums per hour and type; rows later than the watermark are left out."""
    grouped = events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
    summed = grouped.agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total"))
    return summed.select(F.col("w.start").alias("hour"), "event_type", "n", "total")


def deduplicated(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """Each event once, however often it is delivered within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def to_partitions(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append events to a store partitioned by month, exactly once by the sink's log."""
    monthly = events.withColumn("month", F.date_format("ts", "yyyy-MM"))
    return monthly.writeStream.format("parquet").option("checkpointLocation", checkpoint).partitionBy("month").trigger(availableNow=True).start(path)


def upsert_cells(readings: DataFrame, merge, keys: list[str], target: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch's readings are kept, and the cells that it touches merged again from all their readings.

    A batch that is repeated after a failure replaces its own readings, so no
    reading counts twice.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{target}/readings/batch={number}")
        touched = batch.select(*keys).distinct()
        every = spark.read.parquet(f"{target}/readings").where(F.col("batch") <= number).drop("batch")
        merge(every.join(touched, keys, "left_semi")).write.mode("overwrite").parquet(f"{target}/cells/batch={number}")

    return readings.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_cells(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """The newest merge of each cell."""
    cells = spark.read.parquet(f"{target}/cells")
    columns = [c for c in cells.columns if c not in (*keys, "batch")]
    newest = cells.groupBy(*keys).agg(F.max_by(F.struct(*columns), "batch").alias("x"))
    return newest.select(*keys, "x.*")

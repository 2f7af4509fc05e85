"""The supplied tables seen as measurements, strains, trees and series.

A line item is a reading: part = antigen, supplier = serum, quantity and
return flag = the censored token.  An order is a laboratory table.  Nations
lie in regions; part types form a hierarchy; events form series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """antigen, serum, table_id, token."""
    mark = F.when(F.col("l_returnflag") == "R", "<").when(F.col("l_returnflag") == "A", ">").otherwise("")
    number = (F.lit(10) * F.pow(F.lit(2), F.col("l_quantity").cast("long") % 8)).cast("long").cast("string")
    missing = F.col("l_quantity") == 50
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("antigen"),
        (F.col("l_suppkey") % 10).alias("serum"),
        F.col("l_orderkey").alias("table_id"),
        F.when(missing, "*").otherwise(F.concat(mark, number)).alias("token"),
    )


def lab_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """table_id, lab, subtype, date, date_suffix of the measurement tables."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("table_id"),
        F.substring("o_orderpriority", 1, 1).alias("lab"),
        F.col("o_orderstatus").alias("subtype"),
        F.col("o_orderdate").cast("date").alias("date"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None)).otherwise(F.col("o_orderkey") % 3).alias("date_suffix"),
    )


def antigens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Antigen rows of the tables: table_id, name, passage, annotations."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linenumber")
    return lines.select(
        F.col("l_orderkey").alias("table_id"),
        F.col("l_partkey").alias("name"),
        F.col("l_returnflag").alias("passage"),
        F.when(F.col("l_linenumber") == 7, "DISTINCT").otherwise("").alias("annotations"),
    )


def serum_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sera in tables with a reading: table_id, serum."""
    lines = table(spark, sf_dir, "lineitem").where("l_quantity < 50")
    return lines.select(F.col("l_orderkey").alias("table_id"), F.col("l_suppkey").alias("serum")).distinct()


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control series: one per user modulo 20, in event order; a tenth of the values missing."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 20).alias("serum"),
        F.col("event_id").alias("pos"),
        F.when(F.col("event_id") % 10 == 7, F.lit(None)).otherwise(F.floor("value").cast("double") % 8).alias("value"),
    )

"""Filters of lists, styles of points, movements between maps, and group membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def listed(records: DataFrame, names: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(records on a list, listed names that no record has)."""
    wanted = names.select(key).distinct()
    return records.join(wanted, key, "left_semi"), wanted.join(records.select(key), key, "left_anti")


def style(clade: Column, needs_none: Column, aligned: Column, entry: Column) -> Column:
    """A point's style and why it has none: unknown and known-none clades are kept apart."""
    reason = (
        F.when(clade.isNull(), "clade not defined")
        .when((clade == "") & ~needs_none, "no clade")
        .when(~aligned, "no aligned sequence")
        .when(entry.isNull(), "no scheme row")
        .otherwise("")
    )
    return F.struct(F.when(reason == "", entry).alias("colour"), reason.alias("reason"))


def windowed(points: DataFrame, date: str, first: str, last: str) -> DataFrame:
    """Points with whether they are inside the window, before it (grey) or undated."""
    d = F.col(date)
    state = F.when(d.isNull(), "undated").when(d < F.lit(first).cast("date"), "grey").when(d > F.lit(last).cast("date"), "later").otherwise("shown")
    return points.withColumn("window", state)


def members(records: DataFrame, anchors: DataFrame, pairs: DataFrame, required: DataFrame, states: DataFrame) -> DataFrame:
    """(record, group): records within a group's anchor clade that show all of its required states.

    anchors (group, clade), required (group, locus, state), states (record, locus, state).
    """
    inside = records.join(pairs, records["clade"] == pairs["descendant"]).join(anchors.withColumnRenamed("clade", "ancestor"), "ancestor").select("record", "group")
    wanted = required.groupBy("group").agg(F.count("*").alias("needed"))
    hits = inside.join(required, "group").join(states.withColumnRenamed("state", "has"), ["record", "locus"]).where("state = has").groupBy("record", "group").agg(F.count("*").alias("met"))
    judged = inside.join(wanted, "group", "left").join(hits, ["record", "group"], "left").fillna(0, ["needed", "met"])
    return judged.where("met = needed").select("record", "group")


def movers(points: DataFrame, limits: Sequence[float]) -> DataFrame:
    """How many points moved farther than each limit between (x, y) and (u, v)."""
    d = F.sqrt(F.pow(F.col("x") - F.col("u"), 2) + F.pow(F.col("y") - F.col("v"), 2))
    counts = [F.count_if(d > limit).alias(f"over_{k}") for k, limit in enumerate(limits)]
    return points.agg(F.count("*").alias("n"), *counts)


def moved_groups(points: DataFrame, by: str, least_points: int, limit: float) -> DataFrame:
    """Groups whose median move is over the limit, with that move."""
    grouped = points.groupBy(by).agg(F.count("*").alias("n"), F.percentile(F.col("u") - F.col("x"), F.lit(0.5)).alias("dx"), F.percentile(F.col("v") - F.col("y"), F.lit(0.5)).alias("dy"))
    length = F.round(F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")), 6)
    return grouped.where(F.col("n") >= least_points).select(by, "n", length.alias("moved")).where(F.col("moved") > limit)


def paired(left: DataFrame, right: DataFrame, strict: str, loose: str) -> DataFrame:
    """Points of two sides paired by a strict key, then by a loose one; a key that a side has twice pairs nothing."""
    def single(df: DataFrame, key: str, name: str) -> DataFrame:
        once = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("c"), F.min("point").alias(name)).where("c = 1")
        return once.select(key, name)

    first = single(left, strict, "a").join(single(right, strict, "b"), strict).select("a", "b", F.lit("strict").alias("how"))
    rest_l = left.join(first.select(F.col("a").alias("point")), "point", "left_anti")
    rest_r = right.join(first.select(F.col("b").alias("point")), "point", "left_anti")
    second = single(rest_l, loose, "a").join(single(rest_r, loose, "b"), loose).select("a", "b", F.lit("loose").alias("how"))
    return first.unionByName(second)


def expected(checks: DataFrame, excuses: DataFrame) -> DataFrame:
    """Failing checks with the excuse that covers them, and excuses that nothing needs."""
    failing = checks.where("value > most").select("check", "slot", "value")
    both = failing.join(excuses, ["check", "slot"], "full_outer")
    verdict = F.when(F.col("value").isNull(), "stale excuse").when(F.col("reason").isNotNull(), "excused").otherwise("failing")
    return both.select("check", "slot", "value", "reason", verdict.alias("verdict"))


def batches(rows: DataFrame, key: str, size: int) -> DataFrame:
    """Stable batch numbers by hash: a row's batch doesn't depend on the others."""
    return rows.withColumn("batch", F.pmod(F.crc32(F.col(key).cast("string")), F.lit(size)))

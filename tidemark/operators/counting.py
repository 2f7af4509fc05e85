"""Counts by subtype, laboratory, period and place, and changes between rounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ALL = "all"


def cube(rows: DataFrame, dimensions: Sequence[str], *measures) -> DataFrame:
    """Measures over every combination of the dimensions or `all` of each.

    Distinct measures are counted within each combination, never added up.
    """
    out = rows.cube(*dimensions).agg(*[F.grouping(d).alias(f"__{d}") for d in dimensions], *measures)
    for d in dimensions:
        out = out.withColumn(d, F.when(F.col(f"__{d}") == 1, ALL).otherwise(F.col(d).cast("string"))).drop(f"__{d}")
    return out


def first_uses(uses: DataFrame, period: str) -> DataFrame:
    """New sera per lab and period: those whose first use of all is there."""
    return uses.where("is_new").groupBy("lab", period).agg(F.count("*").alias("n_new"))


def distinct_used(uses: DataFrame, *by: str) -> DataFrame:
    """Distinct (subtype, serum) used in each cell: each cell counts a serum once."""
    return uses.groupBy(*by).agg(F.count_distinct("subtype", "serum").alias("n_used"))


def changes(before: DataFrame, after: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Cells whose count differs between two rounds; an absent cell counts 0."""
    old = before.select(*keys, F.col(count).alias("was"))
    new = after.select(*keys, F.col(count).alias("now"))
    both = old.join(new, list(keys), "full_outer").fillna(0, ["was", "now"])
    return both.where("was <> now").withColumn("change", F.col("now") - F.col("was"))


def months(spark, first: str, last: str) -> DataFrame:
    """Every month from first to last."""
    one = spark.range(1).select(F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 month"))).alias("month"))
    return one.select(F.col("month").cast("date"))


def merged_style(preparations: DataFrame, virus: Sequence[str]) -> DataFrame:
    """One style per virus from its preparations' styles (NULL: uncoloured) and passage classes.

    One preparation: its style.  One distinct colour: that; `agree` if all are
    coloured, else `coloured over uncoloured`.  Several: the only colour among
    cell and original preparations, else uncoloured, `disagree`.
    """
    coloured = F.col("style").isNotNull()
    preferred = coloured & F.col("passage_class").isin("cell", "original")
    counted = preparations.groupBy(*virus).agg(
        F.count("*").alias("n"),
        F.count_if(coloured).alias("n_coloured"),
        F.count_distinct("style").alias("n_styles"),
        F.max("style").alias("one"),
        F.count_distinct(F.when(preferred, F.col("style"))).alias("n_preferred"),
        F.max(F.when(preferred, F.col("style"))).alias("preferred"),
    )
    how = (
        F.when(F.col("n") == 1, "single")
        .when(F.col("n_styles") == 0, "uncoloured")
        .when((F.col("n_styles") == 1) & (F.col("n_coloured") == F.col("n")), "agree")
        .when(F.col("n_styles") == 1, "coloured over uncoloured")
        .when(F.col("n_preferred") == 1, "cell chosen")
        .otherwise("disagree")
    )
    style = F.when(how.isin("single", "agree", "coloured over uncoloured"), F.col("one")).when(how == "cell chosen", F.col("preferred"))
    return counted.select(*virus, style.alias("style"), how.alias("how"))


def legend(dots: DataFrame, entry: str, month: str, periods: Sequence[str]) -> DataFrame:
    """Entries by month with a total; the months are given, so the plan needs no extra pass."""
    wide = dots.groupBy(entry).pivot(month, list(periods)).agg(F.count(F.lit(1)))
    named = [F.coalesce(F.col(f"`{p}`"), F.lit(0)).alias(f"m_{p.replace('-', '_')}") for p in periods]
    total = sum((F.coalesce(F.col(f"`{p}`"), F.lit(0)) for p in periods), F.lit(0))
    return wide.select(entry, *named, total.alias("total"))


def by_month(rows: DataFrame, spine: DataFrame, groups: DataFrame, key: str) -> DataFrame:
    """Counts for each group and month, empty months kept; groups and months are small lists."""
    counted = rows.groupBy(key, "month").agg(F.count("*").alias("n"))
    wanted = spine.agg(F.collect_list("month").alias("months"))
    grid = groups.select(key).distinct().join(F.broadcast(wanted)).select(key, F.explode("months").alias("month"))
    return grid.join(counted, [key, "month"], "left").fillna(0, ["n"])


def largest(changes_: DataFrame, n: int) -> DataFrame:
    """The n largest changes, ties by key."""
    return changes_.orderBy(F.desc(F.abs("change")), *[c for c in changes_.columns if c not in ("was", "now", "change")]).limit(n)

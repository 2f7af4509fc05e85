"""Control charts, runs and bands on ordered series."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(by: str, at: str):
    return Window.partitionBy(by).orderBy(at)


def beyond(series: DataFrame, by: str, at: str, centre: float, sd: float, x: int, y: int, z: float, poison: bool = True) -> DataFrame:
    """Points that end a stretch of y with x or more beyond centre +- z sd on one side.

    A NULL in the stretch gives NULL.  With `poison`, as a running sum would
    have it, a NULL does so for all later points of its series.
    """
    last = _order(by, at).rowsBetween(-(y - 1), 0)
    seen = _order(by, at).rowsBetween(Window.unboundedPreceding, 0) if poison else last
    v = F.col("value")
    out = series
    for name, side in (("high", v > centre + z * sd), ("low", v < centre - z * sd)):
        hits = F.sum(F.when(v.isNotNull(), side.cast("int"))).over(last)
        full = F.count("*").over(last) == y
        known = F.count("value").over(seen) == F.count("*").over(seen)
        out = out.withColumn(name, F.when(full & ~known, F.lit(None)).otherwise(full & (hits >= x)))
    return out


def islands(series: DataFrame, by: str, at: str, flag: Column) -> DataFrame:
    """Maximal runs of rows where the flag holds: first, last, length.  NULL ends a run."""
    order = _order(by, at)
    marked = series.withColumn("__on", F.coalesce(flag, F.lit(False))).withColumn("__n", F.row_number().over(order))
    group = F.col("__n") - F.row_number().over(Window.partitionBy(by, "__on").orderBy(at))
    runs = marked.withColumn("__run", group).where("__on")
    return runs.groupBy(by, "__run").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("length")).drop("__run")


def long_runs(series: DataFrame, by: str, at: str, flag: Column, n: int) -> DataFrame:
    """Per series the points that complete a run of n: the sum of (length - n + 1) over its long runs."""
    runs = islands(series, by, at, flag).where(F.col("length") >= n)
    return runs.groupBy(by).agg(F.sum(F.col("length") - n + 1).alias("n_hits"), F.max("length").alias("longest"))


def outside(centre: float, sd: float) -> Column:
    return F.abs(F.col("value") - centre) > sd


def stretches(series: DataFrame, by: str, at: str, flag: str) -> DataFrame:
    """Rows with `flag` recomputed from the previous values: rising, falling, equal or alternating."""
    order = _order(by, at)
    now, was = F.col("value"), F.lag("value").over(order)
    before = F.lag("value", 2).over(order)
    kinds = {
        "rising": now > was,
        "falling": now < was,
        "equal": now == was,
        "alternating": F.sign(now - was) * F.sign(was - before) < 0,
    }
    return series.withColumn("flag", kinds[flag])


def jumps(series: DataFrame, by: str, at: str, least: float) -> DataFrame:
    """Points from which the next one differs by `least` or more."""
    after = F.lead("value").over(_order(by, at))
    return series.withColumn("step", F.abs(after - F.col("value"))).where(F.col("step") >= least)


#: The eight rules of a control report: name, and the stretch or run that each asks for.
RULES = ("1 >=3", "2/3 >=2", "8 >=1", "9 >=1 both", "no diff 25", "alt 10", "trend 4", "diff of 3")


def report(series: DataFrame, by: str, at: str, centre: float, sd: float) -> DataFrame:
    """(series, rule, n) of the eight rules; a rule that a series is too short for has 0.

    Stretches count once a side; a run of at least its rule's length counts
    every point that completes one.  A NULL ends a run, and ends the rules that
    go by running sums (stretches, alternation) for the rest of the series.
    """
    order = _order(by, at)
    v, after = F.col("value"), F.lead("value").over(order)
    whole = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = series.withColumn("__n", F.row_number().over(order)).withColumn("__nulls", F.count_if(v.isNull()).over(whole)).withColumn("__step", v - after)
    rows = rows.withColumn("__sign", F.signum("__step"))
    following = F.lead("__sign").over(order)
    # the sum of two steps is NULL once any earlier step was
    rows = rows.withColumn("__unknown", F.count_if(F.col("__step").isNull()).over(order.rowsBetween(Window.unboundedPreceding, 1)))
    rows = rows.withColumn("__level", F.when(F.col("__unknown") == 0, F.col("__sign") + following))
    counts = []
    for k, (x, y, z) in enumerate(((1, 1, 3 - 1e-5), (2, 3, 2 - 1e-5), (8, 8, 0.0))):
        last = order.rowsBetween(-(y - 1), 0)
        full = (F.col("__n") >= y) & (F.col("__nulls") == 0)
        for side, beyond_it in (("high", v > centre + z * sd), ("low", v < centre - z * sd)):
            rows = rows.withColumn(f"__{side}{k}", full & (F.sum(beyond_it.cast("int")).over(last) >= x))
        counts.append((RULES[k], F.count_if(F.col(f"__high{k}")) + F.count_if(F.col(f"__low{k}"))))
    counts.append((RULES[7], F.count_if(F.abs("__step") >= 3)))
    lines = F.array(*[F.struct(F.lit(name).alias("rule"), n.alias("n")) for name, n in counts])
    points = rows.groupBy(by).agg(lines.alias("lines")).select(by, F.inline("lines"))
    keep = rows.select(by, at, "value", "__step", "__sign", "__level")
    flags = {
        RULES[3]: (F.abs(v - centre) >= sd, 9, 0),
        RULES[4]: (F.col("__step") == 0, 24, 0),
        RULES[5]: (F.col("__level") == 0, 8, 0),
        RULES[6] + " up": (F.col("__step") < 0, 3, 0),
        RULES[6] + " down": (F.col("__step") > 0, 3, 0),
    }
    out = points
    for name, (flag, least, _) in flags.items():
        runs = islands(keep, by, at, flag).where(F.col("length") >= least)
        if name == RULES[5]:  # a run that begins on a level isn't alternation
            begins = keep.where("__sign <> 0").select(by, F.col(at).alias("first"))
            runs = runs.join(begins, [by, "first"], "left_semi")
        found = runs.groupBy(by).agg(F.sum(F.col("length") - least + 1).alias("n"))
        out = out.unionByName(found.select(by, F.lit(name.removesuffix(" up").removesuffix(" down")).alias("rule"), "n"))
    every = series.select(by).distinct().select(by, F.explode(F.array(*[F.lit(r) for r in RULES])).alias("rule"))
    summed = out.groupBy(by, "rule").agg(F.sum("n").alias("n"))
    return every.join(summed, [by, "rule"], "left").fillna(0, ["n"])


def bands(rows: DataFrame, clade: str, min_gap: int, purity: float, fraction: float) -> DataFrame:
    """Runs merged from the left while gaps are small: (clade, first, last, members).

    A gap is closed if it is at most min_gap, or at most `fraction` of all
    rows while the merged span keeps its purity.  Each merge depends on the
    span so far, so a clade's runs are folded in order; the fold sees runs, not
    rows.  Bands under a tenth of the clade's largest go.
    """
    def fold(runs: pd.DataFrame) -> pd.DataFrame:
        runs = runs.sort_values("first")
        done: list[list] = []
        for first, last, length, total in zip(runs["first"], runs["last"], runs["length"], runs["total"]):
            if done:
                gap = first - done[-1][1] - 1
                members = done[-1][2] + length
                if gap <= min_gap or gap <= max(min_gap, fraction * total) and members / (last - done[-1][0] + 1) >= purity:
                    done[-1][1:] = [last, members]
                    continue
            done.append([first, last, length])
        largest = max((d[2] for d in done), default=0)
        kept = [d for d in done if d[2] * 10 >= largest]
        return pd.DataFrame([(runs[clade].iloc[0], *d) for d in kept], columns=[clade, "first", "last", "members"])

    kind = dict(rows.dtypes)[clade]
    return rows.groupBy(clade).applyInPandas(fold, f"{clade} {kind}, first long, last long, members long")


def owners(candidates: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """Each key in one section only: the first by the order."""
    return candidates.groupBy(key).agg(F.min(F.struct(*order)).alias("x")).select(key, "x.*")


def picks(rows: DataFrame, by: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first n rows of each group."""
    return rows.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= n)


def pages(rows: DataFrame, by: str, order: Sequence[Column | str], each: int) -> DataFrame:
    """Columns of each group on pages of `each`."""
    place = F.row_number().over(Window.partitionBy(by).orderBy(*order)) - 1
    return rows.withColumn("page", F.floor(place / each).cast("int")).withColumn("slot", (place % each).cast("int"))

"""Comparing clusterings, sets, layouts, counts and versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def adjusted_rand(labels: DataFrame, a: str, b: str) -> DataFrame:
    """Adjusted Rand index of two labelings from pair counts; 1 where it is undefined."""
    pairs = lambda n: n * (n - 1) / 2
    cells = labels.groupBy(a, b).agg(F.count("*").alias("n"))
    both = cells.agg(F.sum(pairs(F.col("n"))).alias("both"), F.sum("n").alias("total"))
    rows = cells.groupBy(a).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("rows"))
    columns = cells.groupBy(b).agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("columns"))
    one = both.join(F.broadcast(rows)).join(F.broadcast(columns))  # a row each
    expected = F.col("rows") * F.col("columns") / pairs(F.col("total"))
    most = (F.col("rows") + F.col("columns")) / 2
    return one.select(F.round(F.when(most == expected, 1.0).otherwise((F.col("both") - expected) / (most - expected)), 9).alias("ari"))


def jaccard_sides(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Common and union of two key sets; a key that a side has twice is dropped there."""
    single = lambda df, name: df.groupBy(key).agg(F.count("*").alias("n")).where("n = 1").select(key, F.lit(1).alias(name))
    both = single(left, "l").join(single(right, "r"), key, "full_outer").fillna(0, ["l", "r"])
    counted = both.agg(F.sum(F.col("l") * F.col("r")).alias("n_common"), F.count("*").alias("n_union"))
    return counted.withColumn("jaccard", F.round(F.col("n_common") / F.col("n_union"), 9))


def _sums(points: DataFrame, by: Sequence[str]):
    """Centred sums of products of two 2-D layouts (x, y) and (u, v), in one aggregate."""
    names = [(p, q) for p in "xy" for q in "uv"]
    groups = points.groupBy(*by) if by else points
    sums = groups.agg(F.count("*").alias("n"), *[F.avg(c).alias(f"m_{c}") for c in "xyuv"], *[F.covar_pop(p, q).alias(f"s_{p}{q}") for p, q in names], *[F.var_pop(c).alias(f"v_{c}") for c in "xyuv"])
    return sums


def procrustes(points: DataFrame, *by: str) -> DataFrame:
    """Rotation, reflection and RMSD that bring (u, v) onto (x, y), in closed form.

    In the plane the best rotation is atan2 of two sums and the best
    reflection likewise, so one aggregate over the points is enough.  The
    reflection is taken only if it lowers the sum of squares.
    """
    s = _sums(points, by)
    cos, sin = F.col("s_xu") + F.col("s_yv"), F.col("s_yu") - F.col("s_xv")
    cos_r, sin_r = F.col("s_xu") - F.col("s_yv"), F.col("s_yu") + F.col("s_xv")
    plain, mirrored = F.sqrt(cos * cos + sin * sin), F.sqrt(cos_r * cos_r + sin_r * sin_r)
    reflect = mirrored > plain + 1e-12
    spread = F.col("v_x") + F.col("v_y") + F.col("v_u") + F.col("v_v")
    left = F.greatest(F.lit(0.0), spread - 2 * F.when(reflect, mirrored).otherwise(plain))
    angle = F.when(reflect, F.atan2(sin_r, cos_r)).otherwise(F.atan2(sin, cos))
    return s.select(*by, "n", reflect.alias("reflected"), F.round(F.degrees(angle), 6).alias("degrees"), F.round(F.sqrt(left), 6).alias("rmsd"))


def oriented(points: DataFrame, least: int, margin: float) -> DataFrame:
    """How a layout (u, v) is turned onto a reference (x, y) of common points, or why not: too few of them, or a reflection that gains too little to be sure.

    The margin is the least difference of the two RMSDs, with and without reflection.
    """
    s = _sums(points, ())
    size = lambda c, d: F.sqrt(c * c + d * d)
    plain = size(F.col("s_xu") + F.col("s_yv"), F.col("s_yu") - F.col("s_xv"))
    mirrored = size(F.col("s_xu") - F.col("s_yv"), F.col("s_yu") + F.col("s_xv"))
    spread = F.col("v_x") + F.col("v_y") + F.col("v_u") + F.col("v_v")
    rmsd = lambda m: F.sqrt(F.greatest(F.lit(0.0), spread - 2 * m))
    gain = F.abs(rmsd(plain) - rmsd(mirrored))
    state = F.when(F.col("n") < least, "too few points").when(gain < margin, "reflection unclear").otherwise("oriented")
    both = procrustes(points).join(F.broadcast(s.select(state.alias("state"), F.round(gain, 6).alias("margin"))))  # a row each
    return both.select("n", "state", "margin", *[F.when(F.col("state") == "oriented", F.col(c)).alias(c) for c in ("reflected", "degrees", "rmsd")])


def moved(points: DataFrame, *by: str) -> DataFrame:
    """Distance between a point's two positions, largest first per group."""
    return points.withColumn("distance", F.round(F.sqrt(F.pow(F.col("x") - F.col("u"), 2) + F.pow(F.col("y") - F.col("v"), 2)), 9))


def fitted(points: DataFrame) -> DataFrame:
    """The points with `distance`, how far each (u, v) stays from its (x, y) after the best rotation, reflection and shift."""
    s = _sums(points, ())
    cos, sin = F.col("s_xu") + F.col("s_yv"), F.col("s_yu") - F.col("s_xv")
    cos_r, sin_r = F.col("s_xu") - F.col("s_yv"), F.col("s_yu") + F.col("s_xv")
    plain, mirrored = F.sqrt(cos * cos + sin * sin), F.sqrt(cos_r * cos_r + sin_r * sin_r)
    reflect = mirrored > plain + 1e-12
    size = F.when(reflect, mirrored).otherwise(plain)
    turn = s.select(
        *[F.col(f"m_{c}").alias(f"__m{c}") for c in "xyuv"],
        F.when(reflect, -1.0).otherwise(1.0).alias("__flip"),
        F.coalesce(F.when(reflect, cos_r).otherwise(cos) / F.nullif(size, F.lit(0.0)), F.lit(1.0)).alias("__cos"),
        F.coalesce(F.when(reflect, sin_r).otherwise(sin) / F.nullif(size, F.lit(0.0)), F.lit(0.0)).alias("__sin"),
    )
    both = points.join(F.broadcast(turn))  # one row
    u, v = F.col("u") - F.col("__mu"), (F.col("v") - F.col("__mv")) * F.col("__flip")
    dx = u * F.col("__cos") - v * F.col("__sin") + F.col("__mx") - F.col("x")
    dy = u * F.col("__sin") + v * F.col("__cos") + F.col("__my") - F.col("y")
    return both.withColumn("distance", F.sqrt(dx * dx + dy * dy)).select(*points.columns, "distance")


def bulk(points: DataFrame, limit: float = 1.0, least: int = 3) -> DataFrame:
    """Orientation of the bulk: fitted again without the points that the fit of all leaves beyond the limit.

    Under half of the points (or under `least`) within it there is no bulk,
    and the fit of all points stands.
    """
    near = fitted(points).where(F.col("distance") <= limit)
    every = procrustes(points).select("n", *[F.col(c).alias(f"all_{c}") for c in ("reflected", "degrees", "rmsd")])
    again = procrustes(near).withColumnRenamed("n", "n_bulk")
    both = every.join(F.broadcast(again))  # a row each
    usable = F.col("n_bulk") >= F.greatest(F.lit(least), F.floor(F.col("n") / 2))
    return both.select("n", "n_bulk", usable.alias("uses_bulk"), *[F.when(usable, F.col(c)).otherwise(F.col(f"all_{c}")).alias(c) for c in ("reflected", "degrees", "rmsd")])


def centroid_shift(points: DataFrame, by: str) -> DataFrame:
    """How far each group's centroid moves between two layouts."""
    c = points.groupBy(by).agg(F.count("*").alias("n"), *[F.avg(k).alias(k) for k in "xyuv"])
    return c.select(by, "n", F.round(F.sqrt(F.pow(F.col("x") - F.col("u"), 2) + F.pow(F.col("y") - F.col("v"), 2)), 6).alias("shift"))


def cell_diff(old: DataFrame, new: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Cells added, removed or changed between two versions; equal ones, NULLs included, are left out."""
    a = old.select(*keys, F.col(value).alias("was"), F.lit(True).alias("__a"))
    b = new.select(*keys, F.col(value).alias("now"), F.lit(True).alias("__b"))
    both = a.join(b, list(keys), "full_outer")
    change = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("now")), "changed")
    return both.withColumn("change", change).where("change is not null").drop("__a", "__b")


def share_of_maximum(counts: DataFrame, by: str, entry: str, n: str) -> DataFrame:
    """Each entry's share of its group."""
    total = counts.groupBy(by).agg(F.sum(n).alias("__total"))
    return counts.join(total, by).select(by, entry, F.round(F.col(n) / F.col("__total"), 9).alias("share"))


def percentiles(rows: DataFrame, by: str, value: str) -> DataFrame:
    """Median, 95th percentile and largest value of each group."""
    return rows.groupBy(by).agg(F.round(F.percentile(value, F.lit(0.5)), 6).alias("median"), F.round(F.percentile(value, F.lit(0.95)), 6).alias("p95"), F.round(F.max(value), 6).alias("largest"))

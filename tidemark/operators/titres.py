"""Merging censored readings, column bases, point checks and stress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import titres as T


def parsed(readings: DataFrame, token: str = "token") -> DataFrame:
    """Readings with kind, value and log of their token; malformed tokens have NULL kinds."""
    return (
        readings.withColumn("kind", T.kind(F.col(token)))
        .withColumn("value", T.value(F.col(token)))
        .withColumn("log", T.log_titre(F.col("value")))
    )


def merge_cells(readings: DataFrame, keys: Sequence[str], sd_limit: float | None = 1.0) -> DataFrame:
    """One titre per cell from all of its readings.

    Needs kind, value and log.  One pass of partial aggregates; the rules are
    a cascade over them.  `kind`/`value` are for the map, `basis_kind` and
    `basis_value` for column bases, which keep a cell of more-than readings.
    """
    k, v = F.col("kind"), F.col("value")
    used = k.isin(T.REGULAR, T.LESS, T.MORE, T.DODGY)
    step = F.when(used, T.shifted(k, F.col("log")))
    cells = readings.groupBy(*keys).agg(
        F.count("*").alias("n_all"),
        F.count_if(used).alias("n"),
        F.count_if(k == T.REGULAR).alias("n_num"),
        F.count_if(k == T.LESS).alias("n_lt"),
        F.count_if(k == T.MORE).alias("n_gt"),
        F.count_if(k == T.DODGY).alias("n_dodgy"),
        F.round(F.stddev_pop(step), 12).alias("sd"),
        F.avg(F.when(k == T.REGULAR, F.col("log"))).alias("mean_log"),
        F.max(F.when(k == T.REGULAR, v)).alias("max_num"),
        F.min(F.when(k == T.REGULAR, v)).alias("min_num"),
        F.min(F.when(k == T.LESS, v)).alias("min_lt"),
        F.max(F.when(k == T.LESS, v)).alias("max_lt"),
        F.min(F.when(k == T.MORE, v)).alias("min_gt"),
        F.max(F.when(k == T.MORE, v)).alias("max_gt"),
        # the censored values that a rule picks from depend on the regular ones: keep them per distinct value
        F.array_sort(F.collect_set(F.when(k == T.LESS, v))).alias("lts"),
        F.array_sort(F.collect_set(F.when(k == T.MORE, v))).alias("gts"),
    )
    none, num, lt, gt = F.col("n") == 0, F.col("n_num"), F.col("n_lt"), F.col("n_gt")
    spread = F.lit(False) if sd_limit is None else F.col("sd") > sd_limit
    above = F.array_min(F.filter("lts", lambda x: x > F.col("max_num")))
    below = F.array_max(F.filter("gts", lambda x: x < F.col("min_num")))
    outcome = (
        F.when(none, "all-dont-care")
        .when(F.col("n_dodgy") > 0, "error-dodgy")
        .when((lt > 0) & (gt > 0), "less-and-more-than")
        .when((num == 0) & (lt > 0), "less-than-only")
        .when((num == 0) & (gt > 0), "more-than-only-to-dont-care")
        .when(spread, "sd-too-big")
        .when((lt == 0) & (gt == 0), "regular-only")
        .when((lt > 0) & (F.col("max_lt") > F.col("max_num")), "max-less-than-bigger-than-max-regular")
        .when(lt > 0, "less-than-and-regular")
        .when(F.col("min_gt") < F.col("min_num"), "min-more-than-less-than-min-regular")
        .otherwise("more-than-and-regular")
    )
    cells = cells.withColumn("outcome", outcome)
    is_ = lambda *names: F.col("outcome").isin(*names)
    result = (
        F.when(is_("less-than-only"), F.col("min_lt"))
        .when(is_("regular-only"), T.whole(F.pow(F.lit(2.0), "mean_log") * 10))
        .when(is_("max-less-than-bigger-than-max-regular"), above)
        .when(is_("less-than-and-regular"), F.col("max_num") * 2)
        .when(is_("min-more-than-less-than-min-regular"), below)
        .when(is_("more-than-and-regular"), F.floor(F.col("min_num") / 2))
        .cast("long")
    )
    kind = (
        F.when(is_("less-than-only", "max-less-than-bigger-than-max-regular", "less-than-and-regular"), T.LESS)
        .when(is_("regular-only"), T.REGULAR)
        .when(is_("min-more-than-less-than-min-regular", "more-than-and-regular"), T.MORE)
    )
    only_more = is_("more-than-only-to-dont-care")
    return cells.select(
        *keys,
        "n_all",
        "outcome",
        kind.alias("kind"),
        result.alias("value"),
        F.when(only_more, T.MORE).otherwise(kind).alias("basis_kind"),
        F.when(only_more, F.col("max_gt")).otherwise(result).alias("basis_value"),
    )


def outcome_counts(cells: DataFrame) -> DataFrame:
    return cells.groupBy("outcome").agg(F.count("*").alias("n_cells"), F.count("value").alias("n_titres"))


def column_basis(cells: DataFrame, serum: str, minimum: float = 0.0, forced: DataFrame | None = None, fixed: DataFrame | None = None) -> DataFrame:
    """Each serum's basis: its largest log titre, more-than titres one up, not below the minimum.

    `forced` (serum, forced_basis), a chart's own bases, takes precedence over
    what is computed and is raised to the minimum too; `fixed` (serum,
    fixed_basis), a projection's, is taken as it is.
    """
    log = T.log_titre(F.col("basis_value"))
    part = F.when(F.col("basis_kind") == T.MORE, log + 1).otherwise(log)
    found = cells.groupBy(serum).agg(F.round(F.greatest(F.lit(0.0), F.coalesce(F.max(part), F.lit(0.0))), 9).alias("computed"))
    if forced is not None:
        found = found.join(forced, serum, "left").withColumn("computed", F.coalesce("forced_basis", "computed")).drop("forced_basis")
    found = found.select(serum, F.greatest(F.col("computed"), F.lit(minimum)).alias("basis"))
    if fixed is not None:
        found = found.join(fixed, serum, "left").select(serum, F.coalesce("fixed_basis", "basis").alias("basis"))
    return found


def disconnected(cells: DataFrame, point: str, least: int = 3) -> DataFrame:
    """Points with fewer than `least` regular titres."""
    counted = cells.groupBy(point).agg(F.count_if(F.col("kind") == T.REGULAR).alias("n_regular"))
    return counted.where(F.col("n_regular") < least)


def repeat_readings(readings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells with several readings, and how many of each kind."""
    kinds = {name: F.count_if(F.col("kind") == name).alias(f"n_{name}") for name in (T.REGULAR, T.LESS, T.MORE)}
    return readings.groupBy(*keys).agg(F.count("*").alias("n_readings"), *kinds.values()).where("n_readings > 1")


def target_distances(cells: DataFrame, bases: DataFrame, serum: str) -> DataFrame:
    """Table distances max(0, basis - log); more-than titres and missing ones have none."""
    usable = cells.where(F.col("kind").isin(T.REGULAR, T.LESS))
    distance = F.greatest(F.lit(0.0), F.col("basis") - T.log_titre(F.col("value")))
    return usable.join(bases, serum).withColumn("target", F.round(distance, 9))


def stress(distances: DataFrame, *by: str) -> DataFrame:
    """Stress of mapped distances (`distance`) against targets: squares, softened for less-than titres."""
    away = F.col("distance") - F.col("target")
    d = F.col("target") - F.col("distance") + 1
    part = F.when(F.col("kind") == T.LESS, d * d / (1 + F.exp(-10 * d))).otherwise(away * away)
    measured = distances.groupBy(*by) if by else distances
    return measured.agg(F.round(F.sum(part), 6).alias("stress"), F.count("*").alias("n_terms"))

"""Rules kept as data: first match, usage accounts, selection, placement, holding."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_match(rows: DataFrame, rules: DataFrame, scope: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Each row with the first rule, by line, whose scope and pattern match it; none: NULL rule columns.

    A rule's scope column equals the row's, ignoring case, or is `*`; its
    pattern matches the row's `text` in full, ignoring case.  Rules are a
    curated file, so their number doesn't grow with the rows; Spark broadcasts
    them while they are small.
    """
    parts = [(F.col(f"rule_{c}") == "*") | (F.lower(F.col(f"rule_{c}")) == F.lower(F.col(c))) for c in scope]
    whole = F.expr("text rlike concat('(?i)^(?:', rule_pattern, ')$')")
    matched = rows.join(rules, reduce(lambda a, b: a & b, parts, whole), "left")
    return matched.groupBy(*key).agg(F.min_by(F.struct("rule_line", "rule_value"), "rule_line").alias("hit")).select(
        *key, F.col("hit.rule_line").alias("rule_line"), F.col("hit.rule_value").alias("rule_value")
    )


def decided(rows: DataFrame, rules: DataFrame, scope: Sequence[str], key: Sequence[str]) -> DataFrame:
    """All rows with their first rule; each distinct key meets the rules once, and NULL keys find theirs again."""
    hits = first_match(rows.select(*key).distinct(), rules, scope, key)
    hits = hits.withColumnsRenamed({k: f"__{k}" for k in key})
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(hits[f"__{k}"]) for k in key])
    return rows.join(hits, same, "left").drop(*[f"__{k}" for k in key])


def usage(matched: DataFrame, rules: DataFrame) -> DataFrame:
    """How many rows each rule decided; 0 for a rule that did nothing."""
    hits = matched.where("rule_line is not null").groupBy("rule_line").agg(F.count("*").alias("hits"))
    return rules.select("rule_line").join(hits, "rule_line", "left").fillna(0, ["hits"])


@dataclass(frozen=True)
class Step:
    """A step of a selection: rows where `condition` holds are kept, re-added or removed."""

    name: str
    kind: str  # filter | include | exclude
    condition: Column


def select(rows: DataFrame, steps: Sequence[Step], exempt: Column) -> tuple[DataFrame, DataFrame]:
    """(kept rows, counts per step): steps in order, the exempt rows outside all counting.

    One pass: each row carries its state through the steps, so any number of
    steps costs one scan and one small aggregate.
    """
    state = rows.withColumn("__exempt", exempt).withColumn("__in", F.lit(True))
    flags = []
    for i, step in enumerate(steps):
        holds = F.coalesce(step.condition, F.lit(False))
        now = {"filter": F.col("__in") & holds, "include": F.col("__in") | holds, "exclude": F.col("__in") & ~holds}[step.kind]
        state = state.withColumn("__next", now)
        removed, added = f"__removed{i}", f"__added{i}"
        state = state.withColumn(removed, F.col("__in") & ~F.col("__next")).withColumn(added, ~F.col("__in") & F.col("__next"))
        state = state.withColumn(f"__left{i}", F.col("__next")).withColumn("__in", F.col("__next")).drop("__next")
        flags += [(step.name, i)]
    totals = state.where(~F.col("__exempt")).agg(
        *[F.count_if(F.col(f"__{what}{i}")).alias(f"{what}{i}") for _, i in flags for what in ("removed", "added", "left")]
    )
    lines = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(n).alias("rule"), F.col(f"removed{i}").alias("removed"), F.col(f"added{i}").alias("added"), F.col(f"left{i}").alias("remaining")) for n, i in flags])
    counts = totals.select(F.inline(lines))
    kept = state.where(F.col("__in") | F.col("__exempt")).select(*rows.columns)
    return kept, counts


def low_divergence(rows: DataFrame, year: str, distance: str, ratio: float, least: int) -> DataFrame:
    """Rows marked `low` whose distance is under a share of their year's median, for years with enough measured rows."""
    medians = rows.where(F.col(distance).isNotNull()).groupBy(year).agg(F.count("*").alias("n_measured"), F.percentile(distance, F.lit(0.5)).alias("median"))
    usable = medians.where((F.col("n_measured") >= least) & (F.col("median") > 0)).select(year, "median")
    low = F.coalesce(F.col(distance) / F.col("median") < ratio, F.lit(False))
    return rows.join(usable, year, "left").withColumn("low", low).drop("median")


def place(distances: DataFrame, key: str, margin: int) -> DataFrame:
    """The reference with the fewest substitutions per row, if it leads by the margin; else `ambiguous`."""
    order = Window.partitionBy(key).orderBy("substitutions", "reference")
    two = distances.withColumn("__place", F.row_number().over(order)).where("__place <= 2")  # a row's two best reach the aggregate
    best = lambda n, c: F.max(F.when(F.col("__place") == n, F.col(c)))
    leading = two.groupBy(key).agg(best(1, "reference").alias("reference"), best(1, "substitutions").alias("substitutions"), best(2, "substitutions").alias("second"))
    clear = F.coalesce(F.col("second") - F.col("substitutions") >= margin, F.lit(True))
    return leading.select(key, F.when(clear, F.col("reference")).alias("placed"), F.when(clear, "").otherwise("ambiguous").alias("flag"), "substitutions")


def held(rows: DataFrame, most: int, rate: float) -> DataFrame:
    """Rows with the reason to hold them back, or the flag they keep."""
    reason = F.when(F.col("substitutions").isNull(), "no-distance").when(F.col("substitutions") > most, "too-far").when(F.col("substitutions") / F.col("years") > rate, "too-fast").otherwise("")
    return rows.withColumn("reason", reason).withColumn("held", reason.isin("too-far", "too-fast"))


def shadowed(rules: DataFrame, closure: DataFrame) -> DataFrame:
    """Under last-match-wins, rules that a later rule makes dead: the later one's clade contains theirs.

    `closure` is (ancestor, descendant), each clade being its own ancestor.
    """
    earlier = rules.select(F.col("line").alias("dead"), F.col("clade").alias("descendant"))
    later = rules.select(F.col("line").alias("by"), F.col("clade").alias("ancestor"))
    hits = earlier.join(closure, "descendant").join(later, "ancestor").where("by > dead")
    return hits.groupBy("dead").agg(F.min("by").alias("by"))

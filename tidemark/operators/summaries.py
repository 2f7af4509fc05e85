"""Counts and documents that reports are made of."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def residues(rows: DataFrame, sequence: str, positions: Sequence[int]) -> DataFrame:
    """(position, residue, n) of drawn rows at each bar's position; a sequence that ends before is ''."""
    at = F.explode(F.array(*[F.lit(p) for p in positions])).alias("position")
    shown = rows.select(F.col(sequence).alias("__s"), at)
    return shown.groupBy("position", F.coalesce(F.substr("__s", F.col("position"), F.lit(1)), F.lit("")).alias("residue")).agg(F.count("*").alias("n"))


def unpainted(styles: DataFrame, by: str) -> DataFrame:
    """Per clade the records that have no colour, and those coloured only by their place in the tree."""
    return styles.groupBy(by).agg(F.count_if(F.col("colour").isNull()).alias("unpainted"), F.count_if(F.col("colour").isNotNull() & F.col("by_placement")).alias("placed"), F.count("*").alias("n")).where("unpainted + placed > 0")


def unpainted_sentence(count: Column, clade: Column, scheme: str) -> Column:
    """What a map's warning says of unpainted records."""
    what = F.when(count == 1, "1 record").otherwise(F.concat(count.cast("string"), F.lit(" records")))
    return F.concat(what, F.when(clade.isNull(), " without a clade").otherwise(F.concat(F.lit(" of "), clade)), F.lit(f": no row in scheme {scheme}"))


def not_in_legend(rows: DataFrame, legend: DataFrame, key: str) -> DataFrame:
    """Values on a figure that its legend lacks, with how often they are drawn."""
    return rows.join(legend.select(key).distinct(), key, "left_anti").groupBy(key).agg(F.count("*").alias("n"))


def overlaps(boxes: DataFrame, size: float) -> DataFrame:
    """(a, b, area) of labels that overlap, found in grid cells so that only neighbours meet; no box is larger than a cell."""
    cell = lambda c: F.floor(F.col(c) / size)
    mine = boxes.select(F.col("label").alias("a"), "x0", "y0", "x1", "y1", cell("x0").alias("i"), cell("y0").alias("j"))
    steps = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    other = mine.select(F.col("a").alias("b"), *[F.col(c).alias(f"o_{c}") for c in ("x0", "y0", "x1", "y1")], "i", "j", F.explode(steps).alias("s"))
    other = other.withColumn("i", F.col("i") + F.col("s.a")).withColumn("j", F.col("j") + F.col("s.b")).drop("s")
    w = F.least("x1", "o_x1") - F.greatest("x0", "o_x0")
    h = F.least("y1", "o_y1") - F.greatest("y0", "o_y0")
    return mine.join(other, ["i", "j"]).where("a < b").where((w > 0) & (h > 0)).select("a", "b", F.round(w * h, 6).alias("area"))


def newly(now: DataFrame, before: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What holds now and did not before."""
    return now.join(before.select(*keys).distinct(), list(keys), "left_anti")


def month_rows(rows: DataFrame, start: str, end: str) -> DataFrame:
    """(row, case, month) of rows on a month axis [start, end): a bar by day or month, none for a year, undated or outside."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    case = F.when(F.col("date").isNull(), "undated").when(F.col("precision") == "year", "year only").when(F.col("date") < first, "before").when(F.col("date") >= last, "after").otherwise("shown")
    month = F.when(case == "shown", F.floor(F.months_between(F.trunc("date", "month"), first)).cast("int"))
    return rows.select("row", case.alias("case"), month.alias("month"))


def in_selection_order(rows: DataFrame, outgroup: Column) -> tuple[Column, ...]:
    """The order of a selection: the outgroup, then by first date, undated last, then key."""
    del rows
    return (F.when(outgroup, 0).otherwise(1), F.coalesce(F.col("first"), F.lit("9999-12-31").cast("date")), F.col("key"))


def tiers_of_new(points: DataFrame, reports: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Points that earlier reports lack, each with the most recent tier: the first report that doesn't hold it."""
    out = points.withColumn("tier", F.lit(None).cast("string"))
    for name, held in reports:
        mark = held.select("point", F.lit(True).alias("__held")).distinct()
        out = out.join(mark, "point", "left").withColumn("tier", F.coalesce("tier", F.when(F.col("__held").isNull(), F.lit(name)))).drop("__held")
    return out.where("tier is not null")


def marked_repeats(points: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Repeats of a point inside one table are DISTINCT: annotated so that nothing is compared with them."""
    place = F.row_number().over(Window.partitionBy("table_id", *keys).orderBy(order))
    return points.withColumn("annotations", F.when(place > 1, F.array_append("annotations", F.lit("DISTINCT"))).otherwise(F.col("annotations")))


def geo_document(counts: DataFrame) -> DataFrame:
    """Counts (period, location, style, n) as one document per period: its locations, each with its groups."""
    groups = counts.groupBy("period", "location").agg(F.array_sort(F.collect_list(F.struct("style", "n"))).alias("groups"))
    return groups.groupBy("period").agg(F.to_json(F.array_sort(F.collect_list(F.struct("location", "groups")))).alias("locations"))


def bad_documents(documents: DataFrame, schema: str) -> DataFrame:
    """Documents that don't have the shared form: text that isn't JSON, or a field that is missing or of another type."""
    parsed = F.from_json("document", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"})
    names = [part.split()[0] for part in schema.split(", ") if not part.startswith("bad ")]
    missing = F.array_compact(F.array(*[F.when(F.col(f"__d.{n}").isNull(), F.lit(n)) for n in names]))
    both = documents.withColumn("__d", parsed)
    why = F.when(F.col("__d.bad").isNotNull(), "unreadable").when(F.size(missing) > 0, F.concat(F.lit("missing "), F.array_join(missing, ",")))
    return both.select("id", why.alias("problem")).where("problem is not null")


def frame(points: DataFrame, margin: float) -> DataFrame:
    """The square frame around the shown points with a margin, its centre in the middle of their extent."""
    extent = points.where("shown").agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    size = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")) + 2 * margin
    return extent.select(F.round((F.col("x0") + F.col("x1") - size) / 2, 9).alias("left"), F.round((F.col("y0") + F.col("y1") - size) / 2, 9).alias("bottom"), F.round(size, 9).alias("size"))


def transformed(points: DataFrame, matrix: Sequence[float]) -> DataFrame:
    """Row vectors times a 2 x 2 matrix, which must be orthogonal."""
    a, b, c, d = matrix
    if abs(a * c + b * d) > 1e-6 or abs(a * a + b * b - 1) > 1e-6 or abs(c * c + d * d - 1) > 1e-6:
        raise ValueError("the transformation isn't orthogonal")
    return points.withColumns({"x": F.col("x") * a + F.col("y") * c, "y": F.col("x") * b + F.col("y") * d})


def known_differences(rows: DataFrame, expected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A draft of known differences: failing figures with their entry, new ones to explain, and entries that match nothing."""
    failing = rows.where("failing").select(*keys, "value")
    both = failing.join(expected.select(*keys, F.col("reason").alias("known")), list(keys), "full_outer")
    state = F.when(F.col("value").isNull(), "orphan").when(F.col("known").isNull(), "new").otherwise("known")
    return both.withColumn("state", state)

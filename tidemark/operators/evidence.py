"""Clade evidence, colour schemes, branch changes and occlusion."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def clade_evidence(records: DataFrame, own: DataFrame, states: DataFrame, pairs: DataFrame) -> DataFrame:
    """Evidence of each record's clade on the clade's own loci, and the deepest ancestor that is supported.

    records (record, clade); own (clade, locus, state); states (record, locus,
    state), an absent or NULL state being unobserved; pairs the hierarchy's
    closure.  Any contradicted locus: contradicted; else any unobserved one:
    unobserved; else supported.
    """
    lineage = records.join(pairs, records["clade"] == pairs["descendant"]).select("record", "clade", "ancestor", "distance")
    tested = lineage.join(own.select(F.col("clade").alias("ancestor"), "locus", F.col("state").alias("wanted")), "ancestor")
    seen = tested.join(states, ["record", "locus"], "left")
    judged = seen.groupBy("record", "clade", "ancestor", "distance").agg(
        F.count_if(F.col("state").isNotNull() & (F.col("state") != F.col("wanted"))).alias("against"), F.count_if(F.col("state").isNull()).alias("unseen")
    )
    verdict = F.when(F.col("against") > 0, "contradicted").when(F.col("unseen") > 0, "unobserved").otherwise("supported")
    judged = judged.withColumn("verdict", verdict)
    return judged.groupBy("record", "clade").agg(
        F.max(F.when(F.col("distance") == 0, F.col("verdict"))).alias("evidence"),
        F.min_by("ancestor", F.when(F.col("verdict") == "supported", F.col("distance"))).alias("supported"),
    ).withColumn("supported", F.when(F.col("evidence") != "supported", F.col("supported")))


def scheme_entry(records: DataFrame, scheme: DataFrame, pairs: DataFrame) -> DataFrame:
    """The last scheme row whose clade contains the record's; NULL where none does."""
    hits = records.join(pairs, records["clade"] == pairs["descendant"]).join(scheme.withColumnRenamed("clade", "ancestor"), "ancestor")
    best = hits.groupBy("record").agg(F.max_by("colour", "line").alias("colour"), F.max("line").alias("line"))
    return records.join(best, "record", "left").select("record", "clade", "line", "colour")


def branch_changes(states: DataFrame, nodes: DataFrame, unknown: str = "X") -> DataFrame:
    """(node, site, was, now): definite differences between each node and its parent."""
    below = states.join(nodes.where("parent is not null"), "node")
    above = states.select(F.col("node").alias("parent"), "site", F.col("state").alias("was"))
    both = below.join(above, ["parent", "site"])
    return both.where((F.col("was") != F.col("state")) & (F.col("was") != unknown) & (F.col("state") != unknown)).select("node", "site", "was", F.col("state").alias("now"))


def consensus(residues: DataFrame, by: str, skip: str = "X-") -> DataFrame:
    """Each site's commonest residue and its share among the called ones; ties to the first by name."""
    counted = residues.where(~F.col("residue").isin(*skip)).groupBy(by, "residue").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(by))
    ranked = counted.withColumn("share", F.round(F.col("n") / total, 9)).withColumn("place", F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "residue")))
    return ranked.where("place = 1").select(by, "residue", "share")


def vanished(expected: DataFrame, carried: DataFrame) -> DataFrame:
    """Clades that were expected and that no node carries, with their former size."""
    return expected.join(carried.select("clade").distinct(), "clade", "left_anti")


def sibling_conflicts(matches: DataFrame, pairs: DataFrame) -> DataFrame:
    """Nodes that fully match a clade outside their label's lineage with support at least the label's.

    matches (node, label, label_support, clade, support).
    """
    related = pairs.select(F.col("ancestor").alias("a"), F.col("descendant").alias("b"))
    both = related.unionByName(related.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    outside = matches.join(both, (matches["label"] == both["a"]) & (matches["clade"] == both["b"]), "left_anti")
    strong = outside.where("support >= label_support")
    return strong.groupBy("node", "label").agg(F.max_by("clade", F.struct("support", "clade")).alias("clade"), F.max("support").alias("support"))


def hidden(dots: DataFrame, radius: float) -> DataFrame:
    """Dots whose centre a later dot covers, found in grid cells of one diameter so that only neighbours meet."""
    size = 2 * radius
    cell = lambda c: F.floor(F.col(c) / size)
    mine = dots.select("dot", "x", "y", cell("x").alias("i"), cell("y").alias("j"))
    around = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    others = dots.select(F.col("dot").alias("later"), F.col("x").alias("u"), F.col("y").alias("v"), cell("x").alias("ci"), cell("y").alias("cj"), F.explode(around).alias("o"))
    others = others.select("later", "u", "v", (F.col("ci") + F.col("o.a")).alias("i"), (F.col("cj") + F.col("o.b")).alias("j"))
    near = mine.join(others, ["i", "j"]).where("later > dot").where(F.pow(F.col("x") - F.col("u"), 2) + F.pow(F.col("y") - F.col("v"), 2) < radius * radius)
    return near.groupBy("dot").agg(F.count("*").alias("n_above"))


def rerooted(nodes: DataFrame, path: DataFrame) -> DataFrame:
    """Parents and branch lengths after rooting at the first node of `path` (node, place from 1 without gaps), the nodes from it to the old root.

    Only the path's links turn: each of its nodes hangs on the one before it, by that one's old branch.
    """
    step = path.select(F.col("node").alias("new_parent"), (F.col("place") + 1).alias("place"))
    turned = path.select(F.col("node").alias("on"), "place").join(step, "place", "left").select("on", "new_parent")
    turned = turned.join(nodes.select(F.col("node").alias("new_parent"), F.col("length").alias("new_length")), "new_parent", "left")
    turns = F.col("on").isNotNull()
    joined = nodes.join(turned, nodes["node"] == turned["on"], "left")
    return joined.select("node", F.when(turns, F.col("new_parent")).otherwise(F.col("parent")).alias("parent"), F.when(turns, F.col("new_length")).otherwise(F.col("length")).alias("length"))


def collapsed(nodes: DataFrame, pairs: DataFrame, shortest: float) -> DataFrame:
    """Inner nodes with a branch under the limit go; their children hang on the nearest node above that stays."""
    inner = nodes.select(F.col("parent").alias("node")).where("node is not null").distinct().withColumn("inner", F.lit(True))
    marked = nodes.join(inner, "node", "left")
    stays = marked.where(F.col("parent").isNull() | F.col("inner").isNull() | (F.col("length") >= shortest)).select("node")
    above = pairs.where("distance > 0").join(stays.select(F.col("node").alias("ancestor")), "ancestor").groupBy(F.col("descendant").alias("node")).agg(F.min_by("ancestor", "distance").alias("parent"))
    return stays.join(above, "node", "left").select("node", "parent")

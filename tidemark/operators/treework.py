"""Work on trees beyond their shape: orders, trims, anchors, bands, published labels, extended hierarchies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .filters import require_none
from .trees import subtree_counts


def preorder(nodes: DataFrame, pairs: DataFrame, order: Column) -> DataFrame:
    """(node, pre, size): each node's number in pre-order from 0, siblings by `order` and node; no fold over the tree.

    A node comes after its ancestors and after the subtrees of the earlier
    siblings of itself and of each ancestor.
    """
    sizes = pairs.groupBy(F.col("ancestor").alias("node")).agg(F.count("*").alias("size"))
    siblings = Window.partitionBy("parent").orderBy(order, "node").rowsBetween(Window.unboundedPreceding, -1)
    before = nodes.join(sizes, "node").withColumn("before", F.coalesce(F.sum("size").over(siblings), F.lit(0)))
    steps = before.select(F.col("node").alias("ancestor"), F.when(F.col("parent").isNull(), 0).otherwise(F.col("before") + 1).alias("step"))
    summed = pairs.join(steps, "ancestor").groupBy(F.col("descendant").alias("node")).agg(F.sum("step").alias("pre"))
    return summed.join(sizes, "node")


def trim_node(changes: DataFrame, pairs: DataFrame, leaves: DataFrame, substitution: str, least: int, outgroup: int) -> DataFrame:
    """The one branch with a substitution and enough leaves below, not above the outgroup; none or several are an error."""
    sizes = subtree_counts(pairs, leaves).select("node", "n_leaves")
    found = changes.where(F.col("change") == substitution).join(sizes, "node").where(F.col("n_leaves") >= least).select("node", "n_leaves")
    above = pairs.where(F.col("descendant") == outgroup).select(F.col("ancestor").alias("node"))
    n = found.count()
    if n != 1:
        require_none(found if n else found.sparkSession.createDataFrame([(substitution,)], "substitution string"), f"{n} branches carry {substitution}")
    require_none(found.join(above, "node", "left_semi"), "the outgroup lies below")
    return found


def anchors(leaves: DataFrame, children: DataFrame, n: int) -> DataFrame:
    """Leaves spread over a node's children, largest child first: one of each in turn, by key.

    leaves: child, leaf; children: child, n_leaves.
    """
    turn = leaves.join(children, "child").withColumn("turn", F.row_number().over(Window.partitionBy("child").orderBy("leaf")))
    # the first n of this order have a turn of at most n
    return turn.where(F.col("turn") <= n).orderBy("turn", F.desc("n_leaves"), "child").limit(n).select("leaf", "child", "turn")


def lettered(rows: DataFrame, bands: DataFrame, depth: DataFrame) -> DataFrame:
    """Each row's clade: the deepest whose band covers the row, ties to the larger name; NULL outside all bands."""
    deep = bands.join(depth, "clade")
    hits = rows.join(deep, F.col("row").between(F.col("first"), F.col("last")), "left")
    return hits.groupBy("row").agg(F.max(F.when(F.col("clade").isNotNull(), F.struct("depth", "clade"))).alias("x")).select("row", F.col("x.clade").alias("clade"))


def published_anchor(pairs: DataFrame, published: DataFrame, depth: DataFrame) -> DataFrame:
    """Each clade's deepest published ancestor-or-self."""
    above = pairs.join(published.select(F.col("clade").alias("ancestor")), "ancestor").join(depth.select(F.col("node").alias("ancestor"), "depth"), "ancestor")
    return above.groupBy(F.col("descendant").alias("clade")).agg(F.max_by("ancestor", "depth").alias("anchor"))


def labels_changed(before: DataFrame, after: DataFrame, anchor: DataFrame) -> DataFrame:
    """Nodes whose published label differs between two assignments; local clades count as their published anchor."""
    named = lambda df, name: df.join(anchor, "clade", "left").select("node", F.col("anchor").alias(name))
    both = named(before, "was").join(named(after, "now"), "node", "full_outer")
    return both.where(~F.col("was").eqNullSafe(F.col("now")))


def extended(hierarchy: DataFrame, local: DataFrame) -> DataFrame:
    """A hierarchy with local clades: their names must be new, their parents known in one of the two."""
    require_none(local.join(hierarchy, "clade", "left_semi").select("clade"), "local clades that are published")
    whole = hierarchy.withColumn("local", F.lit(False)).unionByName(local.withColumn("local", F.lit(True)))
    parents = local.where("parent is not null").select(F.col("parent").alias("clade"))
    require_none(parents.join(whole.select("clade"), "clade", "left_anti"), "local clades without a parent")
    return whole


def moved_to_siblings(contradicted: DataFrame, siblings: DataFrame) -> DataFrame:
    """Inner nodes that contradict their clade and not its parent, with the sibling that they support best.

    contradicted: node, clade, parent_holds, leaf; siblings: node, sibling, matching, fits.  Leaves never move.
    """
    able = contradicted.where("parent_holds and not leaf")
    best = siblings.where("fits and matching > 0").groupBy("node").agg(F.max(F.struct("matching", "sibling")).alias("x"))
    return able.join(best, "node").select("node", F.col("clade").alias("from"), F.col("x.sibling").alias("to"))


def resumed(leaves: DataFrame, below: DataFrame, known: DataFrame, outgroup: int) -> DataFrame:
    """Leaves of a rebuilt tree above the cut, by why they are there: the outgroup, known before, or new."""
    above = leaves.join(below, "leaf", "left_anti")
    both = above.join(known.select("leaf", F.lit(True).alias("known")).distinct(), "leaf", "left")
    why = F.when(F.col("leaf") == outgroup, "outgroup").when(F.col("known"), "known before").otherwise("new")
    return both.select("leaf", why.alias("why"))


def printed_changes(changes: DataFrame, sizes: DataFrame, total: DataFrame, least: int, share: float) -> DataFrame:
    """Substitutions that are printed: on branches with enough leaves and at least a share of all."""
    both = changes.join(sizes, "node").join(F.broadcast(total))  # one row
    return both.where((F.col("n_leaves") >= least) & (F.col("n_leaves") >= share * F.col("total"))).select("node", "change", "n_leaves")


def clock_direction(leaves: DataFrame) -> DataFrame:
    """Whether later leaves lie farther from the root, by subtree: slope of distance on date, its sign and the number of leaves."""
    slope = F.regr_slope("distance", "date")
    return leaves.groupBy("subtree").agg(F.count("*").alias("n"), F.round(slope, 9).alias("slope"), (slope > 0).alias("forward"))


def placement_quality(leaves: DataFrame, n: int) -> DataFrame:
    """Correlation and ratios of tree distance to sequence distance on the n leaves with the smallest hashes."""
    sample = leaves.where("sequence > 0").orderBy(F.xxhash64("leaf"), "leaf").limit(n)
    ratio = F.col("tree") / F.col("sequence")
    rounded = lambda c: F.round(c, 6)
    return sample.agg(F.count("*").alias("n"), rounded(F.corr("tree", "sequence")).alias("correlation"), rounded(F.percentile(ratio, F.lit(0.5))).alias("median"), rounded(F.percentile(ratio, F.lit(0.95))).alias("p95"), rounded(F.max(ratio)).alias("largest"))

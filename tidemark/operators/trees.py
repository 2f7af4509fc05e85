"""Hierarchies and rooted trees held as parent pointers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import settled


def closure(spark: SparkSession, nodes: DataFrame, node: str = "node", parent: str = "parent") -> DataFrame:
    """(ancestor, descendant, distance), each node its own ancestor at distance 0.

    Grows by doubling: a round joins the pairs so far with themselves, so a
    hierarchy of depth d takes log2(d) rounds.
    """
    del spark
    steps = nodes.where(F.col(parent).isNotNull()).select(F.col(parent).alias("ancestor"), F.col(node).alias("descendant"), F.lit(1).alias("distance"))
    own = nodes.select(F.col(node).alias("ancestor"), F.col(node).alias("descendant"), F.lit(0).alias("distance"))
    pairs, reach = settled(own.unionByName(steps), "closure"), 1
    while True:
        far = pairs.where(F.col("distance") == reach)
        if far.isEmpty():
            return pairs
        more = pairs.where("distance > 0").select(F.col("ancestor").alias("mid"), F.col("descendant").alias("low"), F.col("distance").alias("d"))
        longer = far.join(more, far["descendant"] == more["mid"]).select("ancestor", F.col("low").alias("descendant"), (F.col("distance") + F.col("d")).alias("distance"))
        pairs, reach = pairs.unionByName(settled(longer, "closure")), 2 * reach


def depths(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("descendant").agg(F.max("distance").alias("depth")).withColumnRenamed("descendant", "node")


def cumulative(pairs: DataFrame, own: DataFrame) -> DataFrame:
    """Every node's signature: its own (locus, state) and its ancestors', the nearest winning."""
    inherited = pairs.join(own.withColumnRenamed("node", "ancestor"), "ancestor")
    return inherited.groupBy(F.col("descendant").alias("node"), "locus").agg(F.min_by("state", "distance").alias("state"))


def subtree_counts(pairs: DataFrame, leaves: DataFrame) -> DataFrame:
    """Leaves and distinct labels below every node."""
    below = pairs.join(leaves.withColumnRenamed("node", "descendant"), "descendant")
    return below.groupBy(F.col("ancestor").alias("node")).agg(F.count("*").alias("n_leaves"), F.count_distinct("label").alias("n_labels"))


def node_ids(pairs: DataFrame, leaves: DataFrame) -> DataFrame:
    """A node's content id: the XOR of its leaves' ids, the same in any order."""
    below = pairs.join(leaves.withColumnRenamed("node", "descendant"), "descendant")
    return below.groupBy(F.col("ancestor").alias("node")).agg(F.expr("bit_xor(leaf_id)").alias("id"))


def mrca(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The deepest node above all members of each group (group, node)."""
    sizes = groups.groupBy("group").agg(F.count_distinct("node").alias("size"))
    above = groups.distinct().join(pairs, groups["node"] == pairs["descendant"]).groupBy("group", "ancestor").agg(F.count("*").alias("covered"), F.max("distance").alias("height"))
    return above.join(sizes, "group").where("covered = size").groupBy("group").agg(F.min_by("ancestor", F.struct("height", "ancestor")).alias("mrca"))


def prune(nodes: DataFrame, pairs: DataFrame, keep: DataFrame) -> DataFrame:
    """The nodes with a kept leaf below."""
    used = pairs.join(keep.select(F.col("node").alias("descendant")), "descendant", "left_semi").select(F.col("ancestor").alias("node")).distinct()
    return nodes.join(used, "node", "left_semi")


def unary(nodes: DataFrame) -> DataFrame:
    """Nodes with exactly one child."""
    return nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n")).where("n = 1").select("node")


def ladderized(nodes: DataFrame, sizes: DataFrame) -> DataFrame:
    """Each child's place among its siblings, smallest subtree first, ties by node."""
    order = Window.partitionBy("parent").orderBy("n_leaves", "node")
    return nodes.where("parent is not null").join(sizes, "node").select("node", "parent", F.row_number().over(order).alias("place"))


def splits(pairs: DataFrame, leaves: DataFrame, least: int) -> DataFrame:
    """The sides of each inner branch by content id and size; the smaller side has `least` leaves or more."""
    total = leaves.agg(F.count("*").alias("total"), F.expr("bit_xor(leaf_id)").alias("all"))  # one row
    below = pairs.join(leaves.withColumnRenamed("node", "descendant"), "descendant")
    sides = below.groupBy("ancestor").agg(F.count("*").alias("n"), F.expr("bit_xor(leaf_id)").alias("id")).join(F.broadcast(total))
    other = F.expr("id ^ all")
    small = F.least(F.col("n"), F.col("total") - F.col("n"))
    return sides.where(small >= least).select(F.least("id", other).alias("split"), small.alias("size")).distinct()


def robinson_foulds(a: DataFrame, b: DataFrame) -> DataFrame:
    """Symmetric difference of two trees' splits over their number."""
    both = a.select("split", F.lit(1).alias("a")).join(b.select("split", F.lit(1).alias("b")), "split", "full_outer").fillna(0)
    return both.agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b"), F.sum(F.col("a") * F.col("b")).alias("n_common"), F.round(F.sum(F.abs(F.col("a") - F.col("b"))) / F.sum(F.col("a") + F.col("b")), 9).alias("rf"))


def assign(spark: SparkSession, nodes: DataFrame, clades: DataFrame, signatures: DataFrame, own: DataFrame, states: DataFrame, levels: int) -> DataFrame:
    """A clade for every tree node, from the root down.

    nodes (node, parent, depth); clades is the closure of the hierarchy with
    depth of the descendant (ancestor, descendant, clade_depth); signatures and
    own (clade, locus, state); states (node, locus, state).  Candidates are the
    descendants of the inherited clade, or all.  A clade is out if a locus of
    its whole signature contradicts, or if none of its own loci match, unless
    it is inherited.  The deepest wins, then most matching loci, then name.
    The evidence doesn't depend on what is inherited: it is joined once, and
    each level only chooses.
    """
    del spark
    tested = states.join(signatures.withColumnRenamed("state", "wanted"), "locus")
    verdict = tested.groupBy("node", "clade").agg(F.count_if(F.col("state") != F.col("wanted")).alias("against"), F.count_if(F.col("state") == F.col("wanted")).alias("matching"))
    ours = states.join(own.withColumnRenamed("state", "wanted"), "locus").where("state = wanted").groupBy("node", "clade").agg(F.count("*").alias("own_hits"))
    possible = settled(verdict.where("against = 0").join(ours, ["node", "clade"], "left").fillna(0, ["own_hits"]), "possible")
    clades = settled(clades, "clades")
    done = nodes.where("parent is null").select("node", F.lit(None).cast("string").alias("inherited"))
    result = None
    for level in range(levels):
        here = done if level == 0 else nodes.where(F.col("depth") == level).join(result.select(F.col("node").alias("parent"), F.col("clade").alias("inherited")), "parent").select("node", "inherited")
        options = here.join(possible, "node").join(clades.select(F.col("descendant").alias("clade"), F.col("ancestor").alias("above"), "clade_depth"), "clade")
        options = options.where("inherited is null and above = clade or above = inherited").where("own_hits > 0 or clade = inherited")
        best = options.groupBy("node").agg(F.max(F.struct("clade_depth", "matching", "clade")).alias("best"))
        chosen = settled(here.join(best, "node", "left").select("node", F.coalesce("best.clade", "inherited").alias("clade")), "level")
        result = chosen if result is None else result.unionByName(chosen)
    return result


def fitch(alignment: DataFrame) -> DataFrame:
    """Fitch parsimony per tree and site: (tree, site, node, state, changes).

    `alignment` holds each site's nodes in post-order: (tree, site, post, node,
    parent, state); inner states are NULL.  A fold over one site's tree keeps
    the order that set unions need, so sites run in parallel as groups.
    """
    order = "ACGT-"

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("post")
        masks: dict = {}
        children: dict = {}
        parent_of = dict(zip(rows["node"], rows["parent"]))
        for node, parent, state in zip(rows["node"], rows["parent"], rows["state"]):
            if state is not None and state == state:
                masks[node] = 1 << order.index(state) if state in order else 31
            else:
                below = [masks[c] for c in children.get(node, [])]
                shared = 31
                union = 0
                for m in below:
                    shared &= m
                    union |= m
                masks[node] = shared or union or 31
            if parent is not None and parent == parent:
                children.setdefault(parent, []).append(node)
        states, changes = {}, 0
        for node in reversed(list(rows["node"])):
            parent = parent_of[node]
            above = states.get(parent) if parent is not None and parent == parent else None
            if above is not None and masks[node] >> above & 1:
                states[node] = above
            else:
                states[node] = next(k for k in range(5) if masks[node] >> k & 1)
                changes += above is not None
        first = rows.iloc[0]
        return pd.DataFrame({"tree": first["tree"], "site": first["site"], "node": list(states), "state": [order[s] for s in states.values()], "changes": changes})

    return alignment.groupBy("tree", "site").applyInPandas(run, "tree string, site int, node long, state string, changes long")


def newick(texts: DataFrame) -> DataFrame:
    """(tree, pre, node, parent, name, length) of Newick texts (tree, text): quoted labels, comments, any nesting."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for tree, text in zip(batch["tree"], batch["text"]):
                out += [(tree, *row) for row in parse_newick(text)]
            yield pd.DataFrame(out, columns=["tree", "pre", "node", "parent", "name", "length"]).astype({"parent": "Int64"})

    return texts.select("tree", "text").mapInPandas(run, "tree long, pre long, node long, parent long, name string, length double")


#: What a name can hold only inside quotes.
NEWICK_MARKS = re.compile(r"[\s()\[\]',:;]")


def parse_newick(text: str) -> list[tuple]:
    """(pre, node, parent, name, length) rows; node numbers are pre-order.  Unbalanced text is a ValueError."""
    rows: list[list] = [[0, 0, None, "", None]]
    here, i, n = 0, 0, len(text)

    def child(parent: int) -> int:
        rows.append([len(rows), len(rows), parent, "", None])
        return len(rows) - 1

    def above(node: int, at: int) -> int:
        if rows[node][2] is None:
            raise ValueError(f"Newick text isn't balanced at character {at}")
        return rows[node][2]

    while i < n:
        c = text[i]
        if c == "(":
            here = child(here)
        elif c == ",":
            here = child(above(here, i))
        elif c == ")":
            here = above(here, i)
        elif c == "[":
            i = text.index("]", i)
        elif c == ";":
            break
        elif c == "'":
            end = i + 1
            name = ""
            while True:
                stop = text.index("'", end)
                name += text[end:stop]
                if text[stop + 1 : stop + 2] != "'":
                    break
                name, end = name + "'", stop + 2
            rows[here][3], i = name, stop
        elif not c.isspace():
            end = i
            while end < n and text[end] not in "(),;[":
                end += 1
            label, _, length = text[i:end].strip().partition(":")
            rows[here][3] = label or rows[here][3]
            if length:
                rows[here][4] = float(length)
            i = end - 1
        i += 1
    if here:
        raise ValueError("Newick text ends inside a bracket")
    return [tuple(r) for r in rows]


def write_newick(nodes: DataFrame) -> DataFrame:
    """(tree, text) from (tree, node, parent, name, length), children in node order; a fold per tree.

    Lengths have 10 significant digits; a name that the format's own characters are in is quoted.
    """

    def label(name: str) -> str:
        return "'" + name.replace("'", "''") + "'" if NEWICK_MARKS.search(name) else name

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        children: dict = {}
        named = {}
        root = None
        for node, parent, name, length in sorted(zip(rows["node"], rows["parent"], rows["name"], rows["length"]), key=lambda r: r[0]):
            named[node] = (name or "", length)
            if parent is None or parent != parent:
                root = node
            else:
                children.setdefault(int(parent), []).append(node)
        text: dict = {}
        stack = [(root, False)]
        while stack:
            node, ready = stack.pop()
            below = children.get(node, [])
            if below and not ready:
                stack += [(node, True), *((c, False) for c in below)]
                continue
            name, length = named[node]
            own = "(" + ",".join(text.pop(c) for c in below) + ")" if below else ""
            text[node] = own + label(name) + (f":{length:.10g}" if length is not None and length == length else "")
        return pd.DataFrame({"tree": [rows["tree"].iloc[0]], "text": [text[root] + ";"]})

    return nodes.groupBy("tree").applyInPandas(run, "tree long, text string")

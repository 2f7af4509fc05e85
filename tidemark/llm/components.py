"""Connected components of a graph whose links lie in a table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LINKS = "a long, b long"
#: A node with more links than this and than a 500th of all links meets them in several tasks; there are 1,000 such nodes at most.
MANY = 200


class Forest:
    """Union-find over hashable nodes; the smallest node is its set's root."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def join(self, a, b) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.parent.setdefault(min(a, b), min(a, b))
        return True


def thinned(links: DataFrame) -> DataFrame:
    """Each partition's links as stars: as connected, and no more than its nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            pairs = np.unique(np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1), axis=0)
            for a, b in pairs.tolist():
                forest.join(a, b)
        stars = [(forest.find(x), x) for x in list(forest.parent)]
        stars = [(a, b) for a, b in stars if a != b]
        if stars:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*stars)], names=["a", "b"])

    return links.select("a", "b").mapInArrow(run, LINKS)


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has a link; the root is the smallest node reachable.

    Stars are made larger and smaller in turn until each node hangs on its
    root.  A node with very many links costs one minimum, summed per partition,
    and its links meet it in several tasks; all others are joined once.  Each
    round ends in a written table, and the round before it is deleted.
    """
    spark = links.sparkSession
    stars = common.written(thinned(links), "stars")
    for _ in range(most_rounds):
        both = stars.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(stars.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        least = common.written(least, "least")
        many = max(MANY, stars.count() // 500)
        hubs = F.col("u").isin([row.u for row in least.where(F.col("n") > many).select("u").collect()])
        # each node hangs its larger neighbours on its smallest one
        above = both.where("v > u")
        large = above.where(~hubs).join(least.where(~hubs).hint("merge"), "u")
        large = large.unionByName(common.salted_join(above.where(hubs), least.where(hubs), ["u"], "v")).select(F.col("m").alias("a"), F.col("v").alias("b"))
        down = common.written(thinned(large.where("a <> b")), "stars")
        smallest = down.groupBy("b").agg(F.min("a").alias("m"))
        small = down.join(smallest, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b").distinct()
        following = common.written(small, "stars")
        common.discard(stars, least, down)
        # done when every link is from a root: nobody is at once above and below
        if following.select("a").distinct().join(following.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty() and following.groupBy("b").count().where("count > 1").isEmpty():
            stars = following
            break
        stars = following
    else:
        raise RuntimeError("components did not settle")
    roots = stars.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(stars.select(F.col("b").alias("node"), F.col("a").alias("root")))

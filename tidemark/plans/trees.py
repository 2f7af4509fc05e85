"""Queries on hierarchies and trees: region -> nation -> customer, and clades of part types."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import trees
from tidemark.sources import standins

from .registry import query

#: Node numbers: regions from 1,000,000, nations from 2,000,000, customers as they are; 3,000,000 is the root.
NODES = """
nodes AS (
  SELECT 3000000 AS node, CAST(NULL AS BIGINT) AS parent UNION ALL SELECT 1000000 + r_regionkey, 3000000 FROM region
  UNION ALL SELECT 2000000 + n_nationkey, 1000000 + n_regionkey FROM nation UNION ALL SELECT c_custkey, 2000000 + c_nationkey FROM customer),
pairs AS (
  WITH RECURSIVE up(ancestor, descendant, distance) AS (
    SELECT node, node, 0 FROM nodes UNION ALL SELECT n.parent, u.descendant, u.distance + 1 FROM up u JOIN nodes n ON u.ancestor = n.node WHERE n.parent IS NOT NULL)
  SELECT * FROM up),
leaves AS (SELECT c_custkey AS node, c_mktsegment AS label, c_custkey * 2654435761 % 4294967296 AS leaf_id FROM customer)"""


def _nodes(spark, sf_dir):
    read = lambda name: standins.table(spark, sf_dir, name)
    rows = spark.range(1).select(F.lit(3000000).cast("long").alias("node"), F.lit(None).cast("long").alias("parent"))
    for part in (
        read("region").select((F.col("r_regionkey") + 1000000).cast("long").alias("node"), F.lit(3000000).cast("long").alias("parent")),
        read("nation").select((F.col("n_nationkey") + 2000000).cast("long").alias("node"), (F.col("n_regionkey") + 1000000).cast("long").alias("parent")),
        read("customer").select(F.col("c_custkey").alias("node"), (F.col("c_nationkey") + 2000000).cast("long").alias("parent")),
    ):
        rows = rows.unionByName(part)
    return rows


def _pairs(spark, sf_dir):
    return trees.closure(spark, _nodes(spark, sf_dir))


def _leaves(spark, sf_dir):
    key = F.col("c_custkey")
    return standins.table(spark, sf_dir, "customer").select(key.alias("node"), F.col("c_mktsegment").alias("label"), (key * 2654435761 % 4294967296).alias("leaf_id"))


@query(f"WITH {NODES} SELECT * FROM pairs")
def closure(spark, sf_dir):
    return _pairs(spark, sf_dir)


@query(f"WITH {NODES} SELECT descendant AS node, max(distance) AS depth FROM pairs GROUP BY 1")
def depth(spark, sf_dir):
    return trees.depths(_pairs(spark, sf_dir))


@query(f"WITH {NODES} SELECT ancestor AS node, count(*) AS n_leaves, count(DISTINCT label) AS n_labels FROM pairs JOIN leaves ON descendant = leaves.node GROUP BY 1")
def subtree_counts(spark, sf_dir):
    return trees.subtree_counts(_pairs(spark, sf_dir), _leaves(spark, sf_dir))


@query(f"WITH {NODES} SELECT ancestor AS node, bit_xor(leaf_id) AS id FROM pairs JOIN leaves ON descendant = leaves.node GROUP BY 1")
def node_ids_xor(spark, sf_dir):
    return trees.node_ids(_pairs(spark, sf_dir), _leaves(spark, sf_dir))


@query(
    f"""WITH {NODES}, own AS (SELECT node, node % 3 AS locus, CAST(node % 7 AS VARCHAR) AS state FROM nodes),
    seen AS (SELECT descendant AS node, locus, state, row_number() OVER (PARTITION BY descendant, locus ORDER BY distance) AS r FROM pairs JOIN own ON ancestor = own.node)
    SELECT node, locus, state FROM seen WHERE r = 1"""
)
def cumulative_signature(spark, sf_dir):
    own = _nodes(spark, sf_dir).select("node", (F.col("node") % 3).alias("locus"), (F.col("node") % 7).cast("string").alias("state"))
    return trees.cumulative(_pairs(spark, sf_dir), own)


@query(
    f"""WITH {NODES}, groups AS (SELECT node, node % 400 AS grp FROM leaves),
    above AS (SELECT grp, ancestor, count(*) AS covered, max(distance) AS height FROM groups JOIN pairs ON groups.node = descendant GROUP BY 1, 2),
    sizes AS (SELECT grp, count(*) AS size FROM groups GROUP BY 1),
    ok AS (SELECT grp, ancestor, row_number() OVER (PARTITION BY grp ORDER BY height, ancestor) AS r FROM above JOIN sizes USING (grp) WHERE covered = size)
    SELECT grp AS "group", ancestor AS mrca FROM ok WHERE r = 1"""
)
def mrca(spark, sf_dir):
    groups = _leaves(spark, sf_dir).select("node", (F.col("node") % 400).alias("group"))
    return trees.mrca(_pairs(spark, sf_dir), groups)


@query(f"WITH {NODES} SELECT * FROM nodes WHERE node IN (SELECT ancestor FROM pairs WHERE descendant IN (SELECT node FROM leaves WHERE node % 60 = 1))")
def prune(spark, sf_dir):
    return trees.prune(_nodes(spark, sf_dir), _pairs(spark, sf_dir), _leaves(spark, sf_dir).where("node % 60 = 1"))


@query(
    f"""WITH {NODES}, sizes AS (SELECT ancestor AS node, count(*) AS n_leaves FROM pairs JOIN leaves ON descendant = leaves.node GROUP BY 1)
    SELECT n.node, n.parent, row_number() OVER (PARTITION BY n.parent ORDER BY n_leaves, n.node) AS place FROM nodes n JOIN sizes USING (node) WHERE n.parent IS NOT NULL"""
)
def ladderize(spark, sf_dir):
    return trees.ladderized(_nodes(spark, sf_dir), trees.subtree_counts(_pairs(spark, sf_dir), _leaves(spark, sf_dir)))


@query(f"WITH {NODES} SELECT parent AS node FROM nodes WHERE parent IS NOT NULL GROUP BY 1 HAVING count(*) = 1")
def unary_nodes(spark, sf_dir):
    return trees.unary(_nodes(spark, sf_dir))


RF = (
    NODES
    + """,
total AS (SELECT count(*) AS total, bit_xor(leaf_id) AS every FROM leaves),
a AS (SELECT DISTINCT least(id, xor(id, every)) AS split FROM (SELECT ancestor, count(*) AS n, bit_xor(leaf_id) AS id FROM pairs JOIN leaves ON descendant = leaves.node GROUP BY 1), total
  WHERE least(n, total - n) >= 2),
b AS (SELECT DISTINCT least(id, xor(id, every)) AS split FROM (SELECT CASE WHEN c_custkey % 50 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS g, count(*) AS n,
    bit_xor(c_custkey * 2654435761 % 4294967296) AS id FROM customer GROUP BY 1), total WHERE least(n, total - n) >= 2),
j AS (SELECT coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM (SELECT split, 1 AS x FROM a) FULL JOIN (SELECT split, 1 AS y FROM b) USING (split))"""
)


@query(f"WITH {RF} SELECT sum(x) AS n_a, sum(y) AS n_b, sum(x * y) AS n_common, round(sum(abs(x - y)) * 1.0 / sum(x + y), 9) AS rf FROM j")
def splits_rf(spark, sf_dir):
    leaves = _leaves(spark, sf_dir)
    a = trees.splits(_pairs(spark, sf_dir), leaves, 2)
    moved = F.when(F.col("c_custkey") % 50 == 0, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey"))
    other = standins.table(spark, sf_dir, "customer").select(moved.cast("long").alias("ancestor"), F.col("c_custkey").alias("descendant"))
    b = trees.splits(other, leaves, 2)
    return trees.robinson_foulds(a, b)


CLADES = """
clade(name, parent, locus, state) AS (VALUES ('R', NULL, 0, '0'), ('R.0', 'R', 1, '0'), ('R.1', 'R', 1, '1'), ('R.0.2', 'R.0', 2, '2'), ('R.1.3', 'R.1', 2, '3'))"""


def _assigned(spark, sf_dir):
    rows = [("R", None, 0, "0"), ("R.0", "R", 1, "0"), ("R.1", "R", 1, "1"), ("R.0.2", "R.0", 2, "2"), ("R.1.3", "R.1", 2, "3")]
    hierarchy = spark.createDataFrame(rows, "node string, parent string, locus int, state string")
    above = trees.closure(spark, hierarchy)
    depth = trees.depths(above).select(F.col("node").alias("descendant"), F.col("depth").alias("clade_depth"))
    clades = above.join(depth, "descendant").select("ancestor", "descendant", "clade_depth")
    own = hierarchy.select(F.col("node").alias("clade"), "locus", "state")
    signatures = trees.cumulative(above, hierarchy.select("node", "locus", "state")).withColumnRenamed("node", "clade")
    nodes = _nodes(spark, sf_dir)
    levels = F.when(F.col("node") == 3000000, 0).when(F.col("node") >= 2000000, 2).when(F.col("node") >= 1000000, 1).otherwise(3)
    leveled = nodes.withColumn("depth", levels)
    loci = F.array(
        F.struct(F.lit(0).alias("locus"), F.lit("0").alias("state")),
        F.struct(F.lit(1).alias("locus"), F.when(F.col("depth") > 0, (F.col("node") % 2).cast("string")).otherwise("x").alias("state")),
        F.struct(F.lit(2).alias("locus"), F.when(F.col("depth") > 1, (F.col("node") % 4).cast("string")).otherwise("x").alias("state")),
    )
    states = leveled.select("node", F.inline(loci)).where("state <> 'x'")
    return trees.assign(spark, leveled, clades, signatures, own, states, 4)


@query(
    # the root shows only R's locus; below, odd nodes show R.1, even ones R.0, and the third locus refines them
    f"""WITH {NODES},
    seen AS (SELECT node, parent, CASE WHEN node = 3000000 THEN 0 WHEN node >= 2000000 THEN 2 WHEN node >= 1000000 THEN 1 ELSE 3 END AS depth FROM nodes),
    level1 AS (SELECT node, 'R.' || CAST(node % 2 AS VARCHAR) AS clade FROM seen WHERE depth = 1),
    deep AS (SELECT s.node, s.depth, s.parent, CASE WHEN node % 4 = 2 THEN 'R.0.2' WHEN node % 4 = 3 THEN 'R.1.3' ELSE 'R.' || CAST(node % 2 AS VARCHAR) END AS best FROM seen s WHERE depth >= 2),
    level2 AS (SELECT d.node, CASE WHEN d.best = p.clade OR d.best LIKE p.clade || '.%' THEN d.best ELSE p.clade END AS clade FROM deep d JOIN level1 p ON d.parent = p.node WHERE d.depth = 2),
    level3 AS (SELECT d.node, CASE WHEN d.best = p.clade OR d.best LIKE p.clade || '.%' THEN d.best ELSE p.clade END AS clade FROM deep d JOIN level2 p ON d.parent = p.node WHERE d.depth = 3)
    SELECT 3000000 AS node, 'R' AS clade UNION ALL SELECT * FROM level1 UNION ALL SELECT * FROM level2 UNION ALL SELECT * FROM level3"""
)
def assign_clades(spark, sf_dir):
    return _assigned(spark, sf_dir)


MASK = "CASE WHEN bit_and(m) <> 0 THEN bit_and(m) ELSE bit_or(m) END"
LOWEST = "CASE WHEN {m} & 1 > 0 THEN 0 WHEN {m} & 2 > 0 THEN 1 WHEN {m} & 4 > 0 THEN 2 WHEN {m} & 8 > 0 THEN 3 ELSE 4 END"


def _level(name: str, below: str, above: str) -> str:
    """The states of a level of the tree from its masks and the states above; `moved` counts the changes."""
    own = LOWEST.format(m="x.m")
    return f"""{name} AS (SELECT x.site, x.node, CASE WHEN (x.m >> a.state) & 1 = 1 THEN a.state ELSE {own} END AS state, CASE WHEN (x.m >> a.state) & 1 = 1 THEN 0 ELSE 1 END AS moved
      FROM {below} x JOIN {above} a ON a.site = x.site AND a.node = x.parent)"""


@query(
    f"""WITH sites AS (SELECT unnest(range(1, 7)) AS site),
    m3 AS (SELECT site, c_custkey AS node, 2000000 + c_nationkey AS parent, 1 << CAST((c_custkey // 60 + site) % 5 AS INTEGER) AS m FROM customer, sites),
    m2 AS (SELECT s.site, 2000000 + n_nationkey AS node, 1000000 + n_regionkey AS parent, coalesce(g.m, 31) AS m FROM nation CROSS JOIN sites s LEFT JOIN (SELECT site, parent, {MASK} AS m FROM m3 GROUP BY 1, 2) g ON g.site = s.site AND g.parent = 2000000 + n_nationkey),
    m1 AS (SELECT s.site, 1000000 + r_regionkey AS node, 3000000 AS parent, coalesce(g.m, 31) AS m FROM region CROSS JOIN sites s LEFT JOIN (SELECT site, parent, {MASK} AS m FROM m2 GROUP BY 1, 2) g ON g.site = s.site AND g.parent = 1000000 + r_regionkey),
    m0 AS (SELECT site, {MASK} AS m FROM m1 GROUP BY 1),
    s0 AS (SELECT site, 3000000 AS node, {LOWEST.format(m="m")} AS state, 0 AS moved FROM m0), {_level("s1", "m1", "s0")}, {_level("s2", "m2", "s1")}, {_level("s3", "m3", "s2")}
    SELECT 'customers' AS tree, site, sum(moved) AS changes, count(*) AS n_nodes FROM (SELECT * FROM s0 UNION ALL SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3) GROUP BY 1, 2"""
)
def parsimony(spark, sf_dir):
    nodes = _nodes(spark, sf_dir)
    sites = F.explode(F.sequence(F.lit(1), F.lit(6))).alias("site")
    post = F.when(F.col("node") == 3000000, 3).when(F.col("node") >= 2000000, 1).when(F.col("node") >= 1000000, 2).otherwise(0)
    rows = nodes.select(F.lit("customers").alias("tree"), sites, post.alias("post"), "node", "parent")
    state = F.when(F.col("node") < 1000000, F.substr(F.lit("ACGT-"), (F.pmod(F.floor(F.col("node") / 60) + F.col("site"), F.lit(5)) + 1).cast("int"), F.lit(1)))
    return trees.fitch(rows.withColumn("state", state)).groupBy("tree", "site").agg(F.max("changes").alias("changes"), F.count("*").alias("n_nodes"))


@query(
    """WITH nations AS (SELECT n_regionkey AS tree, n_nationkey AS k, count(c_custkey) AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2),
    placed AS (SELECT *, 1 + coalesce(sum(n + 1) OVER (PARTITION BY tree ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre FROM nations)
    SELECT r_regionkey AS tree, 0 AS pre, NULL AS parent, 'region ' || chr(39) || r_name || chr(39) AS name, NULL AS length FROM region
    UNION ALL SELECT tree, pre, 0, 'n, (' || k || ')', 0.123456789 FROM placed
    UNION ALL SELECT p.tree, p.pre + row_number() OVER (PARTITION BY p.tree, p.k ORDER BY c_custkey), p.pre, CASE WHEN c_custkey % 10 <> 0 THEN 'c' || c_custkey ELSE '' END, (c_custkey % 1000) / 1000.0 FROM customer JOIN placed p ON c_nationkey = p.k"""
)
def newick_round_trip(spark, sf_dir):
    """Each region with its nations and customers as Newick text, and read again."""
    read = lambda name: standins.table(spark, sf_dir, name)
    region = read("region").select(F.col("r_regionkey").cast("long").alias("tree"), (F.col("r_regionkey") + 1000000).cast("long").alias("node"), F.lit(None).cast("long").alias("parent"), F.concat(F.lit("region '"), "r_name", F.lit("'")).alias("name"), F.lit(None).cast("double").alias("length"))
    nation = read("nation").select(F.col("n_regionkey").cast("long").alias("tree"), (F.col("n_nationkey") + 2000000).cast("long"), (F.col("n_regionkey") + 1000000).cast("long"), F.concat(F.lit("n, ("), F.col("n_nationkey").cast("string"), F.lit(")")), F.lit(0.123456789))
    named = F.when(F.col("c_custkey") % 10 != 0, F.concat(F.lit("c"), F.col("c_custkey").cast("string"))).otherwise("")
    lands = read("nation").select("n_nationkey", F.col("n_regionkey").cast("long").alias("tree"))
    customer = read("customer").join(lands, F.col("c_nationkey") == F.col("n_nationkey")).select("tree", F.col("c_custkey").cast("long"), (F.col("c_nationkey") + 2000000).cast("long"), named, F.col("c_custkey") % 1000 / 1000.0)
    rows = region.union(nation).union(customer)
    return trees.newick(trees.write_newick(rows)).select("tree", "pre", "parent", "name", "length")

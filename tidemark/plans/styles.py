"""Queries on lists, styles, groups and movements."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import styles
from tidemark.sources import standins

from .comparing import POINTS, _points
from .registry import query
from .trees import NODES, _pairs


def _lists(spark, sf_dir):
    orders = standins.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    names = standins.table(spark, sf_dir, "lineitem").where("l_quantity = 3").select((F.col("l_orderkey") * 2).alias("id"))
    return styles.listed(orders, names, "id")


LISTS = "names AS (SELECT DISTINCT l_orderkey * 2 AS id FROM lineitem WHERE l_quantity = 3)"


@query(f"WITH {LISTS} SELECT o_orderkey AS id FROM orders WHERE o_orderkey IN (SELECT id FROM names)")
def list_matches(spark, sf_dir):
    return _lists(spark, sf_dir)[0]


@query(f"WITH {LISTS} SELECT id FROM names WHERE id NOT IN (SELECT o_orderkey FROM orders)")
def list_unmatched(spark, sf_dir):
    return _lists(spark, sf_dir)[1]


@query(
    """WITH p AS (SELECT c_custkey AS point, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 7 = 1 THEN '' ELSE c_mktsegment END AS clade, c_custkey % 5 <> 0 AS aligned,
      CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN lower(c_mktsegment) END AS entry FROM customer)
    SELECT point, CASE WHEN clade IS NULL OR clade = '' OR NOT aligned THEN NULL ELSE entry END AS colour, CASE WHEN clade IS NULL THEN 'clade not defined' WHEN clade = '' THEN 'no clade'
      WHEN NOT aligned THEN 'no aligned sequence' WHEN entry IS NULL THEN 'no scheme row' ELSE '' END AS reason FROM p"""
)
def dot_styles(spark, sf_dir):
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    clade = F.when(key % 7 == 0, F.lit(None)).when(key % 7 == 1, "").otherwise(segment)
    entry = F.when(segment.isin("BUILDING", "MACHINERY"), F.lower(segment))
    found = standins.table(spark, sf_dir, "customer").select(key.alias("point"), styles.style(clade, F.lit(False), key % 5 != 0, entry).alias("x"))
    return found.select("point", "x.colour", "x.reason")


@query(
    """SELECT w AS "window", count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'undated' WHEN CAST(o_orderdate AS DATE) < DATE '1997-01-01' THEN 'grey'
      WHEN CAST(o_orderdate AS DATE) > DATE '1997-12-31' THEN 'later' ELSE 'shown' END AS w FROM orders) GROUP BY 1"""
)
def report_window(spark, sf_dir):
    points = standins.table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate").cast("date")).alias("date"))
    return styles.windowed(points, "date", "1997-01-01", "1997-12-31").groupBy("window").agg(F.count("*").alias("n"))


@query(
    f"""WITH {NODES}, anchors(grp, clade) AS (VALUES ('a', 1000001), ('b', 2000003), ('c', 1000002)), required(grp, locus, state) AS (VALUES ('a', 0, 1), ('a', 1, 0), ('b', 1, 1)),
    inside AS (SELECT c_custkey AS record, a.grp FROM customer JOIN pairs ON descendant = 2000000 + c_nationkey JOIN anchors a ON ancestor = a.clade),
    met AS (SELECT i.record, i.grp, count(*) FILTER (WHERE r.state = (i.record + r.locus) % 2) AS met, count(r.grp) AS needed FROM inside i LEFT JOIN required r ON i.grp = r.grp GROUP BY 1, 2)
    SELECT record, grp AS "group" FROM met WHERE met = needed"""
)
def group_members(spark, sf_dir):
    customer = standins.table(spark, sf_dir, "customer")
    records = customer.select(F.col("c_custkey").alias("record"), (F.col("c_nationkey") + 2000000).cast("long").alias("clade"))
    anchors = spark.createDataFrame([("a", 1000001), ("b", 2000003), ("c", 1000002)], "group string, clade long")
    required = spark.createDataFrame([("a", 0, 1), ("a", 1, 0), ("b", 1, 1)], "group string, locus int, state long")
    loci = customer.select(F.col("c_custkey").alias("record"), F.explode(F.array(F.lit(0), F.lit(1))).alias("locus"))
    states = loci.withColumn("state", (F.col("record") + F.col("locus")) % 2)
    return styles.members(records, anchors, _pairs(spark, sf_dir), required, states)


D = "sqrt((x - u) * (x - u) + (y - v) * (y - v))"


@query(f"WITH {POINTS} SELECT count(*) AS n, count(*) FILTER (WHERE {D} > 0.05) AS over_0, count(*) FILTER (WHERE {D} > 0.15) AS over_1 FROM points")
def continuity(spark, sf_dir):
    return styles.movers(_points(spark, sf_dir), [0.05, 0.15])


@query(
    f"""WITH {POINTS}, g AS (SELECT label, count(*) AS n, quantile_cont(u - x, 0.5) AS dx, quantile_cont(v - y, 0.5) AS dy FROM points GROUP BY 1)
    SELECT label, n, round(sqrt(dx * dx + dy * dy), 6) AS moved FROM g WHERE n >= 3 AND round(sqrt(dx * dx + dy * dy), 6) > 0.03"""
)
def moved_groups(spark, sf_dir):
    return styles.moved_groups(_points(spark, sf_dir), "label", 3, 0.03)


SIDES = """
l AS (SELECT p_partkey AS point, CASE WHEN p_partkey % 3 = 0 THEN p_name || p_brand END AS strict, p_brand || CAST(p_size AS VARCHAR) AS loose FROM part WHERE p_partkey % 5 <> 0),
r AS (SELECT p_partkey AS point, p_name || p_brand AS strict, p_brand || CAST(p_size AS VARCHAR) AS loose FROM part WHERE p_partkey % 4 <> 0),
s AS (SELECT a, b FROM (SELECT strict, min(point) AS a FROM l WHERE strict IS NOT NULL GROUP BY 1 HAVING count(*) = 1) JOIN (SELECT strict, min(point) AS b FROM r GROUP BY 1 HAVING count(*) = 1) USING (strict)),
o AS (SELECT a, b FROM (SELECT loose, min(point) AS a FROM l WHERE point NOT IN (SELECT a FROM s) GROUP BY 1 HAVING count(*) = 1)
  JOIN (SELECT loose, min(point) AS b FROM r WHERE point NOT IN (SELECT b FROM s) GROUP BY 1 HAVING count(*) = 1) USING (loose))"""


@query(f"WITH {SIDES} SELECT a, b, 'strict' AS how FROM s UNION ALL SELECT a, b, 'loose' FROM o")
def keyed_points(spark, sf_dir):
    part, key = standins.table(spark, sf_dir, "part"), F.col("p_partkey")
    strict, loose = F.concat("p_name", "p_brand"), F.concat("p_brand", F.col("p_size").cast("string"))
    left = part.where(key % 5 != 0).select(key.alias("point"), F.when(key % 3 == 0, strict).alias("strict"), loose.alias("loose"))
    right = part.where(key % 4 != 0).select(key.alias("point"), strict.alias("strict"), loose.alias("loose"))
    return styles.paired(left, right, "strict", "loose")


CHECKS = """
checks AS (SELECT 'share' AS chk, r_name AS slot, count(*) AS value FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 2),
excuses(chk, slot, reason) AS (VALUES ('share', 'ASIA', 'known'), ('share', 'NOWHERE', 'old'))"""


@query(
    f"""WITH {CHECKS}, failing AS (SELECT chk, slot, value FROM checks WHERE value > 290)
    SELECT coalesce(f.chk, e.chk) AS "check", coalesce(f.slot, e.slot) AS slot, value, reason, CASE WHEN value IS NULL THEN 'stale excuse' WHEN reason IS NOT NULL THEN 'excused' ELSE 'failing' END AS verdict
    FROM failing f FULL JOIN excuses e ON f.chk = e.chk AND f.slot = e.slot"""
)
def expected_differences(spark, sf_dir):
    read = lambda name: standins.table(spark, sf_dir, name)
    joined = read("customer").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    checks = joined.groupBy(F.lit("share").alias("check"), F.col("r_name").alias("slot")).agg(F.count("*").alias("value")).withColumn("most", F.lit(290))
    excuses = spark.createDataFrame([("share", "ASIA", "known"), ("share", "NOWHERE", "old")], "check string, slot string, reason string")
    return styles.expected(checks, excuses)

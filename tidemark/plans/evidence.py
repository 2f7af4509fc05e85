"""Queries on clade evidence, schemes, branches and dots."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import evidence
from tidemark.sources import standins

from .registry import query
from .trees import NODES, _nodes, _pairs

RECORDS = (
    NODES
    + """,
records AS (SELECT c_custkey AS record, 2000000 + c_nationkey AS clade FROM customer),
own AS (SELECT node AS clade, node % 3 AS locus, CAST(node % 2 AS VARCHAR) AS state FROM nodes WHERE node >= 1000000),
states AS (SELECT c_custkey AS record, l.i AS locus, CASE WHEN (c_custkey + l.i) % 11 = 0 THEN NULL ELSE CAST((c_custkey // 7 + l.i) % 2 AS VARCHAR) END AS state FROM customer, range(3) l(i)),
judged AS (
  SELECT record, r.clade, ancestor, distance, CASE WHEN count(*) FILTER (WHERE s.state <> o.state) > 0 THEN 'contradicted' WHEN count(*) FILTER (WHERE s.state IS NULL) > 0 THEN 'unobserved' ELSE 'supported' END AS verdict
  FROM records r JOIN pairs ON r.clade = descendant JOIN own o ON ancestor = o.clade LEFT JOIN states s USING (record, locus) GROUP BY 1, 2, 3, 4)"""
)


def _records(spark, sf_dir):
    return standins.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("record"), (F.col("c_nationkey") + 2000000).cast("long").alias("clade"))


def _evidence(spark, sf_dir):
    own = _nodes(spark, sf_dir).where("node >= 1000000").select(F.col("node").alias("clade"), (F.col("node") % 3).alias("locus"), (F.col("node") % 2).cast("string").alias("state"))
    loci = standins.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("record"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2).cast("long"))).alias("locus"))
    shown = ((F.floor(F.col("record") / 7) + F.col("locus")) % 2).cast("string")
    states = loci.withColumn("state", F.when((F.col("record") + F.col("locus")) % 11 != 0, shown))
    return evidence.clade_evidence(_records(spark, sf_dir), own, states, _pairs(spark, sf_dir))


EVIDENCE = """(SELECT record, clade, max(verdict) FILTER (WHERE distance = 0) AS evidence, CASE WHEN max(verdict) FILTER (WHERE distance = 0) <> 'supported' THEN
  arg_min(ancestor, distance) FILTER (WHERE verdict = 'supported') END AS supported FROM judged GROUP BY 1, 2)"""


@query(f"WITH {RECORDS} SELECT * FROM {EVIDENCE}")
def clade_evidence(spark, sf_dir):
    return _evidence(spark, sf_dir)


@query(f"WITH {RECORDS} SELECT evidence, supported IS NOT NULL AS has_ancestor, count(*) AS n FROM {EVIDENCE} GROUP BY 1, 2")
def evidence_summary(spark, sf_dir):
    return _evidence(spark, sf_dir).groupBy("evidence", F.col("supported").isNotNull().alias("has_ancestor")).agg(F.count("*").alias("n"))


@query(
    f"""WITH {RECORDS}, scheme(line, clade, colour) AS (VALUES (1, 1000000, 'red'), (2, 1000001, 'blue'), (3, 2000005, 'green'), (4, 1000000, 'pink'), (5, 2000010, 'grey')),
    hits AS (SELECT record, max(line) AS line FROM records r JOIN pairs ON r.clade = descendant JOIN scheme s ON ancestor = s.clade GROUP BY 1)
    SELECT r.record, r.clade, h.line, s.colour FROM records r LEFT JOIN hits h USING (record) LEFT JOIN scheme s ON h.line = s.line"""
)
def scheme_entry(spark, sf_dir):
    rows = [(1, 1000000, "red"), (2, 1000001, "blue"), (3, 2000005, "green"), (4, 1000000, "pink"), (5, 2000010, "grey")]
    scheme = spark.createDataFrame(rows, "line int, clade long, colour string")
    return evidence.scheme_entry(_records(spark, sf_dir), scheme, _pairs(spark, sf_dir))


STATES = "site_states AS (SELECT node, s.i AS site, substring('ACGTX', CAST((node // 3 + s.i) % 5 + 1 AS BIGINT), 1) AS state FROM nodes, range(4) s(i))"


def _states(spark, sf_dir):
    rows = _nodes(spark, sf_dir).select("node", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("site"))
    return rows.withColumn("state", F.substr(F.lit("ACGTX"), ((F.floor(F.col("node") / 3) + F.col("site")) % 5 + 1).cast("int"), F.lit(1)))


@query(
    f"""WITH {NODES}, {STATES} SELECT c.node, c.site, p.state AS was, c.state AS now FROM site_states c JOIN nodes n ON c.node = n.node JOIN site_states p ON n.parent = p.node AND c.site = p.site
    WHERE c.state <> p.state AND c.state <> 'X' AND p.state <> 'X'"""
)
def branch_changes(spark, sf_dir):
    return evidence.branch_changes(_states(spark, sf_dir), _nodes(spark, sf_dir))


@query(
    f"""WITH {NODES}, {STATES}, c AS (SELECT site, state AS residue, count(*) AS n FROM site_states WHERE state NOT IN ('X', '-') GROUP BY 1, 2)
    SELECT site, residue, round(n * 1.0 / total, 9) AS share FROM (SELECT *, sum(n) OVER (PARTITION BY site) AS total, row_number() OVER (PARTITION BY site ORDER BY n DESC, residue) AS r FROM c) WHERE r = 1"""
)
def leaf_consensus(spark, sf_dir):
    return evidence.consensus(_states(spark, sf_dir).withColumnRenamed("state", "residue"), "site")


@query("SELECT c_mktsegment AS clade, count(*) AS n FROM customer GROUP BY 1 HAVING c_mktsegment NOT IN (SELECT c_mktsegment FROM customer WHERE c_mktsegment LIKE '%U%')")
def vanished_clades(spark, sf_dir):
    customer = standins.table(spark, sf_dir, "customer")
    expected = customer.groupBy(F.col("c_mktsegment").alias("clade")).agg(F.count("*").alias("n"))
    return evidence.vanished(expected, customer.where("c_mktsegment like '%U%'").select(F.col("c_mktsegment").alias("clade")))


@query(
    f"""WITH {NODES}, matches AS (SELECT c_custkey AS node, 2000000 + c_nationkey AS label, c_custkey % 3 AS label_support, CASE WHEN c_custkey % 2 = 0 THEN 1000000 + c_custkey % 5 ELSE 2000000 + c_custkey % 25 END AS clade,
      c_custkey % 4 AS support FROM customer),
    rel AS (SELECT ancestor AS a, descendant AS b FROM pairs UNION SELECT descendant, ancestor FROM pairs)
    SELECT node, label, clade, support FROM matches m WHERE support >= label_support AND NOT EXISTS (SELECT 1 FROM rel WHERE a = m.label AND b = m.clade)"""
)
def sibling_conflicts(spark, sf_dir):
    key = F.col("c_custkey")
    clade = F.when(key % 2 == 0, key % 5 + 1000000).otherwise(key % 25 + 2000000)
    matches = standins.table(spark, sf_dir, "customer").select(key.alias("node"), (F.col("c_nationkey") + 2000000).cast("long").alias("label"), (key % 3).alias("label_support"), clade.alias("clade"), (key % 4).alias("support"))
    return evidence.sibling_conflicts(matches, _pairs(spark, sf_dir))


@query(
    """WITH d AS (SELECT vec_id AS dot, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
    SELECT a.dot, count(*) AS n_above FROM d a JOIN d b ON b.dot > a.dot AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) < 0.02 * 0.02 GROUP BY 1"""
)
def hidden_dots(spark, sf_dir):
    dots = standins.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("dot"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return evidence.hidden(dots, 0.02)


@query(
    f"""WITH {NODES}, path AS (SELECT ancestor AS node, row_number() OVER (ORDER BY distance) AS place FROM pairs WHERE descendant = 17),
    turned AS (SELECT node, lag(node) OVER (ORDER BY place) AS new_parent FROM path)
    SELECT n.node, CASE WHEN t.node IS NOT NULL THEN t.new_parent ELSE n.parent END AS parent,
      CASE WHEN t.node IS NOT NULL THEN (t.new_parent % 7) / 10.0 WHEN n.parent IS NOT NULL THEN (n.node % 7) / 10.0 END AS length FROM nodes n LEFT JOIN turned t ON n.node = t.node"""
)
def reroot(spark, sf_dir):
    path = _pairs(spark, sf_dir).where("descendant = 17").select(F.col("ancestor").alias("node"), (F.col("distance") + 1).alias("place"))
    nodes = _nodes(spark, sf_dir)
    return evidence.rerooted(nodes.withColumn("length", F.when(F.col("parent").isNotNull(), F.col("node") % 7 / 10.0)), path)


@query(
    f"""WITH {NODES}, lengths AS (SELECT node, parent, (node % 7) / 10.0 AS length FROM nodes),
    stays AS (SELECT node FROM lengths WHERE parent IS NULL OR length >= 0.3 OR node NOT IN (SELECT parent FROM nodes WHERE parent IS NOT NULL)),
    up AS (SELECT descendant AS node, ancestor, row_number() OVER (PARTITION BY descendant ORDER BY distance) AS r FROM pairs WHERE distance > 0 AND ancestor IN (SELECT node FROM stays))
    SELECT s.node, u.ancestor AS parent FROM stays s LEFT JOIN up u ON s.node = u.node AND u.r = 1"""
)
def collapse_short(spark, sf_dir):
    nodes = _nodes(spark, sf_dir).withColumn("length", F.col("node") % 7 / 10.0)
    return evidence.collapsed(nodes, _pairs(spark, sf_dir), 0.3)

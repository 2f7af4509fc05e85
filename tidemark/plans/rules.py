"""Queries that apply rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import rules
from tidemark.sources import standins

from .registry import query

LINES = [
    (1, "O", "*", "SMALL .*|.*BOLT", "small or bolt"),
    (2, "*", "BUILDING", "red .*", "red building"),
    (3, "*", "*", "blue (ring|bolt)", "blue"),
    (4, "F", "*", "never matches", "never"),
    (5, "*", "*", ".*widget", "widget"),
]
RULES = "rules(rule_line, rule_status, rule_segment, rule_pattern, rule_value) AS (VALUES " + ", ".join(map(repr, LINES)) + ")"

ROWS = """
lines AS (
  SELECT row_number() OVER () AS row_id, CASE WHEN l_orderkey % 11 <> 0 THEN o_orderstatus END AS status, CASE WHEN l_orderkey % 7 <> 0 THEN c_mktsegment END AS segment,
    CASE WHEN l_partkey % 13 <> 0 THEN p_name END AS text
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey),
hits AS (
  SELECT l.row_id, min(r.rule_line) AS rule_line FROM lines l LEFT JOIN rules r
    ON (r.rule_status = '*' OR lower(r.rule_status) = lower(status)) AND (r.rule_segment = '*' OR lower(r.rule_segment) = lower(segment))
    AND regexp_full_match(text, r.rule_pattern, 'i') GROUP BY 1)"""


def _matched(spark, sf_dir):
    read = lambda name: standins.table(spark, sf_dir, name)
    lines = read("lineitem").join(read("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(read("customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = lines.join(read("part"), F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        F.when(F.col("l_orderkey") % 11 != 0, F.col("o_orderstatus")).alias("status"),
        F.when(F.col("l_orderkey") % 7 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("l_partkey") % 13 != 0, F.col("p_name")).alias("text"),
    )
    table = spark.createDataFrame(LINES, "rule_line int, rule_status string, rule_segment string, rule_pattern string, rule_value string")
    return rules.decided(rows, table, ["status", "segment"], ["status", "segment", "text"]), table


@query(f"WITH {RULES}, {ROWS} SELECT rule_line, rule_value, count(*) AS n FROM hits LEFT JOIN rules USING (rule_line) GROUP BY 1, 2")
def rules_first_match(spark, sf_dir):
    return _matched(spark, sf_dir)[0].groupBy("rule_line", "rule_value").agg(F.count("*").alias("n"))


@query(f"WITH {RULES}, {ROWS} SELECT r.rule_line, count(h.rule_line) AS hits FROM rules r LEFT JOIN hits h USING (rule_line) GROUP BY 1 HAVING count(h.rule_line) = 0")
def rules_unused(spark, sf_dir):
    matched, table = _matched(spark, sf_dir)
    return rules.usage(matched, table).where("hits = 0")


STEPS = """
records AS (
  SELECT o_orderkey AS id, o_orderstatus AS host, CAST(o_orderdate AS DATE) AS first, o_orderpriority AS qc, o_totalprice AS price, o_orderkey % 97 = 0 AS outgroup,
    true AS s0 FROM orders),
s1 AS (SELECT *, s0 AND coalesce(host IN ('O', 'F'), false) AS s1 FROM records),
s2 AS (SELECT *, s1 AND coalesce(first >= DATE '1996-01-01', false) AS s2 FROM s1),
s3 AS (SELECT *, s2 OR id % 50 = 3 AS s3 FROM s2),
s4 AS (SELECT *, s3 AND qc <> '5-LOW' AS s4 FROM s3),
s5 AS (SELECT *, s4 AND NOT (id % 40 = 7) AS s5 FROM s4),
counts AS (
  SELECT 0 AS place, 'host' AS rule, count(*) FILTER (WHERE s0 AND NOT s1) AS removed, count(*) FILTER (WHERE NOT s0 AND s1) AS added, count(*) FILTER (WHERE s1) AS remaining FROM s5 WHERE NOT outgroup
  UNION ALL SELECT 1, 'date floor', count(*) FILTER (WHERE s1 AND NOT s2), count(*) FILTER (WHERE NOT s1 AND s2), count(*) FILTER (WHERE s2) FROM s5 WHERE NOT outgroup
  UNION ALL SELECT 2, 'include list', count(*) FILTER (WHERE s2 AND NOT s3), count(*) FILTER (WHERE NOT s2 AND s3), count(*) FILTER (WHERE s3) FROM s5 WHERE NOT outgroup
  UNION ALL SELECT 3, 'qc', count(*) FILTER (WHERE s3 AND NOT s4), count(*) FILTER (WHERE NOT s3 AND s4), count(*) FILTER (WHERE s4) FROM s5 WHERE NOT outgroup
  UNION ALL SELECT 4, 'exclude list', count(*) FILTER (WHERE s4 AND NOT s5), count(*) FILTER (WHERE NOT s4 AND s5), count(*) FILTER (WHERE s5) FROM s5 WHERE NOT outgroup)"""


def _selection(spark, sf_dir):
    rows = standins.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("host"), F.col("o_orderdate").cast("date").alias("first"), F.col("o_orderpriority").alias("qc"), F.col("o_totalprice").alias("price")
    )
    steps = [
        rules.Step("host", "filter", F.col("host").isin("O", "F")),
        rules.Step("date floor", "filter", F.col("first") >= F.lit("1996-01-01").cast("date")),
        rules.Step("include list", "include", F.col("id") % 50 == 3),
        rules.Step("qc", "filter", F.col("qc") != "5-LOW"),
        rules.Step("exclude list", "exclude", F.col("id") % 40 == 7),
    ]
    return rules.select(rows, steps, F.col("id") % 97 == 0)


@query(f"WITH {STEPS} SELECT * FROM counts")
def selection_counts(spark, sf_dir):
    return _selection(spark, sf_dir)[1]


@query(f"WITH {STEPS} SELECT id FROM s5 WHERE s5 OR outgroup")
def selection_kept(spark, sf_dir):
    return _selection(spark, sf_dir)[0].select("id")


@query(
    """WITH measured AS (SELECT o_orderkey AS id, year(o_orderdate) AS year, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_totalprice END AS distance FROM orders),
    medians AS (SELECT year, count(distance) AS n, median(distance) AS median FROM measured WHERE distance IS NOT NULL GROUP BY 1)
    SELECT id, coalesce(distance / median < 0.25, false) AS low FROM measured LEFT JOIN (SELECT * FROM medians WHERE n >= 10 AND median > 0) USING (year)"""
)
def low_divergence(spark, sf_dir):
    rows = standins.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.year("o_orderdate").alias("year"), F.when(F.col("o_orderkey") % 6 != 0, F.col("o_totalprice")).alias("distance"))
    return rules.low_divergence(rows, "year", "distance", 0.25, 10).select("id", "low")


PLACED = """
distances AS (SELECT l_orderkey AS id, l_suppkey AS reference, min(CAST(l_quantity AS BIGINT)) AS substitutions FROM lineitem GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY substitutions, reference) AS r, lead(substitutions) OVER (PARTITION BY id ORDER BY substitutions, reference) AS second FROM distances),
placed AS (SELECT id, CASE WHEN coalesce(second - substitutions >= 3, true) THEN reference END AS placed,
  CASE WHEN coalesce(second - substitutions >= 3, true) THEN '' ELSE 'ambiguous' END AS flag, substitutions FROM ranked WHERE r = 1)"""


def _placed(spark, sf_dir):
    lines = standins.table(spark, sf_dir, "lineitem")
    distances = lines.groupBy(F.col("l_orderkey").alias("id"), F.col("l_suppkey").alias("reference")).agg(F.min(F.col("l_quantity").cast("long")).alias("substitutions"))
    return rules.place(distances, "id", 3)


@query(f"WITH {PLACED} SELECT * FROM placed")
def place_records(spark, sf_dir):
    return _placed(spark, sf_dir)


@query(
    f"""WITH {PLACED}, aged AS (SELECT id, CASE WHEN id % 8 = 0 THEN NULL ELSE substitutions END AS substitutions, CAST(id % 5 + 1 AS DOUBLE) AS years FROM placed),
    judged AS (SELECT *, CASE WHEN substitutions IS NULL THEN 'no-distance' WHEN substitutions > 30 THEN 'too-far' WHEN substitutions / years > 6 THEN 'too-fast' ELSE '' END AS reason FROM aged)
    SELECT id, reason, reason IN ('too-far', 'too-fast') AS held FROM judged"""
)
def hold_far(spark, sf_dir):
    aged = _placed(spark, sf_dir).select("id", F.when(F.col("id") % 8 != 0, F.col("substitutions")).alias("substitutions"), (F.col("id") % 5 + 1).cast("double").alias("years"))
    return rules.held(aged, 30, 6.0).select("id", "reason", "held")

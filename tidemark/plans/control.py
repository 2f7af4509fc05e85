"""Queries on control series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import control
from tidemark.sources import standins

from .registry import query

SERIES = """
series AS (SELECT user_id % 20 AS serum, event_id AS pos, CASE WHEN event_id % 10 = 7 THEN NULL ELSE CAST(floor(value) AS DOUBLE) % 8 END AS value FROM events)"""

CENTRE, SD = 3.5, 1.5


def _series(spark, sf_dir):
    return standins.series(spark, sf_dir)


XYZ = """CASE WHEN n < {y} THEN false WHEN nulls > 0 THEN NULL ELSE {side} >= {x} END"""


def _xyz(x: int, y: int, z: float) -> str:
    return f"""WITH {SERIES}, w AS (SELECT serum, pos, value, count(*) OVER p AS n, count(*) FILTER (WHERE value IS NULL) OVER (PARTITION BY serum ORDER BY pos ROWS UNBOUNDED PRECEDING) AS nulls,
      sum(CASE WHEN value > {CENTRE + z * SD} THEN 1 WHEN value IS NOT NULL THEN 0 END) OVER p AS hi, sum(CASE WHEN value < {CENTRE - z * SD} THEN 1 WHEN value IS NOT NULL THEN 0 END) OVER p AS lo
      FROM series WINDOW p AS (PARTITION BY serum ORDER BY pos ROWS BETWEEN {y - 1} PRECEDING AND CURRENT ROW))
    SELECT serum, pos, value, {XYZ.format(x=x, y=y, side='hi')} AS high, {XYZ.format(x=x, y=y, side='lo')} AS low FROM w"""


@query(_xyz(1, 1, 2.0))
def control_one_of_one(spark, sf_dir):
    return control.beyond(_series(spark, sf_dir), "serum", "pos", CENTRE, SD, 1, 1, 2.0)


@query(_xyz(2, 3, 1.0))
def control_two_of_three(spark, sf_dir):
    return control.beyond(_series(spark, sf_dir), "serum", "pos", CENTRE, SD, 2, 3, 1.0)


@query(_xyz(4, 5, 0.0))
def control_four_of_five(spark, sf_dir):
    return control.beyond(_series(spark, sf_dir), "serum", "pos", CENTRE, SD, 4, 5, 0.0)


RUNS = """
marked AS (SELECT *, coalesce({flag}, false) AS flag FROM {of}),
runs AS (SELECT serum, min(pos) AS first, max(pos) AS last, count(*) AS length FROM (
  SELECT *, row_number() OVER (PARTITION BY serum ORDER BY pos) - row_number() OVER (PARTITION BY serum, flag ORDER BY pos) AS g FROM marked) WHERE flag GROUP BY serum, g)"""

LAGS = """lags AS (SELECT *, lag(value) OVER (PARTITION BY serum ORDER BY pos) AS was, lag(value, 2) OVER (PARTITION BY serum ORDER BY pos) AS before FROM series)"""


def _runs(flag: str, n: int, of: str = "lags") -> str:
    return f"WITH {SERIES}, {LAGS}, {RUNS.format(flag=flag, of=of)} SELECT serum, CAST(sum(length - {n} + 1) AS BIGINT) AS n_hits, max(length) AS longest FROM runs WHERE length >= {n} GROUP BY 1"


def _long(spark, sf_dir, kind: str, n: int):
    rows = control.stretches(_series(spark, sf_dir), "serum", "pos", kind)
    return control.long_runs(rows, "serum", "pos", F.col("flag"), n)


@query(_runs("value > was", 3))
def control_rising(spark, sf_dir):
    return _long(spark, sf_dir, "rising", 3)


@query(_runs("value < was", 3))
def control_falling(spark, sf_dir):
    return _long(spark, sf_dir, "falling", 3)


@query(_runs("value = was", 2))
def control_nodiff(spark, sf_dir):
    return _long(spark, sf_dir, "equal", 2)


@query(_runs("sign(value - was) * sign(was - before) < 0", 3))
def control_alternating(spark, sf_dir):
    return _long(spark, sf_dir, "alternating", 3)


@query(_runs(f"abs(value - {CENTRE}) > {SD}", 3))
def control_zone(spark, sf_dir):
    return control.long_runs(_series(spark, sf_dir), "serum", "pos", control.outside(CENTRE, SD), 3)


def _stretch(x: int, y: int, z: float) -> str:
    side = lambda test: f"count(*) FILTER (WHERE n >= {y} AND nulls = 0 AND {test} >= {x})"
    return f"""SELECT serum, {side('hi')} + {side('lo')} AS n FROM (SELECT serum, row_number() OVER (PARTITION BY serum ORDER BY pos) AS n,
      count(*) FILTER (WHERE value IS NULL) OVER (PARTITION BY serum ORDER BY pos ROWS UNBOUNDED PRECEDING) AS nulls,
      sum(CAST(value > {CENTRE + z * SD} AS INTEGER)) OVER p AS hi, sum(CAST(value < {CENTRE - z * SD} AS INTEGER)) OVER p AS lo
      FROM dense WINDOW p AS (PARTITION BY serum ORDER BY pos ROWS BETWEEN {y - 1} PRECEDING AND CURRENT ROW)) GROUP BY 1"""


def _run(flag: str, least: int, extra: str = "") -> str:
    return f"""SELECT serum, CAST(sum(length - {least} + 1) AS BIGINT) AS n FROM (SELECT serum, min(pos) AS first, arg_min(sign, pos) AS first_sign, count(*) AS length FROM (
      SELECT *, row_number() OVER (PARTITION BY serum ORDER BY pos) - row_number() OVER (PARTITION BY serum, flag ORDER BY pos) AS g FROM (SELECT *, coalesce({flag}, false) AS flag FROM steps)) WHERE flag GROUP BY serum, g)
      WHERE length >= {least} {extra} GROUP BY 1"""


#: Some series without gaps, some with few distinct values, so that every rule fires somewhere.
DENSE = """dense AS (SELECT user_id % 40 AS serum, event_id AS pos, CASE WHEN user_id % 40 < 20 OR event_id % 50 <> 7 THEN CASE user_id % 4 WHEN 0 THEN CAST(floor(value) AS DOUBLE) % 8
  WHEN 1 THEN CAST(event_id // 400 % 3 AS DOUBLE) * 3 WHEN 2 THEN CAST(floor(value) AS DOUBLE) % 2 * 5 ELSE CAST(event_id // 90 % 6 AS DOUBLE) END END AS value FROM events)"""


@query(
    f"""WITH {DENSE}, signs AS (SELECT *, value - lead(value) OVER (PARTITION BY serum ORDER BY pos) AS step, sign(value - lead(value) OVER (PARTITION BY serum ORDER BY pos)) AS sign FROM dense),
    steps AS (SELECT *, CASE WHEN count(*) FILTER (WHERE step IS NULL) OVER (PARTITION BY serum ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 FOLLOWING) = 0 THEN sign + lead(sign) OVER (PARTITION BY serum ORDER BY pos) END AS level FROM signs),
    found AS (SELECT '1 >=3' AS rule, * FROM ({_stretch(1, 1, 3 - 1e-5)}) UNION ALL SELECT '2/3 >=2', * FROM ({_stretch(2, 3, 2 - 1e-5)}) UNION ALL SELECT '8 >=1', * FROM ({_stretch(8, 8, 0.0)})
      UNION ALL SELECT 'diff of 3', serum, count(*) FILTER (WHERE abs(step) >= 3) FROM steps GROUP BY 1, 2 UNION ALL SELECT '9 >=1 both', * FROM ({_run(f"abs(value - {CENTRE}) >= {SD}", 9)})
      UNION ALL SELECT 'no diff 25', * FROM ({_run("step = 0", 24)}) UNION ALL SELECT 'alt 10', * FROM ({_run("level = 0", 8, "AND first_sign <> 0")})
      UNION ALL SELECT 'trend 4', * FROM ({_run("step < 0", 3)}) UNION ALL SELECT 'trend 4', * FROM ({_run("step > 0", 3)}))
    SELECT s.serum, r.rule, CAST(coalesce(sum(f.n), 0) AS BIGINT) AS n FROM (SELECT DISTINCT serum FROM dense) s CROSS JOIN (VALUES {", ".join(f"('{r}')" for r in control.RULES)}) r(rule)
    LEFT JOIN found f ON f.serum = s.serum AND f.rule = r.rule GROUP BY 1, 2"""
)
def control_report(spark, sf_dir):
    """The eight control rules together."""
    kind, event, floor = F.col("user_id") % 4, F.col("event_id"), F.floor("value").cast("double")
    made = F.when(kind == 0, floor % 8).when(kind == 1, (F.floor(event / 400) % 3).cast("double") * 3).when(kind == 2, floor % 2 * 5).otherwise((F.floor(event / 90) % 6).cast("double"))
    there = (F.col("user_id") % 40 < 20) | (event % 50 != 7)
    rows = standins.table(spark, sf_dir, "events").select((F.col("user_id") % 40).alias("serum"), event.alias("pos"), F.when(there, made).alias("value"))
    return control.report(rows, "serum", "pos", CENTRE, SD)


@query(f"WITH {SERIES}, n AS (SELECT serum, pos, value, abs(lead(value) OVER (PARTITION BY serum ORDER BY pos) - value) AS step FROM series) SELECT * FROM n WHERE step >= 5")
def control_jump(spark, sf_dir):
    return control.jumps(_series(spark, sf_dir), "serum", "pos", 5.0)


@query(f"WITH {SERIES}, {RUNS.format(flag='value >= 4', of='series')} SELECT serum, first, last, length FROM runs")
def islands(spark, sf_dir):
    return control.islands(_series(spark, sf_dir), "serum", "pos", F.col("value") >= 4)


@query()
def clade_bands(spark, sf_dir):
    rows = _series(spark, sf_dir)
    numbered = rows.withColumn("row", F.col("pos"))
    runs = control.islands(numbered, "serum", "row", F.col("value") >= 3)
    total = numbered.agg(F.count("*").alias("total"))  # one row
    return control.bands(runs.join(F.broadcast(total)), "serum", 2, 0.7, 0.01)


@query(
    """SELECT p_type AS strain, p_brand AS class, p_partkey AS antigen, place FROM (
      SELECT *, row_number() OVER (PARTITION BY p_type, p_brand ORDER BY n DESC, latest DESC, p_partkey) AS place FROM (
        SELECT p_type, p_brand, p_partkey, count(DISTINCT l_orderkey) AS n, max(CAST(l_shipdate AS DATE)) AS latest FROM part JOIN lineitem ON p_partkey = l_partkey GROUP BY 1, 2, 3)) WHERE place <= 2"""
)
def vaccine_pick(spark, sf_dir):
    lines = standins.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("antigen")).agg(F.count_distinct("l_orderkey").alias("n"), F.max(F.col("l_shipdate").cast("date")).alias("latest"))
    part = standins.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("antigen"), F.col("p_type").alias("strain"), F.col("p_brand").alias("class"))
    order = [F.desc("n"), F.desc("latest"), F.col("antigen")]
    return control.picks(lines.join(part, "antigen"), ["strain", "class"], order, 2).select("strain", "class", "antigen", "place")


@query(
    """SELECT l_suppkey AS serum, section, matches FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY matches, section) AS r FROM (
      SELECT l_suppkey, l_returnflag || l_linestatus AS section, count(*) AS matches FROM lineitem GROUP BY 1, 2)) WHERE r = 1"""
)
def section_owner(spark, sf_dir):
    lines = standins.table(spark, sf_dir, "lineitem")
    counted = lines.groupBy(F.col("l_suppkey").alias("serum"), F.concat("l_returnflag", "l_linestatus").alias("section")).agg(F.count("*").alias("matches"))
    return control.owners(counted, "serum", ["matches", "section"])


@query("SELECT s_nationkey AS centre, s_suppkey AS serum, CAST(floor((r - 1) / 3) AS INTEGER) AS page, CAST((r - 1) % 3 AS INTEGER) AS slot FROM (SELECT *, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS r FROM supplier)")
def page_columns(spark, sf_dir):
    rows = standins.table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("centre"), F.col("s_suppkey").alias("serum"), "s_acctbal")
    return control.pages(rows, "centre", [F.desc("s_acctbal"), F.col("serum")], 3).drop("s_acctbal")

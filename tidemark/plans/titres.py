"""Queries on censored readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import titres
from tidemark.sources import standins

from .registry import query

READINGS = """
readings AS (
  SELECT l_partkey AS antigen, l_suppkey % 10 AS serum, l_orderkey AS table_id,
    CASE WHEN l_quantity = 50 THEN '*' ELSE
      (CASE l_returnflag WHEN 'R' THEN '<' WHEN 'A' THEN '>' ELSE '' END)
      || CAST(CAST(10 * power(2, CAST(l_quantity AS BIGINT) % 8) AS BIGINT) AS VARCHAR) END AS token
  FROM lineitem),
parsed AS (
  SELECT *, CASE WHEN token = '*' THEN 'missing' WHEN token LIKE '<%' THEN 'lt' WHEN token LIKE '>%' THEN 'gt' ELSE 'num' END AS kind,
    TRY_CAST(ltrim(token, '<>') AS BIGINT) AS value
  FROM readings)"""

CELLS = (
    READINGS
    + """,
logs AS (SELECT *, log2(value / 10.0) AS log FROM parsed),
used AS (SELECT *, log + CASE kind WHEN 'lt' THEN -1 WHEN 'gt' THEN 1 ELSE 0 END AS step FROM logs WHERE kind <> 'missing'),
agg AS (
  SELECT antigen, serum, count(*) AS n, count(*) FILTER (WHERE kind = 'num') AS n_num, count(*) FILTER (WHERE kind = 'lt') AS n_lt,
    count(*) FILTER (WHERE kind = 'gt') AS n_gt, round(stddev_pop(step), 12) AS sd, avg(log) FILTER (WHERE kind = 'num') AS mean_log,
    max(value) FILTER (WHERE kind = 'num') AS max_num, min(value) FILTER (WHERE kind = 'num') AS min_num,
    min(value) FILTER (WHERE kind = 'lt') AS min_lt, max(value) FILTER (WHERE kind = 'lt') AS max_lt,
    min(value) FILTER (WHERE kind = 'gt') AS min_gt, max(value) FILTER (WHERE kind = 'gt') AS max_gt
  FROM used GROUP BY 1, 2),
picks AS (
  SELECT u.antigen, u.serum, min(u.value) FILTER (WHERE u.kind = 'lt' AND u.value > a.max_num) AS above,
    max(u.value) FILTER (WHERE u.kind = 'gt' AND u.value < a.min_num) AS below
  FROM used u JOIN agg a USING (antigen, serum) GROUP BY 1, 2),
outcomes AS (
  SELECT antigen, serum, s.n_all, a.*, p.above, p.below, CASE
      WHEN coalesce(a.n, 0) = 0 THEN 'all-dont-care'
      WHEN n_lt > 0 AND n_gt > 0 THEN 'less-and-more-than'
      WHEN n_num = 0 AND n_lt > 0 THEN 'less-than-only'
      WHEN n_num = 0 AND n_gt > 0 THEN 'more-than-only-to-dont-care'
      WHEN sd > 1.0 THEN 'sd-too-big'
      WHEN n_lt = 0 AND n_gt = 0 THEN 'regular-only'
      WHEN n_lt > 0 AND max_lt > max_num THEN 'max-less-than-bigger-than-max-regular'
      WHEN n_lt > 0 THEN 'less-than-and-regular'
      WHEN min_gt < min_num THEN 'min-more-than-less-than-min-regular'
      ELSE 'more-than-and-regular' END AS outcome
  FROM (SELECT antigen, serum, count(*) AS n_all FROM parsed GROUP BY 1, 2) s
  LEFT JOIN (SELECT * FROM agg) a USING (antigen, serum) LEFT JOIN picks p USING (antigen, serum)),
cells AS (
  SELECT antigen, serum, n_all, outcome,
    CASE WHEN outcome IN ('less-than-only', 'max-less-than-bigger-than-max-regular', 'less-than-and-regular') THEN 'lt'
      WHEN outcome = 'regular-only' THEN 'num'
      WHEN outcome IN ('min-more-than-less-than-min-regular', 'more-than-and-regular') THEN 'gt' END AS kind,
    CASE outcome WHEN 'less-than-only' THEN min_lt WHEN 'regular-only' THEN CAST(floor(power(2.0, mean_log) * 10 + 0.5) AS BIGINT)
      WHEN 'max-less-than-bigger-than-max-regular' THEN above WHEN 'less-than-and-regular' THEN max_num * 2
      WHEN 'min-more-than-less-than-min-regular' THEN below WHEN 'more-than-and-regular' THEN min_num // 2 END AS value, max_gt
  FROM outcomes),
final AS (
  SELECT antigen, serum, n_all, outcome, kind, value,
    CASE WHEN outcome = 'more-than-only-to-dont-care' THEN 'gt' ELSE kind END AS basis_kind,
    CASE WHEN outcome = 'more-than-only-to-dont-care' THEN max_gt ELSE value END AS basis_value
  FROM cells),
bases AS (
  SELECT serum, round(greatest(0.0, coalesce(max(log2(basis_value / 10.0) + CASE basis_kind WHEN 'gt' THEN 1 ELSE 0 END), 0.0)), 9) AS basis
  FROM final GROUP BY 1)"""
)


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return titres.merge_cells(titres.parsed(standins.readings(spark, sf_dir)), ["antigen", "serum"])


@query(f"WITH {READINGS} SELECT kind, value, count(*) AS n FROM parsed GROUP BY 1, 2")
def titre_parse(spark, sf_dir):
    return titres.parsed(standins.readings(spark, sf_dir)).groupBy("kind", "value").agg(F.count("*").alias("n"))


@query(f"WITH {CELLS} SELECT * FROM final")
def cell_merge(spark, sf_dir):
    return _cells(spark, sf_dir)


@query(f"WITH {CELLS} SELECT outcome, count(*) AS n_cells, count(value) AS n_titres FROM final GROUP BY 1")
def merge_outcomes(spark, sf_dir):
    return titres.outcome_counts(_cells(spark, sf_dir))


@query(f"WITH {CELLS} SELECT * FROM bases")
def column_basis(spark, sf_dir):
    return titres.column_basis(_cells(spark, sf_dir), "serum")


@query(
    f"""WITH {CELLS} SELECT b.serum, CASE WHEN b.serum % 5 = 1 THEN 2.5 ELSE greatest(CASE WHEN b.serum % 3 = 0 THEN 6.5 ELSE b.basis END, 7.0) END AS basis FROM bases b"""
)
def column_basis_forced(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    sera = cells.select("serum").distinct()
    forced = sera.where("serum % 3 = 0").withColumn("forced_basis", F.lit(6.5))
    fixed = sera.where("serum % 5 = 1").withColumn("fixed_basis", F.lit(2.5))
    return titres.column_basis(cells, "serum", minimum=7.0, forced=forced, fixed=fixed)


@query(f"WITH {CELLS} SELECT antigen, count(*) FILTER (WHERE kind = 'num') AS n_regular FROM final GROUP BY 1 HAVING n_regular < 3")
def disconnected_points(spark, sf_dir):
    return titres.disconnected(_cells(spark, sf_dir), "antigen", 3)


@query(
    f"""WITH {READINGS} SELECT antigen, serum, count(*) AS n_readings, count(*) FILTER (WHERE kind = 'num') AS n_num,
    count(*) FILTER (WHERE kind = 'lt') AS n_lt, count(*) FILTER (WHERE kind = 'gt') AS n_gt FROM parsed GROUP BY 1, 2 HAVING n_readings > 1"""
)
def repeat_readings(spark, sf_dir):
    return titres.repeat_readings(titres.parsed(standins.readings(spark, sf_dir)), ["antigen", "serum"])


DISTANCES = (
    CELLS
    + """,
targets AS (
  SELECT antigen, serum, kind, round(greatest(0.0, basis - log2(value / 10.0)), 9) AS target,
    abs(antigen % 17 - serum % 5) * 0.5 AS distance
  FROM final JOIN bases USING (serum) WHERE kind IN ('num', 'lt'))"""
)


def _distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _cells(spark, sf_dir)
    found = titres.target_distances(cells, titres.column_basis(cells, "serum"), "serum")
    return found.withColumn("distance", F.abs(F.col("antigen") % 17 - F.col("serum") % 5) * 0.5)


@query(f"WITH {DISTANCES} SELECT antigen, serum, kind, target FROM targets")
def target_distances(spark, sf_dir):
    return _distances(spark, sf_dir).select("antigen", "serum", "kind", "target")


STRESS = """round(sum(CASE kind WHEN 'lt' THEN (target - distance + 1) * (target - distance + 1) / (1 + exp(-10 * (target - distance + 1)))
  ELSE (distance - target) * (distance - target) END), 6) AS stress, count(*) AS n_terms"""


@query(f"WITH {DISTANCES} SELECT {STRESS} FROM targets")
def stress_value(spark, sf_dir):
    return titres.stress(_distances(spark, sf_dir))


@query(f"WITH {DISTANCES} SELECT antigen, {STRESS} FROM targets GROUP BY 1")
def point_stress(spark, sf_dir):
    return titres.stress(_distances(spark, sf_dir), "antigen")


@query(f"WITH {DISTANCES} SELECT max(target) + 1 AS largest FROM targets")
def max_table_distance(spark, sf_dir):
    return _distances(spark, sf_dir).agg((F.max("target") + 1).alias("largest"))

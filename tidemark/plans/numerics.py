"""Numerical queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import numerics, titres
from tidemark.sources import standins

from .registry import query
from .titres import CELLS

CLOCK = """
points AS (
  SELECT o_orderkey AS id, o_orderpriority AS grp, (CAST(o_orderdate AS DATE) - DATE '1995-01-01') / 365.25 AS x,
    (CAST(o_orderdate AS DATE) - DATE '1995-01-01') / 365.25 * 0.004 + o_custkey % 101 * 0.0001 + CASE WHEN o_orderkey % 211 = 0 THEN 0.2 ELSE 0 END AS y FROM orders),
slopes AS (SELECT a.grp, quantile_cont((b.y - a.y) / (b.x - a.x), 0.5) AS slope FROM points a JOIN points b ON a.grp = b.grp AND a.id < b.id AND a.x <> b.x GROUP BY 1),
lines AS (SELECT p.grp, slope, quantile_cont(y - slope * x, 0.5) AS intercept FROM points p JOIN slopes s USING (grp) GROUP BY 1, 2),
fits AS (SELECT l.grp, l.slope, l.intercept, 1.4826 * quantile_cont(abs(y - l.slope * x - l.intercept), 0.5) AS scale FROM points p JOIN lines l USING (grp) GROUP BY 1, 2, 3)"""


def _clock(spark, sf_dir):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1995-01-01").cast("date"))
    rows = standins.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("grp"), (days / 365.25).alias("x"), "o_custkey")
    y = F.col("x") * 0.004 + F.col("o_custkey") % 101 * 0.0001 + F.when(F.col("id") % 211 == 0, 0.2).otherwise(0.0)
    return rows.withColumn("y", y).drop("o_custkey")


def _fits(spark, sf_dir):
    return numerics.theil_sen(_clock(spark, sf_dir), "grp", "x", "y", "id")


@query(f"WITH {CLOCK} SELECT grp, round(slope, 9) AS slope, round(intercept, 9) AS intercept, round(scale, 9) AS scale FROM fits")
def theil_sen(spark, sf_dir):
    fits = _fits(spark, sf_dir)
    return fits.select("grp", *[F.round(c, 9).alias(c) for c in ("slope", "intercept", "scale")])


@query(f"WITH {CLOCK} SELECT grp, id FROM points JOIN fits USING (grp) WHERE scale > 0 AND abs(round((y - slope * x - intercept) / scale, 6)) >= 4")
def mad_outliers(spark, sf_dir):
    return numerics.outliers(_clock(spark, sf_dir), _fits(spark, sf_dir), "grp", "x", "y", 4.0).select("grp", "id")


def _cells(spark, sf_dir):
    return titres.merge_cells(titres.parsed(standins.readings(spark, sf_dir)), ["antigen", "serum"])


@query(f"WITH {CELLS} SELECT antigen, serum, round(2 + basis - log2(value / 10.0), 6) AS radius FROM final JOIN bases USING (serum) WHERE kind = 'num'")
def circle_radius(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    return numerics.theoretical_radius(cells, titres.column_basis(cells, "serum"), "serum", 2.0).select("antigen", "serum", "radius")


@query(
    f"""WITH {CELLS}, points AS (SELECT serum, (antigen * 7 % 40) / 4.0 AS distance, log2(value / 10.0) >= 4 AS protected FROM final WHERE kind = 'num'),
    radii AS (SELECT serum, distance, lead(distance) OVER (PARTITION BY serum ORDER BY distance) AS following, row_number() OVER (PARTITION BY serum ORDER BY distance) AS r FROM (SELECT DISTINCT serum, distance FROM points)),
    candidates AS (SELECT serum, (distance + following) / 2 AS radius FROM radii WHERE following IS NOT NULL UNION ALL SELECT serum, distance FROM radii WHERE r = 1),
    wrong AS (SELECT c.serum, c.radius, count(*) FILTER (WHERE (NOT protected AND distance <= radius) OR (protected AND distance > radius)) AS n FROM candidates c JOIN points p USING (serum) GROUP BY 1, 2)
    SELECT serum, round(avg(radius), 6) AS radius, min(n) AS n_wrong FROM (SELECT *, min(n) OVER (PARTITION BY serum) AS least FROM wrong) WHERE n = least GROUP BY 1"""
)
def empirical_radius(spark, sf_dir):
    points = _cells(spark, sf_dir).where("kind = 'num'").select("serum", (F.col("antigen") * 7 % 40 / 4.0).alias("distance"), (F.log2(F.col("value") / 10.0) >= 4).alias("protected"))
    return numerics.empirical_radius(points, "serum")


@query(
    f"""WITH {CELLS}, h AS (SELECT serum, max(log2(value / 10.0)) AS homologous_log FROM final WHERE kind = 'num' GROUP BY 1),
    s AS (SELECT serum, kind, homologous_log - 2 AS lim, log2(value / 10.0) + CASE kind WHEN 'lt' THEN -1 WHEN 'gt' THEN 1 ELSE 0 END AS shown FROM final JOIN h USING (serum))
    SELECT serum, count(*) FILTER (WHERE kind IS NOT NULL AND shown >= lim) AS n_within, count(*) FILTER (WHERE kind IS NOT NULL AND shown < lim) AS n_outside,
    count(*) FILTER (WHERE kind IS NULL) AS n_unknown FROM s WHERE lim > 0 GROUP BY 1"""
)
def coverage(spark, sf_dir):
    cells = _cells(spark, sf_dir)
    homologous = cells.where("kind = 'num'").groupBy("serum").agg(F.max(F.log2(F.col("value") / 10.0)).alias("homologous_log"))
    return numerics.coverage(cells, homologous, "serum", 2.0)


@query(
    """WITH points AS (SELECT CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
    corners AS (SELECT i, unnest(range(CAST(ceil((y - 0.2) / 0.05) AS BIGINT), CAST(floor(y / 0.05) AS BIGINT) + 1)) AS j FROM (
      SELECT y, unnest(range(CAST(ceil((x - 0.2) / 0.05) AS BIGINT), CAST(floor(x / 0.05) AS BIGINT) + 1)) AS i FROM points)),
    counted AS (SELECT i, j, count(*) AS n FROM corners GROUP BY 1, 2)
    SELECT round(i * 0.05, 6) AS x, round(j * 0.05, 6) AS y, n AS n_points FROM counted ORDER BY n DESC, i, j LIMIT 1"""
)
def frame_search(spark, sf_dir):
    points = standins.table(spark, sf_dir, "embeddings").select(F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return numerics.frame(points, 0.2, 0.2, 0.05)


def _problem(spark, sf_dir) -> numerics.Problem:
    """A small map: distances between nations' and suppliers' invented places."""
    rows = standins.table(spark, sf_dir, "nation").orderBy("n_nationkey").limit(25).select("n_nationkey").collect()
    antigens = np.array([r[0] for r in rows])
    sera = np.arange(10)
    a, s = np.meshgrid(np.arange(len(antigens)), sera, indexing="ij")
    places = np.stack([antigens % 5, antigens // 5], 1), np.stack([sera % 4 * 1.3, sera // 4 * 1.7], 1)
    distance = np.sqrt(((places[0][a.ravel()] - places[1][s.ravel()]) ** 2).sum(1))
    less = (a.ravel() + s.ravel()) % 9 == 0
    return numerics.Problem(a.ravel(), s.ravel(), distance, less, len(antigens), len(sera))


@query()
def map_relax(spark, sf_dir):
    best = numerics.map_relax(spark, _problem(spark, sf_dir), starts=16, keep=3)
    return best.select("start", F.round("stress", 3).alias("stress"), F.size("layout").alias("n_coordinates"))


@query()
def grid_test(spark, sf_dir):
    problem = _problem(spark, sf_dir)
    stress, layout = min((numerics.relax(problem, k) for k in range(4)), key=lambda r: r[0])
    return numerics.grid_test(numerics.map_terms(spark, problem, layout)).select("point", "state")

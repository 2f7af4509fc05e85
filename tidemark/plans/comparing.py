"""Queries that compare."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import comparing
from tidemark.sources import standins

from .registry import query

LABELS = "labels2 AS (SELECT vec_id, label AS a, CASE WHEN vec_id % 6 = 0 THEN (label + 1) % 5 ELSE label END AS b FROM embeddings)"


@query(
    f"""WITH {LABELS}, c AS (SELECT a, b, count(*) AS n FROM labels2 GROUP BY 1, 2), t AS (SELECT sum(n) AS total, sum(n * (n - 1) / 2) AS inboth FROM c),
    r AS (SELECT sum(n * (n - 1) / 2) AS x FROM (SELECT a, sum(n) AS n FROM c GROUP BY 1)), k AS (SELECT sum(n * (n - 1) / 2) AS y FROM (SELECT b, sum(n) AS n FROM c GROUP BY 1))
    SELECT round((inboth - x * y / (total * (total - 1) / 2)) / ((x + y) / 2 - x * y / (total * (total - 1) / 2)), 9) AS ari FROM t, r, k"""
)
def adjusted_rand(spark, sf_dir):
    rows = standins.table(spark, sf_dir, "embeddings").select(F.col("label").alias("a"), F.when(F.col("vec_id") % 6 == 0, (F.col("label") + 1) % 5).otherwise(F.col("label")).alias("b"))
    return comparing.adjusted_rand(rows, "a", "b")


@query(
    """WITH l AS (SELECT l_partkey AS key FROM lineitem WHERE l_quantity = 7 GROUP BY 1 HAVING count(*) = 1), r AS (SELECT l_partkey AS key FROM lineitem WHERE l_quantity = 9 GROUP BY 1 HAVING count(*) = 1)
    SELECT count(*) FILTER (WHERE l.key IS NOT NULL AND r.key IS NOT NULL) AS n_common, count(*) AS n_union,
    round(count(*) FILTER (WHERE l.key IS NOT NULL AND r.key IS NOT NULL) * 1.0 / count(*), 9) AS jaccard FROM l FULL JOIN r ON l.key = r.key"""
)
def jaccard_sides(spark, sf_dir):
    lines = standins.table(spark, sf_dir, "lineitem")
    side = lambda q: lines.where(F.col("l_quantity") == q).select(F.col("l_partkey").alias("key"))
    return comparing.jaccard_sides(side(7), side(9), "key")


POINTS = """
points AS (
  SELECT vec_id, label, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y,
    0.8 * CAST(embedding[1] AS DOUBLE) + 0.6 * CAST(embedding[2] AS DOUBLE) + 0.01 * (vec_id % 7) AS u,
    -0.6 * CAST(embedding[1] AS DOUBLE) + 0.8 * CAST(embedding[2] AS DOUBLE) - 0.02 * (vec_id % 3) AS v FROM embeddings)"""


def _points(spark, sf_dir):
    x, y = F.col("embedding")[0].cast("double"), F.col("embedding")[1].cast("double")
    rows = standins.table(spark, sf_dir, "embeddings").select("vec_id", "label", x.alias("x"), y.alias("y"))
    u = 0.8 * F.col("x") + 0.6 * F.col("y") + 0.01 * (F.col("vec_id") % 7)
    return rows.withColumn("u", u).withColumn("v", -0.6 * F.col("x") + 0.8 * F.col("y") - 0.02 * (F.col("vec_id") % 3))


FIT = """sums AS (SELECT {by} count(*) AS n, covar_pop(x, u) AS xu, covar_pop(x, v) AS xv, covar_pop(y, u) AS yu, covar_pop(y, v) AS yv, var_pop(x) + var_pop(y) + var_pop(u) + var_pop(v) AS spread FROM points {group}),
fit AS (SELECT *, sqrt((xu + yv) * (xu + yv) + (yu - xv) * (yu - xv)) AS p, sqrt((xu - yv) * (xu - yv) + (yu + xv) * (yu + xv)) AS m FROM sums)
SELECT {by} n, m > p + 1e-12 AS reflected, round(degrees(CASE WHEN m > p + 1e-12 THEN atan2(yu + xv, xu - yv) ELSE atan2(yu - xv, xu + yv) END), 6) AS degrees,
  round(sqrt(greatest(0.0, spread - 2 * greatest(p, m))), 6) AS rmsd FROM fit"""


@query(f"WITH {POINTS}, {FIT.format(by='', group='')}")
def procrustes2d(spark, sf_dir):
    return comparing.procrustes(_points(spark, sf_dir))


@query(f"WITH {POINTS}, {FIT.format(by='label,', group='GROUP BY label')}")
def procrustes_by_group(spark, sf_dir):
    return comparing.procrustes(_points(spark, sf_dir), "label")


@query(
    f"""WITH {POINTS}, sums AS (SELECT count(*) AS n, covar_pop(x, u) AS xu, covar_pop(x, v) AS xv, covar_pop(y, u) AS yu, covar_pop(y, v) AS yv, var_pop(x) + var_pop(y) + var_pop(u) + var_pop(v) AS spread FROM points),
    fit AS (SELECT *, sqrt((xu + yv) * (xu + yv) + (yu - xv) * (yu - xv)) AS p, sqrt((xu - yv) * (xu - yv) + (yu + xv) * (yu + xv)) AS m FROM sums),
    r AS (SELECT *, abs(sqrt(greatest(0.0, spread - 2 * p)) - sqrt(greatest(0.0, spread - 2 * m))) AS gain FROM fit)
    SELECT n, CASE WHEN n < 10 THEN 'too few points' WHEN gain < 0.01 THEN 'reflection unclear' ELSE 'oriented' END AS state, round(gain, 6) AS margin,
    CASE WHEN n >= 10 AND gain >= 0.01 THEN m > p + 1e-12 END AS reflected, CASE WHEN n >= 10 AND gain >= 0.01 THEN round(degrees(CASE WHEN m > p + 1e-12 THEN atan2(yu + xv, xu - yv) ELSE atan2(yu - xv, xu + yv) END), 6) END AS degrees,
    CASE WHEN n >= 10 AND gain >= 0.01 THEN round(sqrt(greatest(0.0, spread - 2 * greatest(p, m))), 6) END AS rmsd FROM r"""
)
def map_oriented(spark, sf_dir):
    return comparing.oriented(_points(spark, sf_dir), 10, 0.01)


BULK = """
whole AS (SELECT vec_id, x, y, CASE WHEN vec_id % 11 = 0 THEN u + 4 ELSE u END AS u, CASE WHEN vec_id % 11 = 0 THEN v - 2 ELSE v END AS v FROM points),
sums AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(u) AS mu, avg(v) AS mv, covar_pop(x, u) AS xu, covar_pop(x, v) AS xv, covar_pop(y, u) AS yu, covar_pop(y, v) AS yv,
  var_pop(x) + var_pop(y) + var_pop(u) + var_pop(v) AS spread FROM whole),
sizes AS (SELECT *, sqrt((xu + yv) * (xu + yv) + (yu - xv) * (yu - xv)) AS p, sqrt((xu - yv) * (xu - yv) + (yu + xv) * (yu + xv)) AS m FROM sums),
turn AS (SELECT *, CASE WHEN m > p + 1e-12 THEN -1 ELSE 1 END AS flip, CASE WHEN m > p + 1e-12 THEN (xu - yv) / m ELSE (xu + yv) / p END AS c, CASE WHEN m > p + 1e-12 THEN (yu + xv) / m ELSE (yu - xv) / p END AS s FROM sizes),
near AS (SELECT x, y, u, v FROM (SELECT w.*, (w.u - mu) * c - (w.v - mv) * flip * s + mx - w.x AS dx, (w.u - mu) * s + (w.v - mv) * flip * c + my - w.y AS dy FROM whole w, turn) WHERE sqrt(dx * dx + dy * dy) <= 1.0),
again AS (SELECT count(*) AS n_bulk, covar_pop(x, u) AS xu, covar_pop(x, v) AS xv, covar_pop(y, u) AS yu, covar_pop(y, v) AS yv, var_pop(x) + var_pop(y) + var_pop(u) + var_pop(v) AS spread FROM near),
chosen AS (SELECT t.n, a.n_bulk, a.n_bulk >= greatest(3, t.n // 2) AS uses_bulk,
  CASE WHEN a.n_bulk >= greatest(3, t.n // 2) THEN a.xu ELSE t.xu END AS xu, CASE WHEN a.n_bulk >= greatest(3, t.n // 2) THEN a.xv ELSE t.xv END AS xv,
  CASE WHEN a.n_bulk >= greatest(3, t.n // 2) THEN a.yu ELSE t.yu END AS yu, CASE WHEN a.n_bulk >= greatest(3, t.n // 2) THEN a.yv ELSE t.yv END AS yv,
  CASE WHEN a.n_bulk >= greatest(3, t.n // 2) THEN a.spread ELSE t.spread END AS spread FROM turn t, again a),
fit AS (SELECT *, sqrt((xu + yv) * (xu + yv) + (yu - xv) * (yu - xv)) AS p, sqrt((xu - yv) * (xu - yv) + (yu + xv) * (yu + xv)) AS m FROM chosen)"""


@query(
    f"""WITH {POINTS}, {BULK} SELECT n, n_bulk, uses_bulk, m > p + 1e-12 AS reflected, round(degrees(CASE WHEN m > p + 1e-12 THEN atan2(yu + xv, xu - yv) ELSE atan2(yu - xv, xu + yv) END), 6) AS degrees,
    round(sqrt(greatest(0.0, spread - 2 * greatest(p, m))), 6) AS rmsd FROM fit"""
)
def bulk_refit(spark, sf_dir):
    far = F.col("vec_id") % 11 == 0
    points = _points(spark, sf_dir).withColumn("u", F.when(far, F.col("u") + 4).otherwise(F.col("u"))).withColumn("v", F.when(far, F.col("v") - 2).otherwise(F.col("v")))
    return comparing.bulk(points)


@query(f"WITH {POINTS}, c AS (SELECT label, count(*) AS n, avg(x) AS x, avg(y) AS y, avg(u) AS u, avg(v) AS v FROM points GROUP BY 1) SELECT label, n, round(sqrt((x - u) * (x - u) + (y - v) * (y - v)), 6) AS shift FROM c")
def centroid_shift(spark, sf_dir):
    return comparing.centroid_shift(_points(spark, sf_dir), "label")


DIFF = """
old AS (SELECT o_orderkey AS id, o_orderstatus AS part, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS v FROM orders WHERE o_orderkey % 13 <> 0),
new AS (SELECT o_orderkey AS id, o_orderstatus AS part, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 17 = 0 THEN 'edited' ELSE o_orderpriority END AS v FROM orders WHERE o_orderkey % 19 <> 0)"""


@query(
    f"""WITH {DIFF} SELECT coalesce(a.id, b.id) AS id, coalesce(a.part, b.part) AS part, a.v AS was, b.v AS now,
    CASE WHEN a.id IS NULL THEN 'added' WHEN b.id IS NULL THEN 'removed' ELSE 'changed' END AS change
    FROM old a FULL JOIN new b ON a.id = b.id AND a.part = b.part WHERE a.id IS NULL OR b.id IS NULL OR a.v IS DISTINCT FROM b.v"""
)
def cell_diff(spark, sf_dir):
    orders, key = standins.table(spark, sf_dir, "orders"), F.col("o_orderkey")
    kept = F.when(key % 10 != 0, F.col("o_orderpriority"))
    edited = F.when(key % 10 == 0, F.lit(None)).when(key % 17 == 0, "edited").otherwise(F.col("o_orderpriority"))
    side = lambda n, v: orders.where(key % n != 0).select(key.alias("id"), F.col("o_orderstatus").alias("part"), v.alias("v"))
    return comparing.cell_diff(side(13, kept), side(19, edited), ["id", "part"], "v")


@query("WITH c AS (SELECT n_regionkey AS region, c_mktsegment AS entry, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2) SELECT region, entry, round(n * 1.0 / sum(n) OVER (PARTITION BY region), 9) AS share FROM c")
def geo_shares(spark, sf_dir):
    joined = standins.table(spark, sf_dir, "customer").join(standins.table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    counted = joined.groupBy(F.col("n_regionkey").alias("region"), F.col("c_mktsegment").alias("entry")).agg(F.count("*").alias("n"))
    return comparing.share_of_maximum(counted, "region", "entry", "n")


@query("SELECT l_returnflag AS flag, round(quantile_cont(l_extendedprice, 0.5), 6) AS median, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95, round(max(l_extendedprice), 6) AS largest FROM lineitem GROUP BY 1")
def percentiles(spark, sf_dir):
    rows = standins.table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"), "l_extendedprice")
    return comparing.percentiles(rows, "flag", "l_extendedprice")

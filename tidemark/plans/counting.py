"""Queries that count."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import counting, serology
from tidemark.sources import standins

from .registry import query
from .serology import PREPARATIONS, TABLES, USES


def _uses(spark, sf_dir):
    return serology.serum_uses(standins.serum_rows(spark, sf_dir), standins.lab_tables(spark, sf_dir)).withColumn("year", F.year("date"))


def _preparations(spark, sf_dir):
    return serology.preparations(standins.antigens(spark, sf_dir), standins.lab_tables(spark, sf_dir))


@query(
    f"""WITH {PREPARATIONS} SELECT CASE WHEN grouping(subtype) = 1 THEN 'all' ELSE subtype END AS subtype,
    CASE WHEN grouping(first_lab) = 1 THEN 'all' ELSE first_lab END AS first_lab,
    CASE WHEN grouping(year) = 1 THEN 'all' ELSE CAST(year AS VARCHAR) END AS year, count(*) AS n
    FROM (SELECT *, year(first_date) AS year FROM preparations) GROUP BY CUBE (subtype, first_lab, year)"""
)
def stat_cube_antigens(spark, sf_dir):
    rows = _preparations(spark, sf_dir).withColumn("year", F.year("first_date"))
    return counting.cube(rows, ["subtype", "first_lab", "year"], F.count("*").alias("n"))


@query(
    f"""WITH {USES} SELECT CASE WHEN grouping(lab) = 1 THEN 'all' ELSE lab END AS lab,
    CASE WHEN grouping(year) = 1 THEN 'all' ELSE CAST(year AS VARCHAR) END AS year, count(DISTINCT serum) AS n_sera, count(*) AS n_uses
    FROM (SELECT *, year(date) AS year FROM uses) GROUP BY CUBE (lab, year)"""
)
def stat_cube_sera(spark, sf_dir):
    measures = (F.count_distinct("serum").alias("n_sera"), F.count("*").alias("n_uses"))
    return counting.cube(_uses(spark, sf_dir), ["lab", "year"], *measures)


@query(f"WITH {USES} SELECT lab, year(date) AS year, count(*) AS n_new FROM uses WHERE is_new GROUP BY 1, 2")
def stat_first_use(spark, sf_dir):
    return counting.first_uses(_uses(spark, sf_dir), "year")


@query(f"WITH {USES} SELECT lab, year(date) AS year, count(DISTINCT (subtype, serum)) AS n_used FROM uses GROUP BY 1, 2")
def stat_distinct_used(spark, sf_dir):
    return counting.distinct_used(_uses(spark, sf_dir), "lab", "year")


CHANGES = (
    TABLES
    + """,
before AS (SELECT lab, strftime(date, '%Y-%m') AS month, count(*) AS was FROM tables WHERE table_id % 7 <> 0 GROUP BY 1, 2),
after AS (SELECT lab, strftime(date, '%Y-%m') AS month, count(*) AS now FROM tables WHERE table_id % 11 <> 0 GROUP BY 1, 2),
changed AS (SELECT coalesce(b.lab, a.lab) AS lab, coalesce(b.month, a.month) AS month, coalesce(was, 0) AS was, coalesce(now, 0) AS now,
  coalesce(now, 0) - coalesce(was, 0) AS change FROM before b FULL JOIN after a ON b.lab = a.lab AND b.month = a.month WHERE coalesce(was, 0) <> coalesce(now, 0))"""
)


def _changes(spark, sf_dir):
    tables = standins.lab_tables(spark, sf_dir).withColumn("month", F.date_format("date", "yyyy-MM"))
    count = lambda rows: rows.groupBy("lab", "month").agg(F.count("*").alias("n"))
    return counting.changes(count(tables.where("table_id % 7 <> 0")), count(tables.where("table_id % 11 <> 0")), ["lab", "month"], "n")


@query(f"WITH {CHANGES} SELECT * FROM changed")
def stat_changes(spark, sf_dir):
    return _changes(spark, sf_dir)


@query(f"WITH {CHANGES} SELECT * FROM changed ORDER BY abs(change) DESC, lab, month LIMIT 5")
def largest_changes(spark, sf_dir):
    return counting.largest(_changes(spark, sf_dir), 5)


VIRUSES = """
placed AS (
  SELECT c_custkey % 400 AS virus, n.n_name AS location, r.r_name AS continent, CASE WHEN c_acctbal < 1000 THEN NULL ELSE c_mktsegment END AS style,
    CASE c_custkey % 3 WHEN 0 THEN 'egg' WHEN 1 THEN 'cell' ELSE 'original' END AS passage_class
  FROM customer JOIN nation n ON c_nationkey = n_nationkey JOIN region r ON n_regionkey = r_regionkey),
counted AS (
  SELECT virus, count(*) AS n, count(style) AS n_coloured, count(DISTINCT style) AS n_styles, max(style) AS one,
    count(DISTINCT style) FILTER (WHERE passage_class IN ('cell', 'original')) AS n_preferred,
    max(style) FILTER (WHERE passage_class IN ('cell', 'original')) AS preferred FROM placed GROUP BY 1),
merged AS (
  SELECT virus, CASE WHEN how IN ('single', 'agree', 'coloured over uncoloured') THEN one WHEN how = 'cell chosen' THEN preferred END AS style, how FROM (
    SELECT *, CASE WHEN n = 1 THEN 'single' WHEN n_styles = 0 THEN 'uncoloured' WHEN n_styles = 1 AND n_coloured = n THEN 'agree'
      WHEN n_styles = 1 THEN 'coloured over uncoloured' WHEN n_preferred = 1 THEN 'cell chosen' ELSE 'disagree' END AS how FROM counted))"""


def _placed(spark, sf_dir):
    read = lambda name: standins.table(spark, sf_dir, name)
    nations = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    classes = F.when(F.col("c_custkey") % 3 == 0, "egg").when(F.col("c_custkey") % 3 == 1, "cell").otherwise("original")
    joined = read("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        (F.col("c_custkey") % 400).alias("virus"),
        F.col("n_name").alias("location"),
        F.col("r_name").alias("continent"),
        F.when(F.col("c_acctbal") >= 1000, F.col("c_mktsegment")).alias("style"),
        classes.alias("passage_class"),
    )


@query(f"WITH {VIRUSES} SELECT * FROM merged")
def geo_virus_merge(spark, sf_dir):
    return counting.merged_style(_placed(spark, sf_dir), ["virus"])


@query(f"WITH {VIRUSES} SELECT continent, location, coalesce(style, 'not coloured') AS style, count(*) AS n_dots FROM placed GROUP BY 1, 2, 3")
def geo_counts(spark, sf_dir):
    dots = _placed(spark, sf_dir).withColumn("style", F.coalesce("style", F.lit("not coloured")))
    return dots.groupBy("continent", "location", "style").agg(F.count("*").alias("n_dots"))


PERIODS = ["1998-01", "1998-02", "1998-03", "1998-04"]


@query(
    f"""WITH {TABLES}, dots AS (SELECT lab, strftime(date, '%Y-%m') AS month FROM tables)
    SELECT lab, {", ".join(f"count(*) FILTER (WHERE month = '{p}') AS m_{p.replace('-', '_')}" for p in PERIODS)},
    count(*) FILTER (WHERE month IN ({", ".join(f"'{p}'" for p in PERIODS)})) AS total FROM dots GROUP BY 1"""
)
def legend_pivot(spark, sf_dir):
    dots = standins.lab_tables(spark, sf_dir).select("lab", F.date_format("date", "yyyy-MM").alias("month"))
    return counting.legend(dots, "lab", "month", PERIODS)


@query(
    f"""WITH {TABLES}, spine AS (SELECT CAST(m AS DATE) AS month FROM range(DATE '1995-11-01', DATE '1997-02-01', INTERVAL 1 MONTH) t(m)),
    counted AS (SELECT lab, CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n FROM tables GROUP BY 1, 2)
    SELECT g.lab, s.month, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT lab FROM tables) g CROSS JOIN spine s LEFT JOIN counted c ON c.lab = g.lab AND c.month = s.month"""
)
def month_spine(spark, sf_dir):
    rows = standins.lab_tables(spark, sf_dir).withColumn("month", F.trunc("date", "month"))
    return counting.by_month(rows, counting.months(spark, "1995-11-01", "1997-01-01"), rows, "lab")

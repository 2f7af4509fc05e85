"""Queries on tables, preparations and sera."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import order, serology
from tidemark.sources import standins

from .registry import query

TABLES = """
tables AS (
  SELECT o_orderkey AS table_id, substring(o_orderpriority, 1, 1) AS lab, o_orderstatus AS subtype, CAST(o_orderdate AS DATE) AS date,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey % 3 END AS date_suffix FROM orders),
antigens AS (
  SELECT l_orderkey AS table_id, l_partkey AS name, l_returnflag AS passage, CASE WHEN l_linenumber = 7 THEN 'DISTINCT' ELSE '' END AS annotations FROM lineitem),
sera AS (SELECT DISTINCT l_orderkey AS table_id, l_suppkey AS serum FROM lineitem WHERE l_quantity < 50)"""

PREPARATIONS = (
    TABLES
    + """,
ordered AS (
  SELECT a.name, a.passage, t.*, row_number() OVER (PARTITION BY subtype, name, passage ORDER BY date, coalesce(date_suffix, 0), lab, t.table_id) AS rn
  FROM antigens a JOIN tables t USING (table_id) WHERE annotations <> 'DISTINCT'),
preparations AS (
  SELECT subtype, name, passage, min(date) AS first_date, max(lab) FILTER (WHERE rn = 1) AS first_lab,
    max(table_id) FILTER (WHERE rn = 1) AS first_table, count(DISTINCT table_id) AS n_tables FROM ordered GROUP BY 1, 2, 3)"""
)

USES = (
    TABLES
    + """,
uses AS (
  SELECT subtype, serum, table_id, lab, date, date_suffix,
    row_number() OVER (PARTITION BY subtype, serum ORDER BY date, coalesce(date_suffix, 1), lab, table_id) = 1 AS is_new
  FROM sera JOIN tables USING (table_id))"""
)


def _tables(spark, sf_dir):
    return standins.lab_tables(spark, sf_dir)


@query(f"WITH {PREPARATIONS} SELECT * FROM preparations")
def preparations(spark, sf_dir):
    return serology.preparations(standins.antigens(spark, sf_dir), _tables(spark, sf_dir))


@query(f"WITH {USES} SELECT * FROM uses")
def serum_uses(spark, sf_dir):
    return serology.serum_uses(standins.serum_rows(spark, sf_dir), _tables(spark, sf_dir))


@query(f"WITH {TABLES} SELECT DISTINCT subtype, name FROM antigens JOIN tables USING (table_id) WHERE date >= DATE '2000-06-01'")
def strains_since(spark, sf_dir):
    return serology.strains_since(standins.antigens(spark, sf_dir), _tables(spark, sf_dir), "2000-06-01")


@query(f"WITH {TABLES} SELECT * FROM tables WHERE lab = '2' AND date >= DATE '1998-10-01' AND date < DATE '1998-11-01'")
def centre_month(spark, sf_dir):
    return serology.centre_month(_tables(spark, sf_dir), "2", "1998-10-01")


@query(f"WITH {TABLES} SELECT table_id, name, passage, count(*) AS n_rows FROM antigens GROUP BY 1, 2, 3 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return serology.duplicates(standins.antigens(spark, sf_dir), ["table_id", "name", "passage"])


@query(f"WITH {TABLES} SELECT subtype, year(date) AS year, count(*) AS n_tables, count(DISTINCT date) AS n_days FROM tables GROUP BY 1, 2")
def partition_sizes(spark, sf_dir):
    return serology.partition_sizes(_tables(spark, sf_dir), "subtype")


@query(f"WITH {TABLES} SELECT serum, min(date) AS first_date, max(date) AS last_date, count(*) AS n_tables FROM sera JOIN tables USING (table_id) GROUP BY 1")
def titration_dates(spark, sf_dir):
    return serology.titration_dates(standins.serum_rows(spark, sf_dir), _tables(spark, sf_dir))


@query(
    f"""WITH {TABLES} SELECT lab, table_id, date FROM (
      SELECT lab, table_id, date, row_number() OVER (PARTITION BY lab ORDER BY date DESC, coalesce(date_suffix, 0) DESC, table_id DESC) AS rn FROM tables) WHERE rn = 1"""
)
def newest_table(spark, sf_dir):
    return serology.newest(_tables(spark, sf_dir), "lab")


KNOWN = """known AS (SELECT lab, date, table_id, CAST(row_number() OVER (PARTITION BY lab, date ORDER BY table_id) * 2 AS INTEGER) AS suffix FROM tables WHERE table_id % 4 = 0)"""


@query(
    f"""WITH {TABLES}, {KNOWN},
    taken AS (SELECT lab, date, list(suffix) AS used FROM known GROUP BY 1, 2),
    fresh AS (SELECT t.lab, t.date, t.table_id, row_number() OVER (PARTITION BY t.lab, t.date ORDER BY t.table_id) AS place
      FROM tables t WHERE t.table_id % 4 <> 0),
    numbers AS (SELECT f.lab, f.date, f.table_id, f.place, n.i AS suffix, row_number() OVER (PARTITION BY f.lab, f.date, f.table_id ORDER BY n.i) AS r
      FROM fresh f LEFT JOIN taken k USING (lab, date), range(1, 200) n(i) WHERE k.used IS NULL OR NOT list_contains(k.used, n.i))
    SELECT lab, date, table_id, suffix FROM known UNION ALL SELECT lab, date, table_id, CAST(suffix AS INTEGER) FROM numbers WHERE r = place"""
)
def suffix_assign(spark, sf_dir):
    from pyspark.sql import Window

    tables = _tables(spark, sf_dir).select("lab", "date", "table_id")
    place = F.row_number().over(Window.partitionBy("lab", "date").orderBy("table_id"))
    known = tables.where("table_id % 4 = 0").withColumn("suffix", (place * 2).cast("int"))
    return serology.suffixes(tables, "lab", known)


@query(
    f"""WITH {TABLES}, chosen AS (SELECT * FROM tables),
    published AS (SELECT table_id, row_number() OVER (ORDER BY table_id DESC) AS place FROM chosen WHERE table_id % 2 = 0)
    SELECT table_id, row_number() OVER (ORDER BY part, k1, k2, k3) AS place FROM (
      SELECT table_id, 0 AS part, place AS k1, 0 AS k2, 0 AS k3 FROM published
      UNION ALL SELECT table_id, 1, date - DATE '1970-01-01', coalesce(date_suffix, 0), table_id FROM chosen WHERE table_id % 2 = 1)"""
)
def append_order(spark, sf_dir):
    chosen = _tables(spark, sf_dir)
    published = order.numbered(chosen.where("table_id % 2 = 0"), [-F.col("table_id")])
    return serology.append_order(published, chosen)

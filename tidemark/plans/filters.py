"""Queries that filter by curated rules and check tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import filters
from tidemark.sources import standins

from .registry import query
from .trees import NODES, _nodes, _pairs


def _read(spark, sf_dir, name):
    return standins.table(spark, sf_dir, name)


@query(
    """SELECT l_orderkey AS id, l_linenumber AS line, CASE WHEN l_quantity = 50 THEN 'not-aligned' ELSE concat_ws(',', CASE WHEN l_returnflag <> 'N' THEN 'incomplete' END,
      CASE WHEN l_linenumber = 7 OR l_partkey % 9 = 0 THEN 'cds-failed' END, CASE WHEN l_linenumber % 4 = 3 THEN 'frameshift' END, CASE WHEN l_quantity > 40 THEN 'unknown-aa' END,
      CASE WHEN l_quantity < 5 THEN 'deleted-aa' END, CASE WHEN l_linenumber = 6 THEN 'aa-insertion' END, CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN 'premature-stop' END) END AS reasons FROM lineitem"""
)
def qc_reasons(spark, sf_dir):
    n, q = F.col("l_linenumber"), F.col("l_quantity")
    rows = _read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        n.alias("line"),
        F.when(q == 50, "lost").alias("error"),
        (F.col("l_returnflag") == "N").alias("covers_mature"),
        (n == 7).alias("cds_failed"),
        F.when(F.col("l_partkey") % 9 != 0, "M").alias("protein"),
        (n % 4 == 3).cast("int").alias("frameshifts"),
        q.alias("unknown_aa"),
        (50 - q).alias("deleted_aa"),
        (n == 6).cast("int").alias("inserted_aa"),
        ((F.col("l_linestatus") == "F") & (n == 1)).alias("premature_stop"),
    )
    return rows.select("id", "line", F.array_join(filters.qc_failures(40, 45), ",").alias("reasons"))


@query(
    """WITH r(line, priority, status, value) AS (VALUES (1, '1-urgent', 'O', 'a'), (2, '*', 'f', 'b'), (3, '2-HIGH', '*', 'c')),
    d AS (SELECT DISTINCT o_orderpriority AS priority, o_orderstatus AS status FROM orders),
    m AS (SELECT d.*, r.line, r.value, row_number() OVER (PARTITION BY d.priority, d.status ORDER BY r.line) AS k FROM d LEFT JOIN r ON (r.priority = '*' OR lower(r.priority) = lower(d.priority)) AND (r.status = '*' OR lower(r.status) = lower(d.status)))
    SELECT priority, status, line AS rule_line, value AS rule_value FROM m WHERE k = 1"""
)
def rules_by_scope(spark, sf_dir):
    rules = spark.createDataFrame([(1, "1-urgent", "O", "a"), (2, "*", "f", "b"), (3, "2-HIGH", "*", "c")], "rule_line int, rule_priority string, rule_status string, rule_value string")
    rows = _read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    return filters.first_in_scope(rows, rules, ["priority", "status"], ["priority", "status"])


@query(
    """WITH c AS (SELECT l_orderkey AS sheet, l_linenumber AS cell, l_returnflag AS text FROM lineitem), f AS (SELECT o_orderkey AS sheet, 1 AS cell, 'N' AS raw, 'fixed ' || o_orderstatus AS value FROM orders WHERE o_orderkey % 3 = 0
      UNION ALL SELECT o_orderkey, 99, '', 'new' FROM orders WHERE o_orderkey % 10 = 0)
    SELECT coalesce(c.sheet, f.sheet) AS sheet, coalesce(c.cell, f.cell) AS cell, CASE WHEN raw = coalesce(text, '') THEN value ELSE coalesce(text, '') END AS text, CASE WHEN raw IS NULL THEN '' WHEN raw = coalesce(text, '') THEN 'fixed' ELSE 'stale' END AS state
    FROM c FULL JOIN f ON c.sheet = f.sheet AND c.cell = f.cell"""
)
def cell_fixes(spark, sf_dir):
    cells = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("sheet"), F.col("l_linenumber").cast("int").alias("cell"), F.col("l_returnflag").alias("text"))
    orders, key = _read(spark, sf_dir, "orders"), F.col("o_orderkey")
    one = orders.where(key % 3 == 0).select(key.alias("sheet"), F.lit(1).alias("cell"), F.lit("N").alias("raw"), F.concat(F.lit("fixed "), "o_orderstatus").alias("value"))
    new = orders.where(key % 10 == 0).select(key.alias("sheet"), F.lit(99).alias("cell"), F.lit("").alias("raw"), F.lit("new").alias("value"))
    return filters.fixed_cells(cells, one.unionByName(new), ["sheet", "cell"])


@query(
    """WITH cells AS (SELECT l_partkey AS part, l_suppkey AS cell, max(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_quantity END) AS value FROM lineitem GROUP BY 1, 2),
    renames AS (SELECT p_partkey AS part, 20 + p_size % 20 AS min_titre, 0.25 * (p_partkey % 4) AS min_fraction FROM part WHERE p_partkey % 3 = 0)
    SELECT part, count(value) AS tested, count(*) FILTER (WHERE value >= min_titre) AS reacting, count(value) > 0 AND count(*) FILTER (WHERE value >= min_titre) >= min_fraction * count(value) AS stands
    FROM renames LEFT JOIN cells USING (part) GROUP BY part, min_titre, min_fraction"""
)
def rename_support(spark, sf_dir):
    cells = _read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("cell"), F.when(F.col("l_returnflag") == "R", 0).otherwise(F.col("l_quantity")).alias("value"))
    key = F.col("p_partkey")
    renames = _read(spark, sf_dir, "part").where(key % 3 == 0).select(key.alias("part"), (F.col("p_size") % 20 + 20).alias("min_titre"), (key % 4 * 0.25).alias("min_fraction"))
    return filters.rename_support(renames, cells, "part")


@query(
    """SELECT s_suppkey AS serum, CASE WHEN s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 THEN 'F-1' WHEN s_suppkey % 3 = 0 AND s_suppkey % 5 = 0 THEN 'F-2' ELSE CASE WHEN s_suppkey % 3 = 0 THEN 'No Lot ' || s_suppkey ELSE s_name END END AS lot,
    CASE WHEN s_suppkey % 3 = 0 AND s_suppkey % 2 = 0 THEN 1 WHEN s_suppkey % 3 = 0 AND s_suppkey % 5 = 0 THEN 2 END AS rule_line FROM supplier"""
)
def serum_lots(spark, sf_dir):
    key = F.col("s_suppkey")
    ferret = F.when(key % 2 == 0, "f1").when(key % 5 == 0, "f2").otherwise("f3")
    sera = _read(spark, sf_dir, "supplier").select(key.alias("serum"), F.lit("CDC").alias("lab"), F.when(key % 3 == 0, F.concat(F.lit("No Lot "), key.cast("string"))).otherwise(F.col("s_name")).alias("lot"), ferret.alias("ferret"))
    rules = spark.createDataFrame([(1, "cdc", "no lot.*", "f1", "F-1"), (2, "*", "no lot.*", "f2", "F-2"), (3, "OTHER", ".*", "f3", "x")], "rule_line int, rule_lab string, rule_pattern string, rule_ferret string, rule_value string")
    return filters.restored_lots(sera, rules)


@query(
    """WITH ids AS (SELECT o_orderkey AS key, substring(o_orderpriority, 1, 1) AS lab, CAST(o_orderdate AS DATE) AS date, CASE o_orderkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'A' || o_orderkey ELSE 'x' END AS id FROM orders)
    SELECT lab, CASE WHEN id = '' THEN 'missing' WHEN id LIKE 'A%' THEN 'ok' ELSE 'unexpected shape' END AS outcome, count(*) AS n FROM ids
    WHERE (lab = '1' AND date BETWEEN DATE '1995-01-01' AND DATE '2099-01-01') OR lab = '2' GROUP BY 1, 2"""
)
def id_shapes(spark, sf_dir):
    key = F.col("o_orderkey")
    text = F.when(key % 3 == 0, "").when(key % 3 == 1, F.concat(F.lit("A"), key.cast("string"))).otherwise("x")
    ids = _read(spark, sf_dir, "orders").select(key.alias("key"), F.substring("o_orderpriority", 1, 1).alias("lab"), F.lit("antigen").alias("field"), F.col("o_orderdate").cast("date").alias("date"), text.alias("id"))
    rules = [("1", "antigen", r"A\d+", "1995-01-01", "2099-01-01"), ("2", "antigen", r"A\d{1,3}", "1900-01-01", "2099-01-01"), ("2", "antigen", r"A\d{4,}", "1900-01-01", "2099-01-01"), ("*", "serum", ".*", "1900-01-01", "2099-01-01")]
    force = spark.createDataFrame(rules, "rule_lab string, rule_field string, rule_pattern string, date_from string, date_to string")
    force = force.withColumn("date_from", F.col("date_from").cast("date")).withColumn("date_to", F.col("date_to").cast("date"))
    return filters.id_outcomes(ids, force).groupBy("lab", "outcome").agg(F.count("*").alias("n"))


@query(
    """SELECT p_partkey AS point, 1 AS rule_line FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT p_partkey, 2 FROM part WHERE contains(p_name, 'bolt') UNION ALL SELECT p_partkey, 3 FROM part WHERE contains(p_name || ' ' || p_brand, 'Brand#2')"""
)
def points_removed(spark, sf_dir):
    key = F.col("p_partkey")
    points = _read(spark, sf_dir, "part").select(key.alias("point"), F.lit("antigens").alias("what"), F.when(key % 3 == 0, "egg").otherwise("cell").alias("passage_class"), F.col("p_name").alias("name"), F.concat_ws(" ", "p_name", "p_brand").alias("designation"))
    rules = spark.createDataFrame([(1, "antigens", "passage", "egg"), (2, "antigens", "name", "bolt"), (3, "antigens", "designation", "Brand#2"), (4, "sera", "name", "bolt")], "rule_line int, rule_what string, rule_kind string, rule_text string")
    return filters.removed_points(points, rules)


@query(
    """WITH t AS (SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_quantity = 50 THEN '*' WHEN l_linenumber = 2 AND l_orderkey % 4 = 1 THEN '*' ELSE 'x' END AS token FROM lineitem)
    SELECT token, count(*) AS n FROM t GROUP BY 1"""
)
def cells_dropped(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem")
    readings = lines.select("l_orderkey", "l_linenumber", F.when(F.col("l_quantity") == 50, "*").otherwise("x").alias("token"))
    drops = _read(spark, sf_dir, "orders").where("o_orderkey % 4 = 1").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(2).cast(dict(lines.dtypes)["l_linenumber"]).alias("l_linenumber"))
    return filters.without_cells(readings, drops, ["l_orderkey", "l_linenumber"])[0].groupBy("token").agg(F.count("*").alias("n"))


@query(
    """WITH d AS (SELECT o_orderkey AS l_orderkey, 2 AS l_linenumber FROM orders WHERE o_orderkey % 4 = 1)
    SELECT d.l_orderkey, count(l.l_orderkey) AS n_present FROM d LEFT JOIN lineitem l ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber AND l_quantity <> 50 GROUP BY 1"""
)
def drop_rules_found(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem")
    readings = lines.select("l_orderkey", "l_linenumber", F.when(F.col("l_quantity") == 50, "*").otherwise("x").alias("token"))
    drops = _read(spark, sf_dir, "orders").where("o_orderkey % 4 = 1").select(F.col("o_orderkey").alias("l_orderkey"), F.lit(2).cast(dict(lines.dtypes)["l_linenumber"]).alias("l_linenumber"))
    return filters.without_cells(readings, drops, ["l_orderkey", "l_linenumber"])[1].drop("l_linenumber")


@query(
    """WITH p AS (SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN 'AB--E' WHEN 1 THEN 'ABC-E' WHEN 2 THEN 'ABX-E' WHEN 3 THEN 'AB-' WHEN 4 THEN NULL ELSE 'AB' END AS aa FROM part)
    SELECT id, CASE WHEN coalesce(substring(aa, 3, 1), '') NOT IN ('', '-', 'X') OR coalesce(substring(aa, 4, 1), '') NOT IN ('', '-', 'X') THEN false WHEN substring(aa, 3, 2) = '--' THEN true END AS deleted FROM p"""
)
def deletions(spark, sf_dir):
    key = F.col("p_partkey") % 6
    protein = F.when(key == 0, "AB--E").when(key == 1, "ABC-E").when(key == 2, "ABX-E").when(key == 3, "AB-").when(key == 5, "AB")
    return _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), filters.deleted(protein, [3, 4]).alias("deleted"))


@query(
    """WITH p AS (SELECT l_partkey AS point, CAST(o_orderdate AS DATE) AS date, o_orderkey AS table_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
    SELECT point, arg_min(table_id, (date, table_id)) AS table_id FROM p GROUP BY 1 HAVING max(date) <= DATE '2001-06-30'"""
)
def points_of_early_tables(spark, sf_dir):
    lines = _read(spark, sf_dir, "lineitem").join(_read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    points = lines.select(F.col("l_partkey").alias("point"), F.col("o_orderdate").cast("date").alias("date"), F.col("o_orderkey").alias("table_id"))
    return filters.early_points(points, "2001-06-30")


@query(
    """SELECT s_suppkey AS serum, CASE s_suppkey % 5 WHEN 0 THEN 'species SHEEP' WHEN 1 THEN NULL WHEN 2 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'marker pool' WHEN s_acctbal < 0 THEN 'marker low' END WHEN 3 THEN CASE WHEN s_suppkey % 2 = 0 THEN 'marker pool' WHEN s_acctbal < 0 THEN 'marker low' END END AS kind FROM supplier"""
)
def serum_kinds(spark, sf_dir):
    key = F.col("s_suppkey")
    species = F.when(key % 5 == 0, " sheep").when(key % 5 == 1, "Ferret").when(key % 5 < 4, "").otherwise("FERRET")
    kind = filters.serum_kind(species, [("pool", key % 2 == 0), ("low", F.col("s_acctbal") < 0)])
    return _read(spark, sf_dir, "supplier").select(key.alias("serum"), kind.alias("kind"))


@query("SELECT n_regionkey || '/' || c_mktsegment AS dataset, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def records_placed(spark, sf_dir):
    records = _read(spark, sf_dir, "customer").join(_read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("n_regionkey").alias("subtype"), F.col("c_mktsegment").alias("lineage"))
    rules = records.distinct().withColumn("dataset", F.concat_ws("/", F.col("subtype").cast("string"), "lineage"))
    return filters.placed(records, rules).groupBy("dataset").agg(F.count("*").alias("n"))


@query(
    """WITH leaves AS (SELECT c_custkey AS leaf, c_custkey % 500 AS epi, c_name AS name, CASE WHEN c_custkey % 9 <> 0 THEN DATE '2015-01-01' + CAST(c_custkey % 3000 AS INTEGER) END AS last FROM customer),
    ids AS (SELECT DISTINCT o_custkey AS epi FROM orders WHERE o_custkey % 3 = 0), names AS (SELECT c_name AS name FROM customer WHERE c_custkey % 11 = 0),
    j AS (SELECT l.*, CASE WHEN l.epi IN (SELECT epi FROM ids) THEN 'epi' WHEN l.name IN (SELECT name FROM names) THEN 'name' END AS titrated FROM leaves l),
    s AS (SELECT leaf, titrated, CASE WHEN titrated IS NOT NULL THEN 'titrated' WHEN last IS NULL THEN 'undated' WHEN last < DATE '2018-01-01' THEN 'old' ELSE 'recent' END AS state FROM j)
    SELECT *, state <> 'old' AS kept FROM s"""
)
def report_leaves(spark, sf_dir):
    key = F.col("c_custkey")
    customers = _read(spark, sf_dir, "customer")
    leaves = customers.select(key.alias("leaf"), (key % 500).alias("epi"), F.col("c_name").alias("name"), F.when(key % 9 != 0, F.date_add(F.lit("2015-01-01").cast("date"), (key % 3000).cast("int"))).alias("last"))
    ids = _read(spark, sf_dir, "orders").where("o_custkey % 3 = 0").select(F.col("o_custkey").alias("epi"))
    names = customers.where(key % 11 == 0).select(F.col("c_name").alias("name"))
    return filters.report_leaves(leaves, ids, names, "2018-01-01")


@query(
    """WITH l AS (SELECT c_custkey AS leaf, (c_custkey % 100) / 1000.0 AS length, c_custkey % 300 = 99 AS exempt FROM customer)
    SELECT count(*) AS measured, count(*) FILTER (WHERE length >= 0.09 AND NOT exempt) AS dropped, count(*) FILTER (WHERE length >= 0.09 AND exempt) AS exempt, max(length) AS longest, 0.09 > max(length) AS inert FROM l"""
)
def long_branch_plan(spark, sf_dir):
    key = F.col("c_custkey")
    customers = _read(spark, sf_dir, "customer")
    leaves = customers.select(key.alias("leaf"), (key % 100 / 1000.0).alias("length"))
    return filters.long_branches(leaves, 0.09, customers.where(key % 300 == 99).select(key.alias("leaf")))[1]


@query(
    f"""WITH {NODES}, long AS (SELECT DISTINCT descendant AS leaf FROM pairs WHERE ancestor IN (SELECT node FROM nodes WHERE node % 13 = 4)),
    flags AS (SELECT c_custkey AS leaf, CASE WHEN c_custkey % 10 = 0 THEN 'clock' WHEN c_custkey % 10 = 1 THEN 'lab' ELSE 'other' END AS reason FROM customer WHERE c_custkey % 10 < 3)
    SELECT c_custkey AS leaf, CASE WHEN c_custkey IN (SELECT leaf FROM long) THEN 'long branch' WHEN c_name IN ('Customer#000000005', 'Customer#000000006') THEN 'named override'
      WHEN f.reason IN ('clock', 'lab') THEN 'flag: ' || f.reason ELSE '' END AS hidden_by FROM customer LEFT JOIN flags f ON f.leaf = c_custkey"""
)
def leaves_shown(spark, sf_dir):
    key = F.col("c_custkey")
    customers = _read(spark, sf_dir, "customer")
    long = _pairs(spark, sf_dir).where("ancestor % 13 = 4").select(F.col("descendant").alias("leaf"))
    flags = customers.where(key % 10 < 3).select(key.alias("leaf"), F.when(key % 10 == 0, "clock").when(key % 10 == 1, "lab").otherwise("other").alias("reason"))
    leaves = customers.select(key.alias("leaf"), F.col("c_name").alias("name"))
    return filters.shown(leaves, long, ["Customer#000000005", "Customer#000000006"], flags, ["clock", "lab"])


@query(
    """SELECT o_orderkey AS table_id, CASE o_orderkey % 6 WHEN 1 THEN 'no antigens' WHEN 2 THEN 'titre rows differ from antigens' WHEN 3 THEN '1 ragged rows' WHEN 4 THEN '1 antigens without titres' ELSE '1 sera without titres' END AS problem FROM orders WHERE o_orderkey % 6 <> 0
    UNION ALL SELECT o_orderkey, 'no sera' FROM orders WHERE o_orderkey % 6 = 1"""
)
def nested_table_problems(spark, sf_dir):
    kind = F.col("o_orderkey") % 6
    cell, none = "array('40')", "cast(array() as array<string>)"
    titres = F.expr(
        f"""case o_orderkey % 6 when 1 then cast(array() as array<array<array<string>>>) when 2 then array(array({cell}, {cell})) when 3 then array(array({cell}, {cell}), array({cell}))
        when 4 then array(array({cell}, {cell}), array({none}, {none})) when 5 then array(array({cell}, {none}), array({cell}, {none})) else array(array({cell}, {cell}), array({cell}, {none})) end"""
    )
    two, empty = F.array(F.lit("a"), F.lit("b")), F.array().cast("array<string>")
    tables = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("table_id"), F.when(kind == 1, empty).otherwise(two).alias("antigens"), F.when(kind == 1, empty).otherwise(two).alias("sera"), titres.alias("titres"))
    return filters.table_problems(tables)


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)")
def cut_pin(spark, sf_dir):
    rows = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return filters.kept_by_cut(rows, rows.where("id % 5 = 0"), rows.where("id % 3 <> 0"), "id")


@query("SELECT l_partkey AS id, arg_min(l_returnflag || '.' || l_linestatus, (l_returnflag, l_linenumber)) AS rule FROM (SELECT DISTINCT l_partkey, l_returnflag, l_linestatus, l_linenumber FROM lineitem WHERE l_linenumber = 1 OR l_returnflag = 'A') GROUP BY 1 HAVING count(DISTINCT l_linestatus) = 1")
def withheld_ids(spark, sf_dir):
    """Ids of rules of one status, so that a tie in the order can't matter."""
    lines = _read(spark, sf_dir, "lineitem").where("l_linenumber = 1 or l_returnflag = 'A'")
    one = lines.groupBy("l_partkey").agg(F.count_distinct("l_linestatus").alias("n")).where("n = 1")
    lists = lines.join(one, "l_partkey", "left_semi").select(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("subtype"), F.col("l_linestatus").alias("rule"), F.col("l_linenumber").alias("place"))
    return filters.withheld(lists)


@query("SELECT DISTINCT p_type AS place FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_size < 25)")
def new_places(spark, sf_dir):
    part = _read(spark, sf_dir, "part").select(F.col("p_type").alias("place"), "p_size")
    return filters.unknown(part.select("place").distinct(), part.where("p_size < 25"), "place")


@query(
    """WITH c AS (SELECT p_type AS location, p_brand AS country, count(*) AS n FROM part GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY location ORDER BY n DESC, country) AS k, sum(n) OVER (PARTITION BY location) AS total FROM c)
    SELECT location, country, total AS n FROM r WHERE k = 1"""
)
def stated_places(spark, sf_dir):
    return filters.majority(_read(spark, sf_dir, "part").select(F.col("p_type").alias("location"), F.col("p_brand").alias("country")), "location", ["country"])


WARNINGS = """
warnings AS (SELECT l_orderkey AS table_id, l_linenumber AS line, CASE l_linenumber WHEN 1 THEN 'name ''A/x'': expected type/location/isolate/year' WHEN 2 THEN 'name ''pool 7'': expected type/location/isolate/year'
  WHEN 3 THEN 'B12: ''604'' fixed as ''640'' by cell_fixes.tsv:3' WHEN 4 THEN 'passage ''??'': cannot read ''?''' WHEN 5 THEN '3 fields between type and year' ELSE 'odd ' || l_returnflag END AS text FROM lineitem)"""


@query(
    f"""WITH {WARNINGS} SELECT CASE WHEN line = 1 THEN 'review' WHEN line = 2 THEN 'expected' WHEN line = 3 THEN 'applied' WHEN line IN (4, 5) THEN 'tolerated' ELSE 'review' END AS class,
    CASE line WHEN 1 THEN 'begins like a strain name and does not parse' WHEN 2 THEN 'not a strain name' WHEN 3 THEN 'cell repaired' WHEN 4 THEN 'passage kept' WHEN 5 THEN 'extra fields' ELSE 'unclassified' END AS kind, count(*) AS n FROM warnings GROUP BY 1, 2"""
)
def warning_classes(spark, sf_dir):
    n = F.col("l_linenumber")
    text = (
        F.when(n == 1, "name 'A/x': expected type/location/isolate/year")
        .when(n == 2, "name 'pool 7': expected type/location/isolate/year")
        .when(n == 3, "B12: '604' fixed as '640' by cell_fixes.tsv:3")
        .when(n == 4, "passage '??': cannot read '?'")
        .when(n == 5, "3 fields between type and year")
        .otherwise(F.concat(F.lit("odd "), "l_returnflag"))
    )
    applied, tolerated = {"cell repaired": "fixed as .* by cell_fixes"}, {"extra fields": r"\d+ fields between type and year", "passage kept": "passage .*: cannot read"}
    cls, kind = filters.warning_class(text, applied, tolerated)
    return _read(spark, sf_dir, "lineitem").select(cls.alias("class"), kind.alias("kind")).groupBy("class", "kind").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey AS table_id, l_linenumber AS line FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE CAST(l_shipdate AS DATE) < CAST(o_orderdate AS DATE) + 30")
def date_contradictions(spark, sf_dir):
    """Line items shipped before they could be: a date that contradicts another of its row."""
    both = _read(spark, sf_dir, "lineitem").join(_read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.where(F.col("l_shipdate").cast("date") < F.date_add(F.col("o_orderdate").cast("date"), 30)).select(F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").alias("line"))


@query("SELECT DISTINCT a.l_orderkey AS table_id, 'n' || a.l_partkey AS name, 'r' || a.l_linenumber AS rule FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND b.l_partkey = a.l_partkey AND b.l_returnflag <> 'R' WHERE a.l_returnflag = 'R'")
def rule_outputs_flagged(spark, sf_dir):
    name, back = F.concat(F.lit("n"), F.col("l_partkey").cast("string")), F.col("l_returnflag") == "R"
    rows = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("table_id"), F.when(back, name).alias("output"), F.concat(F.lit("r"), F.col("l_linenumber").cast("string")).alias("rule"), F.when(~back, name).alias("flagged"))
    return filters.bad_outputs(rows)


@query(
    """WITH t AS (SELECT c_custkey AS table_id, c_nationkey || c_mktsegment AS content FROM customer) SELECT table_id, first AS repeats FROM (
      SELECT table_id, first_value(table_id) OVER w AS first, row_number() OVER w AS k FROM t WINDOW w AS (PARTITION BY content ORDER BY table_id)) WHERE k > 1"""
)
def exact_repeats(spark, sf_dir):
    tables = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("table_id"), F.sha2(F.concat(F.col("c_nationkey").cast("string"), "c_mktsegment"), 256).alias("content"))
    return filters.exact_repeats(tables, "content", "table_id")


@query(
    """WITH a AS (SELECT DISTINCT l_orderkey AS table_id, l_linestatus AS grp, l_suppkey AS member FROM lineitem WHERE l_orderkey % 2 = 0), b AS (SELECT DISTINCT l_orderkey AS table_id, l_linestatus AS grp, l_suppkey AS member FROM lineitem WHERE l_orderkey % 2 = 1),
    s AS (SELECT table_id, count(*) AS size FROM a GROUP BY 1), x AS (SELECT a.table_id, b.table_id AS other, count(*) AS shared FROM a JOIN b ON a.grp = b.grp AND a.member = b.member GROUP BY 1, 2)
    SELECT x.table_id, other, shared, size FROM x JOIN s ON x.table_id = s.table_id WHERE 2 * shared > size AND size > 1"""
)
def likely_repeats(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("table_id"), F.col("l_linestatus").alias("grp"), F.col("l_suppkey").alias("member")).distinct()
    return filters.likely_repeats(rows.where("table_id % 2 = 0"), rows.where("table_id % 2 = 1"), ["grp"], least=2)


@query("SELECT c_mktsegment AS code, count(*) AS n, min(c_name) AS example FROM customer WHERE c_mktsegment <> 'BUILDING' GROUP BY 1")
def lineage_minority(spark, sf_dir):
    """Points of another lineage than the map's, by code."""
    rows = _read(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    return rows.groupBy(F.col("c_mktsegment").alias("code")).agg(F.count("*").alias("n"), F.min("c_name").alias("example"))


BASES = "bases AS (SELECT s_suppkey AS serum, s_name AS designation, s_acctbal / 1000 AS basis FROM supplier)"


def _bases(spark, sf_dir):
    return _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("serum"), F.col("s_name").alias("designation"), (F.col("s_acctbal") / 1000).alias("basis"))


@query(f"WITH {BASES} SELECT serum, round(basis, 6) AS was, round(CASE WHEN serum % 4 = 0 THEN 7.0 ELSE basis END, 6) AS basis FROM bases")
def basis_override(spark, sf_dir):
    bases = _bases(spark, sf_dir)
    out = filters.override_bases(bases, bases.where("serum % 4 = 0").select("designation"), 7.0)
    return out.select("serum", F.round("was", 6).alias("was"), F.round("basis", 6).alias("basis"))


@query(f"WITH {BASES} SELECT count(*) FILTER (WHERE serum % 4 = 0) AS n_changed, 1.5 AS most FROM bases")
def basis_lowered(spark, sf_dir):
    bases = _bases(spark, sf_dir)
    counts = filters.lowered_bases(bases, bases.where("serum % 4 = 0").select("designation"), 1.5)[1]
    return counts.withColumn("most", F.round("most", 9))


@query(
    """WITH t AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'F')
    SELECT count(DISTINCT o_orderkey) FILTER (WHERE d <= DATE '2002-01-01') AS tables_used, (SELECT count(*) FROM t WHERE d > DATE '2002-01-01') AS tables_after,
    count(*) FILTER (WHERE d <= DATE '2002-01-01' AND l_returnflag <> 'R') AS antigens_other, count(*) FILTER (WHERE d <= DATE '2002-01-01' AND l_returnflag = 'R') AS antigens_kept FROM t LEFT JOIN lineitem ON l_orderkey = o_orderkey"""
)
def round_tables(spark, sf_dir):
    """One subtype's tables up to a day, antigens of other lineages left out and counted."""
    tables = _read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", (F.col("o_orderdate").cast("date") <= F.lit("2002-01-01").cast("date")).alias("used"))
    lines = _read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count_if(F.col("l_returnflag") != "R").alias("other"), F.count_if(F.col("l_returnflag") == "R").alias("kept"))
    both = tables.join(lines, "o_orderkey", "left").fillna(0, ["other", "kept"])
    total = lambda c: F.coalesce(F.sum(F.when(F.col("used"), F.col(c))), F.lit(0))
    return both.agg(F.count_if("used").alias("tables_used"), F.count_if(~F.col("used")).alias("tables_after"), total("other").alias("antigens_other"), total("kept").alias("antigens_kept"))


@query("SELECT p_partkey AS point FROM part WHERE p_type IN (SELECT p_type FROM part WHERE p_partkey < 20) AND p_brand = 'Brand#1' OR p_type = (SELECT min(p_type) FROM part)")
def vaccines_labelled(spark, sf_dir):
    part = _read(spark, sf_dir, "part")
    marks = part.select(F.col("p_partkey").alias("point"), F.col("p_type").alias("strain"), F.col("p_brand").alias("passage"))
    seen = part.where("p_partkey < 20").select(F.col("p_type").alias("strain")).distinct().join(marks.where("passage = 'Brand#1'"), "strain", "left_semi")
    rules = seen.withColumn("passage", F.lit("Brand#1")).unionByName(marks.agg(F.min("strain").alias("strain")).withColumn("passage", F.lit("any")))
    return filters.labelled_vaccines(marks, None, rules).select("point")


@query("SELECT o_orderstatus AS subtype, count(*) AS value, CASE o_orderstatus WHEN 'O' THEN 1000 ELSE 100000000 END AS \"limit\", count(*) > CASE o_orderstatus WHEN 'O' THEN 1000 ELSE 100000000 END AS over FROM orders GROUP BY 1")
def limits(spark, sf_dir):
    measured = _read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("subtype")).agg(F.count("*").alias("value"))
    known = measured.select("subtype", F.when(F.col("subtype") == "O", 1000).otherwise(100000000).alias("limit"))
    return filters.limited(measured, known, "subtype")


@query(
    f"""WITH {NODES}, flags AS (SELECT node, CASE WHEN node % 10 = 3 THEN 'outlier' END AS reason FROM nodes WHERE node < 1000000)
    SELECT reason, count(*) AS n, min(node) AS first FROM flags WHERE reason IS NOT NULL GROUP BY 1"""
)
def flags_applied(spark, sf_dir):
    """Flags written onto leaves, and the exclusions that they give by reason."""
    leaves = _nodes(spark, sf_dir).where("node < 1000000")
    flags = leaves.where("node % 10 = 3").select("node", F.lit("outlier").alias("reason"))
    marked = leaves.join(flags, "node", "left")
    return marked.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"), F.min("node").alias("first"))

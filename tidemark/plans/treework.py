"""Queries on trees' orders, trims, bands, labels, and on what reports count."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import texts
from tidemark.operators import filters, order, summaries, trees, treework
from tidemark.sources import standins

from .registry import query
from .trees import NODES, _leaves, _nodes, _pairs


def _read(spark, sf_dir, name):
    return standins.table(spark, sf_dir, name)


@query(
    f"""WITH {NODES}, sizes AS (SELECT ancestor AS node, count(*) AS size FROM pairs GROUP BY 1),
    b AS (SELECT n.node, n.parent, size, coalesce(sum(size) OVER (PARTITION BY parent ORDER BY n.node DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM nodes n JOIN sizes s ON s.node = n.node)
    SELECT p.descendant AS node, sum(CASE WHEN b.parent IS NULL THEN 0 ELSE before + 1 END) AS pre, any_value(s.size) AS size FROM pairs p JOIN b ON b.node = p.ancestor JOIN sizes s ON s.node = p.descendant GROUP BY 1"""
)
def node_table(spark, sf_dir):
    """All nodes with their pre-order numbers and subtree sizes."""
    return treework.preorder(_nodes(spark, sf_dir), _pairs(spark, sf_dir), -F.col("node"))


@query(
    f"""WITH {NODES}, sizes AS (SELECT ancestor AS node, count(*) AS n_leaves FROM pairs JOIN leaves ON descendant = leaves.node GROUP BY 1)
    SELECT node, n_leaves FROM sizes WHERE node = (SELECT min(2000000 + c_nationkey) FROM customer WHERE c_nationkey <> (SELECT c_nationkey FROM customer ORDER BY c_custkey LIMIT 1))"""
)
def trim_node(spark, sf_dir):
    customers = _read(spark, sf_dir, "customer")
    first = customers.orderBy("c_custkey").select("c_custkey", "c_nationkey").first()
    at = 2000000 + customers.where(F.col("c_nationkey") != first["c_nationkey"]).agg(F.min("c_nationkey")).first()[0]
    nodes = _nodes(spark, sf_dir)
    changes = nodes.select("node", F.when((F.col("node") == at) | (F.col("node") < 1000000), "145S").otherwise("99K").alias("change"))
    return treework.trim_node(changes, _pairs(spark, sf_dir), _leaves(spark, sf_dir), "145S", 2, first["c_custkey"])


@query(
    """WITH l AS (SELECT c_custkey AS leaf, c_nationkey AS child, count(*) OVER (PARTITION BY c_nationkey) AS n, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS turn FROM customer),
    o AS (SELECT *, row_number() OVER (ORDER BY turn, n DESC, child) AS k FROM l) SELECT leaf, child, turn FROM o WHERE k <= 40"""
)
def cut_anchors(spark, sf_dir):
    leaves = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("leaf"), F.col("c_nationkey").alias("child"))
    return treework.anchors(leaves, leaves.groupBy("child").agg(F.count("*").alias("n_leaves")), 40)


BANDS = "bands(clade, first, last, depth) AS (VALUES ('A', 10, 500, 1), ('A.1', 50, 200, 2), ('A.2', 190, 300, 2), ('B', 450, 900, 1))"


@query(
    f"""WITH {BANDS}, r AS (SELECT c_custkey AS row FROM customer), h AS (SELECT row, clade, row_number() OVER (PARTITION BY row ORDER BY depth DESC, clade DESC) AS k FROM r LEFT JOIN bands ON row BETWEEN first AND last) SELECT row, clade FROM h WHERE k = 1"""
)
def lettered_rows(spark, sf_dir):
    bands = spark.createDataFrame([("A", 10, 500), ("A.1", 50, 200), ("A.2", 190, 300), ("B", 450, 900)], "clade string, first long, last long")
    depth = bands.select("clade", F.when(F.col("clade").contains("."), 2).otherwise(1).alias("depth"))
    return treework.lettered(_read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("row")), bands, depth)


@query(
    f"""WITH {NODES}, d AS (SELECT descendant AS node, max(distance) AS depth FROM pairs GROUP BY 1), r AS (SELECT descendant AS clade, ancestor AS anchor, row_number() OVER (PARTITION BY descendant ORDER BY depth DESC) AS k FROM pairs JOIN d ON d.node = ancestor WHERE ancestor % 3 = 0) SELECT clade, anchor FROM r WHERE k = 1"""
)
def published_anchors(spark, sf_dir):
    pairs = _pairs(spark, sf_dir)
    published = _nodes(spark, sf_dir).where("node % 3 = 0").select(F.col("node").alias("clade"))
    return treework.published_anchor(pairs, published, trees.depths(pairs))


@query(
    """WITH a AS (SELECT c_custkey AS node, c_nationkey AS clade FROM customer WHERE c_custkey % 9 <> 0), b AS (SELECT c_custkey AS node, CASE WHEN c_custkey % 7 = 0 THEN (c_nationkey + 1) % 25 ELSE c_nationkey END AS clade FROM customer WHERE c_custkey % 11 <> 0),
    x AS (SELECT node, n_regionkey AS was FROM a LEFT JOIN nation ON n_nationkey = clade), y AS (SELECT node, n_regionkey AS now FROM b LEFT JOIN nation ON n_nationkey = clade)
    SELECT coalesce(x.node, y.node) AS node, was, now FROM x FULL JOIN y ON x.node = y.node WHERE was IS DISTINCT FROM now"""
)
def labels_changed(spark, sf_dir):
    key = F.col("c_custkey")
    rows = _read(spark, sf_dir, "customer")
    before = rows.where(key % 9 != 0).select(key.alias("node"), F.col("c_nationkey").alias("clade"))
    after = rows.where(key % 11 != 0).select(key.alias("node"), F.when(key % 7 == 0, (F.col("c_nationkey") + 1) % 25).otherwise(F.col("c_nationkey")).alias("clade"))
    anchor = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("clade"), F.col("n_regionkey").alias("anchor"))
    return treework.labels_changed(before, after, anchor)


@query("SELECT n_name AS clade, r_name AS parent, false AS local FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT r_name, NULL, false FROM region UNION ALL SELECT 'local ' || c_custkey, n_name, true FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 20 = 0")
def hierarchy_extended(spark, sf_dir):
    nation, region = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")
    inner = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("clade"), F.col("r_name").alias("parent"))
    hierarchy = inner.unionByName(region.select(F.col("r_name").alias("clade"), F.lit(None).cast("string").alias("parent")))
    local = _read(spark, sf_dir, "customer").where("c_custkey % 20 = 0").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("local "), F.col("c_custkey").cast("string")).alias("clade"), F.col("n_name").alias("parent"))
    return treework.extended(hierarchy, local)


@query(
    """WITH s AS (SELECT o_custkey AS node, o_orderstatus AS sibling, count(*) AS matching, min(o_totalprice) > 0 AND o_orderstatus <> 'P' AS fits FROM orders GROUP BY 1, 2), b AS (SELECT node, max({'m': matching, 's': sibling}) AS x FROM s WHERE fits AND matching > 0 GROUP BY 1)
    SELECT c_custkey AS node, 'old' AS "from", x.s AS "to" FROM customer JOIN b ON b.node = c_custkey WHERE c_custkey % 3 = 0 AND c_custkey % 4 <> 0"""
)
def sibling_recovery(spark, sf_dir):
    key = F.col("c_custkey")
    contradicted = _read(spark, sf_dir, "customer").select(key.alias("node"), F.lit("old").alias("clade"), (key % 3 == 0).alias("parent_holds"), (key % 4 == 0).alias("leaf"))
    siblings = _read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("node"), F.col("o_orderstatus").alias("sibling")).agg(F.count("*").alias("matching"), (F.min("o_totalprice") > 0).alias("fits"))
    return treework.moved_to_siblings(contradicted, siblings.withColumn("fits", F.col("fits") & (F.col("sibling") != "P")))


@query("SELECT CASE WHEN c_custkey = 7 THEN 'outgroup' WHEN c_custkey % 5 = 0 THEN 'known before' ELSE 'new' END AS why, count(*) AS n FROM customer WHERE c_custkey % 2 = 1 GROUP BY 1")
def leaves_resumed(spark, sf_dir):
    leaves = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("leaf"))
    found = treework.resumed(leaves, leaves.where("leaf % 2 = 0"), leaves.where("leaf % 5 = 0"), 7)
    return found.groupBy("why").agg(F.count("*").alias("n"))


@query(
    f"""WITH {NODES}, sizes AS (SELECT ancestor AS node, count(*) AS n_leaves FROM pairs JOIN leaves ON descendant = leaves.node GROUP BY 1)
    SELECT node, 'c' || node % 100 AS change, n_leaves FROM sizes WHERE n_leaves >= 3 AND n_leaves >= 0.03 * (SELECT count(*) FROM leaves) AND node <> 3000000"""
)
def printed_changes(spark, sf_dir):
    pairs, leaves = _pairs(spark, sf_dir), _leaves(spark, sf_dir)
    changes = _nodes(spark, sf_dir).where("parent is not null").select("node", F.concat(F.lit("c"), (F.col("node") % 100).cast("string")).alias("change"))
    return treework.printed_changes(changes, trees.subtree_counts(pairs, leaves).select("node", "n_leaves"), leaves.agg(F.count("*").alias("total")), 3, 0.03)


@query("SELECT o_orderpriority AS subtree, count(*) AS n, round(regr_slope(o_totalprice, CAST(o_orderdate AS DATE) - DATE '1990-01-01'), 9) AS slope, regr_slope(o_totalprice, CAST(o_orderdate AS DATE) - DATE '1990-01-01') > 0 AS forward FROM orders GROUP BY 1")
def clock_direction(spark, sf_dir):
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1990-01-01").cast("date")).cast("double")
    leaves = _read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("subtree"), days.alias("date"), F.col("o_totalprice").alias("distance"))
    return treework.clock_direction(leaves)


@query()
def placement_quality(spark, sf_dir):
    """On 500 leaves by hash, which SQL has no form for."""
    lines = _read(spark, sf_dir, "lineitem")
    leaves = lines.groupBy(F.col("l_orderkey").alias("leaf")).agg(F.sum("l_quantity").alias("tree"), F.count("*").alias("sequence"))
    return treework.placement_quality(leaves, 500)


@query("SELECT i AS position, coalesce(substring(p_name, CAST(i AS BIGINT), 1), '') AS residue, count(*) AS n FROM part, (VALUES (1), (3), (30)) t(i) GROUP BY 1, 2")
def bar_residues(spark, sf_dir):
    return summaries.residues(_read(spark, sf_dir, "part"), "p_name", [1, 3, 30])


@query(
    """WITH c AS (SELECT c_mktsegment AS clade, count(*) FILTER (WHERE c_custkey % 3 = 0) AS unpainted, count(*) FILTER (WHERE c_custkey % 3 <> 0 AND c_custkey % 5 = 0) AS placed, count(*) AS n FROM customer GROUP BY 1)
    SELECT *, unpainted || ' records of ' || clade || ': no row in scheme S' AS said FROM c WHERE unpainted + placed > 0"""
)
def unpainted_clades(spark, sf_dir):
    key = F.col("c_custkey")
    styles = _read(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("clade"), F.when(key % 3 != 0, "red").alias("colour"), (key % 5 == 0).alias("by_placement"))
    counted = summaries.unpainted(styles, "clade")
    return counted.withColumn("said", summaries.unpainted_sentence(F.col("unpainted"), F.col("clade"), "S"))


@query("SELECT n_name AS name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey > 1 GROUP BY 1")
def not_in_legend(spark, sf_dir):
    nation = _read(spark, sf_dir, "nation").withColumnRenamed("n_name", "name")
    rows = _read(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("name")
    return summaries.not_in_legend(rows, nation.where("n_regionkey <= 1"), "name")


@query(
    """WITH b AS (SELECT vec_id AS label, CAST(embedding[1] AS DOUBLE) * 100 AS x, CAST(embedding[2] AS DOUBLE) * 100 AS y FROM embeddings)
    SELECT p.label AS a, q.label AS b, round((least(p.x, q.x) + 1 - greatest(p.x, q.x)) * (least(p.y, q.y) + 0.5 - greatest(p.y, q.y)), 6) AS area FROM b p JOIN b q ON p.label < q.label AND abs(p.x - q.x) < 1 AND abs(p.y - q.y) < 0.5"""
)
def label_overlaps(spark, sf_dir):
    x, y = F.col("embedding")[0].cast("double") * 100, F.col("embedding")[1].cast("double") * 100
    boxes = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("label"), x.alias("x0"), y.alias("y0"), (x + 1).alias("x1"), (y + 0.5).alias("y1"))
    return summaries.overlaps(boxes, 1.0)


@query("SELECT DISTINCT user_id AS serum, event_type AS rule FROM events a WHERE event_id >= 5000 AND NOT EXISTS (SELECT 1 FROM events b WHERE b.event_id < 5000 AND b.user_id = a.user_id AND b.event_type = a.event_type)")
def control_flags(spark, sf_dir):
    """Rules that a step's table completes for the first time."""
    rows = _read(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("serum"), F.col("event_type").alias("rule"))
    return summaries.newly(rows.where("event_id >= 5000").select("serum", "rule").distinct(), rows.where("event_id < 5000"), ["serum", "rule"])


@query(
    """WITH r AS (SELECT o_orderkey AS row, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS date, o_orderkey % 5 = 0 AS yearly FROM orders)
    SELECT "case", month, count(*) AS n FROM (SELECT CASE WHEN date IS NULL THEN 'undated' WHEN yearly THEN 'year only' WHEN date < DATE '1999-01-01' THEN 'before' WHEN date >= DATE '2002-07-01' THEN 'after' ELSE 'shown' END AS "case",
      CASE WHEN date IS NOT NULL AND NOT yearly AND date >= DATE '1999-01-01' AND date < DATE '2002-07-01' THEN (year(date) - 1999) * 12 + month(date) - 1 END AS month FROM r) GROUP BY 1, 2"""
)
def month_axis(spark, sf_dir):
    key = F.col("o_orderkey")
    rows = _read(spark, sf_dir, "orders").select(key.alias("row"), F.when(key % 9 != 0, F.col("o_orderdate").cast("date")).alias("date"), F.when(key % 5 == 0, "year").otherwise("day").alias("precision"))
    return summaries.month_rows(rows, "1999-01-01", "2002-07-01").groupBy("case", "month").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey AS key, row_number() OVER (ORDER BY CASE WHEN o_orderkey = 5 THEN 0 ELSE 1 END, coalesce(CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END, DATE '9999-12-31'), o_orderkey) AS place FROM orders")
def selection_order(spark, sf_dir):
    rows = _read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("key"), F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderdate").cast("date")).alias("first"))
    return order.numbered(rows, summaries.in_selection_order(rows, F.col("key") == 5)).select("key", "place")


@query(
    """SELECT p_partkey AS point, CASE WHEN p_partkey % 2 <> 0 THEN 'last' WHEN p_partkey % 3 <> 0 THEN 'before last' END AS tier FROM part WHERE p_partkey % 6 <> 0"""
)
def new_points(spark, sf_dir):
    points = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("point"))
    return summaries.tiers_of_new(points, [("last", points.where("point % 2 = 0")), ("before last", points.where("point % 3 = 0"))])


@query("SELECT l_orderkey AS table_id, l_linenumber AS line, CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_returnflag, l_linestatus ORDER BY l_linenumber) > 1 THEN l_linestatus || ' DISTINCT' ELSE l_linestatus END AS annotations FROM lineitem")
def repeats_marked(spark, sf_dir):
    rows = _read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").alias("line"), "l_returnflag", "l_linestatus", F.array("l_linestatus").alias("annotations"))
    out = summaries.marked_repeats(rows, ["l_returnflag", "l_linestatus"], "line")
    return out.select("table_id", "line", F.array_join("annotations", " ").alias("annotations"))


@query(
    """WITH c AS (SELECT year(CAST(o_orderdate AS DATE)) AS period, o_orderstatus AS location, o_orderpriority AS style, count(*) AS n FROM orders GROUP BY 1, 2, 3),
    g AS (SELECT period, location, string_agg('{"style":"' || style || '","n":' || n || '}', ',' ORDER BY style) AS groups FROM c GROUP BY 1, 2)
    SELECT period, '[' || string_agg('{"location":"' || location || '","groups":[' || groups || ']}', ',' ORDER BY location) || ']' AS locations FROM g GROUP BY 1"""
)
def geo_documents(spark, sf_dir):
    counts = _read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("period"), F.col("o_orderstatus").alias("location"), F.col("o_orderpriority").alias("style")).agg(F.count("*").alias("n"))
    return summaries.geo_document(counts)


@query("SELECT c_custkey AS id, CASE c_custkey % 4 WHEN 1 THEN 'missing name' WHEN 2 THEN 'unreadable' ELSE 'missing points' END AS problem FROM customer WHERE c_custkey % 4 <> 0")
def document_problems(spark, sf_dir):
    key = F.col("c_custkey") % 4
    text = F.when(key == 0, '{"name": "m", "points": [1, 2]}').when(key == 1, '{"points": [1]}').when(key == 2, "{nothing").otherwise('{"name": "m"}')
    rows = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), text.alias("document"))
    return summaries.bad_documents(rows, "name string, points array<int>, bad string")


@query(
    """WITH p AS (SELECT CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings WHERE label <> 0), e AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p), s AS (SELECT *, greatest(x1 - x0, y1 - y0) + 2.0 AS size FROM e)
    SELECT round((x0 + x1 - size) / 2, 9) AS "left", round((y0 + y1 - size) / 2, 9) AS bottom, round(size, 9) AS size FROM s"""
)
def map_frame(spark, sf_dir):
    points = _read(spark, sf_dir, "embeddings").select(F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"), (F.col("label") != 0).alias("shown"))
    return summaries.frame(points, 1.0)


@query("SELECT vec_id AS point, round(CAST(embedding[1] AS DOUBLE) * 0.6 - CAST(embedding[2] AS DOUBLE) * 0.8, 9) AS x, round(CAST(embedding[1] AS DOUBLE) * 0.8 + CAST(embedding[2] AS DOUBLE) * 0.6, 9) AS y FROM embeddings")
def layout_baked(spark, sf_dir):
    points = _read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("point"), F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    return summaries.transformed(points, (0.6, 0.8, -0.8, 0.6)).select("point", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"))


@query(
    """WITH f AS (SELECT s_suppkey AS figure, s_acctbal AS value FROM supplier WHERE s_acctbal < 2000), e AS (SELECT s_suppkey AS figure, 'known' AS known FROM supplier WHERE s_suppkey % 3 = 0)
    SELECT coalesce(f.figure, e.figure) AS figure, CASE WHEN f.figure IS NULL THEN 'orphan' WHEN e.figure IS NULL THEN 'new' ELSE 'known' END AS state FROM f FULL JOIN e ON f.figure = e.figure"""
)
def known_differences(spark, sf_dir):
    supplier = _read(spark, sf_dir, "supplier")
    rows = supplier.select(F.col("s_suppkey").alias("figure"), F.col("s_acctbal").alias("value"), (F.col("s_acctbal") < 2000).alias("failing"))
    expected = supplier.where("s_suppkey % 3 = 0").select(F.col("s_suppkey").alias("figure"), F.lit("known").alias("reason"))
    return summaries.known_differences(rows, expected, ["figure"]).select("figure", "state")


@query("SELECT substring(o_orderpriority, 1, 1) AS lab, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 4 = 0) AS n_year_only, count(*) FILTER (WHERE o_orderkey % 7 = 0) AS n_problems, count(DISTINCT o_custkey) AS n_isolates FROM orders GROUP BY 1")
def pull_counts(spark, sf_dir):
    """A delivery's records by laboratory: precision of dates, problems, isolates."""
    key = F.col("o_orderkey")
    return _read(spark, sf_dir, "orders").groupBy(F.substring("o_orderpriority", 1, 1).alias("lab")).agg(F.count("*").alias("n"), F.count_if(key % 4 == 0).alias("n_year_only"), F.count_if(key % 7 == 0).alias("n_problems"), F.count_distinct("o_custkey").alias("n_isolates"))


@query("SELECT rule, count(*) AS n FROM (SELECT l_partkey AS id, min(l_returnflag || '.' || l_linenumber) AS rule FROM lineitem WHERE l_linenumber < 3 GROUP BY 1) GROUP BY 1")
def withheld_counts(spark, sf_dir):
    lists = _read(spark, sf_dir, "lineitem").where("l_linenumber < 3").select(F.col("l_partkey").alias("id"), F.col("l_returnflag").alias("subtype"), F.col("l_linenumber").cast("string").alias("rule"), F.col("l_linenumber").alias("place"))
    return filters.withheld(lists).groupBy("rule").agg(F.count("*").alias("n"))


@query()
def leaf_hashes(spark, sf_dir):
    """xxHash32 of each leaf's sequence, one hash per distinct sequence."""
    leaves = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("leaf"), "text")
    hashed = leaves.select("text").distinct().select("text", texts.xxh32_hex("text").alias("hash"))
    return leaves.join(hashed, "text", "left").select("leaf", "hash")

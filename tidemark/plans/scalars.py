"""Queries on passages, mutations, loci, labels, ids and shapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import shapes, texts
from tidemark.sources import standins

from .registry import query


def _part(spark, sf_dir):
    return standins.table(spark, sf_dir, "part")


@query(
    """SELECT l_orderkey AS id, l_linenumber AS line, CASE WHEN l_quantity = 50 THEN NULL WHEN l_returnflag = 'R' THEN round(log2(l_quantity * 20 / 20.0), 9) ELSE round(log2(l_quantity * 20 / 10.0), 9) END AS log,
    l_quantity = 50 AS zero FROM lineitem"""
)
def control_logs(spark, sf_dir):
    lines = standins.table(spark, sf_dir, "lineitem")
    number = F.when(F.col("l_quantity") == 50, "0").otherwise((F.col("l_quantity") * 20).cast("long").cast("string"))
    log = texts.control_log(F.concat(F.when(F.col("l_returnflag") == "R", "<").otherwise(""), number))
    return lines.select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.round(F.when(log > -1e300, log), 9).alias("log"), (log == float("-inf")).alias("zero"))


@query("SELECT o_orderkey AS id, o_orderkey >= 10 AND o_orderkey % 10 = 0 AND bit_count(o_orderkey // 10) = 1 AS dilution FROM orders")
def dilution_series(spark, sf_dir):
    key = F.col("o_orderkey")
    return standins.table(spark, sf_dir, "orders").select(key.alias("id"), texts.is_dilution(key).alias("dilution"))


@query(
    """SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'NYMC X-' || p_size ELSE '' END AS reassortant, CASE p_partkey % 4 WHEN 0 THEN '' WHEN 1 THEN p_brand WHEN 2 THEN '' ELSE 'x-' || p_size || ' and more' END AS annotation FROM part"""
)
def name_extras(spark, sf_dir):
    key, size = F.col("p_partkey") % 4, F.col("p_size").cast("string")
    extra = F.when(key == 0, F.concat(F.lit(" (nymc x-"), size, F.lit(") "))).when(key == 1, F.concat(F.lit("("), "p_brand", F.lit(")"))).when(key == 2, " ").otherwise(F.concat(F.lit("x-"), size, F.lit(" and more")))
    reassortant, annotation = texts.extra_parts(extra, [(r"(nymc )?x-?(\d+)", "NYMC X-$2"), ("never", "no")])
    return _part(spark, sf_dir).select(F.col("p_partkey").alias("id"), reassortant.alias("reassortant"), annotation.alias("annotation"))


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 5 <> 0 THEN p_type END AS location FROM part")
def name_locations(spark, sf_dir):
    key = F.col("p_partkey")
    place = F.when(key % 5 == 0, "").otherwise(F.col("p_type"))
    name = F.when(key % 3 == 0, F.concat_ws("/", F.lit("A"), place, key.cast("string"), F.lit("2020"))).otherwise(F.concat_ws("/", F.lit("A"), place))
    return _part(spark, sf_dir).select(key.alias("id"), texts.name_location(name).alias("location"))


@query(
    """SELECT doc_id AS id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')), '[-_]', ' ', 'g'), '[''.]', '', 'g'), '[\\s\\x1c-\\x1f]+', ' ', 'g'), '^ | $', '', 'g')) AS location FROM documents"""
)
def ascii_locations(spark, sf_dir):
    return standins.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), texts.ascii_location("text").alias("location"))


@query(
    """SELECT n_nationkey AS id, CASE WHEN n_nationkey % 4 = 3 THEN NULL ELSE r_name END AS region, CASE WHEN n_nationkey % 4 IN (1, 2) THEN n_name END AS country,
    CASE WHEN n_nationkey % 4 = 2 THEN 'north / ' || n_nationkey ELSE '' END AS rest FROM nation JOIN region ON n_regionkey = r_regionkey"""
)
def location_split(spark, sf_dir):
    both = standins.table(spark, sf_dir, "nation").join(standins.table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    kind = F.col("n_nationkey") % 4
    text = F.when(kind == 3, "  ").when(kind == 0, F.col("r_name")).when(kind == 1, F.concat_ws(" / ", "r_name", "n_name")).otherwise(F.concat_ws(" / ", "r_name", F.concat("n_name", F.lit(" ")), F.lit("north"), F.col("n_nationkey").cast("string")))
    region, country, rest = texts.location_parts(text)
    return both.select(F.col("n_nationkey").alias("id"), region.alias("region"), country.alias("country"), rest.alias("rest"))


@query(
    """WITH d AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, o_orderkey % 6 AS kind FROM orders)
    SELECT id, CASE kind WHEN 4 THEN NULL WHEN 5 THEN TRY_CAST('1987-' || strftime(day, '%m-%d') AS DATE) WHEN 3 THEN CASE WHEN day(day) > 12 THEN day END ELSE day END AS date,
    CASE kind WHEN 3 THEN CASE WHEN day(day) > 12 THEN 'other order' ELSE 'ambiguous' END WHEN 4 THEN 'not a date' WHEN 5 THEN CASE WHEN strftime(day, '%m-%d') = '02-29' THEN 'invalid' ELSE '' END ELSE '' END AS problem FROM d WHERE kind <> 3 OR day(day) > 12"""
)
def lab_dates(spark, sf_dir):
    """Dates as laboratories write them: ISO, the stated order, another order, two-digit years, no date."""
    day, kind = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 6
    made = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(day, "M/d/yyyy"))
        .when(kind == 2, F.date_format(day, "yyyy.MM.dd"))
        .when(kind == 3, F.date_format(day, "d/M/yyyy"))
        .when(kind == 4, "about May")
        .otherwise(F.date_format(day, "M/d/'87'"))
    )
    rows = standins.table(spark, sf_dir, "orders").where((kind != 3) | (F.dayofmonth(day) > 12))
    date, problem = texts.lab_date(made, F.lit("MDY"), F.lit("2024-01-01").cast("date"))
    return rows.select(F.col("o_orderkey").alias("id"), date.alias("date"), problem.alias("problem"))


TOKENS = [("E", "E", "egg"), ("EGG", "E", "egg"), ("MDCK", "MDCK", "cell"), ("C", "MDCK", "cell"), ("SIAT", "SIAT", "cell"), ("OR", "OR", "original")]


@query(
    """SELECT p_partkey AS id, CASE p_partkey % 6 WHEN 0 THEN 'E' || p_size || '/E?(AM1)' WHEN 1 THEN 'MDCK1SIAT' || p_size WHEN 2 THEN 'MDCK2/MDCK' || p_size WHEN 3 THEN upper(p_name) WHEN 4 THEN '' ELSE 'OR' END AS passage,
    CASE p_partkey % 6 WHEN 0 THEN 'egg' WHEN 1 THEN 'cell' WHEN 2 THEN 'cell' WHEN 5 THEN 'original' ELSE 'unknown' END AS class, CASE p_partkey % 6 WHEN 3 THEN 'passage.unread' ELSE '' END AS problem FROM part"""
)
def passage_parse(spark, sf_dir):
    key, size = F.col("p_partkey") % 6, F.col("p_size").cast("string")
    raw = (
        F.when(key == 0, F.concat(F.lit("egg"), size, F.lit("/eX(Am1)")))
        .when(key == 1, F.concat(F.lit(" c1siat"), size, F.lit(" ")))
        .when(key == 2, F.concat(F.lit("MDCK2C"), size))
        .when(key == 3, F.col("p_name"))
        .when(key == 4, " ")
        .otherwise("or")
    )
    text, classes, problem = texts.passage(raw, TOKENS)
    return _part(spark, sf_dir).select(F.col("p_partkey").alias("id"), text.alias("passage"), texts.class_of(classes).alias("class"), problem.alias("problem"))


@query("SELECT p_partkey AS id, p_partkey % 5 IN (0, 3) AS egg FROM part")
def egg_last(spark, sf_dir):
    key = F.col("p_partkey") % 5
    raw = F.when(key == 0, "MDCK1/E3 (2020-01-31)").when(key == 1, "E3/MDCK2").when(key == 2, "").when(key == 3, "embryonated x2").otherwise("S1(E2)")
    return _part(spark, sf_dir).select(F.col("p_partkey").alias("id"), texts.last_step_is_egg(raw).alias("egg"))


@query(
    """WITH p AS (SELECT p_partkey AS id, p_partkey % 5 AS a, p_size % 5 AS b FROM part)
    SELECT id, CASE WHEN a = 4 OR b = 4 THEN 90 WHEN a = b THEN 0 WHEN a IN (0, 1) AND b IN (0, 1) THEN 10 WHEN a IN (0, 1, 2) AND b IN (0, 1, 2) THEN 20 ELSE 90 END AS rank FROM p"""
)
def passage_ranks(spark, sf_dir):
    """a, b and c end alike, a and b with the same count; d is egg; e has no step."""
    made = F.array(F.lit("MDCK1/SIAT2"), F.lit("SIAT 2"), F.lit("SIAT1"), F.lit("E3"), F.lit("12"))
    mine, theirs = F.get(made, F.col("p_partkey") % 5), F.get(made, F.col("p_size") % 5)
    rank = texts.passage_rank(texts.loose_steps(mine), F.startswith(mine, F.lit("E")), texts.loose_steps(theirs), F.startswith(theirs, F.lit("E")))
    return _part(spark, sf_dir).select(F.col("p_partkey").alias("id"), rank.alias("rank"))


@query(
    """WITH p AS (SELECT p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN 'HA1' WHEN 1 THEN 'HA2' WHEN 2 THEN 'nuc' WHEN 3 THEN 'SigPep' ELSE 'PB2' END AS locus, p_size * 40 AS position FROM part),
    c AS (SELECT *, CASE locus WHEN 'HA1' THEN position WHEN 'HA2' THEN position + 329 WHEN 'nuc' THEN position - 65 END AS spot FROM p),
    r AS (SELECT *, CASE WHEN locus = 'PB2' THEN 'unknown locus' WHEN locus = 'SigPep' THEN 'signal peptide precedes the mature protein' WHEN locus LIKE 'HA%' AND spot > 1653 // 3 THEN 'residue follows the mature protein'
      WHEN locus = 'nuc' AND spot < 1 THEN 'nucleotide precedes the mature protein' WHEN locus = 'nuc' AND spot > 1653 THEN 'nucleotide follows the mature protein' ELSE '' END AS reason FROM c)
    SELECT id, CASE WHEN reason = '' THEN CASE WHEN locus = 'nuc' THEN 'nuc' ELSE 'aa' END END AS alphabet, CASE WHEN reason = '' THEN spot END AS position, reason FROM r"""
)
def mature_positions(spark, sf_dir):
    kind = F.col("p_partkey") % 5
    locus = F.when(kind == 0, "HA1").when(kind == 1, "HA2").when(kind == 2, "nuc").when(kind == 3, "SigPep").otherwise("PB2")
    alphabet, at, reason = texts.mature_position(locus, F.col("p_size") * 40, 65, 329, 1653)
    return _part(spark, sf_dir).select(F.col("p_partkey").alias("id"), alphabet.alias("alphabet"), at.alias("position"), reason.alias("reason"))


@query(
    """SELECT p_partkey AS id, 'aa' AS alphabet, p_size AS position, CASE WHEN p_partkey % 2 = 0 THEN 'S' ELSE '-' END AS state, p_partkey % 3 AS unread FROM part
    UNION ALL SELECT p_partkey, 'nuc', p_size + 100, 'A', p_partkey % 3 FROM part"""
)
def mutation_tokens(spark, sf_dir):
    size, key = F.col("p_size").cast("string"), F.col("p_partkey")
    text = F.concat(size, F.when(key % 2 == 0, "s").otherwise("-"), F.lit("  nuc"), (F.col("p_size") + 100).cast("string"), F.lit("a "), F.repeat(F.lit("S145 "), (key % 3).cast("int")))
    found, unread = texts.mutations(text)
    return _part(spark, sf_dir).select(key.alias("id"), F.size(unread).alias("unread"), F.inline(found)).select("id", "alphabet", "position", "state", "unread")


@query()
def xxh32(spark, sf_dir):
    """xxHash32 of every document's whole text."""
    return standins.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), texts.xxh32_hex("text").alias("hash"))


@query(
    """SELECT n_nationkey AS id, sha256('{"comment":' || CASE WHEN n_nationkey % 3 = 0 THEN 'null' ELSE '"' || n_name || '"' END || ',"key":' || n_nationkey || ',"region":' || n_regionkey || '}') AS digest FROM nation"""
)
def json_digest(spark, sf_dir):
    comment = F.when(F.col("n_nationkey") % 3 != 0, F.col("n_name"))
    text = texts.canonical_json({"region": F.col("n_regionkey"), "key": F.col("n_nationkey"), "comment": comment})
    return standins.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.sha2(text, 256).alias("digest"))


@query(
    """SELECT s_suppkey AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'LAB ' || s_name WHEN s_suppkey % 3 = 0 THEN 'LAB ' WHEN s_suppkey % 5 = 0 THEN 'OTHER ' || s_name ELSE s_name END AS printed FROM supplier"""
)
def serum_labels(spark, sf_dir):
    key = F.col("s_suppkey")
    stored = F.when((key % 2 == 0) | (key % 3 != 0) & (key % 5 != 0), F.concat(F.lit("LAB "), "s_name")).when(key % 3 == 0, "LAB ").otherwise(F.concat(F.lit("OTHER "), "s_name"))
    printing = F.when(key % 2 == 0, "with-lab").otherwise("bare")
    return standins.table(spark, sf_dir, "supplier").select(key.alias("id"), texts.printed_serum_id(stored, F.lit("LAB"), printing).alias("printed"))


@query(
    """SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'NY/21-cell' WHEN 1 THEN 'Ho/21-cell' WHEN 2 THEN 'KW/21-cell' END AS label,
    CASE WHEN p_partkey % 4 < 3 THEN (CASE p_partkey % 4 WHEN 0 THEN 'NEW YORK' WHEN 1 THEN 'HONGO' ELSE 'KANSAS' END) || '/' || p_partkey || '/2021' ELSE 'SHORT/2021' END AS strain, CAST('2020-01-31' AS DATE) AS harvested FROM part"""
)
def vaccine_labels(spark, sf_dir):
    key = F.col("p_partkey")
    place = F.when(key % 4 == 0, "New York").when(key % 4 == 1, "Hongo").otherwise("Kansas")
    name = F.when(key % 4 < 3, F.concat_ws("/", F.lit(" A(H3N2)"), place, key.cast("string"), F.lit("2021"))).otherwise("B/Short/2021")
    label = texts.label(name, F.lit("cell"), {"KANSAS": "KW"})
    return _part(spark, sf_dir).select(key.alias("id"), label.alias("label"), texts.strain_name(name).alias("strain"), texts.passage_date(F.lit("MDCK1 (2020-01-31)")).alias("harvested"))


@query("SELECT p_partkey AS id, p_name || CASE WHEN p_partkey % 2 = 0 THEN ' X-' || p_size ELSE '' END || CASE WHEN p_partkey % 3 = 0 THEN ' ' || p_brand ELSE '' END || ' E3' AS designation FROM part")
def designations(spark, sf_dir):
    key = F.col("p_partkey")
    reassortant = F.when(key % 2 == 0, F.concat(F.lit("X-"), F.col("p_size").cast("string"))).otherwise("")
    notes = F.when(key % 3 == 0, F.array("p_brand")).otherwise(F.array().cast("array<string>"))
    return _part(spark, sf_dir).select(key.alias("id"), texts.designation(F.col("p_name"), reassortant, notes, F.lit("E3 (2021-05-06)")).alias("designation"))


@query("SELECT p_partkey AS id, replace(replace(replace(replace(p_brand || ' & 5% of $' || p_size, '#', '\\#'), '&', '\\&'), '%', '\\%'), '$', '\\$') || ' #_{x}' AS half, replace(p_brand, '#', '\\#') || ' \\textbackslash{}\\{\\}\\textasciitilde{}\\^{}\\_' AS whole FROM part")
def tex_texts(spark, sf_dir):
    part = _part(spark, sf_dir)
    first = F.concat(F.col("p_brand"), F.lit(" & 5% of $"), F.col("p_size").cast("string"))
    half = F.concat(texts.tex_escaped(first), F.lit(" #_{x}"))
    return part.select(F.col("p_partkey").alias("id"), half.alias("half"), texts.tex_escaped(F.concat("p_brand", F.lit(" \\{}~^_"))).alias("whole"))


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 4 = 0 THEN 4611686018427387904 ELSE s_suppkey * 1000003 END AS number FROM supplier")
def id_numbers(spark, sf_dir):
    key = F.col("s_suppkey")
    text = F.when(key % 4 == 0, "EPI_ISL_x1").otherwise(F.concat(F.lit("EPI_ISL_"), (key * 1000003).cast("string")))
    return standins.table(spark, sf_dir, "supplier").select(key.alias("id"), texts.id_number(text).alias("number"))


@query("SELECT doc_id AS id, CASE WHEN doc_id % 3 <> 0 AND doc_id % 4 <> 1 AND doc_id % 5 <> 1 THEN 'aligned:' || sha256(text) ELSE 'raw:' || source END AS identity FROM documents")
def sequence_identity(spark, sf_dir):
    key = F.col("doc_id")
    found = texts.sequence_identity(key % 3 != 0, (key % 4 == 1).cast("int"), (key % 5 == 1).cast("int"), F.col("text"), F.col("source"))
    return standins.table(spark, sf_dir, "documents").select(key.alias("id"), found.alias("identity"))


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 = 0 THEN 0.0 ELSE s_suppkey % 5 + 3.0 END AS basis FROM supplier")
def minimum_bases(spark, sf_dir):
    key = F.col("s_suppkey")
    text = F.when(key % 5 == 0, "none").otherwise((F.lit(80) * F.pow(F.lit(2.0), key % 5)).cast("long").cast("string"))
    return standins.table(spark, sf_dir, "supplier").select(key.alias("id"), texts.minimum_basis(text).alias("basis"))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 7 <> 0 THEN 'EPI' || c_custkey || '|' || c_name END AS key FROM customer")
def leaf_keys(spark, sf_dir):
    isolate = F.when(F.col("c_custkey") % 7 == 0, "").otherwise(F.concat(F.lit("EPI"), F.col("c_custkey").cast("string")))
    return standins.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), texts.leaf_key(isolate, F.col("c_name")).alias("key"))


@query()
def leaf_ids(spark, sf_dir):
    """BLAKE2b ids of all leaves, from their keys."""
    return leaf_keys(spark, sf_dir).select("id", texts.leaf_id("key").alias("leaf_id"))


@query("SELECT n_nationkey AS id, CASE WHEN n_nationkey % 3 <> 0 THEN '{braces} ' || n_name || ' in ' || n_regionkey || ', ' || n_name END AS text, CASE WHEN n_nationkey % 3 <> 0 THEN 'name,region,name' ELSE 'name,other' END AS names FROM nation")
def templates(spark, sf_dir):
    template = F.when(F.col("n_nationkey") % 3 != 0, "{{braces}} {name} in {region}, {name}").otherwise("{name} {other}")
    values = {"name": F.col("n_name"), "region": F.col("n_regionkey").cast("string")}
    return standins.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), texts.filled(template, values).alias("text"), F.array_join(texts.placeholders(template), ",").alias("names"))


BOXES = "boxes AS (SELECT p_partkey AS id, p_size * 1.0 AS x, p_partkey % 50 * 1.0 AS y, 10.0 + p_size % 7 AS w, 5.0 + p_partkey % 4 AS h FROM part)"


def _boxes(spark, sf_dir):
    rows = _part(spark, sf_dir).select(F.col("p_partkey").alias("id"), (F.col("p_size") * 1.0).alias("x"), (F.col("p_partkey") % 50 * 1.0).alias("y"), (F.col("p_size") % 7 + 10.0).alias("w"), (F.col("p_partkey") % 4 + 5.0).alias("h"))
    return rows, (F.col("x"), F.col("y"), F.col("x") + F.col("w"), F.col("y") + F.col("h"))


@query(f"WITH {BOXES} SELECT id, greatest(0.0, least(x + w, 40.0) - greatest(x, 20.0)) * greatest(0.0, least(y + h, 30.0) - greatest(y, 15.0)) AS area FROM boxes")
def box_overlaps(spark, sf_dir):
    rows, box = _boxes(spark, sf_dir)
    return rows.select("id", shapes.box_overlap(box, tuple(map(F.lit, (20.0, 15.0, 40.0, 30.0)))).alias("area"))


@query(
    # a segment along y = x/2 + 10 from (0, 10) to (60, 40): it meets a box where its two corners lie on different sides and the spans meet
    f"""WITH {BOXES}, p AS (SELECT id, x - 0.5 AS x0, y - 0.5 AS y0, x + w + 0.5 AS x1, y + h + 0.5 AS y1 FROM boxes)
    SELECT id, greatest(0, x0, 2 * (y0 - 10)) <= least(60, x1, 2 * (y1 - 10)) AS hits FROM p"""
)
def segments_through_boxes(spark, sf_dir):
    rows, box = _boxes(spark, sf_dir)
    p, q = (F.lit(0.0), F.lit(10.0)), (F.lit(60.0), F.lit(40.0))
    return rows.select("id", shapes.segment_hits_box(p, q, box).alias("hits"))


@query(f"WITH {BOXES} SELECT id, x < 30.25 AND x + w > 30.25 AS crosses FROM boxes")
def crossing_segments(spark, sf_dir):
    """A box's lower edge against a line that stands on both sides of it."""
    rows, box = _boxes(spark, sf_dir)
    found = shapes.segments_cross((box[0], box[1]), (box[2], box[1]), (F.lit(30.25), F.lit(-1000.0)), (F.lit(30.25), F.lit(1000.0)))
    return rows.select("id", found.alias("crosses"))


@query(
    """WITH RECURSIVE rings(ring, first, size) AS (SELECT 1, 1, 6 UNION ALL SELECT ring + 1, first + size, CAST(floor(2 * pi() * (ring + 1) * (ring + 1)) AS INTEGER) FROM rings WHERE first < 100000),
    clusters AS (SELECT c_nationkey AS cluster, count(*) AS n FROM customer GROUP BY 1), dots AS (SELECT cluster, n, unnest(range(0, n)) AS dot FROM clusters)
    SELECT cluster, dot, CASE WHEN dot = 0 THEN 0.0 ELSE round(ring * 0.5 * cos(2 * pi() * (dot - first) / least(size, n - first)), 9) END AS dx,
    CASE WHEN dot = 0 THEN 0.0 ELSE round(ring * 0.5 * sin(2 * pi() * (dot - first) / least(size, n - first)), 9) END AS dy FROM dots LEFT JOIN rings ON dot >= first AND dot < first + size"""
)
def packed_dots(spark, sf_dir):
    clusters = standins.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("cluster")).agg(F.count("*").alias("n"))
    return shapes.packed(clusters, "cluster", "n", 0.5).withColumn("dx", F.round("dx", 9) + 0.0).withColumn("dy", F.round("dy", 9) + 0.0)


@query(
    """WITH RECURSIVE rings(ring, first) AS (SELECT 1, 1 UNION ALL SELECT ring + 1, first + 6 * ring FROM rings WHERE first < 100000),
    clusters AS (SELECT c_nationkey AS cluster, count(*) AS n FROM customer GROUP BY 1), dots AS (SELECT cluster, n, unnest(range(0, n)) AS dot FROM clusters)
    SELECT cluster, dot, CASE WHEN dot = 0 THEN 0.0 ELSE round(ring * 0.5 * cos(2 * pi() * (dot - first) / (6 * ring)), 9) END AS dx,
    CASE WHEN dot = 0 THEN 0.0 ELSE round(ring * 0.5 * sin(2 * pi() * (dot - first) / (6 * ring)), 9) END AS dy FROM dots LEFT JOIN rings ON dot >= first AND dot < first + 6 * ring"""
)
def honeycomb_dots(spark, sf_dir):
    clusters = standins.table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("cluster")).agg(F.count("*").alias("n"))
    return shapes.packed(clusters, "cluster", "n", 0.5, hexagonal=True).withColumn("dx", F.round("dx", 9) + 0.0).withColumn("dy", F.round("dy", 9) + 0.0)


@query(f"WITH {BOXES} SELECT id, CASE WHEN x + w + 2 > 45 THEN 43 - x - w WHEN x - 2 < -45 THEN -43 - x ELSE 0.0 END AS shift FROM boxes")
def inward_shifts(spark, sf_dir):
    rows, box = _boxes(spark, sf_dir)
    return rows.select("id", shapes.inward_shift(box[0], box[2], 2.0, 45.0).alias("shift"))


@query("SELECT s_suppkey AS id, round(CASE WHEN s_suppkey * 37 % 360 >= 180 THEN s_suppkey * 37 % 360 - 360 ELSE s_suppkey * 37 % 360 END, 6) + 0.0 AS degrees, s_suppkey % 2 = 0 AS reflected FROM supplier WHERE s_suppkey * 37 % 360 <> 180")
def rotations(spark, sf_dir):
    """A rotation's matrix and back; half a turn, whose sign is a matter of rounding, left out on both sides."""
    key = F.col("s_suppkey")
    turn = (key * 37 % 360).cast("double")
    degrees, reflected = shapes.decomposed(shapes.rotation(turn, key % 2 == 0))
    return standins.table(spark, sf_dir, "supplier").where(key * 37 % 360 != 180).select(key.alias("id"), (F.round(degrees, 6) + 0.0).alias("degrees"), reflected.alias("reflected"))


@query(
    """WITH p AS (SELECT p_partkey AS id, p_partkey % 256 AS r, p_size * 5 AS g, CASE WHEN p_partkey % 4 = 0 THEN p_partkey % 256 ELSE 0 END AS b, p_partkey % 4 = 0 AS grey FROM part),
    v AS (SELECT id, CASE WHEN grey THEN r ELSE r END / 255.0 AS r, CASE WHEN grey THEN r ELSE g END / 255.0 AS g, CASE WHEN grey THEN r ELSE b END / 255.0 AS b FROM p),
    m AS (SELECT *, greatest(r, g, b) AS v, least(r, g, b) AS l FROM v),
    n AS (SELECT *, CASE WHEN v = l THEN CASE WHEN v = 0 THEN 0.5 ELSE least(1.0, v / 0.4) END ELSE v + (1 - v) * (1 - CAST(0.4 AS DOUBLE)) END AS nv FROM m)
    SELECT id, CAST(round(CASE WHEN v = l THEN nv ELSE nv * (1 - 0.4 * (v - r) / v) END * 255) AS INTEGER) AS red, CAST(round(CASE WHEN v = l THEN nv ELSE nv * (1 - 0.4 * (v - g) / v) END * 255) AS INTEGER) AS green FROM n"""
)
def pale_colours(spark, sf_dir):
    key, grey = F.col("p_partkey"), F.col("p_partkey") % 4 == 0
    two = lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")
    red = key % 256
    colour = F.concat(F.lit("#"), two(red), two(F.when(grey, red).otherwise(F.col("p_size") * 5)), two(F.when(grey, red).otherwise(0)))
    part = lambda at: F.conv(F.substring(shapes.pale(colour), at, 2), 16, 10).cast("int")
    return _part(spark, sf_dir).select(key.alias("id"), part(2).alias("red"), part(4).alias("green"))


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 5 = 0 THEN 'window' WHEN p_partkey % 3 = 0 THEN CASE WHEN p_partkey % 2 = 0 AND p_size <= 25 THEN 'open' ELSE 'grey' END END AS grey FROM part")
def point_greys(spark, sf_dir):
    key = F.col("p_partkey")
    grey = shapes.grey_of(key % 5 == 0, F.when(key % 3 != 0, "red"), key % 2 == 0, F.col("p_size") > 25)
    return _part(spark, sf_dir).select(key.alias("id"), grey.alias("grey"))

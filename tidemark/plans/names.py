"""Queries on names, dates, keys and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.operators import order
from tidemark.sources import standins

from .registry import query

RAW = """
raw AS (
  SELECT p_partkey AS id, CASE WHEN p_partkey % 9 = 0 THEN p_name ELSE
    ' a / ' || p_name || ' /' || CASE WHEN p_partkey % 2 = 0 THEN '00' ELSE '' END || CAST(p_partkey AS VARCHAR) || '/' ||
    CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey % 60 + 10 AS VARCHAR) ELSE CAST(1970 + p_partkey % 50 AS VARCHAR) END ||
    CASE WHEN p_partkey % 5 = 0 THEN ' (' || p_type || ')' ELSE '' END END AS name,
    CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 2020 END AS collected FROM part),
clean AS (
  SELECT *, trim(regexp_replace(regexp_replace(upper(trim(regexp_replace(name, '\\s+', ' ', 'g'))), ' ?/ ?', '/', 'g'), '\\s*\\([^()]*\\)$', '')) AS text FROM raw),
split AS (SELECT *, string_split(text, '/') AS parts FROM clean)"""


def _raw(spark, sf_dir):
    key = F.col("p_partkey")
    year = F.when(key % 3 == 0, (key % 60 + 10).cast("string")).otherwise((key % 50 + 1970).cast("string"))
    note = F.when(key % 5 == 0, F.concat(F.lit(" ("), "p_type", F.lit(")"))).otherwise("")
    made = F.concat(F.lit(" a / "), "p_name", F.lit(" /"), F.when(key % 2 == 0, "00").otherwise(""), key.cast("string"), F.lit("/"), year, note)
    part = standins.table(spark, sf_dir, "part")
    return part.select(key.alias("id"), F.when(key % 9 == 0, F.col("p_name")).otherwise(made).alias("name"), F.when(key % 4 != 0, 2020).alias("collected"))


def normalised(rows):
    """id, location, isolate, year and problem code of raw names."""
    text = names.without_note(names.collapsed(F.col("name")))
    cut = rows.withColumn("parts", F.split(text, "/"))
    shaped = F.size("parts") >= 4
    digits = F.element_at("parts", -1)
    year = names.full_year(digits, F.col("collected"))
    problem = F.when(~shaped, "name.shape").when(year.isNull(), "name.year").otherwise("")
    return cut.select(
        "id",
        F.when(shaped, F.element_at("parts", 2)).alias("location"),
        F.when(shaped, names.isolate(F.element_at("parts", -2))).alias("isolate"),
        F.when(shaped, year).alias("year"),
        problem.alias("problem"),
    )


NORMALISED = (
    RAW
    + """,
named AS (
  SELECT id, CASE WHEN len(parts) >= 4 THEN parts[2] END AS location, CASE WHEN len(parts) >= 4 THEN regexp_replace(parts[-2], '^0+([0-9])', '\\1') END AS isolate,
    CASE WHEN len(parts) >= 4 THEN CASE WHEN length(parts[-1]) = 4 THEN CAST(parts[-1] AS INTEGER)
      WHEN collected IS NOT NULL THEN collected - ((collected - CAST(parts[-1] AS INTEGER)) % 100) END END AS year, len(parts) AS n FROM split)"""
)


@query(
    f"""WITH {NORMALISED} SELECT id, location, isolate, year,
    CASE WHEN n < 4 THEN 'name.shape' WHEN year IS NULL THEN 'name.year' ELSE '' END AS problem FROM named"""
)
def name_normalise(spark, sf_dir):
    return normalised(_raw(spark, sf_dir))


@query(
    f"""WITH {NORMALISED} SELECT CASE WHEN n < 4 THEN 'name.shape' WHEN year IS NULL THEN 'name.year' ELSE '' END AS problem, count(*) AS n FROM named GROUP BY 1"""
)
def name_problems(spark, sf_dir):
    return normalised(_raw(spark, sf_dir)).groupBy("problem").agg(F.count("*").alias("n"))


DATES = """
texts AS (
  SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m')
    WHEN 2 THEN strftime(o_orderdate, '%Y') ELSE strftime(o_orderdate, '%y') END AS text FROM orders),
dates AS (
  SELECT id, text, CASE length(text) WHEN 10 THEN 'day' WHEN 7 THEN 'month' WHEN 4 THEN 'year' END AS precision,
    CASE length(text) WHEN 10 THEN CAST(text AS DATE) WHEN 7 THEN CAST(text || '-01' AS DATE) WHEN 4 THEN CAST(text || '-01-01' AS DATE) END AS first,
    CASE length(text) WHEN 10 THEN CAST(text AS DATE) WHEN 7 THEN last_day(CAST(text || '-01' AS DATE)) WHEN 4 THEN CAST(text || '-12-31' AS DATE) END AS last FROM texts)"""


def _dates(spark, sf_dir):
    key, date = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    text = F.when(key % 4 == 0, F.date_format(date, "yyyy-MM-dd")).when(key % 4 == 1, F.date_format(date, "yyyy-MM")).when(key % 4 == 2, F.date_format(date, "yyyy")).otherwise(F.date_format(date, "yy"))
    rows = standins.table(spark, sf_dir, "orders").select(key.alias("id"), text.alias("text"))
    t = F.col("text")
    return rows.select("id", "text", names.partial_precision(t).alias("precision"), names.partial_first(t).alias("first"), names.partial_last(t).alias("last"))


@query(f"WITH {DATES} SELECT * FROM dates")
def partial_dates(spark, sf_dir):
    return _dates(spark, sf_dir)


@query(
    f"""WITH {DATES} SELECT id, first >= DATE '1998-01-01' AS on_or_after, first <= DATE '1998-06-30' AND last >= DATE '1998-03-01' AS overlaps,
    first + CAST(floor((last - first) / 2) AS INTEGER) AS midpoint FROM dates WHERE precision IS NOT NULL"""
)
def interval_overlap(spark, sf_dir):
    rows = _dates(spark, sf_dir).where("precision is not null")
    overlaps = (F.col("first") <= F.lit("1998-06-30").cast("date")) & (F.col("last") >= F.lit("1998-03-01").cast("date"))
    return rows.select("id", (F.col("first") >= F.lit("1998-01-01").cast("date")).alias("on_or_after"), overlaps.alias("overlaps"), names.midpoint(F.col("first"), F.col("last")).alias("midpoint"))


@query(
    """SELECT p_partkey AS id, CASE WHEN p_partkey % 6 <> 0 AND p_partkey % 7 <> 0 THEN
    substring(sha256(length(p_name) || ':' || p_name || length(p_brand) || ':' || p_brand || '0:' || length(p_type) || ':' || p_type), 1, 16) END AS identity FROM part"""
)
def identity_key(spark, sf_dir):
    part = standins.table(spark, sf_dir, "part")
    annotations = F.when(F.col("p_partkey") % 6 == 0, "DISTINCT").otherwise("")
    passage = F.when(F.col("p_partkey") % 7 == 0, "").otherwise(F.col("p_type"))
    return part.select(F.col("p_partkey").alias("id"), names.identity(annotations, passage, F.col("p_name"), F.col("p_brand")).alias("identity"))


NUCLEOTIDES = """
sequences AS (
  SELECT doc_id AS id, translate(regexp_replace(upper(text), '[^ACGTEINOR-]', '', 'g'), 'EINOR', 'ACGTN') AS nuc FROM documents)"""


def _sequences(spark, sf_dir):
    letters = F.regexp_replace(F.upper("text"), "[^ACGTEINOR-]", "")
    return standins.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.translate(letters, "EINOR", "ACGTN").alias("nuc"))


CODE = ", ".join(
    f"('{a}{b}{c}', '{names.AMINO_ACIDS[16 * i + 4 * j + k]}')"
    for i, a in enumerate(names.BASES)
    for j, b in enumerate(names.BASES)
    for k, c in enumerate(names.BASES)
)


@query(
    f"""WITH {NUCLEOTIDES}, code(codon, aa) AS (VALUES {CODE}),
    lists AS (SELECT id, regexp_extract_all(nuc, '...') AS list FROM sequences),
    codons AS (SELECT id, unnest(list) AS codon, generate_subscripts(list, 1) AS i FROM lists),
    joined AS (SELECT c.id, string_agg(CASE WHEN c.codon = '---' THEN '-' ELSE coalesce(aa, 'X') END, '' ORDER BY i) AS protein FROM codons c LEFT JOIN code USING (codon) GROUP BY 1)
    SELECT s.id, coalesce(j.protein, '') AS protein FROM sequences s LEFT JOIN joined j USING (id)"""
)
def codon_translate(spark, sf_dir):
    return _sequences(spark, sf_dir).select("id", names.translated(F.col("nuc")).alias("protein"))


LOCI = [(7, "T"), (250, "A"), (4000, "C")]


@query(
    f"""WITH {NUCLEOTIDES}, loci(locus, state) AS (VALUES {", ".join(map(str, LOCI))}) SELECT locus, evidence, count(*) AS n FROM (
    SELECT locus, CASE WHEN length(nuc) < locus OR substring(nuc, locus, 1) = 'N' THEN 'unobservable'
    WHEN substring(nuc, locus, 1) = state THEN 'equal' ELSE 'contradicts' END AS evidence FROM sequences, loci) GROUP BY 1, 2"""
)
def locus_evidence(spark, sf_dir):
    at = F.explode(F.array(*[F.struct(F.lit(p).alias("locus"), F.lit(s).alias("state")) for p, s in LOCI])).alias("at")
    rows = _sequences(spark, sf_dir).select("nuc", at)
    found = names.evidence(F.col("nuc"), F.col("at.locus"), F.col("at.state"), unknown="N")
    return rows.select(F.col("at.locus").alias("locus"), found.alias("evidence")).groupBy("locus", "evidence").agg(F.count("*").alias("n"))


@query(
    f"""WITH {NUCLEOTIDES}, ref AS (SELECT nuc AS ref FROM sequences ORDER BY id LIMIT 1),
    left_sites AS (SELECT id, length(nuc) AS size, unnest(string_split(nuc, '')) AS a, generate_subscripts(string_split(nuc, ''), 1) AS i FROM sequences),
    ref_sites AS (SELECT unnest(string_split(ref, '')) AS b, generate_subscripts(string_split(ref, ''), 1) AS i FROM ref),
    counted AS (SELECT id, max(size) AS size, count(*) FILTER (WHERE a IN ('A','C','G','T') AND b IN ('A','C','G','T')) AS n, count(*) FILTER (WHERE a IN ('A','C','G','T') AND b IN ('A','C','G','T') AND a <> b) AS d
      FROM left_sites LEFT JOIN ref_sites USING (i) GROUP BY 1)
    SELECT s.id, CASE WHEN n > 0 AND n >= 0.5 * greatest(size, (SELECT length(ref) FROM ref)) THEN round(d * 1.0 / n, 9) END AS distance FROM sequences s LEFT JOIN counted USING (id)"""
)
def p_distance(spark, sf_dir):
    rows = _sequences(spark, sf_dir)
    reference = rows.agg(F.min_by("nuc", "id").alias("ref"))  # one row
    both = rows.join(F.broadcast(reference))
    return both.select("id", F.round(names.p_distance(F.col("nuc"), F.col("ref"), least=0.5), 9).alias("distance"))


@query(
    """SELECT cls AS passage_class, count(*) AS n FROM (SELECT CASE
      WHEN p LIKE '%E3%' THEN 'egg' WHEN p LIKE '%MDCK%' THEN 'cell' WHEN p = 'OR' THEN 'original' ELSE 'unknown' END AS cls FROM (
      SELECT CASE p_partkey % 5 WHEN 0 THEN 'E3/E2' WHEN 1 THEN 'MDCK1/SIAT2' WHEN 2 THEN 'OR' WHEN 3 THEN '' ELSE 'MDCK2/E3' END AS p FROM part)) GROUP BY 1"""
)
def passage_classes(spark, sf_dir):
    key = F.col("p_partkey") % 5
    passage = F.when(key == 0, "E3/E2").when(key == 1, "MDCK1/SIAT2").when(key == 2, "OR").when(key == 3, "").otherwise("MDCK2/E3")
    return standins.table(spark, sf_dir, "part").select(names.passage_class(passage).alias("passage_class")).groupBy("passage_class").agg(F.count("*").alias("n"))


@query(
    """SELECT score, count(*) AS n FROM (SELECT CASE WHEN a.p_type <> b.p_type THEN 0 WHEN a.p_size % 4 = 0 OR b.p_size % 4 = 0 THEN 1
      WHEN a.p_size % 3 = b.p_size % 3 THEN 2 ELSE 0 END AS score FROM part a JOIN part b ON a.p_partkey + 1 = b.p_partkey) GROUP BY 1"""
)
def passage_scores(spark, sf_dir):
    part = standins.table(spark, sf_dir, "part")
    dated = F.when(F.col("p_size") % 4 != 0, F.col("p_size") % 3)
    a = part.select((F.col("p_partkey") + 1).alias("key"), F.col("p_type").alias("steps_a"), dated.alias("date_a"))
    b = part.select(F.col("p_partkey").alias("key"), F.col("p_type").alias("steps_b"), dated.alias("date_b"))
    score = names.passage_score(F.col("steps_a"), F.col("date_a"), F.col("steps_b"), F.col("date_b"))
    return a.join(b, "key").select(score.alias("score")).groupBy("score").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey AS id, CAST((CAST(s_suppkey * 37 % 720 AS DOUBLE) - 150 + 180) - floor((CAST(s_suppkey * 37 % 720 AS DOUBLE) - 150 + 180) / 360) * 360 - 180 + 150 AS DOUBLE) AS longitude FROM supplier")
def wrap_longitude(spark, sf_dir):
    turned = (F.col("s_suppkey") * 37 % 720).cast("double")
    return standins.table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), names.wrapped_longitude(turned, F.lit(150.0)).alias("longitude"))


@query("SELECT key, row_number() OVER (ORDER BY n) AS place FROM (SELECT 'id ' || CAST(s_suppkey * 7 % 1009 AS VARCHAR) AS key, s_suppkey * 7 % 1009 AS n FROM supplier)")
def natural_order(spark, sf_dir):
    keys = standins.table(spark, sf_dir, "supplier").select(F.concat(F.lit("id "), (F.col("s_suppkey") * 7 % 1009).cast("string")).alias("key"))
    return order.numbered(keys, [names.natural(F.col("key"))])

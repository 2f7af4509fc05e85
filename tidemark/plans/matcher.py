"""Queries of the whole matcher."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import matcher
from tidemark.sources import standins

from .registry import query

LABS = [("A", "sub0"), ("A", "sub1"), ("B", "sub2"), ("C", "sub3")]
PASSAGES = ["E3", "MDCK1", "MDCK2/SIAT1", "OR", "", "E3/E1"]
_PASSAGE = lambda column: "CASE " + column + " % 6 " + " ".join(f"WHEN {i} THEN '{p}'" for i, p in enumerate(PASSAGES)) + " END"

MATCHER = f"""
cand AS (SELECT 'EPI_ISL_' || p_partkey AS epi, 'EPI' || p_partkey % 11 AS accession, 'LOC ' || p_partkey % 23 AS loc, CAST(p_size % 12 AS VARCHAR) AS iso, '2020' AS yr,
  CASE p_partkey % 4 WHEN 0 THEN 'egg' WHEN 1 THEN 'cell' WHEN 2 THEN 'original' ELSE 'unknown' END AS class, {_PASSAGE('p_partkey')} AS passage, 'id' || p_partkey % 3 AS identity, 'sub' || p_partkey % 5 AS submitter, p_partkey AS num FROM part),
pts AS (SELECT p_partkey AS point, CASE WHEN p_partkey % 7 < 2 THEN 'EPI_ISL_' || p_partkey WHEN p_partkey % 7 = 2 THEN 'EPI_ISL_x' ELSE '' END AS stated,
  CASE p_partkey % 7 WHEN 1 THEN 'ELSEWHERE' WHEN 4 THEN 'LOC' || p_partkey % 23 WHEN 5 THEN 'ALIAS ' || p_partkey % 23 WHEN 6 THEN CASE WHEN p_size < 10 THEN NULL ELSE 'LOC-' || p_partkey % 29 || ' X' END ELSE 'LOC ' || p_partkey % 23 END AS loc,
  CAST(p_size % 12 AS VARCHAR) AS iso, CASE WHEN p_partkey % 7 = 3 AND p_size = 7 THEN '2021' ELSE '2020' END AS yr, CASE p_size % 3 WHEN 0 THEN 'egg' WHEN 1 THEN 'cell' ELSE 'original' END AS wanted, {_PASSAGE('p_size')} AS passage,
  CASE WHEN p_partkey % 10 = 0 THEN 'X-1' ELSE '' END AS reassortant, CASE p_partkey % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS lab FROM part),
subs(lab, submitter) AS (VALUES {", ".join(map(str, LABS))}),
equiv AS (SELECT 'A' AS lab, 'ALIAS ' || i AS loc, 'LOC ' || i AS other FROM range(0, 23) r(i)), numrules(lab, scope) AS (VALUES ('B', 'province'), ('C', 'national'))"""


def _judge(name: str, pairs: str) -> str:
    """Common table expressions of the choice among the candidates of `pairs`: {name}_t are the rows that stay, {name}_r the results."""
    has = lambda c: f"list_contains(classes, '{c}')"
    last = lambda c: f"regexp_extract({c}, '([A-Z]+[0-9]*)$', 1)"
    rank = f"""CASE WHEN passage = '' OR c_passage = '' THEN 90 WHEN passage = c_passage THEN 0 WHEN {last('passage')} = {last('c_passage')} THEN 10
      WHEN regexp_extract({last('passage')}, '[A-Z]+') = regexp_extract({last('c_passage')}, '[A-Z]+') THEN 20 WHEN (wanted = 'egg') = (class = 'egg') THEN 50 ELSE 90 END"""
    return f"""
{name}_c AS (SELECT *, passage <> '' AND class <> 'unknown' AND passage = c_passage AS exact, list(class) OVER (PARTITION BY point) AS classes, {rank} AS rank FROM ({pairs})),
{name}_u AS (SELECT *, CASE WHEN wanted = 'egg' THEN CASE WHEN {has('egg')} THEN 'egg' WHEN {has('original')} THEN 'original' WHEN {has('cell')} THEN 'cell' ELSE 'any' END
    WHEN wanted = 'cell' THEN CASE WHEN {has('cell')} THEN 'cell' WHEN {has('original')} THEN 'original' ELSE 'any' END ELSE CASE WHEN list_contains(classes, wanted) THEN wanted ELSE 'any' END END AS use,
  CASE WHEN wanted = 'egg' AND NOT {has('egg')} THEN '{matcher.EGG_WITHOUT_EGG}' WHEN wanted = 'cell' AND NOT {has('cell')} THEN CASE WHEN {has('original')} THEN '{matcher.CELL_FROM_ORIGINAL}' WHEN {has('egg')} THEN '{matcher.CELL_FROM_EGG}' END END AS picked FROM {name}_c),
{name}_o AS (SELECT *, len(list_distinct(list(identity) OVER (PARTITION BY point))) > 1 AND len(list_distinct(list(CASE WHEN own THEN identity END) OVER (PARTITION BY point))) = 1 AS by_own FROM {name}_u WHERE use = 'any' OR use = class),
{name}_t AS (SELECT * FROM {name}_o WHERE own OR NOT by_own),
{name}_g AS (SELECT point, any_value(picked) AS picked, bool_or(by_own) AS by_own, count(*) AS n, count(DISTINCT identity) AS k, count(*) FILTER (WHERE own) AS n_own, count(*) FILTER (WHERE exact) AS n_exact, count(*) FILTER (WHERE own AND exact) AS n_both,
  arg_min({{'epi': epi, 'accession': accession}}, (NOT own, NOT exact, rank, num, accession)) AS best FROM {name}_t GROUP BY 1),
{name}_r AS (SELECT point, CASE WHEN k = 1 THEN best END AS chosen, list_filter([picked, CASE WHEN by_own THEN '{matcher.OWN_LAB}' END, CASE WHEN k = 1 AND n > 1 THEN '{matcher.IDENTICAL}' END, CASE WHEN k = 1 AND n > 1 AND n_own > 0 AND n_own < n THEN '{matcher.OWN_LAB}' END,
  CASE WHEN k = 1 AND n > 1 AND (CASE WHEN n_own > 0 AND n_own < n THEN n_both > 0 AND n_both < n_own ELSE n_exact > 0 AND n_exact < n END) THEN '{matcher.PASSAGE_EXACT}' END, CASE WHEN k > 1 THEN '{matcher.AMBIGUOUS}' END], lambda x: x IS NOT NULL) AS flags FROM {name}_g)"""


def _pairs(source: str, on: str, own: str = "s.lab IS NOT NULL", extra: str = "") -> str:
    return f"""SELECT p.point, p.wanted, p.passage, c.epi, c.accession, c.identity, c.class, c.passage AS c_passage, c.num, c.loc AS c_loc, {own} AS own FROM {source} p {extra} JOIN cand c ON {on} LEFT JOIN subs s ON s.lab = p.lab AND s.submitter = c.submitter"""


REST = "c.iso = p.iso AND c.yr = p.yr"
SQUASH = "regexp_replace({}, '[^A-Z0-9]', '', 'g')"
PROVINCE = "CASE WHEN n.scope = 'province' THEN split_part({}, ' ', 1) ELSE '' END"

MATCHED = f"""{MATCHER},
epi_g AS (SELECT p.point, bool_or(p.loc IS DISTINCT FROM c.loc OR p.iso <> c.iso OR p.yr <> c.yr) AS differs, min({{'epi': c.epi, 'accession': c.accession}}) AS best FROM pts p JOIN cand c ON p.stated = c.epi GROUP BY 1),
rest AS (SELECT * FROM pts WHERE point NOT IN (SELECT point FROM epi_g)), keyed AS (SELECT * FROM rest WHERE loc IS NOT NULL),
{_judge('nm', _pairs('keyed', f'c.loc = p.loc AND {REST}'))},
left2 AS (SELECT * FROM keyed WHERE point NOT IN (SELECT point FROM nm_r)),
{_judge('fm', _pairs('left2', f"{SQUASH.format('c.loc')} = {SQUASH.format('p.loc')} AND {REST}"))},
left3 AS (SELECT * FROM left2 WHERE point NOT IN (SELECT point FROM fm_r)),
{_judge('eq', _pairs('left3', f'c.loc = e.other AND {REST}', extra='JOIN equiv e ON e.lab = p.lab AND e.loc = p.loc'))},
named AS (SELECT point, 'name' AS method, chosen, flags FROM nm_r UNION ALL SELECT point, 'location-forms', chosen, list_append(flags, '{matcher.SPACING}') FROM fm_r UNION ALL SELECT point, 'equivalent', chosen, list_append(flags, '{matcher.EQUIVALENT}') FROM eq_r),
ties AS (SELECT point, epi, accession, identity, exact, own, rank, num FROM nm_t UNION ALL SELECT point, epi, accession, identity, exact, own, rank, num FROM fm_t UNION ALL SELECT point, epi, accession, identity, exact, own, rank, num FROM eq_t),
by_name AS (SELECT * FROM named UNION ALL SELECT point, NULL, NULL, ['{matcher.NONE}'] FROM rest WHERE point NOT IN (SELECT point FROM named)),
open_pts AS (SELECT k.*, n.scope FROM keyed k JOIN by_name b USING (point) JOIN numrules n ON n.lab = k.lab WHERE b.chosen IS NULL),
nump AS (SELECT p.point, p.wanted, p.passage, c.epi, c.accession, c.identity, c.class, c.passage AS c_passage, c.num, c.loc AS c_loc, false AS own FROM open_pts p JOIN numrules n ON n.lab = p.lab JOIN cand c ON {REST} AND {PROVINCE.format('c.loc')} = {PROVINCE.format('p.loc')}
  JOIN subs s ON s.lab = p.lab AND s.submitter = c.submitter),
dist AS (SELECT point, count(DISTINCT c_loc) AS d FROM nump GROUP BY 1),
{_judge('nu', 'SELECT * FROM nump WHERE point IN (SELECT point FROM dist WHERE d = 1)')},
numbered AS (SELECT b.point, CASE WHEN u.point IS NOT NULL THEN 'number' ELSE b.method END AS method, coalesce(u.chosen, b.chosen) AS chosen,
  CASE WHEN u.point IS NOT NULL THEN list_append(list_concat(list_filter(b.flags, lambda x: x NOT IN ('{matcher.NONE}', '{matcher.AMBIGUOUS}')), u.flags), '{matcher.LAB_NUMBER}') WHEN d.d > 1 THEN list_append(b.flags, '{matcher.COLLISION}') ELSE b.flags END AS flags
  FROM by_name b LEFT JOIN (SELECT * FROM nu_r WHERE chosen IS NOT NULL) u ON u.point = b.point LEFT JOIN dist d ON d.point = b.point),
openties AS (SELECT t.* FROM ties t JOIN numbered n ON n.point = t.point WHERE n.chosen IS NULL),
same AS (SELECT point, count(*) AS n, count(*) FILTER (WHERE own) AS n_own, arg_min({{'epi': epi, 'accession': accession}}, (NOT own, rank, num, accession)) AS best FROM openties WHERE exact GROUP BY 1 HAVING count(DISTINCT identity) = 1),
settled AS (SELECT n.point, n.method, coalesce(s.best, n.chosen) AS chosen, CASE WHEN s.point IS NOT NULL THEN list_concat(list_filter(n.flags, lambda x: x <> '{matcher.AMBIGUOUS}'), list_filter([CASE WHEN s.n > 1 THEN '{matcher.IDENTICAL}' END, CASE WHEN s.n > 1 AND n_own > 0 AND n_own < s.n THEN '{matcher.OWN_LAB}' END, '{matcher.PASSAGE_EXACT}'], lambda x: x IS NOT NULL)) ELSE n.flags END AS flags
  FROM numbered n LEFT JOIN same s ON s.point = n.point),
tied AS (SELECT point, count(*) AS n_tied, arg_min(epi, (rank, num, accession)) AS ranked FROM openties GROUP BY 1),
every AS (SELECT point, 'epi' AS method, best AS chosen, CASE WHEN differs THEN ['{matcher.EPI_NAME_DIFFERS}'] ELSE CAST([] AS VARCHAR[]) END AS flags FROM epi_g UNION ALL SELECT * FROM settled),
flagged AS (SELECT e.point, e.method, e.chosen, t.n_tied, t.ranked, list_sort(list_distinct(list_concat(e.flags, list_filter([CASE WHEN p.reassortant <> '' THEN '{matcher.REASSORTANT}' END, CASE WHEN p.stated <> '' AND e.method IS DISTINCT FROM 'epi' THEN '{matcher.EPI_NOT_IN_STORE}' END], lambda x: x IS NOT NULL)))) AS flags
  FROM every e JOIN pts p ON p.point = e.point LEFT JOIN tied t ON t.point = e.point),
final AS (SELECT point, method, chosen.epi AS epi, chosen.accession AS accession, array_to_string(flags, ' ') AS flags, CASE WHEN chosen IS NULL THEN coalesce(n_tied, 0) ELSE 0 END AS n_tied, CASE WHEN chosen IS NULL THEN ranked END AS ranked,
  CASE WHEN chosen IS NULL THEN 'unmatched' WHEN list_has_any(flags, [{", ".join(f"'{f}'" for f in matcher.DOUBTFUL)}]) THEN 'doubtful' ELSE 'matched' END AS status FROM flagged)"""


def _inputs(spark, sf_dir):
    part = standins.table(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    made = F.array(*map(F.lit, PASSAGES))
    text = lambda c: c.cast("string")
    candidates = part.select(
        F.concat(F.lit("EPI_ISL_"), text(key)).alias("epi"),
        F.concat(F.lit("EPI"), text(key % 11)).alias("accession"),
        F.concat(F.lit("LOC "), text(key % 23)).alias("location"),
        text(size % 12).alias("isolate"),
        F.lit("2020").alias("year"),
        F.when(key % 4 == 0, "egg").when(key % 4 == 1, "cell").when(key % 4 == 2, "original").otherwise("unknown").alias("class"),
        F.get(made, key % 6).alias("passage"),
        F.concat(F.lit("id"), text(key % 3)).alias("identity"),
        F.concat(F.lit("sub"), text(key % 5)).alias("submitter"),
    )
    kind, place = key % 7, text(key % 23)
    far = F.when(size >= 10, F.concat(F.lit("LOC-"), text(key % 29), F.lit(" X")))
    location = F.when(kind == 1, "ELSEWHERE").when(kind == 4, F.concat(F.lit("LOC"), place)).when(kind == 5, F.concat(F.lit("ALIAS "), place)).when(kind == 6, far).otherwise(F.concat(F.lit("LOC "), place))
    points = part.select(
        key.alias("point"),
        F.when(kind < 2, F.concat(F.lit("EPI_ISL_"), text(key))).when(kind == 2, "EPI_ISL_x").otherwise("").alias("stated"),
        location.alias("location"),
        text(size % 12).alias("isolate"),
        F.when((kind == 3) & (size == 7), "2021").otherwise("2020").alias("year"),
        F.when(size % 3 == 0, "egg").when(size % 3 == 1, "cell").otherwise("original").alias("wanted"),
        F.get(made, size % 6).alias("passage"),
        F.when(key % 10 == 0, "X-1").otherwise("").alias("reassortant"),
        F.when(key % 3 == 0, "A").when(key % 3 == 1, "B").otherwise("C").alias("lab"),
    )
    submitters = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, LABS))} AS t(lab, submitter)")
    equivalents = spark.range(23).select(F.lit("A").alias("lab"), F.concat(F.lit("ALIAS "), text(F.col("id"))).alias("location"), F.concat(F.lit("LOC "), text(F.col("id"))).alias("other"))
    rules = spark.sql("SELECT * FROM VALUES ('B', 'province'), ('C', 'national') AS t(lab, scope)")
    return points, candidates, submitters, equivalents, rules


@query(f"WITH {MATCHED} SELECT * FROM final")
def match_points(spark, sf_dir):
    """Every point through all routes of the matcher."""
    found = matcher.match(*_inputs(spark, sf_dir))
    return found.withColumn("flags", F.array_join(F.array_sort("flags"), " "))


@query(f"WITH {MATCHED} SELECT method, status, count(*) AS n, count(epi) AS n_chosen, sum(n_tied) AS n_tied FROM final GROUP BY 1, 2")
def match_report(spark, sf_dir):
    found = matcher.match(*_inputs(spark, sf_dir))
    return found.groupBy("method", "status").agg(F.count("*").alias("n"), F.count("epi").alias("n_chosen"), F.sum("n_tied").alias("n_tied"))


PREPARED = f"""
rows AS (SELECT l_partkey AS prep, CASE WHEN l_quantity > 48 THEN 'unmatched' WHEN l_linenumber % 3 = 0 THEN 'doubtful' WHEN l_quantity > 40 THEN 'none' ELSE 'matched' END AS kind,
  CASE WHEN l_quantity > 48 THEN '{matcher.AMBIGUOUS}' WHEN l_linenumber % 6 = 3 THEN '{matcher.EGG_WITHOUT_EGG}' WHEN l_linenumber % 6 = 0 THEN '{matcher.SEVERAL}' ELSE 'match.own-lab' END AS flag,
  l_suppkey % 9 AS num, 'id' || l_suppkey % 3 AS identity, CASE l_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'C' END AS clade, (l_suppkey + l_partkey) % 3 AS score FROM lineitem WHERE l_partkey % 5 <> 0 OR l_quantity > 40),
lv AS (SELECT *, CASE WHEN kind = 'matched' THEN 1 WHEN kind = 'doubtful' AND flag <> '{matcher.SEVERAL}' THEN 2 WHEN kind = 'unmatched' THEN 3 END AS level FROM rows),
used AS (SELECT * FROM lv WHERE level IS NOT NULL QUALIFY level = min(level) OVER (PARTITION BY prep)),
recs AS (SELECT prep, level, num, any_value(identity) AS identity, any_value(clade) AS clade, max(score) AS score FROM used WHERE level < 3 GROUP BY 1, 2, 3),
best AS (SELECT *, max(score) OVER (PARTITION BY prep) AS most FROM recs),
grp AS (SELECT prep, count(*) AS n, count(DISTINCT identity) = 1 AND count(DISTINCT coalesce(clade, '-')) = 1 AS alike, count(*) FILTER (WHERE score = most AND score > 0) AS n_top, arg_min(num, num) AS lowest, min(num) FILTER (WHERE score = most AND score > 0) AS top FROM best GROUP BY 1),
pick AS (SELECT prep, CASE WHEN n = 1 THEN lowest WHEN alike THEN CASE WHEN n_top = 1 THEN top ELSE lowest END WHEN n_top = 1 THEN top END AS num, CASE WHEN n = 1 THEN '' WHEN alike THEN 'same sequence' WHEN n_top = 1 THEN 'passage matched' WHEN n_top = 0 THEN 'none matches' ELSE 'several match' END AS resolution,
  n > 1 AND NOT alike AS conflict, 0 AS n_tied FROM grp UNION ALL SELECT prep, NULL, 'tied', false, count(DISTINCT t) FROM (SELECT prep, unnest([num, num + 1]) AS t FROM used WHERE level = 3) GROUP BY 1),
doubt AS (SELECT prep, bool_or(level = 2) AS doubted FROM used GROUP BY 1)"""


@query(
    f"""WITH {PREPARED} SELECT p.prep, 'EPI_ISL_' || p.num AS epi, 'A' || p.num AS accession, CASE WHEN p.num IS NOT NULL THEN (SELECT any_value(clade) FROM recs r WHERE r.prep = p.prep AND r.num = p.num) END AS clade, resolution, conflict, n_tied,
    CASE WHEN doubted THEN '{matcher.EGG_WITHOUT_EGG}' ELSE '' END AS doubts FROM pick p JOIN doubt d ON d.prep = p.prep"""
)
def preparation_sequences(spark, sf_dir):
    lines = standins.table(spark, sf_dir, "lineitem").where("l_partkey % 5 <> 0 or l_quantity > 40")
    q, n, s = F.col("l_quantity"), F.col("l_linenumber"), F.col("l_suppkey")
    number = (s % 9).cast("string")
    flag = F.when(q > 48, matcher.AMBIGUOUS).when(n % 6 == 3, matcher.EGG_WITHOUT_EGG).when(n % 6 == 0, matcher.SEVERAL).otherwise(matcher.OWN_LAB)
    rows = lines.select(
        F.col("l_partkey").alias("prep"),
        F.when(q > 48, "unmatched").when(n % 3 == 0, "doubtful").when(q > 40, "none").otherwise("matched").alias("status"),
        F.array(flag).alias("flags"),
        F.concat(F.lit("EPI_ISL_"), number).alias("epi"),
        F.concat(F.lit("A"), number).alias("accession"),
        F.concat(F.lit("id"), (s % 3).cast("string")).alias("identity"),
        F.when(s % 3 == 1, "").when(s % 3 == 2, "C").alias("clade"),
        ((s + F.col("l_partkey")) % 3).alias("score"),
        F.array(s % 9, s % 9 + 1).alias("tied"),
    )
    return matcher.preparation_sequences(rows, "prep").withColumn("doubts", F.array_join("doubts", " "))

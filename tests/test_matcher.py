"""The matcher where many points and records share one name."""

import glob

from tidemark.operators import matcher
from tidemark.session import shared_folder

POINT = "point long, stated string, location string, isolate string, year string, wanted string, passage string, reassortant string, lab string"
RECORD = "epi string, accession string, location string, isolate string, year string, class string, passage string, identity string, submitter string"


def matched(spark, points, records):
    labs = spark.createDataFrame([("A", "sub0"), ("B", "sub1")], "lab string, submitter string")
    other = spark.createDataFrame([("A", "ALIAS", "LYON")], "lab string, location string, other string")
    rules = spark.createDataFrame([("B", "national")], "lab string, scope string")
    return matcher.match(points, records, labs, other, rules)


def test_alike_points_and_records_are_judged_once(spark):
    folder = shared_folder(spark).removeprefix("file://").rstrip("/")
    before = set(glob.glob(f"{folder}/tier-*"))
    n = 2_000
    points = spark.range(n).selectExpr("id as point", "'' as stated", "'LYON' as location", "'7' as isolate", "'2020' as year", "'egg' as wanted", "'E3' as passage", "if(id = 5, 'X-1', '') as reassortant", "if(id % 2 = 0, 'A', 'C') as lab")
    # half of the records are of the one sequence, but only lab A's submitter has just that one
    records = spark.range(n).selectExpr("concat('EPI_ISL_', id) as epi", "'a' as accession", "'LYON' as location", "'7' as isolate", "'2020' as year", "'egg' as class", "if(id % 2 = 0, 'E3', 'E4') as passage", "concat('id', id % 2) as identity", "concat('sub', id % 2 * 2) as submitter")
    found = {r["point"]: r for r in matched(spark, points, records).collect()}
    assert len(found) == n
    assert {(r["epi"], r["status"], r["n_tied"]) for p, r in found.items() if p % 2 == 0} == {("EPI_ISL_0", "matched", 0)}
    # the others are tied, and the sequence of the very passage decides
    assert {r["epi"] for p, r in found.items() if p % 2} == {"EPI_ISL_0"}
    assert matcher.REASSORTANT in found[5]["flags"] and matcher.REASSORTANT not in found[7]["flags"]
    tiers = [t for t in glob.glob(f"{folder}/tier-*") if t not in before]
    assert sum(spark.read.parquet(t).count() for t in tiers) < 100


def test_counts_of_a_tie_are_of_records(spark):
    """What match_report adds up: n_tied counts every record, also those that were judged as one."""
    points = spark.range(3).selectExpr("id as point", "'' as stated", "'LYON' as location", "'7' as isolate", "'2020' as year", "'egg' as wanted", "'' as passage", "'' as reassortant", "'C' as lab")
    records = spark.range(40).selectExpr("concat('EPI_ISL_', 50 - id) as epi", "'a' as accession", "'LYON' as location", "'7' as isolate", "'2020' as year", "'egg' as class", "'E3' as passage", "concat('id', id % 2) as identity", "'sub9' as submitter")
    found = matched(spark, points, records).collect()
    assert [(r["status"], r["n_tied"], r["ranked"]) for r in found] == [("unmatched", 40, "EPI_ISL_11")] * 3


def test_few_tables_are_written_and_all_routes_judged_once(spark):
    """Each written table is a job of its own, which on small inputs was most of the time."""
    folder = shared_folder(spark).removeprefix("file://").rstrip("/")
    before = set(glob.glob(f"{folder}/*"))
    point = lambda key, stated="", location="LYON", isolate="7", lab="C": (key, stated, location, isolate, "2020", "egg", "E3", "", lab)
    record = lambda epi, location="LYON", isolate="7", identity="id0", passage="E3", submitter="sub9": (epi, "a", location, isolate, "2020", "egg", passage, identity, submitter)
    points = [
        point(0), point(1, location="LY-ON"), point(2, location="ALIAS", lab="A"), point(3, location=None), point(4, location="NICE"),
        point(5, stated="EPI_ISL_2"), point(6, stated="EPI_ISL_3"), point(7, stated="EPI_ISL_9"),
        point(8, location="PARIS", isolate="8", lab="B"), point(9, location="PARIS", isolate="9", lab="B"), point(10, isolate="10"),
    ]
    records = [
        record("EPI_ISL_1"), record("EPI_ISL_2", location="OTHER"), record("EPI_ISL_3", isolate="1", identity="id1"), record("EPI_ISL_3", isolate="2", identity="id2"),
        record("EPI_ISL_4", location="ROUEN", isolate="8", submitter="sub1"), record("EPI_ISL_5", location="ROUEN", isolate="9", submitter="sub1"), record("EPI_ISL_6", location="BREST", isolate="9", submitter="sub1"),
        *[record(f"EPI_ISL_{7 + i}0", isolate="10", identity=f"id{i}", passage="E4") for i in range(2)],
    ]
    made = matched(spark, spark.createDataFrame(points, POINT), spark.createDataFrame(records, RECORD))
    found = {r["point"]: (r["method"], r["epi"], sorted(r["flags"]), r["n_tied"], r["status"]) for r in made.collect()}
    assert found == {
        0: ("name", "EPI_ISL_1", [], 0, "matched"),
        1: ("location-forms", "EPI_ISL_1", [matcher.SPACING], 0, "matched"),
        2: ("equivalent", "EPI_ISL_1", [matcher.EQUIVALENT], 0, "matched"),
        3: (None, None, [matcher.NONE], 0, "unmatched"),
        4: (None, None, [matcher.NONE], 0, "unmatched"),
        5: ("epi", "EPI_ISL_2", [matcher.EPI_NAME_DIFFERS], 0, "doubtful"),
        6: ("epi", None, [matcher.EPI_NAME_DIFFERS, matcher.SEVERAL], 0, "unmatched"),
        7: ("name", "EPI_ISL_1", [matcher.EPI_NOT_IN_STORE], 0, "matched"),
        8: ("number", "EPI_ISL_4", [matcher.LAB_NUMBER], 0, "matched"),
        9: (None, None, [matcher.COLLISION, matcher.NONE], 0, "unmatched"),
        10: ("name", None, [matcher.AMBIGUOUS], 2, "unmatched"),
    }
    assert len(set(glob.glob(f"{folder}/*")) - before) <= 5


def test_pairs_stay_few_where_points_and_records_are_alike(spark):
    folder = shared_folder(spark).removeprefix("file://").rstrip("/")
    before = set(glob.glob(f"{folder}/*"))
    points = spark.range(500).selectExpr("id as point", "'' as stated", "'LYON' as location", "'7' as isolate", "'2020' as year", "'egg' as wanted", "'E3' as passage", "'' as reassortant", "'C' as lab")
    records = spark.range(500).selectExpr("concat('EPI_ISL_', id) as epi", "'a' as accession", "'LYON' as location", "'7' as isolate", "'2020' as year", "'egg' as class", "'E3' as passage", "'id0' as identity", "'sub9' as submitter")
    assert {(r["epi"], r["n_tied"]) for r in matched(spark, points, records).collect()} == {("EPI_ISL_0", 0)}
    rows = {name: sum(spark.read.parquet(t).count() for t in set(glob.glob(f"{folder}/{name}-*")) - before) for name in ("profiles", "candidates")}
    assert rows == {"profiles": 1, "candidates": 1}

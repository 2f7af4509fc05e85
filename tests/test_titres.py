"""Worked cells of the censored merge, and the readings' parser."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import titres

CELLS = [
    ("a", ["40", "80"], "num", 57, "regular-only"),
    ("b", ["20", "80"], "num", 40, "regular-only"),
    ("c", ["10", "80"], None, None, "sd-too-big"),
    ("d", ["<10", "<20"], "lt", 10, "less-than-only"),
    ("e", ["<10", ">80"], None, None, "less-and-more-than"),
    ("f", ["<20", "40"], "lt", 80, "less-than-and-regular"),
    ("g", [">40", "80"], "gt", 40, "min-more-than-less-than-min-regular"),
    ("h", [">1280"], None, None, "more-than-only-to-dont-care"),
    ("i", ["*"], None, None, "all-dont-care"),
    ("j", ["<80", "40"], "lt", 80, "max-less-than-bigger-than-max-regular"),
    ("k", [">80", "80"], "gt", 40, "more-than-and-regular"),
    ("l", ["~80", "40"], None, None, "error-dodgy"),
]


@pytest.fixture(scope="module")
def merged(spark):
    rows = [(name, token) for name, tokens, *_ in CELLS for token in tokens]
    frame = titres.parsed(spark.createDataFrame(rows, "cell string, token string"))
    return {r["cell"]: r for r in titres.merge_cells(frame, ["cell"]).collect()}


@pytest.mark.parametrize("name,tokens,kind,value,outcome", CELLS)
def test_cell(merged, name, tokens, kind, value, outcome):
    row = merged[name]
    assert (row["outcome"], row["kind"], row["value"]) == (outcome, kind, value)


def test_more_than_counts_for_bases_only(merged):
    assert (merged["h"]["basis_kind"], merged["h"]["basis_value"]) == ("gt", 1280)


def test_no_limit_keeps_wide_cells(spark):
    rows = titres.parsed(spark.createDataFrame([("c", "10"), ("c", "80")], "cell string, token string"))
    assert titres.merge_cells(rows, ["cell"], sd_limit=None).first()["value"] == 28


def test_tokens(spark):
    tokens = ["40", " <10 ", ">1280", "~80", "*", "", "0", "4x", None, "<<10"]
    rows = titres.parsed(spark.createDataFrame([(t,) for t in tokens], "token string")).collect()
    assert [r["kind"] for r in rows] == ["num", "lt", "gt", "dodgy", "missing", "missing", None, None, None, None]
    assert [r["value"] for r in rows] == [40, 10, 1280, 80, None, None, None, None, None, None]


def test_empty_table(spark):
    rows = titres.parsed(spark.createDataFrame([], "cell string, token string"))
    merged = titres.merge_cells(rows, ["cell"])
    assert merged.count() == 0
    assert titres.column_basis(merged.withColumn("serum", F.lit(1)), "serum").count() == 0

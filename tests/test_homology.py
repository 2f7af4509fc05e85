"""Homologous antigens by definition, and where all pairs would be very many."""

import random

from tidemark.operators import joining

COLUMNS = "name string, reassortant string, egg boolean, annotations string"


def test_homologous_by_definition(spark):
    draw = random.Random(5)
    point = lambda: (draw.choice(["A", "B", None]), draw.choice(["", "X"]), draw.choice([True, False]), draw.choice(["", "D", "E", "F", None]))
    antigens, sera = [(i, *point()) for i in range(30)], [(i, *point()) for i in range(60)]
    expected = []
    for serum, *s in sera:
        same = [(antigen, a[3] == s[3]) for antigen, *a in antigens if s[0] is not None and a[:3] == s[:3] and a[3] is not None and s[3] is not None]
        expected += [(serum, antigen) for antigen, exact in same if exact == any(e for _, e in same)]
    found = joining.homologous(spark.createDataFrame(antigens, f"antigen long, {COLUMNS}"), spark.createDataFrame(sera, f"serum long, {COLUMNS}"))
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_homologous_makes_only_its_pairs(spark):
    """20,000 antigens and sera of one name, each with its own annotation: 400 million pairs, 20,000 of them the result."""
    rows = spark.range(20_000).selectExpr("id", "'A' as name", "'' as reassortant", "true as egg", "concat('n', id) as annotations")
    found = joining.homologous(rows.withColumnRenamed("id", "antigen"), rows.withColumnRenamed("id", "serum"))
    assert found.where("serum = antigen").count() == found.count() == 20_000

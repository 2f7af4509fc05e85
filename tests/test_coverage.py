"""Coverage antigens: stated pairs, and profiles where all antigens of a name are titrated."""

import random

from tidemark.operators import joining

COLUMNS = "name string, annotations string, reassortant string, passage string, kind int"


def by_definition(antigens, sera, titrated):
    found = {}
    for serum, *s in sera:
        for antigen, *a in antigens:
            if s[0] is None or s[0] != a[0] or titrated is not None and (serum, antigen) not in titrated:
                continue
            cost = 16 * (s[1] != a[1]) + 8 * (s[2] != a[2]) + (4 + 2 * (s[4] != a[4]) if s[3] != a[3] else 0)
            found[serum] = min(found.get(serum, (99, 0)), (cost, antigen))
    return sorted((serum, antigen, cost) for serum, (cost, antigen) in found.items())


def test_pairs_and_profiles_by_definition(spark):
    draw = random.Random(7)
    point = lambda: (draw.choice(["A", "B", None]), draw.choice(["", "D", "E", None]), draw.choice(["", "X"]), draw.choice(["E1", "M1", "M2", None]), draw.choice([0, 1, None]))
    antigens, sera = [(i, *point()) for i in range(25)], [(i, *point()) for i in range(60)] + [(99, "Z", "", "", "E1", 0)]
    titrated = {(s[0], a[0]) for s in sera for a in antigens if draw.random() < 0.3}
    a, s = spark.createDataFrame(antigens, f"antigen long, {COLUMNS}"), spark.createDataFrame(sera, f"serum long, {COLUMNS}")
    pairs = spark.createDataFrame(sorted(titrated), "serum long, antigen long")
    assert sorted(map(tuple, joining.coverage_antigen(a, s, pairs).collect())) == by_definition(antigens, sera, titrated)
    assert sorted(map(tuple, joining.coverage_antigen(a, s).collect())) == by_definition(antigens, sera, None)


def test_no_pairs_of_one_name(spark):
    """20,000 antigens and 20,000 sera of one name: 400 million pairs, which nobody forms."""
    rows = spark.range(20_000).selectExpr("id", "'A' as name", "'' as annotations", "'' as reassortant", "'E' || id % 3 as passage", "cast(id % 2 as int) as kind")
    found = joining.coverage_antigen(rows.withColumnRenamed("id", "antigen"), rows.withColumnRenamed("id", "serum"))
    assert found.where("cost = 0 and antigen = serum % 3").count() == 20_000

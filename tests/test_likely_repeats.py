"""Likely repeats by definition, and past a member that all tables have."""

import random

from tidemark.operators import filters


def test_repeats_by_definition(spark):
    draw = random.Random(3)

    def tables(first, n):
        rows = set()
        for t in range(first, first + n):
            size = draw.choice([1, 1, 2, 3, 4, 5, 7, 9, filters.PAIRED - 1, filters.PAIRED, filters.PAIRED + 1, 60])
            rows |= {(t, draw.choice("xy") if draw.random() < 0.1 else "x", draw.choice([None, *range(30)]) if size < 12 else draw.randrange(70)) for _ in range(size)}
        return sorted(rows, key=repr)

    a, b = tables(0, 80), tables(1_000, 80)
    frames = [spark.createDataFrame(x, "table_id long, grp string, member long") for x in (a, b)]
    of = lambda rows, t: {r[1:] for r in rows if r[0] == t}
    for least in (1, 2, 4):
        expected = []
        for t in {r[0] for r in a}:
            for o in {r[0] for r in b}:
                mine = of(a, t)
                shared = len([m for m in mine & of(b, o) if m[1] is not None])
                if 2 * shared > len(mine) >= least:
                    expected.append((t, o, shared, len(mine)))
        found = filters.likely_repeats(*frames, ["grp"], least=least).collect()
        assert sorted(map(tuple, found)) == sorted(expected) and expected


def test_repeats_past_a_member_of_all(spark):
    """20,000 tables on each side share one member: 400 million pairs, 20,000 of them repeats."""
    rows = spark.range(20_000).selectExpr("id as table_id", "'x' as grp", "explode(array(-1, id, id + 100000)) as member")
    found = filters.likely_repeats(rows, rows, ["grp"])
    assert found.where("table_id = other and shared = 3 and size = 3").count() == found.count() == 20_000

"""Trees, solver and stores against plain Python."""

import itertools

import numpy as np

from tidemark.operators import numerics, rules, serology, stores, trees
from tidemark.sources import files


def test_newick_reads_quotes_comments_and_lengths(spark):
    rows = trees.parse_newick("((a:1,'b (x)''y':2.5)[note]c:0.1,d)root;")
    assert [(r[2], r[3], r[4]) for r in rows] == [(None, "root", None), (0, "c", 0.1), (1, "a", 1.0), (1, "b (x)'y", 2.5), (0, "d", None)]


def test_newick_ladder_of_a_thousand(spark):
    text = "(" * 1000 + "a" + ",b)" * 1000 + ";"
    assert len(trees.parse_newick(text)) == 2001


def test_closure_of_a_ladder(spark):
    rows = [(0, None)] + [(k, k - 1) for k in range(1, 40)]
    pairs = trees.closure(spark, spark.createDataFrame(rows, "node long, parent long")).collect()
    assert {(r[0], r[1], r[2]) for r in pairs} == {(a, b, b - a) for a in range(40) for b in range(a, 40)}


def fitch_by_hand(states):
    """The fewest changes on ((a,b),(c,d)) by trying all inner states."""
    a, b, c, d = states
    return min((x != a) + (x != b) + (y != c) + (y != d) + (r != x) + (r != y) for r, x, y in itertools.product("ACGT-", repeat=3))


def test_fitch_is_optimal(spark):
    rows, expected = [], {}
    for site, states in enumerate(itertools.product("AC-", repeat=4)):
        expected[site] = fitch_by_hand(states)
        leaves = [("t", site, k, k, 4 if k < 2 else 5, s) for k, s in enumerate(states)]
        rows += leaves + [("t", site, 4, 4, 6, None), ("t", site, 5, 5, 6, None), ("t", site, 6, 6, None, None)]
    frame = spark.createDataFrame(rows, "tree string, site int, post int, node long, parent long, state string")
    found = {r["site"]: r["changes"] for r in trees.fitch(frame).collect()}
    assert found == expected


def problem():
    rng = np.random.default_rng(3)
    places = rng.uniform(-2, 2, (12, 2)), rng.uniform(-2, 2, (6, 2))
    a, s = (x.ravel() for x in np.meshgrid(np.arange(12), np.arange(6), indexing="ij"))
    d = np.sqrt(((places[0][a] - places[1][s]) ** 2).sum(1))
    return numerics.Problem(a, s, d, np.arange(len(a)) % 11 == 0, 12, 6), np.concatenate(places)


def test_stress_gradient_is_right():
    p, _ = problem()
    layout = np.random.default_rng(0).normal(size=(18, 2))
    value, gradient = p.stress(layout)
    for i, k in [(0, 0), (5, 1), (13, 0), (17, 1)]:
        step = np.zeros_like(layout)
        step[i, k] = 1e-6
        assert abs((p.stress(layout + step)[0] - p.stress(layout - step)[0]) / 2e-6 - gradient[i, k]) < 1e-4


def test_starts_do_not_depend_on_the_split(spark):
    p, true = problem()
    every = {r["start"]: r["stress"] for r in numerics.map_relax(spark, p, 8, 8).collect()}
    later = {r["start"]: r["stress"] for r in numerics.map_relax(spark, p, 3, 3, first=5).collect()}
    assert all(every[k] == v for k, v in later.items())
    assert min(every.values()) <= p.stress(true)[0]  # less-than titres push points apart, so even the true places have stress


def test_distinct_basins_drop_a_turned_copy():
    a = np.random.default_rng(1).normal(size=(9, 2))
    turned = a @ np.array([[0.0, -1.0], [1.0, 0.0]]) + 5
    assert numerics.distinct_basins([(1.0, a), (1.1, turned), (1.2, a * 3)], 5, 0.5) == [0, 2]


def test_publishing_equal_content_keeps_the_version(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    rows = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0)], "id long, grp string, v double")
    first = stores.publish(rows, root, ["grp"], ["id", "v"])
    assert stores.publish(rows, root, ["grp"], ["id", "v"]) == first
    more = rows.unionByName(spark.createDataFrame([(3, "y", 3.0)], rows.schema))
    second = stores.publish(more, root, ["grp"], ["id", "v"])
    assert second != first
    assert sorted(r["id"] for r in stores.read_version(spark, root, ["grp"]).collect()) == [1, 2, 3]
    assert sorted(r["id"] for r in stores.read_version(spark, root, ["grp"], first).collect()) == [1, 2]


def test_fasta_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("s1|lab=x|year=2020", "ACGT"), ("s2", "AC--")], "name string, sequence string")
    files.write_fasta(rows.coalesce(1), f"file://{tmp_path}/f")
    back = files.read_fasta(spark, f"file://{tmp_path}/f")
    assert {(r["defline"], r["sequence"]) for r in back.collect()} == {("s1|lab=x|year=2020", "ACGT"), ("s2", "AC--")}
    name, fields = files.defline_fields(back["defline"])
    assert {(r[0], r[1].get("lab")) for r in back.select(name, fields).collect()} == {("s1", "x"), ("s2", None)}


def test_nested_tables_flatten_to_readings(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"table_id": "t", "lab": "L", "date": "2020-01-01", "antigens": ["a", "b"], "sera": ["s"], "titres": [[["40", "80"]], [[]]]}')
    got = files.flatten(files.read_nested(spark, str(path))).collect()
    assert [(r["antigen"], r["serum"], r["reading"], r["token"]) for r in got] == [("a", "s", 0, "40"), ("a", "s", 1, "80")]


def test_shadowed_rules(spark):
    table = spark.createDataFrame([(1, "X.1"), (2, "Y"), (3, "X")], "line int, clade string")
    closure = spark.createDataFrame([("X", "X"), ("X", "X.1"), ("X.1", "X.1"), ("Y", "Y")], "ancestor string, descendant string")
    assert [(r["dead"], r["by"]) for r in rules.shadowed(table, closure).collect()] == [(1, 3)]


def test_suffixes_fill_gaps_and_keep_the_known(spark):
    tables = spark.createDataFrame([("g", "2020-01-01", k) for k in (1, 2, 3)], "lab string, date string, table_id long")
    known = spark.createDataFrame([("g", "2020-01-01", 2, 2), ("g", "2020-01-01", 9, 1)], "lab string, date string, table_id long, suffix int")
    assert {r["table_id"]: r["suffix"] for r in serology.suffixes(tables, "lab", known).collect()} == {1: 3, 2: 2, 3: 4}

"""Bands and control reports against their definitions."""

import random

from tidemark.operators import control


def brute_bands(rows, min_gap, purity, fraction):
    out = {}
    for clade, total in {(r[0], r[4]) for r in rows}:
        spans = []
        for _, first, last, n, _ in sorted(r for r in rows if r[0] == clade):
            if spans:
                a, b, m = spans[-1]
                gap = first - b - 1
                if gap <= min_gap or gap <= max(min_gap, fraction * total) and (m + n) / (last - a + 1) >= purity:
                    spans[-1] = (a, last, m + n)
                    continue
            spans.append((first, last, n))
        most = max(m for _, _, m in spans)
        out[clade] = [s for s in spans if s[2] * 10 >= most]
    return sorted((c, *s) for c, spans in out.items() for s in spans)


def test_bands_by_definition(spark):
    rng = random.Random(5)
    rows = []
    for clade in "abcd":
        at = 0
        for _ in range(40):
            at += rng.choice((1, 2, 3, 5, 9, 40))
            n = rng.choice((1, 2, 5, 20))
            rows.append((clade, at, at + n - 1, n, 900))
            at += n
    frame = spark.createDataFrame(rows, "clade string, first long, last long, length long, total long").repartition(3)
    for min_gap, purity, fraction in ((2, 0.7, 0.01), (0, 0.9, 0.05), (5, 0.1, 0.0)):
        assert sorted(map(tuple, control.bands(frame, "clade", min_gap, purity, fraction).collect())) == brute_bands(rows, min_gap, purity, fraction)


def test_a_gap_poisons_later_stretches(spark):
    values = [9, 9, None, 9, 9, 9]
    frame = spark.createDataFrame([("s", k, None if v is None else float(v)) for k, v in enumerate(values)], "by string, at int, value double")
    high = lambda poison: [r["high"] for r in control.beyond(frame, "by", "at", 5.0, 1.0, 2, 2, 1.0, poison).orderBy("at").collect()]
    assert high(True) == [False, True, None, None, None, None]
    assert high(False) == [False, True, None, None, True, True]

"""Components with hubs: only a hub's smallest neighbour is repeated over tasks."""

from tidemark.llm import common
from tidemark.llm.components import MANY, components


def test_only_hubs_are_repeated(spark, monkeypatch):
    seen, plain = [], common.salted_join

    def counted(many, few, *args, **more):
        seen.append(few.count())
        return plain(many, few, *args, **more)

    monkeypatch.setattr(common, "salted_join", counted)
    chains, spokes = 3_000, 5 * MANY
    links = [(3 * i, 3 * i + 1) for i in range(chains)] + [(3 * i + 1, 3 * i + 2) for i in range(chains)]
    links += [(10**6, 10**6 - 1 - i) for i in range(spokes)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(4)).collect()}
    expected = {n: n // 3 * 3 for n in range(3 * chains)} | {10**6 - i: 10**6 - spokes for i in range(spokes + 1)}
    assert found == expected
    assert seen and max(seen) <= 8  # a hub per partition of links, at most

"""Chains of steps over stores."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import steps, stores


def chain(factor=2, seen=None):
    def doubled(inputs, parameters):
        if seen is not None:
            seen.append("doubled")
        return inputs["rows"].withColumn("v", F.col("v") * parameters["factor"])

    def summed(inputs, _):
        return inputs["doubled"].groupBy("g").agg(F.sum("v").alias("v"))

    return steps.Chain([
        steps.Step("sum", {"doubled": "doubled"}, "sums", summed, ["g"], ["v"]),
        steps.Step("double", {"rows": "rows"}, "doubled", doubled, ["g"], ["v"], {"factor": factor}),
        steps.Step("side", {"rows": "rows"}, "side", lambda i, _: i["rows"], ["g"], ["v"], after=["double"]),
    ])


def test_order_and_cycles():
    assert chain().order() == ["double", "sum", "side"] and chain().order(["sum"]) == ["double", "sum"]
    loop = [steps.Step("a", {"x": "B"}, "A", None, [], []), steps.Step("b", {"x": "A"}, "B", None, [], [])]
    for bad in (loop, [loop[0], loop[0]]):
        with pytest.raises(steps.StepError):
            steps.Chain(bad)
    with pytest.raises(steps.StepError):
        chain().order(["other"])


def test_runs_what_is_out_of_date(spark, tmp_path):
    root = f"file://{tmp_path}"
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "g string, v long")
    with pytest.raises(steps.StepError):
        chain().run(spark, root)
    stores.publish(rows, f"{root}/rows", ["g"], ["v"])
    seen = []
    assert [o.status for o in chain(2, seen).run(spark, root)] == ["made"] * 3
    assert [o.status for o in chain(2, seen).run(spark, root)] == ["current"] * 3 and seen == ["doubled"]
    sums = lambda: sorted(map(tuple, stores.read_version(spark, f"{root}/sums", ["g"]).select("g", "v").collect()), key=repr)
    assert sums() == sorted([("a", 6), ("b", 6), (None, 8)], key=repr)
    pin = steps.snapshot(spark, root, ["sums", "rows"], "first")
    assert [(o.status, o.reason) for o in chain(3).run(spark, root, ["sum"])] == [("made", "parameters changed: factor"), ("made", "inputs changed: doubled")]
    assert sums() == sorted([("a", 9), ("b", 9), (None, 12)], key=repr)
    assert steps.snapshot(spark, root, ["rows", "sums"], "second") != pin and set(steps.pinned(spark, root, pin)) == {"rows", "sums"}
    keys = steps.published_keys(spark, f"{root}/rows", ["g"], "v", "a")
    assert sorted(r["v"] for r in keys.collect()) == [3, 4]


def test_readers_refuse_an_unfinished_batch(spark, tmp_path):
    root = f"file://{tmp_path}"
    with steps.batch(spark, root, "one", ["rows"]):
        with pytest.raises(steps.StepError):
            steps.refuse_unfinished(spark, root, "rows")
    steps.refuse_unfinished(spark, root, "rows")
    with pytest.raises(RuntimeError), steps.batch(spark, root, "two", ["rows"]):
        raise RuntimeError
    with pytest.raises(steps.StepError):
        steps.refuse_unfinished(spark, root, "rows")

"""Hashes and orders that SQL has no form for, by published values and definitions."""

import hashlib
import random

from tidemark.functions import names, texts
from tidemark.operators import order, stores, trees


def test_xxh32_of_published_values(spark):
    rows = spark.createDataFrame([("",), ("a",), ("abc",), (None,)], "t string").select(texts.xxh32_hex("t").alias("h")).collect()
    assert [r["h"] for r in rows] == ["02CC5D05", "550D7456", "32D153FF", None]


def test_leaf_ids(spark):
    row = spark.createDataFrame([("EPI_ISL_1|EPI2",)], "k string").select(texts.leaf_id("k").alias("h")).first()
    assert row["h"] == hashlib.blake2b(b"EPI_ISL_1|EPI2", digest_size=8).hexdigest()


def test_natural_order_of_long_numbers(spark):
    from pyspark.sql import functions as F

    keys = [f"id {10**k + j}" for k in (0, 3, 14, 20) for j in (0, 1)] + ["id 007", "other", ""]
    random.Random(1).shuffle(keys)
    frame = order.numbered(spark.createDataFrame([(k,) for k in keys], "key string").repartition(5), [names.natural(F.col("key"))])
    assert [r["key"] for r in frame.orderBy("place").collect()] == ["", "id 1", "id 2", "id 007", "id 1000", "id 1001", f"id {10**14}", f"id {10**14 + 1}", f"id {10**20}", f"id {10**20 + 1}", "other"]
    assert sorted(r["place"] for r in frame.collect()) == list(range(1, 12))


def test_stores_tell_rows_apart(spark, tmp_path):
    root = f"file://{tmp_path}/store"
    one = spark.createDataFrame([(None, "a|b", "c"), ("x/y", None, "\\N")], "g string, p string, q string")
    two = spark.createDataFrame([(None, "a", "b|c"), ("x/y", "\\N", None)], "g string, p string, q string")
    first = stores.publish(one, root, ["g"], ["p", "q"])
    assert stores.publish(one.repartition(3), root, ["g"], ["p", "q"]) == first and len(stores.history(spark, root)) == 1
    second = stores.publish(two, root, ["g"], ["p", "q"])
    assert second != first and len(stores.history(spark, root)) == 2
    for version, rows in ((first, one), (second, two)):
        assert sorted(map(tuple, stores.read_version(spark, root, ["g"], version).select("g", "p", "q").collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
        assert stores.verified(spark, root, ["g"], ["p", "q"], version).count() == 0


def test_newick_text_must_be_balanced():
    import pytest

    for text in ("(a,b));", "((a,b);", "a,b;"):
        with pytest.raises(ValueError):
            trees.parse_newick(text)
    assert [r[3] for r in trees.parse_newick("('a, (b)':0.1234567891,'it''s')root;")] == ["root", "a, (b)", "it's"]

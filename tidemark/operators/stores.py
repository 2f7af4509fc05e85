"""Versioned stores: content-addressed publishing, diffs, late rows and readers of older schemas."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.names import framed


def fingerprint(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A hash of all rows that doesn't depend on their order: XOR of row hashes, their sum and number."""
    h = F.xxhash64(*(columns or rows.columns))
    return rows.agg(F.count("*").alias("n_rows"), F.expr(f"bit_xor(xxhash64({', '.join(f'`{c}`' for c in columns or rows.columns)}))").alias("xor"), F.sum(F.pmod(h, F.lit(2**31))).alias("sum"))


def manifest(rows: DataFrame, partition: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per partition the number of rows and a stamp of its content, the same in any order of rows.

    A row's stamp is the SHA-256 of its columns, each with its length in front,
    so no two different rows agree; a partition's is the sums of two halves of these.
    """
    digest = F.sha2(framed(*[F.col(c) for c in columns]), 256)
    half = lambda at: F.sum(F.conv(F.substring(digest, at, 15), 16, 10).cast("decimal(20,0)"))
    sums = rows.groupBy(*partition).agg(F.count("*").alias("n_rows"), half(1).alias("__a"), half(16).alias("__b"))
    return sums.select(*partition, "n_rows", F.concat_ws("-", F.col("__a").cast("string"), F.col("__b").cast("string")).alias("content"))


def manifest_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Partitions added, removed or changed."""
    a = old.select(*keys, F.col("content").alias("was"))
    b = new.select(*keys, F.col("content").alias("now"))
    state = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "changed")
    b = b.withColumnsRenamed({k: f"__{k}" for k in keys})
    both = a.join(b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "full_outer").withColumn("state", state).where("state is not null")
    return both.select(*[F.coalesce(k, f"__{k}").alias(k) for k in keys], "state")


def _place(spark: SparkSession, path: str):
    """A path with its file system, whichever that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(rows: DataFrame, root: str, partition: Sequence[str], columns: Sequence[str]) -> str:
    """Write a version named by its content; equal content gives the existing version again.

    Only partitions that are new or changed against the current version are
    written; the version's manifest lists where each partition lies.  A NULL
    partition key is a key like others.  The manifest file is created under the
    next number and only if that is free, so of two publishers at once one
    fails and no reader sees half a version.
    """
    spark = rows.sparkSession
    listed = manifest(rows, partition, columns).collect()  # a row per partition
    found = {tuple(None if r[k] is None else str(r[k]) for k in partition): [r["n_rows"], r["content"]] for r in listed}
    listing = sorted((json.dumps(k), v) for k, v in found.items())
    version = hashlib.sha256(json.dumps(listing).encode()).hexdigest()[:16]
    current = read_manifest(spark, root)
    if current and current["version"] == version:
        return version
    had = {tuple(p["key"]): p for p in current["partitions"]} if current else {}
    fresh = [k for k, v in found.items() if had.get(k, {}).get("stamp") != v]
    folder = f"{root}/data/{version}"
    if fresh:
        changed = _of_partitions(rows, partition, fresh)
        changed.write.mode("overwrite").partitionBy(*partition).parquet(folder)
    entries = [{"key": list(k), "stamp": v, "folder": folder if k in fresh else had[k]["folder"]} for k, v in found.items()]
    number = current["number"] + 1 if current else 0
    body = {"version": version, "number": number, "schema": rows.schema.json(), "keys": list(partition), "partitions": entries}
    place, files = _place(spark, f"{root}/manifests/{number:09d}.json")
    stream = files.create(place, False)
    stream.write(bytearray(json.dumps(body).encode()))
    stream.close()
    return version


def _of_partitions(rows: DataFrame, partition: Sequence[str], keys: Sequence[tuple]) -> DataFrame:
    """The rows of some partitions; Spark broadcasts the keys while they are few."""
    wanted = rows.sparkSession.createDataFrame([list(k) for k in keys], ", ".join(f"`__{k}` string" for k in partition))
    on = [F.col(k).cast("string").eqNullSafe(F.col(f"__{k}")) for k in partition]
    return rows.join(wanted, on, "left_semi")


def history(spark: SparkSession, root: str) -> list[str]:
    """The manifests' paths, oldest first."""
    place, files = _place(spark, f"{root}/manifests")
    if not files.exists(place):
        return []
    return sorted(f.getPath().toString() for f in files.listStatus(place) if f.getPath().getName().endswith(".json"))


def read_manifest(spark: SparkSession, root: str, version: str | None = None) -> dict | None:
    """The current manifest, or the newest of a version."""
    for path in reversed(history(spark, root)):
        body = json.loads(spark.read.text(path, wholetext=True).first()[0])
        if version is None or body["version"] == version:
            return body
    return None


def read_version(spark: SparkSession, root: str, partition: Sequence[str], version: str | None = None) -> DataFrame:
    """A version's rows: each partition from the folder that holds it, by column name."""
    found = read_manifest(spark, root, version)
    if found is None:
        raise FileNotFoundError(f"{root} has no version {version or ''}")
    by: dict[str, list[tuple]] = {}
    for entry in found["partitions"]:
        by.setdefault(entry["folder"], []).append(tuple(entry["key"]))
    schema = StructType.fromJson(json.loads(found["schema"]))
    out = None
    for folder, keys in by.items():
        part = _of_partitions(spark.read.schema(schema).parquet(folder), partition, keys)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], schema) if out is None else out


def verified(spark: SparkSession, root: str, partition: Sequence[str], columns: Sequence[str], version: str | None = None) -> DataFrame:
    """The partitions of a version whose rows aren't what its manifest says: lost, or with another stamp."""
    found = read_manifest(spark, root, version)
    keys = ", ".join(f"`{k}` string" for k in partition)
    listed = [(*p["key"], p["stamp"][0], p["stamp"][1]) for p in found["partitions"]]
    said = spark.createDataFrame(listed, f"{keys}, said_rows long, said string")
    held = manifest(read_version(spark, root, partition, version), partition, columns)
    held = held.select(*[F.col(k).cast("string").alias(f"__{k}") for k in partition], "n_rows", "content")
    both = said.join(held, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in partition], "left")
    return both.where(~F.col("said").eqNullSafe(F.col("content"))).select(*partition, "said_rows", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))


def late(rows: DataFrame, published: DataFrame, key: str) -> DataFrame:
    """Rows whose key no published row has."""
    return rows.join(published.select(key), key, "left_anti")


def overlapping(new: DataFrame, held: DataFrame, key: str, volatile: Sequence[str]) -> DataFrame:
    """What happens to keys that another delivery holds: dropped if equal but for volatile columns, else refused with the columns."""
    columns = [c for c in new.columns if c != key]
    both = new.alias("n").join(held.alias("h"), key)
    differs = F.array_compact(F.array(*[F.when(~F.col(f"n.{c}").eqNullSafe(F.col(f"h.{c}")), F.lit(c)) for c in columns]))
    judged = both.select(key, differs.alias("columns"))
    firm = F.size(F.array_except("columns", F.array(*[F.lit(c) for c in volatile])))
    verdict = F.when(F.size("columns") == 0, "dropped").when(firm == 0, "kept published").otherwise("refused")
    return judged.select(key, verdict.alias("verdict"), F.array_join("columns", ",").alias("columns"))


def stale(derived: DataFrame, current: DataFrame, key: str = "dataset") -> DataFrame:
    """Inputs whose current version isn't the one that a dataset was built from."""
    both = derived.select(key, F.col("version").alias("built_from")).join(current.select(key, "version"), key, "full_outer")
    return both.where(~F.col("built_from").eqNullSafe(F.col("version")))

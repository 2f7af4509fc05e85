"""What the operators share: words, tables, folds and the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, wherever a contract speaks of words.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: The ASCII letters' lower case; other letters stay.
LOWER = {c: c + 32 for c in range(65, 91)}
#: The same over UTF-8.
LOWER_BYTES = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def lower_words(text: str | None) -> list[bytes]:
    """The words of a text in lower case (A-Z), as UTF-8: split() cuts bytes at \\x20 and \\x09-\\x0D alone."""
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER_BYTES).split()


_OWN_FOLDER: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    A path without a scheme lies in the cluster's default file system.  Only a
    session on one machine, as in tests, may have none and gets a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "") or ""
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        if not _OWN_FOLDER:
            _OWN_FOLDER.append("file://" + tempfile.mkdtemp(prefix="tidemark-"))
        folder = _OWN_FOLDER[0]
    if "://" in folder or folder.startswith("file:"):
        return folder
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop.FileSystem.get(spark._jsc.hadoopConfiguration()).makeQualified(hadoop.Path(folder)).toString()


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder's address inside the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete written() tables that no later plan reads."""
    for df in tables:
        place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_to)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def salted_join(many: DataFrame, few: DataFrame, keys: list[str], by: str, salts: int = 16) -> DataFrame:
    """A join whose left side may have very many rows of one key: these go to `salts` tasks by the hash of column `by`.

    `few` has a row per key and is repeated `salts` times, so it is never broadcast.
    """
    salt = free_name("salt", many, few)
    left = many.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    right = few.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), [*keys, salt]).drop(salt)


def free_name(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, in any case of letters."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, parts: int) -> Column:
    """crc32 of a key's decimal text, modulo parts; a null key is the text ''."""
    return (F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % parts).cast("int")


#: Bytes of input, as stored, for which one task is meant.
TASK_BYTES = 32 << 20


def partitions(df: DataFrame) -> int:
    """Tasks for work on a frame: its partitions, or more if these are few for its size; no job runs."""
    return max(1, df.rdd.getNumPartitions(), (stored_bytes(df) or 0) // TASK_BYTES)


def stored_bytes(df: DataFrame) -> int | None:
    """Bytes of a frame's input by the plan's statistics; None for one made from local rows."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 60 else None


def key_bits(df: DataFrame, each: int = 4 << 20) -> int:
    """log2 of the parts that keys of a frame are dealt to: one for each `each` bytes of input, 4 a task at most."""
    tasks = partitions(df)
    size = stored_bytes(df)
    return max(2, (max(4, 4 * tasks if size is None else min(4 * tasks, size // each)) - 1).bit_length())


#: Rows that a worker turns into Python objects at once.
SLICE_ROWS = 500

_RESIDENT: dict = {}


def resident(key, make: Callable):
    """A worker's model or memory, kept between tasks; only the last one asked for stays."""
    if key not in _RESIDENT:
        release()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def release() -> None:
    """Give a worker's kept memory back to the machine; workers serve one operator and one stage after another."""
    if _RESIDENT:
        _RESIDENT.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


#: Rows that an executor hands to a worker at once, at most: whole texts of many rows are large on both sides.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Let the session's Arrow batches have BATCH_ROWS rows at most; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """One Arrow batch in, one out; nothing is kept between batches."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            if (out := fn(batch)) is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def flat(arrays: list[np.ndarray], dtype) -> np.ndarray:
    return np.concatenate(arrays).astype(dtype, copy=False) if arrays else np.empty(0, dtype)


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit mixer (the splitmix64 finaliser) over unsigned integers."""
    with np.errstate(over="ignore"):
        x = x.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

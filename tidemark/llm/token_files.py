"""Token-id files with constant-time keyed access.

Layout of a dataset folder in shared storage:

    shard-00007.ids   the raw ids of a range of documents, little-endian, in
                      ascending doc_id order; nothing else is in the file
    index-00003.mph   a minimal perfect hash over the keys whose hash falls
                      into index part 3: key -> slot -> (fingerprint, shard,
                      first id in the shard, number of ids)

A lookup hashes its key to an index part, then to a slot, compares the stored
fingerprint and reads one range of one shard: the work is the same for any
number of documents.  A key is a doc_id with the number of its copy (0 for the
first row of that doc_id), so repeated rows keep records of their own.

Every file is first written under a name of its task attempt and then renamed,
so a task that runs again after a lost executor replaces it with equal bytes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .storage import read_file, write_file
from .tokens import encoder

ENTRY = "doc_id long, copy long, shard int, first long, n_tokens long"
MAGIC = b"TIDEMPH1"
#: Bits per remaining key at each level of the hash.
GAMMA = 2
#: Levels before the few keys left are kept as a sorted list.
LEVELS = 40
#: Documents per index part, about.
PART_KEYS = 250_000


def key_hash(doc_id: np.ndarray, copy: np.ndarray, null: np.ndarray) -> np.ndarray:
    """64 bits per key; a null doc_id has copies of its own."""
    base = common.mixed(doc_id.astype(np.int64).view(np.uint64), 1)
    return common.mixed(base ^ common.mixed(copy.astype(np.uint64) * np.uint64(2) + null.astype(np.uint64), 2), 3)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (common.mixed(keys, 77) >> np.uint64(32)).astype(np.uint32)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys, by levels of bitmaps.

    At each level a key takes the position its hash names if no other
    remaining key names it too; the rest go to the next level.  A key's slot
    is the number of set bits before its own over all levels.
    """

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest  # bytes of 0/1 per level; sorted keys
        self.before = []
        total = 0
        for bits in levels:
            rank = np.cumsum(bits, dtype=np.int64)
            self.before.append(total + rank - bits)
            total += int(rank[-1]) if len(rank) else 0
        self.first_rest = total

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        levels, left = [], keys
        while len(left) and len(levels) < LEVELS:
            size = max(64, GAMMA * len(left))
            at = common.mixed(left, 100 + len(levels)) % np.uint64(size)
            taken = np.bincount(at.astype(np.int64), minlength=size)
            levels.append((taken == 1).astype(np.uint8))
            left = left[taken[at.astype(np.int64)] > 1]
        return cls(levels, np.sort(left))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot per key; -1 where no level and no rest holds the key."""
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for k, bits in enumerate(self.levels):
            if not len(todo):
                break
            at = (common.mixed(keys[todo], 100 + k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at] == 1
            out[todo[hit]] = self.before[k][at[hit]]
            todo = todo[~hit]
        if len(todo) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            hit = self.rest[at] == keys[todo]
            out[todo[hit]] = self.first_rest + at[hit]
        return out

    def dump(self) -> bytes:
        out = [struct.pack("<II", len(self.levels), len(self.rest))]
        for bits in self.levels:
            out += [struct.pack("<Q", len(bits)), np.packbits(bits).tobytes()]
        return b"".join([*out, self.rest.astype("<u8").tobytes()])

    @classmethod
    def load(cls, raw: memoryview) -> tuple["PerfectHash", int]:
        n_levels, n_rest = struct.unpack_from("<II", raw, 0)
        at, levels = 8, []
        for _ in range(n_levels):
            (size,) = struct.unpack_from("<Q", raw, at)
            packed = np.frombuffer(raw, np.uint8, (size + 7) // 8, at + 8)
            levels.append(np.unpackbits(packed, count=size))
            at += 8 + len(packed)
        rest = np.frombuffer(raw, "<u8", n_rest, at)
        return cls(levels, rest), at + 8 * n_rest


def build_index(path: str, keys: np.ndarray, shard: np.ndarray, first: np.ndarray, count: np.ndarray) -> None:
    perfect = PerfectHash.build(keys)
    slot = perfect.slots(keys)
    columns = []
    for values, kind in ((fingerprints(keys), "<u4"), (shard, "<u4"), (first, "<u8"), (count, "<u8")):
        placed = np.empty(len(keys), dtype=kind)
        placed[slot] = values
        columns.append(placed.tobytes())
    write_file(path, b"".join([MAGIC, struct.pack("<Q", len(keys)), perfect.dump(), *columns]))


class Index:
    """An index part, read whole; lookups are vectorised."""

    def __init__(self, path: str):
        raw = memoryview(read_file(path))
        if bytes(raw[:8]) != MAGIC:
            raise ValueError(f"{path} is not an index")
        (n,) = struct.unpack_from("<Q", raw, 8)
        self.perfect, size = PerfectHash.load(raw[16:])
        at, columns = 16 + size, []
        for kind in ("<u4", "<u4", "<u8", "<u8"):
            columns.append(np.frombuffer(raw, kind, n, at))
            at += columns[-1].nbytes
        self.fingerprint, self.shard, self.first, self.count = columns

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, slot): a key whose fingerprint differs isn't there."""
        slot = self.perfect.slots(keys)
        if not len(self.fingerprint):
            return np.zeros(len(keys), dtype=bool), slot
        return (slot >= 0) & (self.fingerprint[np.maximum(slot, 0)] == fingerprints(keys)), slot


@dataclass(frozen=True)
class Dataset:
    """Where a dataset lies and the few numbers that reading it needs."""

    folder: str
    shards: int
    parts: int
    dtype: str
    starts: tuple[int, ...]  #: ids before each shard

    def shard(self, k: int) -> str:
        return f"{self.folder}/shard-{k:05d}.ids"

    def index(self, k: int) -> str:
        return f"{self.folder}/index-{k:05d}.mph"


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    doc = batch.column("doc_id")
    null = np.asarray(doc.is_null())
    return key_hash(np.asarray(doc.fill_null(0)), batch.column("copy").to_numpy(zero_copy_only=False), null)


def _with_part(df: DataFrame, parts: int) -> DataFrame:
    """The index part of each key."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        part = (_keys(batch) % np.uint64(parts)).astype(np.int32)
        return pa.record_batch([*batch.columns, pa.array(part)], names=[*batch.schema.names, "part"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    return common.map_batches(df, run, f"{schema}, part int")


def _groups(batches: Iterator[pa.RecordBatch], by: str) -> Iterator[tuple[int, pa.Table]]:
    """A partition's rows by part or shard number; a partition has few."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    value = table.column(by).to_numpy()
    for k in np.unique(value):
        yield int(k), table.filter(pa.array(value == k)).combine_chunks()


def write(documents: DataFrame, folder: str, tokenizer: str, *, end_id: int = 0, shards: int | None = None) -> Dataset:
    """Write the ids of all documents, each followed by `end_id`, and their index.

    `documents` needs doc_id and text; other columns are not read.  A null or
    empty text has the end id alone.  A null doc_id comes before all others.
    Rows with equal doc_ids are ordered by their ids.  No rows make no files.
    Only the numbers of ids per shard and the shards' first doc_ids reach the
    driver.
    """
    spark = documents.sparkSession
    documents = documents.select("doc_id", "text")
    shards = shards or common.partitions(documents)
    probabilities = [k / shards for k in range(1, shards)]
    edges = documents.approxQuantile("doc_id", probabilities, 0.2 / shards) if shards > 1 else []
    edges = np.unique(np.array(edges, dtype=np.float64)).astype(np.int64)
    code = encoder(tokenizer)
    dtype = code.dtype.str

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(tokenizer)
        end = np.array([end_id], dtype=coder.dtype).tobytes()
        doc = batch.column(0)
        shard = np.searchsorted(edges, np.asarray(doc.fill_null(np.iinfo(np.int64).min)), side="right")
        ids = [raw + end for raw in coder.encode(batch.column(1).to_pylist())]
        return pa.record_batch(
            [doc, pa.array(shard, pa.int32()), pa.array(ids, pa.binary())], names=["doc_id", "shard", "ids"]
        )

    encoded = common.map_batches(documents, encode, "doc_id long, shard int, ids binary")
    dealt = encoded.repartitionById(len(edges) + 1, "shard").sortWithinPartitions("shard", "doc_id", "ids")
    made = Dataset(folder, len(edges) + 1, 0, dtype, ())

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = np.dtype(dtype).itemsize
        docs: dict[int, list] = {}
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for doc, shard, ids in zip(*(c.to_pylist() for c in batch.columns)):
                docs.setdefault(shard, []).append(doc)
                held.setdefault(shard, []).append(ids)
        for shard, payload in held.items():
            count = np.array([len(ids) // width for ids in payload], dtype=np.int64)
            write_file(made.shard(shard), b"".join(payload))
            copy, last = [], object()
            for doc in docs[shard]:
                copy.append(copy[-1] + 1 if doc == last and copy else 0)
                last = doc
            columns = [
                pa.array(docs[shard], pa.int64()),
                pa.array(copy, pa.int64()),
                pa.array(np.full(len(count), shard, dtype=np.int32)),
                pa.array(np.cumsum(count) - count),
                pa.array(count),
            ]
            yield pa.record_batch(columns, names=["doc_id", "copy", "shard", "first", "n_tokens"])

    entries = common.written(dealt.mapInArrow(store, ENTRY), "entries")
    totals = {r["shard"]: (r["n"], r["rows"]) for r in entries.groupBy("shard").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("rows")).collect()}
    starts = np.cumsum([0, *(totals.get(k, (0, 0))[0] for k in range(made.shards))])
    parts = max(1, sum(rows for _, rows in totals.values()) // PART_KEYS, min(made.shards, 8))
    made = Dataset(folder, made.shards, parts, dtype, tuple(int(x) for x in starts[:-1]))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _groups(batches, "part"):
            batch = rows.to_batches()[0]
            named = {name: batch.column(name).to_numpy(zero_copy_only=False) for name in ("shard", "first", "n_tokens")}
            build_index(made.index(part), _keys(batch), named["shard"], named["first"], named["n_tokens"])
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([len(batch)], pa.int64())], names=["part", "n"])

    built = _with_part(entries, parts).repartitionById(parts, "part").mapInArrow(index, "part int, n long")
    common.written(built, "indexed")
    return made


def lookup(made: Dataset, keys: DataFrame) -> DataFrame:
    """Where each key (doc_id, copy) lies: shard, first, n_tokens; absent keys have no row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in _groups(batches, "part"):
            batch = rows.to_batches()[0]
            index = Index(made.index(part))
            found, slot = index.find(_keys(batch))
            at = slot[found]
            keep = batch.filter(pa.array(found))
            columns = [keep.column("doc_id"), keep.column("copy"), pa.array(index.shard[at].astype(np.int32))]
            columns += [pa.array(index.first[at].astype(np.int64)), pa.array(index.count[at].astype(np.int64))]
            yield pa.record_batch(columns, names=["doc_id", "copy", "shard", "first", "n_tokens"])

    return _with_part(keys.select("doc_id", "copy"), made.parts).repartitionById(made.parts, "part").mapInArrow(find, ENTRY)


def _read(made: Dataset, keys: DataFrame, name: str, kind: pa.DataType, value: Callable[[bytes], object]) -> DataFrame:
    """Each key's start, number of ids, and `value` of its ids (little-endian uint32), by the index."""
    spark_kind = {pa.binary(): "binary", pa.int64(): "long"}[kind]

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, rows in _groups(batches, "shard"):
            payload = np.frombuffer(read_file(made.shard(shard)), dtype=made.dtype)
            for batch in common.sliced(rows.to_batches()):
                first, count = (batch.column(column).to_numpy() for column in ("first", "n_tokens"))
                values = [value(payload[a : a + n].astype("<u4").tobytes()) for a, n in zip(first.tolist(), count.tolist())]
                columns = [batch.column("doc_id"), batch.column("copy"), pa.array(first + made.starts[shard]), pa.array(count), pa.array(values, kind)]
                yield pa.record_batch(columns, names=["doc_id", "copy", "start", "n_tokens", name])

    schema = f"doc_id long, copy long, start long, n_tokens long, {name} {spark_kind}"
    return lookup(made, keys).repartitionById(made.shards, "shard").mapInArrow(take, schema)


def read(made: Dataset, keys: DataFrame) -> DataFrame:
    """The stored ids of each key: doc_id, copy, start, n_tokens, ids (little-endian uint32)."""
    return _read(made, keys, "ids", pa.binary(), bytes)


def digests(made: Dataset, keys: DataFrame) -> DataFrame:
    """As read(), with the unsigned crc32 of the ids in their place."""
    return _read(made, keys, "ids_crc32", pa.int64(), zlib.crc32)


def fetch(made: Dataset, doc_id: int | None, copy: int = 0) -> np.ndarray | None:
    """One document's ids, by one index part and one range read; None if absent."""
    key = key_hash(np.array([doc_id or 0]), np.array([copy]), np.array([doc_id is None]))
    index = Index(made.index(int(key[0] % np.uint64(made.parts))))
    found, slot = index.find(key)
    if not found[0]:
        return None
    width = np.dtype(made.dtype).itemsize
    where, name = fs.FileSystem.from_uri(made.shard(int(index.shard[slot[0]])))
    with where.open_input_file(name) as source:
        source.seek(int(index.first[slot[0]]) * width)
        return np.frombuffer(source.read(int(index.count[slot[0]]) * width), dtype=made.dtype).astype(np.uint32)


def keys_of(documents: DataFrame) -> DataFrame:
    """(doc_id, copy) of every row."""
    counted = documents.groupBy("doc_id").agg(F.count("*").alias("n"))
    return counted.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))


def round_trip(spark: SparkSession, documents: DataFrame, tokenizer: str, *, end_id: int = 0) -> DataFrame:
    """Write all documents, then read each back through the index."""
    made = write(documents, common.work_dir(spark, "token-ids"), tokenizer, end_id=end_id)
    return digests(made, keys_of(documents)).select("doc_id", "start", "n_tokens", "ids_crc32")

"""Exact top-k by inner product with a KD-tree in each shard.

Shards are regions of space: a coarse tree over a bounded sample cuts space at
medians, and a leaf of it with more than a shard's share of the vectors is
dealt to several shards.  A shard's own tree splits at the median of the widest
dimension and keeps each node's tight bounding box.  No vector in a box can
score more with a query q than sum_i max(q_i lo_i, q_i hi_i), so a search goes
through a tree best bound first and stops at the first bound below the query's
k-th score so far.  A query searches the shard it lives in first; that k-th
score rules out regions by their boxes before anything is sent, then shards by
their root boxes before their trees are read, and goes along from shard to
shard.  Results are exact: a box whose bound equals the k-th score is still
opened, for ties.
"""

from __future__ import annotations

import heapq
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .storage import pack, read_file, unpack, write_file

#: Vectors in a shard, in a leaf of its tree; shards that one task visits: about.
SHARD, LEAF, VISITED = 8192, 192, 32
#: Vectors that the coarse tree is fitted on, at most, and of these in a region, at least.
SAMPLE, REGION = 16_384, 64
SCALED = "vec_id long, dim int, vector binary"
#: Sums of products are exact in doubles while they are below this.
EXACT = 2.0**52
LONGS = -(2**63), 2**63 - 1


@dataclass
class Tree:
    """Vectors in the order of the leaves; nodes by number, children after parents."""

    ids: np.ndarray
    vectors: np.ndarray  # whole numbers, as doubles
    low: np.ndarray
    high: np.ndarray
    left: np.ndarray  # -1 at a leaf
    right: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def __post_init__(self):
        self.biggest = float(np.abs(self.vectors).max(initial=0))
        self.same = (self.low == self.high).all(axis=1)

    def exact(self, queries: np.ndarray) -> bool:
        """Whether doubles hold these queries' scores without rounding."""
        return self.biggest * float(np.abs(queries).max(initial=0)) * max(1, self.vectors.shape[1]) < EXACT

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> "Tree":
        order = np.lexsort((ids,))
        nodes: list[list] = []
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            part = vectors[order[a:b]]
            low, high = part.min(axis=0), part.max(axis=0)
            number = len(nodes)
            nodes.append([low, high, -1, -1, a, b])
            if parent >= 0:
                nodes[parent][2 + side] = number
            if b - a <= leaf or (low == high).all():
                order[a:b] = np.sort(order[a:b]) if parent < 0 else order[a:b][np.argsort(ids[order[a:b]], kind="stable")]
                continue
            widest = int(np.argmax(high / 2 - low / 2))
            middle = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(part[:, widest], middle)]
            todo += [(a, a + middle, number, 0), (a + middle, b, number, 1)]
        low, high, left, right, begin, end = zip(*nodes)
        numbers = [np.array(x, dtype=np.int64) for x in (left, right, begin, end)]
        return cls(ids[order], vectors[order], np.array(low), np.array(high), *numbers)

    def dump(self) -> bytes:
        whole, real = ("ids", "left", "right", "begin", "end"), ("vectors", "low", "high")
        named = {n: np.ascontiguousarray(getattr(self, n), dtype="<i8").tobytes() for n in whole}
        named |= {n: np.ascontiguousarray(getattr(self, n), dtype="<f8").tobytes() for n in real}
        return pack(named | {"dim": struct.pack("<q", self.vectors.shape[1])})

    @classmethod
    def load(cls, raw: bytes) -> "Tree":
        parts = unpack(raw)
        (dim,) = struct.unpack("<q", parts.pop("dim"))
        real = ("vectors", "low", "high")
        arrays = {n: np.frombuffer(b, dtype="<f8" if n in real else "<i8") for n, b in parts.items()}
        sizes = {"vectors": len(arrays["ids"]), "low": len(arrays["left"]), "high": len(arrays["left"])}
        return cls(**{n: a.reshape(sizes[n], dim) if n in sizes else a for n, a in arrays.items()})

    def search(self, queries: np.ndarray, k: int, best: list["Best"], own: list[int] | None = None) -> None:
        """Put each query's better candidates into its `best`; own: its row here, which is left out."""
        if not len(self.ids):
            return
        exact = self.exact(queries)
        bounds = most(queries, self.low, self.high, exact)
        for row in range(len(queries)):
            q, found, bound = queries[row], best[row], bounds[row].tolist()
            heap = [(-bound[0], 0)]
            while heap:
                highest, node = heapq.heappop(heap)
                if -highest < found.least:
                    break
                if self.left[node] >= 0:
                    for child in (int(self.left[node]), int(self.right[node])):
                        if bound[child] >= found.least:
                            heapq.heappush(heap, (-bound[child], child))
                    continue
                a, b = int(self.begin[node]), int(self.end[node])
                if self.same[node]:  # equal vectors by ascending id: no more can matter
                    b = min(b, a + k + 1)
                scores = self.vectors[a:b] @ q if exact else _wide(self.vectors[a:b], q)
                keep = scores >= found.least
                if own is not None and a <= own[row] < b:
                    keep[own[row] - a] = False
                if keep.any():
                    found.add(scores[keep].astype(np.int64), self.ids[a:b][keep])


def _wide(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Scores beyond what doubles hold, in whole numbers of any size; those beyond 64 bits are the nearest of 64."""
    q = [int(x) for x in query.tolist()]
    sums = (sum(int(x) * y for x, y in zip(row, q)) for row in vectors.tolist())
    return np.array([min(max(x, LONGS[0]), LONGS[1]) for x in sums], dtype=object)


def most(queries: np.ndarray, low: np.ndarray, high: np.ndarray, exact: bool) -> np.ndarray:
    """The most that each query can score in each box; never too low."""
    with np.errstate(over="ignore", invalid="ignore"):
        bound = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
        if exact:
            return bound
        # products may round, overflow or cancel: room for that by the sizes of what is summed
        size = np.abs(queries) @ np.maximum(np.abs(low), np.abs(high)).T
        wide = bound + size * 1e-9 + 1
        return np.where(np.isfinite(wide), np.minimum(wide, float(LONGS[1])), np.inf)


class Best:
    """A query's k best candidates so far and the score that a better one needs."""

    def __init__(self, k: int, least: int | None = None):
        self.k, self.least = k, -np.inf if least is None else least
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, ~scores))[: self.k]  # ~x falls as x rises, without overflow
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.scores[-1]))


def scaled(vectors: DataFrame, scale: int) -> DataFrame:
    """floor(scale * x) of every usable vector as doubles, which hold it exactly; others are dropped."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if vec_id is None or vector is None or None in vector:
                continue
            plain = np.array(vector, dtype=np.float64)
            if np.isfinite(plain).all():
                with np.errstate(over="ignore"):
                    values = np.nan_to_num(np.floor(plain * scale))  # doubles near their limit stay there
                rows.append((vec_id, len(vector), values.astype("<f8").tobytes()))
        columns = list(zip(*rows)) if rows else [(), (), ()]
        kinds = (pa.int64(), pa.int32(), pa.binary())
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["vec_id", "dim", "vector"])

    return common.map_batches(vectors.select("vec_id", "embedding"), run, SCALED)


@dataclass
class Regions:
    """Space cut by a coarse tree, for the vectors of one dimension."""

    axis: np.ndarray  # of each node: the dimension that it cuts, -1 at a leaf
    cut: np.ndarray  # vectors below it go left
    left: np.ndarray
    right: np.ndarray
    first: np.ndarray  # of each leaf: its first shard
    shards: np.ndarray  # and how many it has

    @classmethod
    def fit(cls, sample: np.ndarray, total: int, first: int) -> "Regions":
        """Cut at medians until a region has a shard's share, or too little of the sample to say."""
        nodes: list[list] = []
        todo = [(np.arange(len(sample)), -1, 0)]
        while todo:
            rows, parent, side = todo.pop()
            number = len(nodes)
            nodes.append([-1, 0.0, -1, -1, 0, 0])
            if parent >= 0:
                nodes[parent][2 + side] = number
            share = total * len(rows) / max(1, len(sample))
            if len(rows) >= 2 * REGION and share > SHARD and sample.shape[1]:
                part = sample[rows]
                widest = int(np.argmax(part.max(axis=0) / 2 - part.min(axis=0) / 2))
                cut = float(np.median(part[:, widest]))
                below = part[:, widest] < cut
                if not below.any():  # the median is the least value, as where most vectors are equal
                    cut = np.nextafter(cut, np.inf)
                    below = part[:, widest] < cut
                if not below.all():
                    nodes[number][:2] = [widest, cut]
                    todo += [(rows[below], number, 0), (rows[~below], number, 1)]
                    continue
            nodes[number][4:] = [first, max(1, math.ceil(share / SHARD))]
            first += nodes[number][5]
        columns = list(zip(*nodes))
        kinds = (np.int64, np.float64, np.int64, np.int64, np.int64, np.int64)
        return cls(*[np.array(c, dtype=k) for c, k in zip(columns, kinds)])

    def of(self, vectors: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(region, shard) of each vector; inside a region the shard is by the id's hash."""
        node = np.zeros(len(vectors), dtype=np.int64)
        while (moving := np.flatnonzero(self.axis[node] >= 0)).size:
            here = node[moving]
            below = vectors[moving, self.axis[here]] < self.cut[here]
            node[moving] = np.where(below, self.left[here], self.right[here])
        spread = (common.mixed(ids.astype(np.uint64), 7) % self.shards[node].astype(np.uint64)).astype(np.int64)
        return node, self.first[node] + spread


def _matrix(vectors: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), dtype="<f8").reshape(len(vectors), dim)


def regions(rows: DataFrame) -> dict[int, Regions]:
    """Per dimension the regions, from its SAMPLE vectors with the smallest id hashes.

    A row per dimension and the sample reach the driver, whatever the table's size.
    """
    counted = rows.where("dim > 0").groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(64).collect()
    out, first = {}, 0
    for r in counted:
        share = min(1.0, 2.0 * SAMPLE / r["n"])
        hashed = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
        part = rows.where((F.col("dim") == r["dim"]) & (hashed <= int(share * (1 << 30)))).select(F.xxhash64("vec_id").alias("h"), "vec_id", "vector")
        taken = part.orderBy("h", "vec_id").limit(SAMPLE).collect()
        sample = _matrix([x["vector"] for x in taken], r["dim"]) if taken else np.zeros((0, r["dim"]))
        out[r["dim"]] = Regions.fit(sample, r["n"], first)
        first = int((out[r["dim"]].first + out[r["dim"]].shards).max())
    return out


def top_k(vectors: DataFrame, *, k: int = 20, every: int = 20, scale: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of all other rows for each query.

    `vectors` needs vec_id and embedding; other columns are not read.  Queries
    are the rows whose vec_id is divisible by `every`.  Rows with a null id,
    a null vector, or a null or non-finite component take no part; vectors of
    different dimension don't meet.  Rows that repeat an id are candidates and
    queries of their own.  Equal scores go to the smaller vec_id.  Scores are
    exact, however large the components; one beyond 64 bits counts as the
    nearest number of 64.  Vectors of any length are held whole, a shard of
    them at a time.  No rows give none.
    """
    spark = vectors.sparkSession
    folder = common.work_dir(spark, "kd")
    tasks = common.partitions(vectors)
    rows = common.written(scaled(vectors, scale), "vectors")
    cuts = regions(rows)
    shards = max((int((r.first + r.shards).max()) for r in cuts.values()), default=1)
    spare = shards  # vectors of rare dimensions: their shards follow, by hash

    def path(kind: str, shard: int, dim: int) -> str:
        return f"{folder}/{kind}-{shard:09d}-{dim}"

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, dims = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        region, shard = np.full(len(ids), -1, dtype=np.int64), spare + (common.mixed(ids.astype(np.uint64), 7) % np.uint64(VISITED)).astype(np.int64)
        vectors = batch.column(2)
        for dim in np.unique(dims).tolist():
            if dim in cuts:
                at = np.flatnonzero(dims == dim)
                region[at], shard[at] = cuts[dim].of(_matrix(vectors.take(pa.array(at)).to_pylist(), dim), ids[at])
        columns = [pa.array(shard), pa.array(region), *batch.columns]
        return pa.record_batch(columns, names=["shard", "region", "vec_id", "dim", "vector"])

    home_schema = "shard long, region long, query_id long, copy long, dim int, vector binary, least long, ids array<long>, scores array<long>, low array<double>, high array<double>"
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64()))
    names = [c.split()[0] for c in home_schema.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Write the shard's trees and root boxes, and search them for the queries that live here."""
        held: dict[tuple, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for shard, region, vec_id, dim, vector in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault((shard, region, dim), []).append((vec_id, vector))
        for (shard, region, dim), members in held.items():
            members.sort()
            tree = Tree.build(np.array([m[0] for m in members], dtype=np.int64), _matrix([m[1] for m in members], dim))
            write_file(path("tree", shard, dim), tree.dump())
            write_file(path("box", shard, dim), np.stack([tree.low[0], tree.high[0]]).astype("<f8").tobytes())
            own = np.flatnonzero(tree.ids % every == 0)
            best = [Best(k) for _ in own]
            if len(own):
                tree.search(tree.vectors[own], k, best, own.tolist())
            copies: dict[int, int] = {}
            out: list[tuple] = [(shard, region, None, None, dim, None, None, None, None, tree.low[0].tolist(), tree.high[0].tolist())]
            for at, found in zip(own.tolist(), best):
                query = int(tree.ids[at])
                copy = copies[query] = copies.get(query, -1) + 1
                least = None if found.least == -np.inf else int(found.least)
                out.append((shard, region, query, copy, dim, tree.vectors[at].tobytes(), least, found.ids.tolist(), found.scores.tolist(), None, None))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

    placed = common.map_batches(rows, place, "shard long, region long, vec_id long, dim int, vector binary")
    home = common.written(placed.repartition(max(tasks, shards // 8), "shard").mapInArrow(build, home_schema), "home")
    queries = home.where("query_id is not null").select("shard", "query_id", "copy", "dim", "vector", "least", "ids", "scores")

    # a region's box is that of its shards; the coarse trees have at most SAMPLE / REGION regions a dimension
    bounds = home.where("query_id is null").select("dim", "region", F.posexplode(F.arrays_zip("low", "high")).alias("i", "x"))
    bounds = bounds.groupBy("dim", "region", "i").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high"))
    boxes: dict[int, dict[int, np.ndarray]] = {}
    for r in bounds.where("region >= 0").collect():
        boxes.setdefault(r["dim"], {}).setdefault(r["region"], np.zeros((2, r["dim"])))[:, r["i"]] = r["low"], r["high"]

    route_schema = "home long, query_id long, copy long, dim int, vector binary, least long, first long, stop long"

    def route(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        """A row per query and range of shards whose region may hold something better."""
        rows = batch.to_pylist()
        out: list[tuple] = []
        for dim in {r["dim"] for r in rows}:
            block = [r for r in rows if r["dim"] == dim]
            least = np.array([-np.inf if r["least"] is None else float(r["least"]) for r in block])
            ranges, known = [(spare, spare + VISITED)], np.full((len(block), 1), dim not in cuts)
            if dim in cuts:
                found = boxes.get(dim, {})
                numbers = sorted(found)
                low, high = (np.array([found[n][side] for n in numbers]).reshape(-1, dim) for side in (0, 1))
                # not exact: rounding may only let a region through
                known = most(_matrix([r["vector"] for r in block], dim), low, high, False) >= least[:, None] - np.abs(least[:, None]) * 1e-9 if numbers else known[:, :0]
                ranges = [(int(cuts[dim].first[n]), int(cuts[dim].first[n] + cuts[dim].shards[n])) for n in numbers]
            for i, j in zip(*np.nonzero(known)):
                r = block[i]
                for first in range(ranges[j][0], ranges[j][1], VISITED):
                    out.append((r["shard"], r["query_id"], r["copy"], dim, r["vector"], r["least"], first, min(first + VISITED, ranges[j][1])))
        if not out:
            return None
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[c.split()[0] for c in route_schema.split(", ")])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Search ranges of shards for the queries of one home shard, the k-th score going along."""
        held: dict[tuple, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault((row["first"], row["stop"], row["dim"], row["home"]), []).append(row)
        kept: tuple | None = None  # the tree read last, as ranges come in order
        for (first, stop, dim, home_shard), block in sorted(held.items(), key=lambda x: x[0]):
            block.sort(key=lambda r: (r["query_id"], r["copy"]))
            matrix = _matrix([r["vector"] for r in block], dim)
            best = [Best(k, r["least"]) for r in block]
            for shard in range(first, stop):
                if shard == home_shard:
                    continue
                try:
                    low, high = np.frombuffer(read_file(path("box", shard, dim)), dtype="<f8").reshape(2, 1, dim)
                except FileNotFoundError:  # no vector of this dimension fell there
                    continue
                least = np.array([float(b.least) for b in best])
                some = np.flatnonzero(most(matrix, low, high, False)[:, 0] >= least - np.abs(least) * 1e-9 if np.isfinite(least).all() else np.ones(len(best), dtype=bool))
                if len(some):
                    if kept is None or kept[0] != (shard, dim):
                        kept = ((shard, dim), Tree.load(read_file(path("tree", shard, dim))))
                    kept[1].search(matrix[some], k, [best[i] for i in some])
            out = [(r["query_id"], r["copy"], r["home"], dim, i, s) for r, b in zip(block, best) for i, s in zip(b.ids.tolist(), b.scores.tolist())]
            if out:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=["query_id", "copy", "home", "dim", "vec_id", "score"])

    routed = common.map_batches(queries.select("shard", "query_id", "copy", "dim", "vector", "least"), route, route_schema)
    far = routed.repartition(max(tasks, shards // 8), "first", "home").mapInArrow(visit, "query_id long, copy long, home long, dim long, vec_id long, score long")
    near = queries.select("query_id", "copy", F.col("shard").alias("home"), F.col("dim").cast("long").alias("dim"), F.explode(F.arrays_zip("ids", "scores")).alias("x"))
    near = near.select("query_id", "copy", "home", "dim", F.col("x.ids").alias("vec_id"), F.col("x.scores").alias("score"))
    order = Window.partitionBy("query_id", "copy", "home", "dim").orderBy(F.desc("score"), "vec_id")
    ranked = near.unionByName(far).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

"""Exact Jaccard join of texts on word shingles, by signature trees.

1. Texts are tokenised once into batches (files of word numbers); equal sets
   become one node.
2. The corpus counts in how many nodes each shingle is.  A node's rarest
   n - ceil(0.75 n) + 1 shingles are its prefix: two nodes that link share a
   prefix shingle.  Nodes that share one are in one block, through any chain;
   most nodes share none and are finished.
3. A block's nodes meet in one task, or, cut into chunks by size class and hash,
   in a task per pair of chunks whose sizes can match.  A tree over them holds in each node the OR of the shingle bitmaps
   below, the range of set sizes, and how many shingles a bitmap may hide.  A
   traversal of the tree against itself drops pairs of tree nodes whose sizes
   cannot match, whose largest possible overlap is too small, or that are
   connected already; what is left is verified on the sets themselves.

A passage shared by many texts is made of frequent shingles, which come last
in the order and so are in few prefixes.  A large group of near copies costs a
row per batch and shingle, and once a chunk is connected its pairs are dropped
together.  Texts of one set are never paired.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .components import LINKS, Forest, components
from .storage import dump, dump_sorted, load, load_sorted, pack, read_file, slices, unpack, write_file

#: Tokens in a batch; shingles in a chunk of a block: about.
BATCH_TOKENS, CHUNK = 500_000, 60_000
#: Bytes of the bitmaps of one signature tree's texts, at most.
BITMAPS = 32 << 20
#: Texts in a leaf of a signature tree, children of its nodes.
LEAF, FANOUT = 8, 4
#: A row is numbered by its batch and its place in it.
PLACES = 22
DOCS = "row long, doc_id long, text_hash long, n long, k1 long, k2 long"
MESSAGE = "kind string, batch long, part int, keys binary, a binary"
SETS = "block long, class int, chunk int, node long, n long, tokens binary"


def shingles(words: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of each text, by text and hash.

    words: the 64-bit hashes of all words.  A text of fewer words is one
    shingle; one without words has none.
    """
    n = len(words)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    owners, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    with np.errstate(over="ignore"):
        if n >= size:
            h = np.zeros(n - size + 1, dtype=np.uint64)
            for j in range(size):
                h = common.mixed(h * np.uint64(3) + words[j : j + len(h)], j)
            inside = doc[: len(h)] == doc[size - 1 :]
            owners.append(doc[: len(h)][inside])
            hashes.append(h[inside])
        starts = np.cumsum(lengths) - lengths
        for few in range(1, size):
            which = np.flatnonzero(lengths == few)
            h = np.full(len(which), np.uint64(few + 1000))
            for j in range(few):
                h = common.mixed(h * np.uint64(3) + words[starts[which] + j], 50 + few)
            owners.append(which)
            hashes.append(h)
    owner, found = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((found, owner))
    owner, found = owner[order], found[order]
    first = np.ones(len(owner), dtype=bool)
    first[1:] = (owner[1:] != owner[:-1]) | (found[1:] != found[:-1])
    return owner[first], found[first]


def tokenise(documents: DataFrame, folder: str, size: int) -> DataFrame:
    """Write the batches; a row per document with its set's size and 128-bit key."""
    tasks = common.partitions(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        task, turn, held = TaskContext.get().partitionId(), 0, 0
        docs: list[tuple] = []
        parts: list[np.ndarray] = []
        number: dict[bytes, int] = {}

        def close() -> pa.RecordBatch:
            nonlocal turn, held, docs, parts, number
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number), dtype=np.uint64, count=len(number))
            ordered, place = np.unique(hashes, return_inverse=True) if len(hashes) else (hashes, np.empty(0, np.int64))
            words = place[np.concatenate(parts)] if held else np.empty(0, np.int64)
            lengths = np.array([d[2] for d in docs], dtype=np.int64)
            owner, found = shingles(ordered[words] if held else np.empty(0, np.uint64), lengths, size)
            count = np.bincount(owner, minlength=len(docs))
            keys = []
            bounds = np.cumsum(count) - count
            some = np.flatnonzero(count)
            for seed in (5, 6):
                key = np.zeros(len(docs), dtype=np.uint64)
                if len(some):
                    with np.errstate(over="ignore"):
                        key[some] = np.add.reduceat(common.mixed(found, seed), bounds[some])
                keys.append(pa.array(key.view(np.int64)))
            batch, turn = task + turn * tasks, turn + 1
            named = {"hashes": dump_sorted(ordered), "words": dump(words.astype(np.uint32)), "lengths": dump(lengths)}
            write_file(f"{folder}/batch-{batch:09d}", pack(named))
            rows = pa.array((np.int64(batch) << PLACES) + np.arange(len(docs)))
            ids, texts = pa.array([d[0] for d in docs], pa.int64()), pa.array([d[1] for d in docs], pa.int64())
            docs, parts, number, held = [], [], {}, 0
            return pa.record_batch([rows, ids, texts, pa.array(count.astype(np.int64)), *keys], names=[c.split()[0] for c in DOCS.split(", ")])

        for batch in common.sliced(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                words = raw.translate(common.LOWER_BYTES).split()
                for word in set(words).difference(number):
                    number[word] = len(number)
                parts.append(np.fromiter(map(number.__getitem__, words), dtype=np.uint32, count=len(words)))
                # as Spark's xxhash64(text), by which a row is found again
                signed = xxhash.xxh64_intdigest(raw, seed=42) if text is not None else 42
                docs.append((doc, signed - 2**64 if signed >= 2**63 else signed, len(words)))
                held += len(words)
                if held >= BATCH_TOKENS or len(docs) >= 1 << (PLACES - 1):
                    yield close()
        if docs:
            yield close()

    return documents.select("doc_id", "text").mapInArrow(run, DOCS)


class Batch:
    """The shingle sets of some of a batch's texts."""

    def __init__(self, folder: str, number: int, places: np.ndarray, size: int):
        raw = unpack(read_file(f"{folder}/batch-{number:09d}"))
        hashes, words, lengths = load_sorted(raw["hashes"]), load(raw["words"]), load(raw["lengths"])
        keep = np.zeros(len(lengths), dtype=bool)
        keep[places] = True
        chosen = hashes[words[np.repeat(keep, lengths)]] if len(words) else np.empty(0, np.uint64)
        owner, self.tokens = shingles(chosen, lengths[keep], size)
        self.nodes = (np.int64(number) << PLACES) + np.flatnonzero(keep)
        self.counts = np.bincount(owner, minlength=len(self.nodes))
        self.owner = owner


def _by_batch(df: DataFrame, node: str, tasks: int) -> DataFrame:
    """Rows go to a task by the batch of their node."""
    batch = F.shiftright(F.col(node), PLACES)
    return df.withColumn("batch", batch).repartitionById(tasks, F.pmod(batch, F.lit(tasks)).cast("int"))


def _held(batches: Iterator[pa.RecordBatch]) -> dict[int, dict[str, np.ndarray]]:
    """A partition's numeric rows by batch."""
    tables = list(batches)
    if not tables:
        return {}
    table = pa.Table.from_batches(tables)
    columns = {name: table.column(name).to_numpy() for name in table.column_names}
    order = np.argsort(columns["batch"], kind="stable")
    numbers, first = np.unique(columns["batch"][order], return_index=True)
    cuts = [*first.tolist(), len(order)]
    return {int(b): {k: v[order[a:z]] for k, v in columns.items()} for b, a, z in zip(numbers, cuts, cuts[1:])}


def _message(kind: str, batch: int, rows: list[tuple[int, bytes, bytes | None]]) -> pa.RecordBatch:
    columns = [pa.array([kind] * len(rows)), pa.array([batch] * len(rows), pa.int64()), pa.array([r[0] for r in rows], pa.int32())]
    columns += [pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())]
    return pa.record_batch(columns, names=["kind", "batch", "part", "keys", "a"])


COARSE = 24  # low bits that frequencies don't look at; a clash only makes a shingle look more frequent


def _coarse(tokens: np.ndarray) -> np.ndarray:
    return tokens & ~np.uint64((1 << COARSE) - 1)


def frequencies(nodes: DataFrame, folder: str, tasks: int, bits: int, size: int) -> DataFrame:
    """To each batch, in the order of its distinct coarse shingles: 0 for one in a single node, else 1 + log2."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        for number, rows in _held(batches).items():
            sets = Batch(folder, number, rows["node"] & ((1 << PLACES) - 1), size)
            keys, times = np.unique(_coarse(sets.tokens), return_counts=True)
            yield _message("count", number, [(p, dump_sorted(keys[a:b] >> np.uint64(COARSE)), dump(times[a:b].astype(np.uint32))) for p, a, b in slices(keys, bits)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        held: dict[int, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["part"], []).append(row)
        for part, rows in held.items():
            keys, times = [load_sorted(r["keys"]) for r in rows], [load(r["a"]) for r in rows]
            distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            total = np.bincount(inverse, weights=np.concatenate(times), minlength=len(distinct))
            level = np.where(total > 1, 1 + np.floor(np.log2(np.maximum(total, 1))), 0).astype(np.uint8)[inverse]
            at = 0
            for row, own in zip(rows, keys):
                yield _message("reply", row["batch"], [(part, dump(level[at : at + len(own)]), None)])
                at += len(own)

    sent = _by_batch(nodes.select("node"), "node", tasks).mapInArrow(count, MESSAGE)
    return common.written(sent.repartitionById(1 << bits, "part").mapInArrow(add, MESSAGE), "frequencies")


def star(keys: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of (key, node) rows: first row of each key in order of key and node, and the links of its other nodes to that one."""
    order = np.lexsort((nodes, keys))
    keys, nodes = keys[order], nodes[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    leader = nodes[np.maximum.accumulate(np.where(first, np.arange(len(keys)), 0))] if len(keys) else nodes
    links = np.unique(np.stack([leader, nodes], axis=1)[leader != nodes], axis=0) if len(keys) else np.empty((0, 2), np.int64)
    return keys[first], nodes[first], links


def candidates(nodes: DataFrame, levels: DataFrame, folder: str, tasks: int, bits: int, size: int, percent: int) -> DataFrame:
    """Links between nodes that share a prefix shingle, as stars: enough to connect them, not all pairs."""
    replies = levels.select(F.lit(None).cast("long").alias("node"), "batch", "part", F.col("keys").alias("level"))
    wanted = nodes.select("node", F.shiftright("node", PLACES).alias("batch"), F.lit(None).cast("int").alias("part"), F.lit(None).cast("binary").alias("level"))

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        places: dict[int, list[int]] = {}
        parts: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            for node, number, part, level in zip(*(c.to_pylist() for c in batch.columns)):
                if node is not None:
                    places.setdefault(number, []).append(node & ((1 << PLACES) - 1))
                else:
                    parts.setdefault(number, []).append((part, level))
        for number in sorted(places):
            sets = Batch(folder, number, np.array(places[number]), size)
            level = np.concatenate([load(raw) for _, raw in sorted(parts[number])])
            of = level[np.unique(_coarse(sets.tokens), return_inverse=True)[1]]
            order = np.lexsort((sets.tokens, of, sets.owner))
            rank = np.arange(len(order)) - np.repeat(np.cumsum(sets.counts) - sets.counts, sets.counts)
            length = sets.counts - (percent * sets.counts + 99) // 100 + 1
            keep = order[(rank < length[sets.owner[order]]) & (of[order] > 0)]
            keys, leaders, links = star(sets.tokens[keep], sets.nodes[sets.owner[keep]])
            if len(links):
                yield _message("links", number, [(-1, dump(links[:, 0].copy()), dump(links[:, 1].copy()))])
            if len(keys):
                yield _message("keys", number, [(p, dump_sorted(keys[a:b]), dump(leaders[a:b])) for p, a, b in slices(keys, bits)])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        keys, nodes = [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == "links":
                    links = np.stack([load(row["keys"]), load(row["a"])], axis=1)
                    yield pa.record_batch([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])
                else:
                    keys.append(load_sorted(row["keys"]))
                    nodes.append(load(row["a"]))
        if keys:
            links = star(np.concatenate(keys), np.concatenate(nodes))[2]
            if len(links):
                yield pa.record_batch([pa.array(links[:, 0].copy()), pa.array(links[:, 1].copy())], names=["a", "b"])

    home = F.pmod(F.col("batch"), F.lit(tasks)).cast("int")
    sent = wanted.unionByName(replies).repartitionById(tasks, home).mapInArrow(prefix, MESSAGE)
    target = F.when(F.col("part") >= 0, F.col("part")).otherwise(F.pmod(F.col("batch"), F.lit(1 << bits))).cast("int")
    return sent.repartitionById(1 << bits, target).mapInArrow(meet, LINKS)


class SignatureTree:
    """A tree over sets by size and smallest shingle, and its traversal against itself."""

    def __init__(self, nodes: list[int], sets: list[np.ndarray], percent: int, groups: list[int] | None = None):
        order = sorted(range(len(nodes)), key=lambda i: (len(sets[i]), int(sets[i][0]), nodes[i]))
        self.nodes, self.sets = [nodes[i] for i in order], [sets[i] for i in order]
        self.groups = [groups[i] for i in order] if groups else None
        self.percent = percent
        sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        bits = 256
        while bits < 2 * sizes.max() and bits < 1 << 16 and bits // 4 * len(order) <= BITMAPS:
            bits *= 2
        self.bits = np.zeros((len(order), bits // 64), dtype=np.uint64)
        for row, tokens in enumerate(self.sets):
            at = np.unique(tokens % np.uint64(bits))
            np.bitwise_or.at(self.bits[row], (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63)))
        self.sizes = sizes
        self.hidden = sizes - np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        # nodes of the tree: (children, first text, one past the last)
        level = [(None, a, min(a + LEAF, len(order))) for a in range(0, len(order), LEAF)]
        self.tree: list[tuple] = list(level)
        level_ids = list(range(len(level)))
        while len(level_ids) > 1:
            above = []
            for a in range(0, len(level_ids), FANOUT):
                children = level_ids[a : a + FANOUT]
                self.tree.append((children, self.tree[children[0]][1], self.tree[children[-1]][2]))
                above.append(len(self.tree) - 1)
            level_ids = above
        self.root = level_ids[0]
        self.union = np.zeros((len(self.tree), bits // 64), dtype=np.uint64)
        self.least, self.most, self.hides = (np.zeros(len(self.tree), dtype=np.int64) for _ in range(3))
        for k, (children, a, b) in enumerate(self.tree):
            self.union[k] = np.bitwise_or.reduce(self.bits[a:b] if children is None else self.union[children], axis=0)
            self.least[k], self.most[k], self.hides[k] = sizes[a], sizes[b - 1], self.hidden[a:b].max()
        self.connected = [False] * len(self.tree)

    def may_match(self, x: int, y: int) -> bool:
        """Whether texts below two tree nodes can link at all."""
        if 100 * self.most[x] < self.percent * self.least[y] or 100 * self.most[y] < self.percent * self.least[x]:
            return False
        overlap = int(np.bitwise_count(self.union[x] & self.union[y]).sum()) + min(self.hides[x], self.hides[y])
        return (100 + self.percent) * overlap >= self.percent * (self.least[x] + self.least[y])

    def _one(self, k: int, forest: Forest) -> bool:
        """Whether the texts below are connected with each other; once true it stays."""
        if not self.connected[k]:
            children, a, b = self.tree[k]
            if children is not None and not all(self._one(c, forest) for c in children):
                return False
            firsts = range(a, b) if children is None else [self.tree[c][1] for c in children]
            roots = {forest.find(self.nodes[i]) for i in firsts}
            self.connected[k] = len(roots) == 1
        return self.connected[k]

    def links(self, forest: Forest, across: bool = False) -> list[tuple[int, int]]:
        """Links that connect what links connect; across: only between different groups."""
        found = []
        stack = [(self.root, self.root)]
        while stack:
            x, y = stack.pop()
            if self._one(x, forest) and (x == y or self._one(y, forest) and forest.find(self.nodes[self.tree[x][1]]) == forest.find(self.nodes[self.tree[y][1]])):
                continue
            if not self.may_match(x, y):
                continue
            left, right = self.tree[x][0], self.tree[y][0]
            if left is None and right is None:
                found += self._leaves(x, y, forest, across)
            elif x == y:
                pairs = [(left[i], left[j]) for i in range(len(left)) for j in range(i + 1, len(left))]
                stack += pairs[::-1] + [(c, c) for c in left]  # within children first: they connect
            elif right is None or left is not None and self.tree[x][2] - self.tree[x][1] >= self.tree[y][2] - self.tree[y][1]:
                stack += [(c, y) for c in left]
            else:
                stack += [(x, c) for c in right]
        return found

    def _leaves(self, x: int, y: int, forest: Forest, across: bool) -> list[tuple[int, int]]:
        (_, a, b), (_, c, d) = self.tree[x], self.tree[y]
        common_bits = np.bitwise_count(self.bits[a:b, None] & self.bits[None, c:d]).sum(axis=2, dtype=np.int64)
        overlap = common_bits + np.minimum(self.hidden[a:b, None], self.hidden[None, c:d])
        possible = (100 + self.percent) * overlap >= self.percent * (self.sizes[a:b, None] + self.sizes[None, c:d])
        found = []
        for i, j in zip(*np.nonzero(possible)):
            i, j = a + int(i), c + int(j)
            if x == y and i >= j or across and self.groups[i] == self.groups[j]:
                continue
            if forest.find(self.nodes[i]) == forest.find(self.nodes[j]):
                continue
            same = len(np.intersect1d(self.sets[i], self.sets[j], assume_unique=True))
            if 100 * same >= self.percent * (len(self.sets[i]) + len(self.sets[j]) - same):
                forest.join(self.nodes[i], self.nodes[j])
                found.append((self.nodes[i], self.nodes[j]))
        return found


def _links(rows: DataFrame, keys: list[str], tasks: int, percent: int) -> DataFrame:
    """Links inside each group of rows by `keys`; across chunks only, if a group has two, and not inside known components."""
    columns = [*keys, "chunk", "node", "known", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, list[tuple]] = {}
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in dict.fromkeys(columns))):
                named = dict(zip(dict.fromkeys(columns), row))
                groups.setdefault(tuple(named[k] for k in keys), []).append((named["chunk"], named["node"], named["known"], named["tokens"]))
        for members in groups.values():
            if len(members) < 2:
                continue
            members.sort(key=lambda m: m[1])
            forest = Forest()
            first: dict[int, int] = {}
            for _, node, known, _ in members:
                if known is not None and first.setdefault(known, node) != node:
                    forest.join(first[known], node)
            sets = [np.frombuffer(m[3], dtype="<u8") for m in members]
            tree = SignatureTree([m[1] for m in members], sets, percent, [m[0] for m in members])
            if found := tree.links(forest, across=len({m[0] for m in members}) > 1):
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

    return rows.repartition(tasks, *keys).mapInArrow(run, LINKS)


def linked(documents: DataFrame, *, size: int = 5, percent: int = 75) -> tuple[DataFrame, DataFrame]:
    """(rows, sets): a row per document with its set's key, and each set with its component's root."""
    spark = documents.sparkSession
    common.small_batches(spark)
    folder = common.work_dir(spark, "shingles")
    tasks = common.partitions(documents)
    bits = common.key_bits(documents)
    docs = common.written(tokenise(documents, folder, size), "documents")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "text_hash")
    sets = docs.where("n > 0").groupBy("k1", "k2", "n").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.min(first).alias("first"))
    sets = common.written(sets, "sets")
    nodes = sets.select("node")

    levels = frequencies(nodes, folder, tasks, bits, size)
    blocks = common.written(components(candidates(nodes, levels, folder, tasks, bits, size, percent)), "blocks")
    blocks = blocks.join(sets.select("node", "n"), "node").select("node", F.col("root").alias("block"), "n")
    # two sets can link only if their size classes are equal or next to each other
    klass = F.floor(F.log(F.col("n").cast("double")) / (math.log(100 / percent) * (1 + 1e-9))).cast("int") if percent < 100 else F.col("n").cast("int")
    blocks = blocks.withColumn("class", klass)
    sums = blocks.groupBy("block", "class").agg(F.sum("n").alias("shingles"))
    wide = F.sum("shingles").over(Window.partitionBy("block")) > CHUNK  # a block has few classes
    plan = sums.select("block", "class", F.when(wide, F.ceil(F.col("shingles") / CHUNK)).otherwise(0).cast("int").alias("chunks"))
    some = F.col("chunks") > 0
    placed = common.salted_join(blocks.select("node", "block", "class"), plan, ["block", "class"], "node")
    chunk = F.pmod(F.xxhash64("node"), F.greatest("chunks", F.lit(1))).cast("int")
    placed = placed.select("node", "block", F.when(some, F.col("class")).otherwise(0).alias("class"), F.when(some, chunk).otherwise(0).alias("chunk"))

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        for number, rows in _held(batches).items():
            own = Batch(folder, number, rows["node"] & ((1 << PLACES) - 1), size)
            of = np.argsort(rows["node"])
            ends = np.cumsum(own.counts)
            tokens = [own.tokens[e - c : e].astype("<u8").tobytes() for c, e in zip(own.counts.tolist(), ends.tolist())]
            columns = [*(pa.array(rows[c][of]) for c in ("block", "class", "chunk")), pa.array(own.nodes), pa.array(own.counts.astype(np.int64)), pa.array(tokens, pa.binary())]
            yield pa.record_batch(columns, names=["block", "class", "chunk", "node", "n", "tokens"])

    shipped = common.written(_by_batch(placed, "node", tasks).mapInArrow(ship, SETS), "shipped")
    # a chunk is named by its size class and number
    shipped = shipped.withColumn("chunk", F.col("class") * F.lit(1 << 20) + F.col("chunk"))
    inner = shipped.withColumn("known", F.lit(None).cast("long"))
    links = common.written(_links(inner, ["block", "chunk"], 2 * tasks, percent), "links")

    chunks = common.written(shipped.groupBy("block", "class", "chunk").agg(F.count("*").alias("members")), "chunks")
    wide = chunks.groupBy("block").agg(F.count("*").alias("chunks")).where("chunks > 1")
    if not wide.isEmpty():
        # the first chunk of each class against those of its class and the next one, then what isn't one component yet
        for first in (True, False):
            known = components(links)
            rows = common.salted_join(shipped, wide.select("block"), ["block"], "node").join(known.select("node", F.col("root").alias("known")), "node", "left")
            rows = common.written(rows, "cross")
            several = rows.groupBy("block").agg(F.count_distinct(F.coalesce("known", "node")).alias("parts")).where("parts > 1").select("block")
            left = chunks.select("block", F.col("class").alias("c"), F.col("chunk").alias("i"))
            right = chunks.select("block", F.col("class").alias("d"), F.col("chunk").alias("j"))
            pairs = left.join(right, "block").where("i < j and d <= c + 1").join(several, "block", "left_semi")
            pairs = pairs.where(F.col("i") == F.col("c") * F.lit(1 << 20) if first else F.col("i") > F.col("c") * F.lit(1 << 20))
            ends = pairs.select("block", "i", "j", F.explode(F.array("i", "j")).alias("chunk"))
            meet = rows.join(ends, ["block", "chunk"])
            links = links.unionByName(common.written(_links(meet, ["block", "i", "j"], 2 * tasks, percent), "links"))
    roots = components(links)
    rooted = sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return docs, rooted


def join(documents: DataFrame, *, size: int = 5, percent: int = 75) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    `documents` needs doc_id and text; other columns are not read.  Two
    documents link when 100 * |intersection| >= percent * |union| of their
    distinct `size`-word shingles (words lower-cased A-Z).  component_id is the
    smallest doc_id that links reach.  A null, empty or wordless text has no
    shingle and links with nothing; a null doc_id is never the smallest unless
    all are null; repeated rows link like any equal texts.  No rows give none.
    """
    rows, sets = linked(documents, size=size, percent=percent)
    least = sets.groupBy("root").agg(F.min("least").alias("component_id"))
    named = common.salted_join(sets, least, ["root"], "node").select("k1", "k2", "n", "component_id")
    found = rows.join(named, ["k1", "k2", "n"], "left")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(documents: DataFrame, *, size: int = 5, percent: int = 75) -> DataFrame:
    """Of each group of linked documents the row with the smallest doc_id; all others, columns as they are.

    Null, empty and wordless texts link with nothing and stay.  A null doc_id
    comes after all others.  Rows are found again by doc_id and a hash of the
    text; of rows that agree in both, the one whose columns as JSON come first
    stays.  Other columns may have any names and types.  No rows give none.
    """
    rows, sets = linked(documents, size=size, percent=percent)
    first = sets.groupBy("root").agg(F.min("first").alias("x")).select("x.doc_id", "x.text_hash")
    kept = common.written(first.unionByName(rows.where("n = 0").select("doc_id", "text_hash")).distinct(), "kept")
    columns = documents.columns
    own = common.free_name("hash", documents, kept)
    hashed = documents.withColumn(own, F.xxhash64("text"))
    match = lambda left, right: left["doc_id"].eqNullSafe(right["doc_id"]) & (left[own] == right["text_hash"])
    stay = hashed.join(kept.hint("shuffle_hash"), match(hashed, kept), "left_semi")
    repeats = rows.where("n > 0").groupBy("doc_id", "text_hash").count().where("count > 1")
    again = common.written(repeats.select("doc_id", "text_hash"), "repeats")
    if not again.isEmpty():
        once = stay.join(again.hint("shuffle_hash"), match(stay, again), "left_anti")
        twice = stay.join(again.hint("shuffle_hash"), match(stay, again), "left_semi")
        whole = F.struct(*columns)
        one = twice.groupBy("doc_id", own).agg(F.min_by(whole, F.to_json(whole)).alias("row")).select("row.*")
        stay = once.select(*columns).unionByName(one)
    return stay.select(*columns)

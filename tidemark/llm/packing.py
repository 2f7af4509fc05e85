"""Best-fit packing by patterns: pieces of at most `size` tokens into sequences.

Only the histogram of piece lengths (at most `size` numbers, whatever the
corpus) reaches the driver.  Patterns of one to three lengths that fill a
sequence are fitted to it by non-negative least squares, the repeat counts are
rounded, and what the rounded patterns leave over is packed best-fit
decreasing, again on the histogram.  The plan is a list of rank intervals per
length; each piece finds its sequence by its rank among the pieces of its
length, so no task or driver ever holds the pieces of a group together.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .tokens import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Pieces that one task ranks together, about.
RANKED_TOGETHER = 50_000


def patterns(histogram: dict[int, int], size: int, most: int = 200_000) -> np.ndarray:
    """Patterns of up to three present lengths that fill a sequence, as rows; of triples the `most` fullest.

    What no pattern is fitted for is packed best-fit like all that is left over.

    Singles and exact pairs and triples; where an exact partner is missing,
    the longest present one that fits.  0 stands for no document.
    """
    present = np.array(sorted(histogram), dtype=np.int64)
    floor = np.zeros(size + 1, dtype=np.int64)
    floor[present] = present
    floor = np.maximum.accumulate(floor)  # the longest present length that fits
    rows = [np.stack([present, floor[size - present], np.zeros_like(present)], 1)]
    rows.append(np.stack([present, np.zeros_like(present), np.zeros_like(present)], 1))
    first, second = np.meshgrid(present, present, indexing="ij")
    keep = (first >= second) & (first + second < size)
    first, second = first[keep], second[keep]
    third = floor[size - first - second]
    keep = (third > 0) & (third <= second)
    triples = np.stack([first[keep], second[keep], third[keep]], 1)
    full = triples.sum(1)
    triples = triples[np.argsort(-full, kind="stable")][:most]
    rows.append(triples)
    return np.unique(-np.sort(-np.concatenate(rows), axis=1), axis=0)[::-1]


def least_squares(rows: np.ndarray, target: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - target|, A[l, p] = times length l is in pattern p.

    Accelerated projected gradient; A is only ever its index rows.
    """
    size = len(target)

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(rows[:, j], weights=x, minlength=size) for j in range(rows.shape[1]))
        total[0] = 0
        return total

    def back(r: np.ndarray) -> np.ndarray:
        r = r.copy()
        r[0] = 0
        return sum(r[rows[:, j]] for j in range(rows.shape[1]))

    v = np.ones(len(rows))
    for _ in range(20):
        v = back(used(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (norm * 1.02)
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - step * back(used(y) - target))
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / nt * (new - x)
        x, t = new, nt
    return x


def best_fit(left: dict[int, int], size: int) -> Counter:
    """Best-fit decreasing over a histogram: pattern -> how many sequences.

    Pieces of equal length move together, so the work follows the number of
    lengths and patterns, not that of pieces.
    """
    rooms: dict[int, Counter] = {size: Counter()}
    free: list[int] = []  # the rooms of opened sequences, ascending
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            at = bisect.bisect_left(free, length)
            if at == len(free):
                room, held = size, None
                each = size // length
                full, rest = divmod(n, each)
                for k, times in ((each, full), (rest, int(rest > 0))):
                    if k and times:
                        _put(rooms, free, size - k * length, (length,) * k, times)
                n = 0
                continue
            room = free[at]
            held, times = next(iter(rooms[room].items()))
            each = min(room // length, n)
            take = max(1, min(times, n // each))
            if take == times:
                del rooms[room][held]
            else:
                rooms[room][held] -= take
            if not rooms[room]:
                del rooms[room], free[at]
            _put(rooms, free, room - each * length, held + (length,) * each, take)
            n -= each * take
    out: Counter = Counter()
    for held in rooms.values():
        out.update(held)
    return out


def _put(rooms: dict[int, Counter], free: list[int], room: int, held: tuple, times: int) -> None:
    if room not in rooms:
        rooms[room] = Counter()
    if room and not rooms[room]:
        bisect.insort(free, room)
    rooms[room][held] += times


def plan(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """(pattern, repeats) that use every piece of the histogram exactly once."""
    left = {length: n for length, n in histogram.items() if n}
    chosen: Counter = Counter()
    if left:
        if full := left.pop(size, 0):
            chosen[(size,)] += full
    if left:
        rows = patterns(left, size)
        target = np.zeros(size + 1)
        target[list(left)] = list(left.values())
        x = least_squares(rows, target)
        order = np.lexsort((-rows.sum(1), -x))
        for p in order:
            # a half-filled pattern would waste room that the residual can fill
            pattern = tuple(int(length) for length in rows[p] if length)
            if x[p] < 0.5:
                break
            if sum(pattern) < size - size // 128:
                continue
            need = Counter(pattern)
            times = min([int(x[p] + 0.5), *(left.get(length, 0) // k for length, k in need.items())])
            if times > 0:
                chosen[pattern] += times
                for length, k in need.items():
                    left[length] -= k * times
        chosen.update(best_fit({k: n for k, n in left.items() if n}, size))
    return sorted(chosen.items(), reverse=True)


def intervals(chosen: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """Per length, the rank intervals and where their pieces go."""
    used: Counter = Counter()
    base, rows = 0, []
    for pattern, times in chosen:
        offset = 0
        for length in pattern:
            rows.append((length, used[length], base, offset))
            used[length] += times
            offset += length
        base += times
    rows.sort()
    names = ("length", "rank", "sequence", "offset")
    return {k: np.array([r[i] for r in rows], dtype=np.int64) for i, k in enumerate(names)}


def cut(ids: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    if len(ids) <= size:
        return [(0, len(ids))]
    first = len(ids) % size or size
    return [(0, first), *((at, size) for at in range(first, len(ids), size))]


def pieces(documents: DataFrame, tokenizer: str, end_id: int, size: int) -> DataFrame:
    """A row per piece of every document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(tokenizer)
        ids_of, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows: list[tuple] = []
        for doc, raw in zip(ids_of, coder.encode(texts)):
            ids = np.append(np.frombuffer(raw, dtype=coder.dtype), end_id).astype("<u4")
            for k, (start, length) in enumerate(cut(ids, size)):
                rows.append((doc, k, start, length, zlib.crc32(ids[start : start + length])))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        names = ("doc_id", "piece", "start", "length", "ids_crc32")
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=list(names))

    return common.map_batches(documents.select("doc_id", "text"), run, PIECES)


def pack(documents: DataFrame, tokenizer: str, *, end_id: int = 2, size: int = 1024) -> DataFrame:
    """Every document's pieces with their sequence and place in it.

    `documents` needs doc_id and text; other columns are not read.  A null or
    empty text is one piece that holds the end id; a null doc_id is packed as
    any other; rows with equal ids are packed one by one, and which of equal
    rows goes where is open.  A text of any length is encoded whole and cut.
    No rows give none.
    """
    # the written number tells equal rows apart, so that these too spread over the tasks that rank
    rows = common.written(pieces(documents, tokenizer, end_id, size).withColumn("tie", F.monotonically_increasing_id()), "pieces")
    counted = rows.groupBy("length").count().collect()  # at most `size` rows
    histogram = {r["length"]: r["count"] for r in counted}
    where = intervals(plan(histogram, size))

    salts = max(64, sum(histogram.values()) // RANKED_TOGETHER)
    key = ("length", "salt")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "tie"), F.lit(salts)))
    per_salt = salted.groupBy(*key).agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    first = per_salt.select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy(*key).orderBy("doc_id", "piece", "ids_crc32", "tie")
    ranked = salted.withColumn("at", F.row_number().over(own)).join(first, list(key))
    ranked = ranked.withColumn("rank", F.col("first") + F.col("at") - 1)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        length, rank = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("length", "rank"))
        scale = np.int64(1) << np.int64(40)
        at = np.searchsorted(where["length"] * scale + where["rank"], length * scale + rank, side="right") - 1
        out = [batch.column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")]
        out.append(pa.array(where["sequence"][at] + rank - where["rank"][at]))
        out.append(pa.array(where["offset"][at]))
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        return pa.record_batch(out, names=names)

    kept = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return common.map_batches(kept, place, PIECES + ", sequence_id long, offset long")

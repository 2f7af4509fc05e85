"""Fitting small models on the driver: labelled samples and an optimiser."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


#: Characters of a sample's texts, at most.
MOST_CHARS = 100_000_000


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, folds: int, left_out: int, per_class: int, most_chars: int = MOST_CHARS) -> tuple[list[tuple[str, int]], float]:
    """At most `per_class` labelled whole texts of each class, and the share of class 1 among all training labels.

    Only labels whose crc32(doc_id as text) mod `folds` isn't `left_out` are
    looked at; null labels or ids and labels of absent documents are ignored;
    of several labels of one id the largest counts, of several rows of one id
    the least text (a null one is empty).  The sample is the ids with the
    smallest hashes, so it is the same in every run; its two classes together
    hold at most `most_chars` characters, and the ids whose texts no longer fit
    are left out whole.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    usable = usable.where(common.fold(F.col("doc_id"), folds) != left_out)
    usable = usable.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    counts = {r["label"]: r["count"] for r in usable.groupBy("label").count().collect()}
    chosen = None
    for value in (0, 1):
        part = usable.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 * per_class rows of two numbers, here and in the next collect
    one = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = common.written(one.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "labelled")
    sizes = one.select("doc_id", F.length("text").alias("chars"), F.xxhash64("doc_id").alias("h")).collect()
    left, taken = most_chars, []
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if r["chars"] <= left:
            left -= r["chars"]
            taken.append((r["doc_id"],))
    keep = one if len(taken) == len(sizes) else one.join(F.broadcast(one.sparkSession.createDataFrame(taken, "doc_id long")), "doc_id")
    rows = sorted(keep.collect(), key=lambda r: r["doc_id"])
    total = sum(counts.values())
    return [(r["text"], r["label"]) for r in rows], (counts.get(1, 0) / total if total else 0.5)


def minimise(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, rounds: int = 100, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking; loss returns its value and gradient."""
    value, gradient = loss(x)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        q, alphas = gradient.copy(), []
        for s, y, rho in reversed(steps):
            alphas.append(rho * (s @ q))
            q -= alphas[-1] * y
        if steps:
            s, y, _ = steps[-1]
            q *= (s @ y) / (y @ y)
        else:
            q /= max(1.0, float(np.linalg.norm(q)))
        for (s, y, rho), a in zip(steps, reversed(alphas)):
            q += s * (a - rho * (y @ q))
        slope, size = -(gradient @ q), 1.0
        while True:
            new_value, new_gradient = loss(x - size * q)
            if new_value <= value + 1e-4 * size * slope or size < 1e-8:
                break
            size /= 2
        s, y = -size * q, new_gradient - gradient
        x, done = x + s, value - new_value < 1e-7 * max(1.0, abs(value))
        value, gradient = new_value, new_gradient
        if s @ y > 1e-12:
            steps = [*steps[1 - memory :], (s, y, 1 / (s @ y))] if len(steps) >= memory else [*steps, (s, y, 1 / (s @ y))]
        if done:
            break
    return x

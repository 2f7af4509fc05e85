"""Toxicity by character n-grams: a linear classifier over naive Bayes ratios.

A text's features are the distinct character n-grams of its lower-cased form.
Each is scaled by its naive Bayes log-count ratio (how much likelier it is in
a toxic text than in another), and a logistic regression over the scaled
features decides.  Only n-grams found in enough training texts take part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, fit

ORDERS = (3, 4, 5, 6)
#: log2 of the number of n-gram codes.
BITS = 20
#: Training texts per class, at most.
PER_CLASS = 1500
#: An n-gram must be in so many training texts.
LEAST_TEXTS = 4
#: N-grams that the classifier may use, at most.
FEATURES = 20_000
#: Standard deviations by which an n-gram's share of toxic texts must differ from theirs among all.
LEAST_DEVIATIONS = 3.0
#: A text group's characters, about.
GROUP_CHARS = 500_000
RIDGE = 3e-4
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts with a space around each, and each one's text."""
    lowered = [f" {text.lower()} " for text in texts]
    lengths = np.array([len(text) for text in lowered], dtype=np.int64)
    flat = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    flat = np.where(flat < 33, np.uint32(32), flat)  # any white space or control character is a space
    return flat, np.repeat(np.arange(len(texts), dtype=np.int64), lengths)


def codes(flat: np.ndarray, order: int) -> np.ndarray:
    """A code for the n-gram that begins at each place."""
    n = len(flat) - order + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    with np.errstate(over="ignore"):
        h = np.full(n, np.uint32(order * 0x9E3779B1 & 0xFFFFFFFF), dtype=np.uint32)
        for j in range(order):
            h = (h ^ flat[j : j + n]) * np.uint32(0x01000193)
            h ^= h >> np.uint32(15)
        h = h * np.uint32(0x2C1B3C6D)
        return (h >> np.uint32(32 - BITS)).astype(np.int64)


def features(texts: list[str], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, code) of each distinct n-gram of each text; `wanted` marks the codes to keep."""
    flat, owner = points(texts)
    found = []
    for order in ORDERS:
        code = codes(flat, order)
        at = owner[: len(code)]
        keep = at == owner[order - 1 :][: len(code)]
        if wanted is not None:
            keep &= wanted[code]
        found.append((at[keep] << BITS) | code[keep])
    keys = np.unique(np.concatenate(found))
    return keys >> BITS, keys & ((1 << BITS) - 1)


def groups(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) of groups of about GROUP_CHARS characters."""
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars < GROUP_CHARS):
            chars += len(texts[end] or "")
            end += 1
        yield at, [text or "" for text in texts[at:end]]
        at = end


@dataclass(frozen=True)
class Model:
    codes: np.ndarray
    weights: np.ndarray
    bias: float


def fit_model(sample: list[tuple[str, int]], share: float, features_most: int = FEATURES, least_texts: int = LEAST_TEXTS) -> Model:
    """Train on labelled texts; `share` is class 1's share of all training labels.

    N-grams in fewer than `least_texts` texts, and all but the `features_most`
    that tell the classes apart best, take no part.  With one class or none
    the score is the share itself.
    """
    y = np.array([label for _, label in sample], dtype=float)
    prior = float(np.clip(share, 1e-3, 1 - 1e-3))
    odds = float(np.log(prior / (1 - prior)))
    if not len(y) or y.min() == y.max():
        return Model(np.empty(0, dtype=np.int64), np.empty(0), odds)
    size = 1 << BITS
    texts, positive = (np.zeros(size, dtype=np.int64) for _ in range(2))
    for first, group in groups([text for text, _ in sample]):
        row, col = features(group)
        texts += np.bincount(col, minlength=size)
        positive += np.bincount(col[y[first + row] > 0], minlength=size)
    p, q = 1.0 + positive, 1.0 + texts - positive
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    half = y.mean()
    worth = np.abs(positive - texts * half) / np.sqrt(np.maximum(texts, 1) * half * (1 - half))
    worth[texts < least_texts] = 0
    chosen = np.sort(np.argsort(-worth, kind="stable")[:features_most])
    chosen = chosen[worth[chosen] >= LEAST_DEVIATIONS]
    number = np.full(size, -1, dtype=np.int64)
    number[chosen] = np.arange(len(chosen))
    # a second pass over the texts keeps the chosen n-grams alone, so memory follows those
    kept = [(first + row, number[col]) for first, group in groups([text for text, _ in sample]) for row, col in [features(group, number >= 0)]]
    row, col = np.concatenate([r for r, _ in kept]), np.concatenate([c for _, c in kept])
    scale = ratio[chosen]

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = x[:-1], x[-1]
        z = np.bincount(row, weights=(w * scale)[col], minlength=len(y)) + b
        error = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        value = float(np.logaddexp(0, np.where(y > 0, -z, z)).mean() + RIDGE / 2 * (w @ w))
        return value, np.append(np.bincount(col, weights=error[row], minlength=len(w)) * scale / len(y) + RIDGE * w, error.mean())

    x = fit.minimise(loss, np.zeros(len(chosen) + 1), rounds=60)
    sampled = float(np.log(y.mean() / (1 - y.mean())))
    return Model(chosen, x[:-1] * scale, float(x[-1]) + odds - sampled)


class Scorer:
    """A model's dense table, made once in each worker."""

    def __init__(self, model: Model):
        self.table = np.zeros(1 << BITS)
        self.table[model.codes] = model.weights
        self.wanted = self.table != 0
        self.bias = model.bias

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for first, group in groups(texts):
            row, code = features(group, self.wanted)
            z = np.bincount(row, weights=self.table[code], minlength=len(group)) + self.bias
            out[first : first + len(group)] = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        return out


def train(documents: DataFrame, labels: DataFrame, *, folds: int = 5, left_out: int = 0, per_class: int = PER_CLASS, features_most: int = FEATURES, least_texts: int = LEAST_TEXTS) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold (fit.labelled_sample)."""
    sample, share = fit.labelled_sample(documents, labels, "toxic", folds, left_out, per_class)
    return fit_model(sample, share, features_most, least_texts)


def score(documents: DataFrame, model: Model, *, folds: int = 5, left_out: int = 0) -> DataFrame:
    """Every document's score.

    `documents` needs doc_id and text; other columns are not read.  A null or
    empty text has the score that the model gives to a text without n-grams.
    Null ids and repeated rows are scored as any, equal texts alike.  A text of
    any length is read whole, in memory that follows its length.  A score of
    exactly 0.5 is toxic.  No rows give none.
    """

    def run(batches):
        common.release()
        scorer = Scorer(model)
        for batch in common.sliced(batches):
            found = scorer(batch.column(1).to_pylist())
            columns = [batch.column(0), batch.column(2), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.record_batch(columns, names=["doc_id", "held_out", "score", "predicted"])

    keyed = documents.select("doc_id", "text", (common.fold(F.col("doc_id"), folds) == left_out).alias("held_out"))
    return keyed.mapInArrow(run, SCHEMA)


def keep_clean(documents: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The documents whose score is under the threshold, all columns, of any name, as they are.

    A null or empty text has the score of a text without n-grams; a score equal
    to the threshold goes; repeated rows go or stay alike; no rows give none.
    """
    at = documents.columns.index("text")
    common.small_batches(documents.sparkSession)

    def run(batches):
        common.release()
        scorer = Scorer(model)
        for batch in common.sliced(batches):
            yield batch.filter(pa.array(scorer(batch.column(at).to_pylist()) < threshold))

    return documents.mapInArrow(run, documents.schema)

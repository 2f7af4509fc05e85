"""Document quality by a linear-chain conditional random field over lines.

Every line of a text is good or bad.  A line is described by binned measures
of itself and of the lines before and after it; the chain's transitions make
neighbours agree.  Forward and backward passes give each line's marginal, and
a document's quality is the mean of its lines' marginals weighted by length.
Training gives each line its document's label.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, fit

#: Training texts per class, at most.
PER_CLASS = 1500
#: A text group's characters, about.
GROUP_CHARS = 1_500_000
RIDGE = 1e-3
SCHEMA = "doc_id long, held_out boolean, score double, predicted int, n_lines long, good_share double"

#: Upper edges of each measure's bins; a value takes the first bin whose edge isn't below it.
EDGES = {
    "log_length": (0, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12),
    "upper": (0, 0.01, 0.02, 0.04, 0.08, 0.15, 0.3, 0.6),
    "digit": (0, 0.01, 0.05, 0.1, 0.2, 0.4),
    "punctuation": (0, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.4),
    "exclamation": (0, 0.002, 0.01, 0.03, 0.1),
    "bar": (0, 0.002, 0.01, 0.05),
    "symbol": (0, 0.002, 0.01, 0.05, 0.15),
    "space": (0.05, 0.1, 0.13, 0.15, 0.17, 0.19, 0.22, 0.3),
    "distinct": (0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.99),
    "again": (0, 0.05, 0.2, 0.5, 0.9),
    "short_words": (0.02, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7),
    "same_neighbour": (0, 0.02, 0.1, 0.3, 0.6),
    "stutter": (0, 0.02, 0.05, 0.1, 0.3, 0.6),
    "ends": (0, 1, 2),
}
BINS = [len(edges) + 1 for edges in EDGES.values()]
STARTS = np.concatenate([[0], np.cumsum(BINS)])
#: Features of a line itself, of the line before and of the line after, and the chain's ends.
WIDTH = int(STARTS[-1])
N_FEATURES = 3 * WIDTH + 2

# The kinds of characters that the measures count.
LETTER, UPPER, DIGIT, SPACE, EXCLAMATION, BAR, SYMBOL, PUNCTUATION, NEWLINE = range(9)


def _kinds() -> np.ndarray:
    """The kind of each code point below 0x3000; letters elsewhere."""
    table = np.zeros(0x3000, dtype=np.uint8)
    for c in range(len(table)):
        char = chr(c)
        if char == "\n":
            table[c] = NEWLINE
        elif char.isspace():
            table[c] = SPACE
        elif char.isdigit():
            table[c] = DIGIT
        elif char.isupper():
            table[c] = UPPER
        elif char == "!":
            table[c] = EXCLAMATION
        elif char == "|":
            table[c] = BAR
        elif char in "#*$%&<>{}[]\\^~_=+@/":
            table[c] = SYMBOL
        elif not char.isalnum():
            table[c] = PUNCTUATION
    return table


KINDS = _kinds()


@dataclass
class Lines:
    """The lines of several texts: active features and lengths, in order of text and line."""

    counts: np.ndarray  # lines of each text
    bins: np.ndarray  # per line, its bin of each measure, as a feature number
    lengths: np.ndarray  # characters, 1 at least


def describe(texts: list[str]) -> Lines:
    """Measure all lines; a text without characters is one empty line."""
    cut = [text.split("\n") for text in texts]
    counts = np.array([len(lines) for lines in cut], dtype=np.int64)
    n = int(counts.sum())
    flat = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = KINDS[np.minimum(flat, len(KINDS) - 1)]
    kind[flat >= len(KINDS)] = LETTER
    newline = kind == NEWLINE
    line = np.cumsum(newline) - newline
    per = np.bincount(line * 9 + kind, minlength=9 * n).reshape(n, 9).astype(float)
    length = per[:, :NEWLINE].sum(1)
    safe = np.maximum(length, 1)

    distinct, again, short, neighbour, stutter, ends = (np.zeros(n) for _ in range(6))
    k = 0
    for lines in cut:
        seen_lines: set[str] = set()
        before: set[str] = set()
        for text in lines:
            words = text.split()
            if words:
                own = set(words)
                distinct[k] = len(own) / len(words)
                short[k] = sum([len(w) < 4 for w in words]) / len(words)
                again[k] = 1.0 if text in seen_lines else 0.0
                neighbour[k] = len(own & before) / len(own)
                stutter[k] = sum(map(eq, words, words[1:])) / len(words)
                seen_lines.add(text)
                before = own
                last = words[-1][-1]
                ends[k] = 2 if last in ".!?…" else 1 if last.isalnum() else 0
            else:
                distinct[k] = 1.0
            k += 1
    measures = [
        np.log2(length + 1), per[:, UPPER] / safe, per[:, DIGIT] / safe, per[:, PUNCTUATION] / safe,
        per[:, EXCLAMATION] / safe, per[:, BAR] / safe, per[:, SYMBOL] / safe, per[:, SPACE] / safe,
        distinct, again, short, neighbour, stutter, ends,
    ]
    bins = np.stack([np.searchsorted(edges, m) + s for edges, m, s in zip(EDGES.values(), measures, STARTS)], axis=1)
    return Lines(counts, bins, safe)


def active(lines: Lines) -> np.ndarray:
    """Per line the numbers of its features; N_FEATURES, a feature of weight 0, fills up."""
    n = len(lines.lengths)
    first = np.zeros(n, dtype=bool)
    starts = np.cumsum(lines.counts) - lines.counts
    first[starts] = True
    last = np.zeros(n, dtype=bool)
    last[starts + lines.counts - 1] = True
    before = np.where(first[:, None], N_FEATURES, np.roll(lines.bins, 1, axis=0) + WIDTH)
    after = np.where(last[:, None], N_FEATURES, np.roll(lines.bins, -1, axis=0) + 2 * WIDTH)
    edge = np.stack([np.where(first, 3 * WIDTH, N_FEATURES), np.where(last, 3 * WIDTH + 1, N_FEATURES)], axis=1)
    return np.concatenate([lines.bins, before, after, edge], axis=1)


class Chains:
    """Sequences of different lengths side by side: step t holds the t-th line of each that has one."""

    def __init__(self, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        starts = (np.cumsum(counts) - counts)[order]
        ordered = counts[order]
        self.steps = [starts[: int(np.searchsorted(-ordered, -t, side="left"))] + t for t in range(int(ordered[0]) if len(ordered) else 0)]

    def passes(self, emission: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Marginals of state 1, expected transitions, and the sum of log partition functions.

        emission: per line the log potential of state 1 (state 0 has 0);
        transition[a, b]: the log potential of b after a.
        """
        n = len(emission)
        forward, backward = np.zeros((n, 2)), np.zeros((n, 2))
        potential = np.stack([np.zeros(n), emission], axis=1)
        for t, at in enumerate(self.steps):
            if not t:
                forward[at] = potential[at]
                continue
            a = forward[at - 1]
            forward[at] = np.logaddexp(a[:, :1] + transition[0], a[:, 1:] + transition[1]) + potential[at]
        for t in range(len(self.steps) - 2, -1, -1):
            at = self.steps[t][: len(self.steps[t + 1])]
            b = backward[at + 1] + potential[at + 1]
            backward[at] = np.logaddexp(b[:, :1] + transition[:, 0], b[:, 1:] + transition[:, 1])
        both = forward + backward
        z = np.logaddexp(both[:, 0], both[:, 1])
        marginal = np.exp(both[:, 1] - z)
        expected = np.zeros((2, 2))
        total = float(z[self.steps[0]].sum()) if self.steps else 0.0
        if len(self.steps) > 1:
            to = np.concatenate(self.steps[1:])
            for a in (0, 1):
                for b in (0, 1):
                    expected[a, b] = np.exp(forward[to - 1, a] + transition[a, b] + potential[to, b] + backward[to, b] - z[to]).sum()
        return marginal, expected, z, total


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of the features; a last 0 for the filler
    bias: float
    transition: np.ndarray
    shift: float  # added to a document's log odds

    def marginals(self, lines: Lines) -> np.ndarray:
        emission = self.weights[active(lines)].sum(1) + self.bias
        return Chains(lines.counts).passes(emission, self.transition)[0]


def fit_model(sample: list[tuple[str, int]], share: float) -> Model:
    """Train on labelled texts; with one class or none every line has the share as its marginal."""
    y = np.array([label for _, label in sample], dtype=np.int64)
    if not len(y) or y.min() == y.max():
        prior = float(np.clip(share, 1e-3, 1 - 1e-3))
        return Model(np.zeros(N_FEATURES + 1), float(np.log(prior / (1 - prior))), np.zeros((2, 2)), 0.0)
    lines = describe([text for text, _ in sample])
    features, chains = active(lines), Chains(lines.counts)
    doc = np.repeat(np.arange(len(y)), lines.counts)
    state = y[doc]
    kept = np.zeros((2, 2))
    kept[0, 0], kept[1, 1] = ((lines.counts - 1)[y == 0].sum(), (lines.counts - 1)[y == 1].sum())
    scale = 1 / len(y)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, bias, transition = np.append(x[:N_FEATURES], 0), x[N_FEATURES], x[N_FEATURES + 1 :].reshape(2, 2)
        emission = weights[features].sum(1) + bias
        marginal, expected, _, total = chains.passes(emission, transition)
        value = (total - float(emission[state == 1].sum()) - float((kept * transition).sum())) * scale + RIDGE / 2 * float(x @ x)
        error = marginal - state
        gradient = np.bincount(features.ravel(), weights=np.repeat(error, features.shape[1]), minlength=N_FEATURES + 1)[:N_FEATURES]
        return value, np.concatenate([gradient, [error.sum()], (expected - kept).ravel()]) * scale + RIDGE * x

    x = fit.minimise(loss, np.zeros(N_FEATURES + 5), rounds=120)
    return Model(np.append(x[:N_FEATURES], 0), float(x[N_FEATURES]), x[N_FEATURES + 1 :].reshape(2, 2), 0.0)


def qualities(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: the length-weighted marginal, the number of lines, and the share of good ones."""
    score, count, good = (np.empty(len(texts)) for _ in range(3))
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars < GROUP_CHARS):
            chars += len(texts[end] or "")
            end += 1
        lines = describe([text or "" for text in texts[at:end]])
        marginal = model.marginals(lines)
        doc = np.repeat(np.arange(end - at), lines.counts)
        weight = np.bincount(doc, weights=lines.lengths, minlength=end - at)
        score[at:end] = np.bincount(doc, weights=lines.lengths * marginal, minlength=end - at) / weight
        count[at:end] = lines.counts
        good[at:end] = np.bincount(doc[marginal >= 0.5], minlength=end - at) / lines.counts
        at = end
    return np.clip(score, 0, 1), count, good


def train(documents: DataFrame, labels: DataFrame, *, folds: int = 3, left_out: int = 1, per_class: int = PER_CLASS) -> Model:
    """Fit on a bounded sample of the labelled rows outside the held-out fold."""
    sample, share = fit.labelled_sample(documents, labels, "quality", folds, left_out, per_class)
    return fit_model(sample, share)


def score(documents: DataFrame, model: Model, *, folds: int = 3, left_out: int = 1) -> DataFrame:
    """Every document's quality.

    `documents` needs doc_id and text; other columns are not read.  A null or
    empty text is one empty line.  Null ids and repeated rows are scored as
    any, equal texts alike.  A text of any length and a line of any length is
    read whole, in memory that follows the text's length.  A score of exactly
    0.5 is good.  No rows give none.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found, count, good = qualities(batch.column(1).to_pylist(), model)
        columns = [batch.column(0), batch.column(2), pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
        columns += [pa.array(count.astype(np.int64)), pa.array(good)]
        return pa.record_batch(columns, names=["doc_id", "held_out", "score", "predicted", "n_lines", "good_share"])

    keyed = documents.select("doc_id", "text", (common.fold(F.col("doc_id"), folds) == left_out).alias("held_out"))
    return common.map_batches(keyed, run, SCHEMA)

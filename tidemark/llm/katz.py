"""Katz backoff language model, trained and evaluated by partitions of n-grams.

    P_k(w | h) = d(c) c(h w) / Z(h)         where h w was seen in training
               = alpha(h) P_{k-1}(w | h')   elsewhere, h' being h without its first word
    P_1(w)     = d(c) c(w) / Z, and what is left over for one class of unknown words

d is the Good-Turing discount of Katz (counts up to 5, from the corpus's counts
of counts), Z(h) the context's count, and alpha(h) the number that makes the
probabilities after h sum to exactly 1.  Where a context's counts leave no mass
(all are above 5), Z grows by what keeps half a count for the unseen words.

How it runs.  Documents are tokenised once into batches; a batch is a file of
word numbers and of its distinct words' 64-bit hashes.  For each order a batch
sends its distinct n-grams, each once with its training count, to the partition
that owns their hashes; the partition sums them, keeps them as the model's
table, and replies with the sums in the batch's own order.  Context weights
travel likewise.  No table of the model is ever held by one process, a frequent
word costs a row per batch at most, and a batch needs the memory of its own
tokens.  Replies are written tables, so no stage depends on an earlier one's
executors.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .storage import dump, dump_sorted, load, load_sorted, pack, read_file, slices, unpack, write_file

#: Counts up to this are discounted.
DISCOUNTED = 5
#: Tokens in a batch, about.
BATCH_TOKENS = 2_000_000
END, START = b"", b"\n"  # neither is a word
MESSAGE = "batch long, part int, keys binary, a binary, b binary, c binary"
REPLY = "kind string, batch long, part int, keys binary, a binary, b binary, stats array<double>"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def held_out(doc_id: int | None, folds: int) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """d(0..DISCOUNTED + 1): Katz's Good-Turing discounts; the last, for all higher counts, is 1.

    counts_of_counts[r] is the number of n-grams seen r times.  Where it holds
    too little for Good-Turing (a zero, or a discount outside 0 to 1), the
    discount takes half a count off.
    """
    n, k = counts_of_counts.astype(float), DISCOUNTED
    out = np.ones(k + 2)
    out[0] = 0
    share = (k + 1) * n[k + 1] / n[1] if n[1] else 1.0
    for r in range(1, k + 1):
        plain = (r - 0.5) / r
        turing = (r + 1) * n[r + 1] / (r * n[r]) if n[r] else 0.0
        good = (turing - share) / (1 - share) if share < 1 else 0.0
        out[r] = good if 0 < good < 1 else plain
    return out


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return d[np.minimum(counts, DISCOUNTED + 1).astype(np.int64)] * counts


def leftover(total: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Z: the total, or more where the discounts left under half a count."""
    return np.maximum(total, kept + 0.5)


class Files:
    """The dataset's folder; names are by batch and meaning."""

    def __init__(self, folder: str):
        self.folder = folder

    def put(self, batch: int, what: str, named: dict[str, bytes]) -> None:
        write_file(f"{self.folder}/{what}/batch-{batch:09d}", pack(named))

    def get(self, batch: int, what: str) -> dict[str, bytes]:
        return unpack(read_file(f"{self.folder}/{what}/batch-{batch:09d}"))


class Batch:
    """A batch's tokens: per token its word's number; per document its length."""

    def __init__(self, files: Files, number: int):
        raw = files.get(number, "tokens")
        self.number, self.files = number, files
        self.hashes = load_sorted(raw["hashes"])
        self.words = load(raw["words"]).astype(np.int64)
        self.lengths = load(raw["lengths"])
        self.doc_ids, self.nulls, self.train = load(raw["doc_ids"]), load(raw["nulls"]), load(raw["train"]).astype(bool)
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.train_token = self.train[self.doc]

    def keys(self, order: int) -> tuple[np.ndarray, np.ndarray]:
        """Per token the 64-bit keys of the n-gram that ends there and of its context."""
        first = np.cumsum(self.lengths) - self.lengths
        place = np.arange(len(self.words)) - np.repeat(first, self.lengths)
        at = self.hashes[self.words]
        context = np.zeros(len(at), dtype=np.uint64)
        start = np.uint64(word_hash(START))
        with np.errstate(over="ignore"):
            for back in range(order - 1, 0, -1):
                word = np.full(len(at), start)
                word[back:] = np.where(place[back:] >= back, at[:-back], start)
                context = common.mixed(context * np.uint64(3) + word, order)
            return common.mixed(context * np.uint64(3) + at, 50 + order), context


def tokenise(documents: DataFrame, files: Files, folds: int, bits: int) -> DataFrame:
    """Write the batches; the distinct words of each with their training counts, by part."""
    tasks = common.partitions(documents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common.release()
        task, turn = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []
        number: dict[bytes, int] = {}
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal turn, docs, lengths, parts, number, held
            hashes = np.fromiter(map(word_hash, number), dtype=np.uint64, count=len(number))
            ordered, place = np.unique(hashes, return_inverse=True)
            words = place[np.concatenate(parts)]
            train = np.array([not held_out(d, folds) for d in docs])
            length = np.array(lengths, dtype=np.int64)
            counts = np.bincount(words[np.repeat(train, length)], minlength=len(ordered)).astype(np.uint32)
            batch, turn = task + turn * tasks, turn + 1
            named = {
                "hashes": dump_sorted(ordered),
                "words": dump(words.astype(np.uint32)),
                "lengths": dump(length),
                "doc_ids": dump(np.array([d or 0 for d in docs], dtype=np.int64)),
                "nulls": dump(np.array([d is None for d in docs], dtype=np.uint8)),
                "train": dump(train.astype(np.uint8)),
            }
            files.put(batch, "tokens", named)
            out = _messages(batch, ordered, bits, counts)
            docs, lengths, parts, number, held = [], [], [], {}, 0
            return out

        for rows in common.sliced(batches):
            for doc, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
                words = common.lower_words(text) + [END]
                for word in set(words).difference(number):
                    number[word] = len(number)
                parts.append(np.fromiter(map(number.__getitem__, words), dtype=np.uint32, count=len(words)))
                docs.append(doc)
                lengths.append(len(words))
                held += len(words)
                if held >= BATCH_TOKENS:
                    yield close()
        if docs:
            yield close()

    return documents.select("doc_id", "text").mapInArrow(run, MESSAGE)


def _messages(batch: int, keys: np.ndarray, bits: int, *columns: np.ndarray) -> pa.RecordBatch:
    """A batch's ascending keys and their numbers, a row per part."""
    rows = slices(keys, bits)
    named = {"batch": pa.array([batch] * len(rows), pa.int64()), "part": pa.array([p for p, _, _ in rows], pa.int32())}
    named["keys"] = pa.array([dump_sorted(keys[a:b]) for _, a, b in rows], pa.binary())
    for name, values in zip("abc", [*columns, *[None] * (3 - len(columns))]):
        blobs = [None if values is None else dump(values[a:b]) for _, a, b in rows]
        named[name] = pa.array(blobs, pa.binary())
    return pa.record_batch(list(named.values()), names=list(named))


def _reduce(messages: DataFrame, bits: int, combine: Callable, path: str) -> DataFrame:
    """Each part's messages go through combine(keys, columns, inverse) -> (model columns, reply columns, stats).

    The part's sums are kept as the model's rows; replies go out in each
    batch's own order.  Returns the written table's replies.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}
        for rows in batches:
            for row in rows.to_pylist():
                held.setdefault(row["part"], []).append(row)
        for part, rows in held.items():
            rows.sort(key=lambda r: r["batch"])  # sums don't depend on what came first
            keys = [load_sorted(r["keys"]) for r in rows]
            ends = np.cumsum([0, *(len(k) for k in keys)])
            distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            columns = [np.concatenate([load(r[name]) for r in rows]) for name in "abc" if rows[0][name] is not None]
            model, reply, stats = combine(distinct, columns, inverse)
            out = [("model", -1, part, dump_sorted(distinct), dump(model[0]), dump(model[1]) if len(model) > 1 else None, None)]
            out.append(("stats", -1, part, None, None, None, stats))
            for row, a, b in zip(rows, ends, ends[1:]):
                sent = [dump(values[inverse[a:b]]) for values in reply]
                out.append(("reply", row["batch"], part, None, sent[0], sent[1] if len(sent) > 1 else None, None))
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()))
            names = ["kind", "batch", "part", "keys", "a", "b", "stats"]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    spark = messages.sparkSession
    reduced = messages.repartitionById(1 << bits, "part").mapInArrow(run, REPLY)
    reduced.write.partitionBy("kind").parquet(path)
    return spark.read.schema(REPLY).parquet(path)


def _stats(table: DataFrame) -> np.ndarray:
    """The parts' statistics, summed; a row of a few numbers."""
    row = table.where("kind = 'stats'").select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    found = {r["i"]: r["x"] for r in row.collect()}
    return np.array([found.get(i, 0.0) for i in range(DISCOUNTED + 4)])


def _count(distinct: np.ndarray, columns: list[np.ndarray], inverse: np.ndarray):
    """Sums of training counts, and how many n-grams have each count."""
    total = np.bincount(inverse, weights=columns[0], minlength=len(distinct)).astype(np.uint32 if columns[0].sum() < 2**32 else np.uint64)
    of = np.bincount(np.minimum(total, DISCOUNTED + 2).astype(np.int64), minlength=DISCOUNTED + 3)
    stats = [float(x) for x in of] + [float(total.sum())]
    return [total], [total], stats


def _weigh(distinct: np.ndarray, columns: list[np.ndarray], inverse: np.ndarray):
    """Of each context: Z and alpha, from its count, discounted mass and lower-order mass."""
    count, kept, lower = (np.bincount(inverse, weights=c, minlength=len(distinct)) for c in columns)
    z = leftover(count, kept)
    seen = count > 0
    z = np.where(seen, z, 1.0)
    alpha = np.where(seen, (1 - kept / z) / np.maximum(1 - lower, 1e-300), 1.0)
    return [z, alpha], [z, alpha], [0.0]


def _per_batch(replies: DataFrame, tasks: int, work: Callable[[int, list[np.ndarray]], pa.RecordBatch | None], schema: str) -> DataFrame:
    """Run `work` on each batch with its replies' columns, joined over the parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        for rows in batches:
            for row in rows.to_pylist():
                held.setdefault(row["batch"], []).append((row["part"], row["a"], row["b"]))
        for batch in sorted(held):
            rows = sorted(held.pop(batch), key=lambda r: r[0])
            columns = [np.concatenate([load(r[i]) for r in rows]) for i in (1, 2) if rows[0][i] is not None]
            if (out := work(batch, columns)) is not None:
                yield out

    some = replies.where("kind = 'reply'").select("batch", "part", "a", "b")
    home = F.pmod(F.col("batch"), F.lit(tasks)).cast("int")
    return some.repartitionById(tasks, home).mapInArrow(run, schema)


def score(documents: DataFrame, *, order: int = 2, folds: int = 10) -> DataFrame:
    """log10 probability of every text under the model of the training texts.

    `documents` needs doc_id and text; other columns are not read.  Rows whose
    crc32(doc_id as text) is divisible by `folds` are held out of training.  A
    null text is empty: one end token.  A null doc_id counts as the text ''.
    Repeated rows train and are scored one by one, equal texts alike.  A text of
    any length is one row of a batch and scored whole.  Without training rows
    all tokens are unknown and have the probability 1.  No rows give none.
    """
    return train(documents, common.work_dir(documents.sparkSession, "katz"), order=order, folds=folds)


def train(documents: DataFrame, folder: str, *, order: int, folds: int) -> DataFrame:
    """As score(); the model's tables stay under `folder`, and score_stored() scores other texts by them."""
    spark = documents.sparkSession
    files, tasks = Files(f"{folder}/batches"), common.partitions(documents)
    bits = max(1, (max(4, tasks) - 1).bit_length())

    replies = _reduce(tokenise(documents, files, folds, bits), bits, _count, f"{folder}/order-1")
    stats = _stats(replies)
    d = [discounts(stats[: DISCOUNTED + 2])]
    total, distinct = stats[DISCOUNTED + 3], stats[1 : DISCOUNTED + 3].sum()
    kept = float(sum(d[0][r] * r * stats[r] for r in range(1, DISCOUNTED + 1)))
    kept += total - sum(r * stats[r] for r in range(1, DISCOUNTED + 1))
    z = max(total, kept + 0.5) if total else 1.0
    unknown = 1 - kept / z if total else 1.0
    d1 = d[0]

    def unigram(counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, d1) / z, unknown)

    def ended(batch: Batch, at_token: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        return _scored(batch, at_token, counts, total, distinct)

    def described() -> None:
        """What the tables need beside themselves to score other texts."""
        facts = {"order": order, "bits": bits, "total": total, "distinct": distinct, "z": z, "unknown": unknown, "discounts": [x.tolist() for x in d]}
        write_file(f"{folder}/model.json", json.dumps(facts).encode())

    if order == 1:

        def only(number: int, columns: list[np.ndarray]) -> pa.RecordBatch:
            batch = Batch(files, number)
            return ended(batch, unigram(columns[0])[batch.words], columns[0])

        described()
        return _per_batch(replies, tasks, only, SCORES)

    def begin(number: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        batch = Batch(files, number)
        files.put(number, "words", {"counts": dump(columns[0])})
        return _grams(batch, 2, bits)

    messages = _per_batch(replies, tasks, begin, MESSAGE)
    for k in range(2, order + 1):
        counted = _reduce(messages, bits, _count, f"{folder}/order-{k}")
        d.append(discounts(_stats(counted)[: DISCOUNTED + 2]))

        def lower(batch: Batch, k: int = k) -> np.ndarray:
            """P_{k-1} of each token."""
            if k == 2:
                return unigram(load(files.get(batch.number, "words")["counts"]))[batch.words]
            return load(files.get(batch.number, f"order-{k - 1}")["p"])

        def contexts(number: int, columns: list[np.ndarray], k: int = k, dk: np.ndarray = d[-1], lower=lower) -> pa.RecordBatch:
            batch = Batch(files, number)
            keys, context = batch.keys(k)
            _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
            files.put(number, f"counts-{k}", {"counts": dump(columns[0])})
            own = np.bincount(inverse[batch.train_token], minlength=len(first))  # this batch's share of each n-gram
            share = own / np.maximum(columns[0], 1)
            names, where = np.unique(context, return_inverse=True)
            at = where[first]
            sums = [own, share * discounted(columns[0], dk), share * lower(batch)[first]]
            sums = [np.bincount(at, weights=x, minlength=len(names)) for x in sums]
            return _messages(number, names, bits, sums[0].astype(np.uint32), sums[1], sums[2])

        weighed = _reduce(_per_batch(counted, tasks, contexts, MESSAGE), bits, _weigh, f"{folder}/contexts-{k}")

        def evaluate(number: int, columns: list[np.ndarray], k: int = k, dk: np.ndarray = d[-1], lower=lower) -> pa.RecordBatch:
            batch = Batch(files, number)
            keys, context = batch.keys(k)
            counts = load(files.get(number, f"counts-{k}")["counts"])[np.unique(keys, return_inverse=True)[1]]
            where = np.unique(context, return_inverse=True)[1]
            seen = discounted(counts, dk) / columns[0][where]
            p = np.where(counts > 0, seen, columns[1][where] * lower(batch))
            if k == order:
                return ended(batch, p, load(files.get(number, "words")["counts"]))
            files.put(number, f"order-{k}", {"p": dump(p)})
            return _grams(batch, k + 1, bits)

        messages = _per_batch(weighed, tasks, evaluate, SCORES if k == order else MESSAGE)
    described()
    return messages


def _scored(batch: Batch, at_token: np.ndarray, counts: np.ndarray, total: float, distinct: float) -> pa.RecordBatch:
    """A batch's rows of SCORES from its tokens' probabilities and its words' training counts."""
    size = len(batch.lengths)
    own = counts[batch.words].astype(float)
    base = np.log10((own + 0.1) / (total + 0.1 * (distinct + 1)))
    per_doc = [np.bincount(batch.doc, weights=w, minlength=size) for w in (own > 0, base, np.log10(at_token))]
    columns = [pa.array(batch.doc_ids, mask=batch.nulls.astype(bool)), pa.array(~batch.train)]
    columns += [pa.array(batch.lengths), pa.array(per_doc[0].astype(np.int64))]
    columns += [pa.array(np.full(size, int(total), dtype=np.int64)), pa.array(per_doc[1]), pa.array(per_doc[2])]
    return pa.record_batch(columns, names=[c.split()[0] for c in SCORES.split(", ")])


def _asked(messages: DataFrame, bits: int, path: str, missing: tuple[float, ...]) -> DataFrame:
    """Replies from a stored table: each part's rows meet the batches' keys there; a key that it lacks has the values `missing`."""
    nothing = F.lit(None).cast("binary")
    asks = messages.select("batch", "part", "keys", nothing.alias("a"), nothing.alias("b"))
    stored = messages.sparkSession.read.schema(REPLY).parquet(path).where("kind = 'model'").select(F.lit(-1).cast("long").alias("batch"), "part", "keys", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}
        for rows in batches:
            for row in rows.to_pylist():
                held.setdefault(row["part"], []).append(row)
        for part, rows in held.items():
            table = next((r for r in rows if r["batch"] < 0), None)
            known = load_sorted(table["keys"]) if table else np.empty(0, np.uint64)
            values = [load(table[c]) if table else np.empty(0) for c in "ab"[: len(missing)]]
            out = []
            for row in rows:
                if row["batch"] >= 0:
                    keys = load_sorted(row["keys"])
                    at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
                    hit = known[at] == keys if len(known) else np.zeros(len(keys), dtype=bool)
                    sent = [np.full(len(keys), m, dtype=v.dtype if len(v) else float) for m, v in zip(missing, values)]
                    for column, v in zip(sent, values):
                        column[hit] = v[at[hit]]
                    blobs = [dump(c) for c in sent] + [None]
                    out.append(("reply", row["batch"], part, None, blobs[0], blobs[1], None))
            if out:
                kinds = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()))
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["kind", "batch", "part", "keys", "a", "b", "stats"])

    return common.written(asks.unionByName(stored).repartitionById(1 << bits, "part").mapInArrow(run, REPLY), "replies")


def score_stored(documents: DataFrame, folder: str) -> DataFrame:
    """The rows of SCORES for other texts, from the tables that train() left under `folder`; nothing is learned from them.

    As score(): the same text has the same score.  `held_out` is true.
    """
    facts = json.loads(bytes(read_file(f"{folder}/model.json")))
    order, bits, total, distinct, d = facts["order"], facts["bits"], facts["total"], facts["distinct"], [np.array(x) for x in facts["discounts"]]
    files, tasks = Files(common.work_dir(documents.sparkSession, "katz-new")), common.partitions(documents)

    def unigram(counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, d[0]) / facts["z"], facts["unknown"])

    # with one fold every row is held out
    replies = _asked(tokenise(documents, files, 1, bits), bits, f"{folder}/order-1", (0,))

    def words(number: int, columns: list[np.ndarray]) -> pa.RecordBatch:
        batch = Batch(files, number)
        p = unigram(columns[0])[batch.words]
        files.put(number, "words", {"counts": dump(columns[0])})
        files.put(number, "order-1", {"p": dump(p)})
        return _scored(batch, p, columns[0], total, distinct) if order == 1 else _grams(batch, 2, bits)

    messages = _per_batch(replies, tasks, words, SCORES if order == 1 else MESSAGE)
    for k in range(2, order + 1):

        def contexts(number: int, columns: list[np.ndarray], k: int = k) -> pa.RecordBatch:
            files.put(number, f"counts-{k}", {"counts": dump(columns[0])})
            return _messages(number, np.unique(Batch(files, number).keys(k)[1]), bits)

        def evaluate(number: int, columns: list[np.ndarray], k: int = k) -> pa.RecordBatch:
            batch = Batch(files, number)
            keys, context = batch.keys(k)
            counts = load(files.get(number, f"counts-{k}")["counts"])[np.unique(keys, return_inverse=True)[1]]
            where = np.unique(context, return_inverse=True)[1]
            lower = load(files.get(number, f"order-{k - 1}")["p"])
            p = np.where(counts > 0, discounted(counts, d[k - 1]) / columns[0][where], columns[1][where] * lower)
            if k == order:
                return _scored(batch, p, load(files.get(number, "words")["counts"]), total, distinct)
            files.put(number, f"order-{k}", {"p": dump(p)})
            return _grams(batch, k + 1, bits)

        counted = _per_batch(_asked(messages, bits, f"{folder}/order-{k}", (0,)), tasks, contexts, MESSAGE)
        messages = _per_batch(_asked(counted, bits, f"{folder}/contexts-{k}", (1.0, 1.0)), tasks, evaluate, SCORES if k == order else MESSAGE)
    return messages


def _grams(batch: Batch, order: int, bits: int) -> pa.RecordBatch:
    keys, _ = batch.keys(order)
    distinct, inverse = np.unique(keys, return_inverse=True)
    counts = np.bincount(inverse[batch.train_token], minlength=len(distinct)).astype(np.uint32)
    return _messages(batch.number, distinct, bits, counts)

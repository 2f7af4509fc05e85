"""SentencePiece BPE encoding with seeded merge-dropout, and its decoding.

A word's agenda holds its candidate merges, best score first, then leftmost.
When a candidate's turn comes, a keyed hash of (seed, document, place, place in
the word, merged piece) decides whether it is skipped, so one seed always gives
one segmentation, and each occurrence of a word draws its own.  Without dropout
the ids are those of the sentencepiece library.  Every sequence of pieces
decodes to the text it came from, whatever characters that holds.

The agendas of many short words run side by side in arrays; a long word runs
through a heap.  Both give the same pieces.  The verdicts that occurrences of a
frequent word met are kept as a decision tree, so an occurrence that meets the
same ones finds its pieces by walking down that tree.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

SPACE = "▁"
#: A unit that is a space mark of the text itself; it is written as bytes.
LITERAL = " "
#: Longer words go through the heap.
SHORT = 48
#: Words side by side in arrays; nodes of decision trees that a worker keeps; characters of a text group.
TOGETHER, REMEMBERED, GROUP_CHARS = 4096, 1_500_000, 1_500_000
#: A word that is so often in a text group gets a decision tree.
OFTEN = 2
GONE = np.iinfo(np.int32).min
SCHEMA = "doc_id long, n_tokens long, ids_crc32 long, n_chars long, lossless boolean"


class Vocabulary:
    """Pieces, scores and mergeable pairs of a BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = library.get_piece_size()
        self.dtype = np.dtype("<u2" if self.size <= 65536 else "<u4")
        self.texts: list[bytes] = [b""] * self.size
        self.byte_ids = [0] * 256
        self.ids: dict[str, int] = {}
        scores = np.zeros(self.size, dtype=np.float32)
        for i in range(self.size):
            piece = library.id_to_piece(i)
            if library.is_byte(i):
                self.texts[i] = bytes([int(piece[1:-1], 16)])
                self.byte_ids[self.texts[i][0]] = i
            elif not (library.is_control(i) or library.is_unknown(i) or library.is_unused(i)):
                self.ids[piece] = i
                self.texts[i] = piece.replace(SPACE, " ").encode()
                scores[i] = library.get_score(i)
        self.scores = scores
        merges = {}
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                a, b = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if a is not None and b is not None:
                    merges[a * self.size + b] = i
        self.merges = merges
        self._index(np.array(list(merges), dtype=np.int64), np.array(list(merges.values()), dtype=np.int32))
        #: Texts may be cut before spaces and around line ends if no piece spans such a place.
        self.cuts = all(SPACE not in piece.lstrip(SPACE) for piece in self.ids)
        self.cuts_lines = not any("\n" in piece for piece in self.ids)

    def symbol(self, char: str) -> int:
        """A character's piece, or minus its code point - 1 if only bytes hold it."""
        return self.ids.get(char, -1 - ord(char))

    def output(self, symbols: list[int]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            if s >= 0:
                out.append(s)
            else:
                out += [self.byte_ids[b] for b in chr(-1 - s).encode("utf-8", "surrogatepass")]
        return out

    def _index(self, keys: np.ndarray, pieces: np.ndarray) -> None:
        """A hash table of the mergeable pairs with linear probing, filled a probe at a time."""
        self.bits = max(4, int(16 * max(1, len(keys)) - 1).bit_length())
        self.table, self.found = np.full(1 << self.bits, -1, dtype=np.int64), np.full(1 << self.bits, -1, dtype=np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self.table[slot] < 0
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            first = first[free[first]]
            self.table[slot[first]], self.found[slot[first]] = keys[first], pieces[first]
            left = np.ones(len(keys), dtype=bool)
            left[first] = False
            keys, pieces, slot = keys[left], pieces[left], (slot[left] + 1) & (len(self.table) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair merges to, or -1."""
        keys = a.astype(np.int64) * self.size + b
        slot = self._slot(keys)
        at = self.table[slot]
        out = np.where((at == keys) & (a >= 0) & (b >= 0), self.found[slot], np.int32(-1))
        more = np.flatnonzero((at >= 0) & (at != keys) & (a >= 0) & (b >= 0))
        while len(more):
            slot[more] = (slot[more] + 1) & (len(self.table) - 1)
            at = self.table[slot[more]]
            hit = at == keys[more]
            out[more[hit]] = self.found[slot[more[hit]]]
            more = more[(at >= 0) & ~hit]
        return out


MASK = 2**64 - 1


def coded(begin, end, piece):
    """A candidate merge as one number: where its piece begins and ends in the word, and the piece."""
    return begin << 42 ^ end << 21 ^ piece


def verdicts(word: np.ndarray, candidate: np.ndarray, limit: int) -> np.ndarray:
    """The keyed hash's verdict on candidates: whether each is skipped; `word` holds the key of seed, document and place."""
    with np.errstate(over="ignore"):
        return common.mixed(word ^ candidate.astype(np.uint64), 9) < np.uint64(limit)


def verdict(word: int, candidate: int, limit: int) -> bool:
    """verdicts() of one candidate."""
    x = ((word ^ candidate) + 0x9E3779B97F4A7C15 * 10) & MASK
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31 < limit


def by_heap(vocabulary: Vocabulary, word: str, key: int, limit: int) -> list[int]:
    """A word's pieces through an agenda in a heap."""
    symbols = [vocabulary.symbol(c) for c in word]
    n = len(symbols)
    end = list(range(1, n + 1))  # of the symbol that begins here; that is also where the next one begins
    before = list(range(-1, n))
    agenda: list[tuple] = []

    def offer(i: int) -> None:
        j = end[i]
        if j >= n or symbols[i] < 0 or symbols[j] < 0:
            return
        piece = vocabulary.merges.get(symbols[i] * vocabulary.size + symbols[j])
        if piece is not None:
            heapq.heappush(agenda, (-vocabulary.scores[piece], i, end[j], piece, j))

    for i in range(n - 1):
        offer(i)
    alive = [True] * n
    while agenda:
        _, i, stop, piece, j = heapq.heappop(agenda)
        if not (alive[i] and alive[j] and end[i] == j and end[j] == stop):
            continue
        if limit and verdict(key, coded(i, stop, piece), limit):
            continue
        symbols[i], end[i], alive[j] = piece, stop, False
        before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return vocabulary.output([s for s, live in zip(symbols, alive) if live])


def by_arrays(vocabulary: Vocabulary, words: list[str], keys: np.ndarray, limit: int) -> tuple[list[bytes], list[tuple]]:
    """The pieces of short words, an agenda step of every word at a time; and each step's (words, candidates, verdicts)."""
    rows, width = len(words), max(map(len, words))
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=rows)
    flat = "".join(words)
    points = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds, kind = np.unique(points, return_inverse=True)
    own = np.array([vocabulary.symbol(chr(c)) for c in kinds.tolist()], dtype=np.int32)
    wide = width + 2  # two places past the end, which no symbol holds
    base = np.arange(rows, dtype=np.int64) * wide
    place = np.arange(wide)
    filled = place[None] < lengths[:, None]
    symbols = np.full((rows, wide), GONE, dtype=np.int32)
    symbols[filled] = own[kind]
    merged = np.full((rows, wide), -1, dtype=np.int32)
    merged[:, :-1] = vocabulary.lookup(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(rows, wide - 1)
    scores = np.where(merged >= 0, vocabulary.scores[merged], np.float32(-np.inf))
    after = np.minimum(place + 1, wide - 1) + base[:, None]  # flat place of the next symbol
    before = place - 1 + base[:, None]
    symbols, merged, after, before = (x.reshape(-1) for x in (symbols, merged, after, before))
    flat_scores = scores.reshape(-1)

    def offer(at: np.ndarray) -> None:
        piece = vocabulary.lookup(symbols[at], symbols[after[at]])
        merged[at] = piece
        flat_scores[at] = np.where(piece >= 0, vocabulary.scores[piece], np.float32(-np.inf))

    live, steps = np.arange(rows), []
    while len(live):
        at = scores[live].argmax(axis=1) + base[live]
        go = flat_scores[at] > -np.inf
        if not go.all():
            live, at = live[go], at[go]
            if not len(live):
                break
        right = after[at]
        stop = after[right]
        if limit:
            candidate = coded(at - base[live], stop - base[live], merged[at].astype(np.int64))
            skip = verdicts(keys[live], candidate, limit)
            steps.append((live, candidate, skip))
            flat_scores[at[skip]] = -np.inf
            at, right, stop = at[~skip], right[~skip], stop[~skip]
        symbols[at] = merged[at]
        symbols[right] = GONE
        flat_scores[right] = -np.inf
        after[at] = stop
        before[stop] = at
        offer(at)
        left = before[at]
        offer(left[left >= at - at % wide])
    held = symbols.reshape(rows, wide) != GONE
    counts = held.sum(axis=1)
    ids = symbols[held.reshape(-1)]
    ends = np.cumsum(counts)
    if (ids >= 0).all():
        raw, cuts = ids.astype(vocabulary.dtype).tobytes(), (ends * vocabulary.dtype.itemsize).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts)], steps
    listed, cuts = ids.tolist(), ends.tolist()
    return [np.array(vocabulary.output(listed[a:b]), dtype=vocabulary.dtype).tobytes() for a, b in zip([0, *cuts], cuts)], steps


class Trees:
    """A decision tree per word over the verdicts that its agenda can meet.

    A slot is what follows a verdict: -1 not met yet, a node's number, or -2
    minus the number of the pieces that the word ends in.
    """

    def __init__(self):
        self.words: dict[str, int] = {}  # each one's first slot
        self.slots = np.empty(1 << 16, dtype=np.int32)
        self.candidates, self.children = (np.empty(1 << 16, dtype=np.int64) for _ in range(2))
        self.used = self.nodes = 0
        self.pieces: list[bytes] = []

    def new_slots(self, n: int) -> int:
        while self.used + n > len(self.slots):
            self.slots = np.concatenate([self.slots, np.empty_like(self.slots)])
        self.slots[self.used : self.used + n] = -1
        self.used += n
        return self.used - n

    def new_nodes(self, candidates: np.ndarray) -> np.ndarray:
        """Nodes with two slots each: node k has its slots where children[k] says."""
        n = len(candidates)
        while self.nodes + n > len(self.candidates):
            self.candidates, self.children = (np.concatenate([x, np.empty_like(x)]) for x in (self.candidates, self.children))
        numbers = np.arange(self.nodes, self.nodes + n)
        self.candidates[numbers] = candidates
        self.children[numbers] = self.new_slots(2 * n) + 2 * np.arange(n)
        self.nodes += n
        return numbers

    def walk(self, slots: np.ndarray, keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(what was found, the slot where the walk ended, steps taken) of every occurrence."""
        slots, depth = slots.copy(), np.zeros(len(slots), dtype=np.int64)
        found = self.slots[slots]
        at = np.flatnonzero(found >= 0)
        while len(at):
            node = found[at]
            slots[at] = self.children[node] + verdicts(keys[at], self.candidates[node], limit)
            found[at] = self.slots[slots[at]]
            depth[at] += 1
            at = at[found[at] >= 0]
        return found, slots, depth

    def learn(self, slots: np.ndarray, depth: np.ndarray, raw: list[bytes], steps: list[tuple]) -> np.ndarray:
        """Grow the trees by occurrences that left them at `slots` after `depth` steps; returns the numbers of their pieces."""
        slots = slots.copy()
        for k, (rows, candidates, skip) in enumerate(steps):
            beyond = depth[rows] <= k
            rows, candidates, skip = rows[beyond], candidates[beyond], skip[beyond]
            here, first = np.unique(slots[rows], return_index=True)
            new = self.slots[here] == -1
            self.slots[here[new]] = self.new_nodes(candidates[first[new]])
            slots[rows] = self.children[self.slots[slots[rows]]] + skip
        ends, first = np.unique(slots, return_index=True)
        new = self.slots[ends] == -1
        self.slots[ends[new]] = -2 - (len(self.pieces) + np.arange(int(new.sum())))
        self.pieces += [raw[k] for k in first[new].tolist()]
        return -2 - self.slots[slots]


class Encoder:
    """Encodes texts; keeps the decision trees of frequent words."""

    def __init__(self, path: str, seed: int = 0, dropout: float = 0.0):
        self.vocabulary, self.seed = Vocabulary(path), seed
        #: A candidate is skipped if its hash is below this.
        self.limit = min(MASK, int(dropout * 2.0**64))
        self.trees = Trees()

    def units(self, text: str) -> list[str]:
        """A text as the strings between which no merge can happen; a space mark of its own is LITERAL."""
        out: list[str] = []
        mark = SPACE
        for k, part in enumerate(text.split(SPACE)):
            if k:
                out.append(LITERAL)
            part, mark = mark + part.replace(" ", SPACE), ""
            if not self.vocabulary.cuts:
                out += [part] if part else []
                continue
            for n, line in enumerate(part.split("\n") if self.vocabulary.cuts_lines else [part]):
                if n:
                    out.append("\n")
                self._words(line, out)
        return out

    def _words(self, line: str, out: list[str]) -> None:
        """A line cut in front of each run of spaces."""
        parts = line.split(SPACE)
        if parts[0]:
            out.append(parts[0])
        if "" not in parts[1:]:
            out += [SPACE + p for p in parts[1:]]
            return
        spaces = ""
        for p in parts[1:]:
            spaces += SPACE
            if p:
                out.append(spaces + p)
                spaces = ""
        if spaces:
            out.append(spaces)

    def encode(self, doc_ids: list[int | None], texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text; none for a null or empty text."""
        cut = [self.units(text) if text else [] for text in texts]
        flat = [word for words in cut for word in words]
        words = list(dict.fromkeys(flat))
        number = dict(zip(words, range(len(words))))
        ids = np.fromiter(map(number.__getitem__, flat), dtype=np.int64, count=len(flat))
        if self.trees.nodes > REMEMBERED:
            self.trees = Trees()
        keys = self._keys(doc_ids, cut) if self.limit else np.zeros(len(flat), dtype=np.uint64)
        pieces, kept = self.trees.pieces, len(self.trees.pieces)
        which = self._pieces(flat, words, ids, keys)
        raw = list(map(pieces.__getitem__, which.tolist()))
        if len(pieces) > kept + self.learnt:
            del pieces[kept + self.learnt :]
        out, at = [], 0
        for part in cut:
            out.append(np.frombuffer(b"".join(raw[at : at + len(part)]), dtype=self.vocabulary.dtype))
            at += len(part)
        return out

    def _keys(self, doc_ids: list[int | None], cut: list[list[str]]) -> np.ndarray:
        """The key of each occurrence: its document and place under the seed."""
        out = [np.zeros(0, dtype=np.uint64)]
        for doc, words in zip(doc_ids, cut):
            base = np.array([((doc or 0) * 0x9E3779B97F4A7C15 + self.seed * 0xD6E8FEB86659FD93) % 2**64], dtype=np.uint64)
            with np.errstate(over="ignore"):
                out.append(common.mixed(np.arange(len(words), dtype=np.uint64) + common.mixed(base, 5), 4))
        return np.concatenate(out)

    def _pieces(self, flat: list[str], words: list[str], ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The number of each occurrence's pieces in the trees' list; from `kept + learnt` on they are of this group alone."""
        trees = self.trees
        often = np.bincount(ids, minlength=len(words)) >= OFTEN
        first = np.empty(len(words), dtype=np.int64)  # a slot, -1 for a word without a tree, -2 for a long one
        for k, (word, many) in enumerate(zip(words, often.tolist())):
            slot = trees.words.get(word, -1)
            if slot < 0:
                if len(word) > SHORT or word == LITERAL:
                    slot = -2
                elif many:
                    slot = trees.words[word] = trees.new_slots(1)
            first[k] = slot
        at = first[ids]
        which = np.empty(len(ids), dtype=np.int64)
        inside = np.flatnonzero(at >= 0)
        found, slots, depth = trees.walk(at[inside], keys[inside], self.limit)
        which[inside] = -2 - found
        self.learnt = -len(trees.pieces)
        lost = found == -1
        size = np.array([len(w) for w in words], dtype=np.int64)[ids] if len(words) else ids
        for part in self._together(inside[lost], size):
            here = np.searchsorted(inside, part)
            raw, steps = by_arrays(self.vocabulary, [flat[k] for k in part.tolist()], keys[part], self.limit)
            which[part] = trees.learn(slots[here], depth[here], raw, steps)
        self.learnt += len(trees.pieces)
        for part in self._together(np.flatnonzero(at == -1), size):
            which[part] = len(trees.pieces) + np.arange(len(part))
            trees.pieces += by_arrays(self.vocabulary, [flat[k] for k in part.tolist()], keys[part], self.limit)[0]
        for k in np.flatnonzero(at == -2).tolist():
            which[k] = len(trees.pieces)
            trees.pieces.append(self._long(flat[k], int(keys[k])))
        return which

    def _together(self, rows: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
        """Occurrences of like length in groups."""
        rows = rows[np.argsort(size[rows], kind="stable")]
        return [rows[a : a + TOGETHER] for a in range(0, len(rows), TOGETHER)]

    def _long(self, word: str, key: int) -> bytes:
        """A long word, or a literal space mark, which is written as bytes."""
        if word == LITERAL:
            out = [self.vocabulary.byte_ids[b] for b in SPACE.encode()]
        else:
            out = by_heap(self.vocabulary, word, key, self.limit)
        return np.array(out, dtype=self.vocabulary.dtype).tobytes()

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the space put in front of a text goes again."""
        raw = b"".join(map(self.vocabulary.texts.__getitem__, ids.tolist()))
        return raw.decode("utf-8", "surrogatepass").removeprefix(" ")


def encoder(path: str, seed: int, dropout: float) -> Encoder:
    return common.resident(("dropout", path, seed, dropout), lambda: Encoder(path, seed, dropout))


def encode(documents: DataFrame, path: str, *, seed: int = 7, dropout: float = 0.1) -> DataFrame:
    """doc_id and the ids of every text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        ids = [x.astype(np.int32) for x in encoder(path, seed, dropout).encode(docs, texts)]
        return pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return common.map_batches(documents.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of every list of ids; null ids have no text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(path, 0, 0.0)
        texts = [None if ids is None else coder.decode(np.array(ids, dtype=np.int64)) for ids in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return common.map_batches(encoded.select("doc_id", "ids"), run, "doc_id long, text string")


def round_trip(documents: DataFrame, path: str, *, seed: int = 7, dropout: float = 0.1) -> DataFrame:
    """Encode every text with dropout, decode the ids, and compare.

    `documents` needs doc_id and text; other columns are not read.  A null or
    empty text has no ids and decodes to ''.  A null doc_id is keyed as 0, so
    repeated rows get equal ids; equal texts of different ids don't.  Of merges
    with equal scores the leftmost comes first.  A text of any length is encoded
    whole, a word of any length in time n log n.  No rows give none.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = encoder(path, seed, dropout)
        docs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows: list[tuple] = []
        at = 0
        while at < len(docs):
            end, chars = at, 0
            while end < len(docs) and (end == at or chars < GROUP_CHARS):
                chars += len(texts[end] or "")
                end += 1
            for doc, text, ids in zip(docs[at:end], texts[at:end], coder.encode(docs[at:end], texts[at:end])):
                decoded = coder.decode(ids)
                rows.append((doc, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), len(decoded), decoded == (text or "")))
            at = end
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return common.map_batches(documents.select("doc_id", "text"), run, SCHEMA)

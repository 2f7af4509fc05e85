"""Quality rules: base counts of a text and the fertility of public tokenisers.

A text's words go one by one through public vocabularies: a SentencePiece one
with byte fallback and a byte-level one for many languages.  Three measures
come out of each: characters per token, the share of tokens that are fallback
bytes (of the byte-level one: parts of characters), and the entropy of the
tokens against the most that so many tokens could have.  Each script has a band
per vocabulary and measure; a text outside one of its script's bands is
rejected.  Ordinary prose of any length lies inside; words with symbols stuck
to them, strings of symbols, encoded data, one passage over and over, or text
in a wrong encoding do not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

#: Characters that the base rules count as symbols.
SYMBOLS = "#*$%&|<>"
#: Words in a window of which a repeat is counted.
WINDOW = 8
#: Documents are measured in groups of about so many characters.
GROUP_CHARS = 1_000_000
#: Distinct words whose tokens a worker remembers.
REMEMBERED = 250_000
#: Where a byte-level vocabulary cuts words before it merges (fixed value of the public vocabularies).
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Scripts by their code point ranges; the first is the default.  Two more names have no range of their own: "other" is
#: any script not listed, and "latin_extended" is Latin of which MARKED of the letters lie in EXTENDED.
SCRIPTS = {
    "latin": ((0x41, 0x2AF), (0x1E00, 0x1EFF)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F)),
    "indic": ((0x900, 0xDFF),),
    "thai": ((0xE00, 0xE7F),),
    "hangul": ((0x1100, 0x11FF), (0xAC00, 0xD7AF)),
    "kana": ((0x3040, 0x30FF),),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF)),
}
#: Letters that no single-byte encoding gives by mistake; languages that use many, as Vietnamese, have short tokens.
EXTENDED = ((0x100, 0x2AF), (0x1E00, 0x1EFF))
MARKED = 0.05


@dataclass(frozen=True)
class Band:
    """What a script's texts may measure: a text outside is rejected."""

    chars_per_token: tuple[float, float]
    fallback_share: tuple[float, float] = (0.0, 0.2)
    entropy_share: tuple[float, float] = (0.56, 1.0)


#: Rejection bands of the SentencePiece vocabulary, set a tenth or more outside the extremes of prose of 50, 500 and
#: 5,000 words (README).  Scripts that it spells letter by letter have the entropy of letters, those in bytes less.
PIECE_BANDS = {
    "latin": Band((1.5, 8.0)),
    "latin_extended": Band((0.9, 8.0), (0.0, 0.4), (0.58, 1.0)),
    "greek": Band((0.5, 4.0), (0.0, 0.8), (0.4, 1.0)),
    "cyrillic": Band((0.8, 6.0), (0.0, 0.5)),
    "hebrew": Band((0.4, 4.0), (0.0, 1.0), (0.4, 1.0)),
    "arabic": Band((0.4, 4.0), (0.0, 1.0), (0.4, 1.0)),
    "indic": Band((0.25, 4.0), (0.0, 1.0), (0.29, 1.0)),
    "thai": Band((0.3, 4.0), (0.0, 1.0), (0.45, 1.0)),
    "hangul": Band((0.3, 3.0), (0.0, 1.0), (0.5, 1.0)),
    "kana": Band((0.3, 3.0), (0.0, 1.0)),
    "han": Band((0.3, 3.0), (0.0, 1.0)),
    "other": Band((0.2, 4.0), (0.0, 1.0), (0.28, 1.0)),
}
#: The same of the byte-level vocabulary, a tenth or more outside what all but a hundredth of the prose measures.  It
#: knows more scripts, so its bands are narrower: a text whose words it must spell in single bytes is rejected.
BYTE_BANDS = {
    "latin": Band((1.5, 8.0), (0.0, 0.3), (0.62, 1.0)),
    "latin_extended": Band((1.3, 8.0), (0.0, 0.3), (0.64, 1.0)),
    "greek": Band((1.1, 5.0), (0.0, 0.4), (0.6, 1.0)),
    "cyrillic": Band((1.0, 6.0), (0.0, 0.5), (0.58, 1.0)),
    "hebrew": Band((0.75, 4.0), (0.0, 0.6), (0.48, 1.0)),
    "arabic": Band((0.75, 4.0), (0.0, 0.6), (0.46, 1.0)),
    "indic": Band((0.28, 4.0), (0.0, 1.0), (0.3, 1.0)),
    "thai": Band((0.85, 4.0), (0.0, 0.4), (0.5, 1.0)),
    "hangul": Band((0.8, 3.0), (0.0, 0.7), (0.64, 1.0)),
    "kana": Band((0.8, 3.0), (0.0, 0.5), (0.64, 1.0)),
    "han": Band((0.55, 3.0), (0.0, 0.7), (0.6, 1.0)),
    "other": Band((0.28, 4.0), (0.0, 1.0), (0.28, 1.0)),
}
#: Per kind of vocabulary file, by the end of its name.
BANDS = {".model": PIECE_BANDS, ".tiktoken": BYTE_BANDS}

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, script string"
)
#: For each vocabulary, in the order given.
MEASURES = "chars_per_token{0} double, fallback_share{0} double, entropy_share{0} double"


def schema(n: int) -> str:
    """SCHEMA and the measures of n vocabularies; those after the first are numbered."""
    return ", ".join([SCHEMA, *(MEASURES.format(f"_{k + 1}" if k else "") for k in range(n))])


class PieceVocabulary:
    """A SentencePiece vocabulary with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.library.get_piece_size()
        self.fallback = np.array([self.library.is_byte(i) or self.library.is_unknown(i) for i in range(self.size)])

    def encode(self, words: list[str]) -> list[list[int]]:
        return self.library.encode(words, num_threads=1)


class ByteVocabulary:
    """A byte-level vocabulary of ranks; a token that is a part of a character is a fallback."""

    def __init__(self, path: str):
        import base64

        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.library = tiktoken.Encoding("bands", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.size = max(ranks.values()) + 1
        self.fallback = np.zeros(self.size, dtype=bool)
        for token, rank in ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                self.fallback[rank] = True

    def encode(self, words: list[str]) -> list[list[int]]:
        """Each word as it stands after a space."""
        return [self.library.encode_ordinary(" " + word) for word in words]


KINDS = {".model": PieceVocabulary, ".tiktoken": ByteVocabulary}


def kind_of(path: str) -> str:
    return "." + path.rsplit(".", 1)[-1]


class Tokens:
    """The tokens of a growing list of words in one vocabulary."""

    def __init__(self, path: str):
        self.vocabulary = KINDS[kind_of(path)](path)
        self.clear()

    def clear(self) -> None:
        self.flat = np.empty(0, dtype=np.int32)
        self.lengths = np.empty(0, dtype=np.int64)
        self.starts = np.empty(0, dtype=np.int64)

    def learn(self, words: list[str]) -> None:
        new = self.vocabulary.encode(words)
        lengths = np.fromiter(map(len, new), dtype=np.int64, count=len(new))
        flat = np.fromiter(chain.from_iterable(new), dtype=np.int32, count=int(lengths.sum()))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
        self.flat = np.concatenate([self.flat, flat])
        self.lengths = np.concatenate([self.lengths, lengths])

    def of(self, words: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
        """(the tokens of all words in order, how many each document has)."""
        lengths = self.lengths[words]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[words] - (ends - lengths), lengths) + np.arange(int(lengths.sum()))
        return self.flat[at], np.bincount(doc, weights=lengths, minlength=docs).astype(np.int64)


class Fertility:
    """Words by number, and their tokens in several vocabularies."""

    def __init__(self, paths: tuple[str, ...], remembered: int = REMEMBERED):
        self.tokens = [Tokens(path) for path in paths]
        self.remembered = remembered
        self.words: dict[str, int] = {}

    def numbers(self, flat: list[str]) -> np.ndarray:
        """The number of each word; new words are encoded."""
        if len(self.words) > self.remembered:
            self.words.clear()
            for tokens in self.tokens:
                tokens.clear()
        new = list(dict.fromkeys(flat).keys() - self.words.keys())
        if new:
            self.words.update(zip(new, range(len(self.words), len(self.words) + len(new))))
            for tokens in self.tokens:
                tokens.learn(new)
        return np.fromiter(map(self.words.__getitem__, flat), dtype=np.int64, count=len(flat))


def fertility(paths: tuple[str, ...]) -> Fertility:
    return common.resident(("fertility", paths), lambda: Fertility(paths))


def _inside(points: np.ndarray, ranges: tuple[tuple[int, int], ...]) -> np.ndarray:
    return np.any([(points >= a) & (points <= b) for a, b in ranges], axis=0)


def script_of(text: str) -> str:
    """The script of most of a text's letters."""
    if text.isascii():
        return "latin"
    points, counts = np.unique(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4"), return_counts=True)
    best, most = "latin", 0
    listed = points < 0x80
    for name, ranges in SCRIPTS.items():
        inside = _inside(points, ranges)
        listed |= inside
        n = int(counts[inside].sum())
        if n > most:
            best, most = name, n
    if counts[~listed].sum() > most:
        letters = [chr(p).isalpha() for p in points[~listed].tolist()]
        if counts[~listed][letters].sum() > most:
            return "other"
    if best == "latin" and counts[_inside(points, EXTENDED)].sum() > MARKED * most:
        return "latin_extended"
    return best


def _segments(lengths: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(lengths)), lengths)


def repeated_words(words: np.ndarray, doc: np.ndarray, docs: int, window: int = WINDOW) -> np.ndarray:
    """Per text, the words inside windows found twice or more in that text; words by number, and each one's text."""
    total = len(words)
    out = np.zeros(docs, dtype=np.int64)
    if total < window:
        return out
    hashed = common.mixed(words.astype(np.uint64), 3)
    with np.errstate(over="ignore"):
        rolled = np.zeros(total - window + 1, dtype=np.uint64)
        for j in range(window):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashed[j : j + len(rolled)]
        inside = doc[: len(rolled)] == doc[window - 1 :]
        rolled = common.mixed(rolled) + doc[: len(rolled)].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    starts = np.flatnonzero(inside)
    if not len(starts):
        return out
    keys = rolled[starts]
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    begins = starts[order[twice]]
    covered = np.zeros(total, dtype=bool)
    for j in range(window):
        covered[begins + j] = True
    return np.bincount(doc[covered], minlength=docs).astype(np.int64)


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def entropy_shares(tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Entropy of each text's tokens over the most that so many could have; 1 for a text of at most one token.

    The most is log2 of the number of tokens, or of 1,000 for longer texts:
    a language's entropy stops growing, and long prose must not look poor.
    No share is above 1, however long and varied a text is.
    """
    out = np.ones(len(lengths))
    if not len(tokens):
        return out
    keys = np.sort(_segments(lengths) * np.int64(1 << 20) + tokens)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    counts = np.diff(np.concatenate([first, [len(keys)]]))
    summed = np.bincount(keys[first] >> 20, weights=counts * np.log2(counts), minlength=len(lengths))
    some = lengths > 1
    n = lengths[some].astype(float)
    out[some] = np.minimum((np.log2(n) - summed[some] / n) / np.log2(np.minimum(n, 1000)), 1.0)
    return out


def within(value: float, band: tuple[float, float]) -> bool:
    return band[0] <= value <= band[1]


def groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """(first, one past the last) of groups of about GROUP_CHARS characters."""
    at = 0
    while at < len(texts):
        end, chars = at, 0
        while end < len(texts) and (end == at or chars < GROUP_CHARS):
            chars += len(texts[end] or "")
            end += 1
        yield at, end
        at = end


def measure(doc_ids: list[int | None], texts: list[str | None], paths: tuple[str, ...], bands: dict[str, dict[str, Band]]) -> list[tuple]:
    """The rows of schema(len(paths)) for a group of texts."""
    known = fertility(paths)
    texts = [text or "" for text in texts]
    words = [common.WORD.findall(text) for text in texts]
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    numbers, doc = known.numbers(list(chain.from_iterable(words))), _segments(lengths)
    repeats = repeated_words(numbers, doc, len(texts)).tolist()
    chars = [sum(map(len, own)) for own in words]
    scripts = list(map(script_of, texts))
    fits = [True] * len(texts)
    columns: list[list] = []
    for path, tokens in zip(paths, known.tokens):
        ids, counts = tokens.of(numbers, doc, len(texts))
        some = np.maximum(counts, 1)
        spelt = np.bincount(_segments(counts)[tokens.vocabulary.fallback[ids]], minlength=len(texts))
        measured = [(np.array(chars) / some).tolist(), (spelt / some).tolist(), entropy_shares(ids, counts).tolist()]
        own = bands[kind_of(path)]
        for k, (script, per_token, fallback, entropy) in enumerate(zip(scripts, *measured)):
            band = own[script]
            fits[k] &= within(per_token, band.chars_per_token) and within(fallback, band.fallback_share) and within(entropy, band.entropy_share)
        columns += measured
    rows = []
    for k, (doc_id, text, n_words, *measures) in enumerate(zip(doc_ids, texts, lengths.tolist(), *columns)):
        failed = n_words < 20 or 100 * repeats[k] > 30 * n_words
        symbols = sum(map(text.count, SYMBOLS))
        rows.append((doc_id, n_words, chars[k], symbols, duplicate_lines(text), repeats[k], failed, fits[k] and not failed, scripts[k], *measures))
    return rows


def score(documents: DataFrame, paths: tuple[str, ...], bands: dict[str, dict[str, Band]] | None = None) -> DataFrame:
    """Base counts, fertility and verdict of every document.

    `paths` are vocabulary files, SentencePiece models or byte-level ranks;
    `bands` has each kind's bands by script.  `documents` needs doc_id and
    text; other columns are not read.  A null text is one without words and
    fails; a null doc_id is kept; repeated rows are measured one by one and
    get equal rows; a text of any length is measured whole, and its words and
    tokens are what it needs of memory; a measure on a band's edge is inside.
    No rows give none.
    """
    bands = bands or BANDS
    kinds = [pa.int64()] * 6 + [pa.bool_()] * 2 + [pa.string()] + [pa.float64()] * 3 * len(paths)
    names = [column.split()[0] for column in schema(len(paths)).split(", ")]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows = [row for a, b in groups(texts) for row in measure(ids[a:b], texts[a:b], paths, bands)]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return common.map_batches(documents.select("doc_id", "text"), run, schema(len(paths)))


def keep_good(documents: DataFrame, paths: tuple[str, ...], bands: dict[str, dict[str, Band]] | None = None) -> DataFrame:
    """The documents that the rules keep, with all their columns as they are.

    Decided row by row beside the text, so nothing is joined or shuffled: a
    null or empty text goes, repeated rows stay or go alike, a null doc_id
    doesn't matter, other columns of any name are passed on, and no rows give
    none.
    """
    bands = bands or BANDS
    at = documents.columns.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        keep = [row[7] for a, b in groups(texts) for row in measure([None] * (b - a), texts[a:b], paths, bands)]
        return batch.filter(pa.array(keep, pa.bool_()))

    return common.map_batches(documents, run, documents.schema)

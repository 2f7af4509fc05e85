"""Exact token ids of whole texts by the tokenizers library, memoised per word.

A byte-level BPE splits a text before every white-space run that follows a
non-space character, and nothing crosses that split.  So a text whose spaces
are single ones is the concatenation of its first word and its later words
with one space in front of each, and each of these can be encoded once by the
library and remembered.  Other texts go to the library whole.
"""

from __future__ import annotations

import numpy as np

from . import common

#: Unicode White_Space, which is what the library's pattern means by ``\s``.
WHITE = frozenset(
    [chr(c) for c in (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680)]
    + [chr(c) for c in range(0x2000, 0x200B)]
    + [chr(c) for c in (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
)
#: A text is handled in groups of about this many characters.
GROUP_CHARS = 2_000_000

def encoder(path: str, remembered: int = 500_000) -> "WordEncoder":
    """The encoder of a vocabulary file, one per worker process."""
    return common.resident(("words", path, remembered), lambda: WordEncoder(path, remembered))


class WordEncoder:
    """Ids as little-endian bytes: 2 a token if the vocabulary allows, else 4."""

    def __init__(self, path: str, remembered: int = 500_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 65536 else "<u4")
        #: Tokens that begin with a space; no others begin a remembered word.
        self.opens = np.zeros(size, dtype=bool)
        for token, i in self.library.get_vocab().items():
            self.opens[i] = token.startswith("Ġ")
        self.remembered = remembered
        self.words: dict[str, bytes | None] = {}
        self.heads: dict[str, bytes | None] = {}

    def whole(self, text: str) -> bytes:
        """A text's ids straight from the library."""
        ids = self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(ids, dtype=self.dtype).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of words that follow a single space."""
        good = []
        for word in words:
            if not word or word[0] in WHITE or word[-1] in WHITE or "<|" in word:
                self.words[word] = None
            else:
                good.append(word)
        for at in range(0, len(good), 512):
            part = good[at : at + 512]
            text = " " + " ".join(part)
            ids = np.array(self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)
            begins = np.flatnonzero(self.opens[ids])
            if len(begins) != len(part):
                for word in part:
                    self.words[word] = self.whole(" " + word)
                continue
            raw, width = ids.tobytes(), self.dtype.itemsize
            cuts = (begins * width).tolist() + [len(raw)]
            self.words.update(zip(part, [raw[a:b] for a, b in zip(cuts, cuts[1:])]))

    def _head(self, word: str) -> bytes | None:
        if word not in self.heads:
            if len(self.heads) > self.remembered // 10:
                self.heads.clear()
            bad = not word or word[0] in WHITE or word[-1] in WHITE or "<|" in word
            self.heads[word] = None if bad else self.whole(word)
        return self.heads[word]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text; none for a null or empty text."""
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            end, chars = at, 0
            while end < len(texts) and (end == at or chars < GROUP_CHARS):
                chars += len(texts[end] or "")
                end += 1
            out += self._group(texts[at:end])
            at = end
        return out

    def _group(self, texts: list[str | None]) -> list[bytes]:
        if len(self.words) > self.remembered:
            self.words.clear()
        cut = [text.split(" ") if text else [] for text in texts]
        heads = [self._head(words[0]) if words else b"" for words in cut]
        seen: set[str] = set()
        for words in cut:
            seen.update(words[1:])
        self._learn(list(seen.difference(self.words)))
        get, out = self.words.__getitem__, []
        for text, words, head in zip(texts, cut, heads):
            try:
                out.append(head + b"".join(map(get, words[1:])))
            except TypeError:
                out.append(self.whole(text))
        return out

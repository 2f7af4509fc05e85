"""Merge-dropout draws anew for every occurrence of a word."""

from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import pieces
from tidemark.llm.queries import vocabulary

PIECE = vocabulary("piece_bpe_32k.model")


def test_a_frequent_word_has_many_segmentations():
    coder = pieces.Encoder(PIECE, 7, 0.1)
    library = coder.vocabulary
    found = Counter(tuple(coder.encode([doc], ["x internationalisation"])[0].tolist()) for doc in range(3000))
    assert len(found) > 20
    assert all(coder.decode(np.array(ids)) == "x internationalisation" for ids in found)
    assert len({tuple(x.tolist()) for x in coder.encode([1] * 2, ["of of of of of of of of of of of of of of"] * 2)}) == 1
    two = [coder.encode([doc], ["of"])[0].tolist() != [library.ids["▁of"]] for doc in range(5000)]
    assert 0.1 < np.mean(two) < 0.25  # a word of two merges changes when either is skipped


def test_remembered_segmentations_are_those_of_each_occurrence(monkeypatch):
    texts = ["the international nations of the world and the national word " * 30] * 5
    known = pieces.Encoder(PIECE, 3, 0.2).encode(list(range(5)), texts)
    monkeypatch.setattr(pieces, "OFTEN", 10**9)  # no word is remembered
    fresh = pieces.Encoder(PIECE, 3, 0.2).encode(list(range(5)), texts)
    assert all(a.tolist() == b.tolist() for a, b in zip(known, fresh))


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \n\x00\x01\ue000▁\ud800é\u2028"), max_size=30) | st.text(max_size=40), st.integers(0, 5))
def test_every_character_survives(text, doc):
    coder = pieces.encoder(PIECE, 7, 0.3)
    assert coder.decode(coder.encode([doc], [text])[0]) == text

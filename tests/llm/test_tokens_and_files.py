"""Token files, packing and pieces against the libraries themselves."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import common, packing, pieces, token_files
from tidemark.llm.queries import vocabulary
from tidemark.llm.tokens import WordEncoder

BPE, PIECE = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary(BPE))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def coder():
    return WordEncoder(vocabulary(BPE))


TEXTS = st.text(alphabet=st.sampled_from("ab' .,!?1\n\t\r\x0b\x85  　éß日▁|<>\U0001f600s"), max_size=60)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_words_give_the_librarys_ids(coder, library, text):
    assert np.frombuffer(coder.encode([text])[0], coder.dtype).tolist() == library(text)


def brute_files(rows, library):
    out, start = [], 0
    key = lambda r: (r[0] is not None, r[0] or 0, np.array(library(r[1]) + [0], dtype="<u2").tobytes())
    for doc, text in sorted(rows, key=key):
        ids = np.array(library(text) + [0], dtype="<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files_hold_every_document(spark, documents, library):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = [tuple(r) for r in token_files.round_trip(spark, documents.repartition(5), vocabulary(BPE)).collect()]
    assert sorted(got) == sorted(brute_files(rows, library))


def test_files_of_odd_rows(spark, odd, empty, library):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    got = [tuple(r) for r in token_files.round_trip(spark, odd, vocabulary(BPE)).collect()]
    assert sorted(got, key=repr) == sorted(brute_files(rows, library), key=repr)
    assert token_files.round_trip(spark, empty, vocabulary(BPE)).count() == 0


def test_keyed_access(spark, odd, library):
    made = token_files.write(odd, common.work_dir(spark, "keyed"), vocabulary(BPE), shards=3)
    assert token_files.fetch(made, 8).tolist() == library("ONE TWO THREE FOUR FIVE SIX SEVEN EIGHT NINE TEN") + [0]
    assert token_files.fetch(made, 5, 1).tolist() == token_files.fetch(made, 5, 0).tolist()
    keys = spark.createDataFrame([(8, 0), (3, 0), (77, 0)], "doc_id long, copy long")
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_files.read(made, keys).collect()}
    assert got == {8: token_files.fetch(made, 8).tolist(), 3: [0]}
    assert token_files.fetch(made, 5, 2) is None and token_files.fetch(made, 12345) is None


@settings(max_examples=50, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_perfect_hash_is_minimal_and_perfect(keys):
    keys = np.array(sorted(keys), dtype=np.uint64)
    built = token_files.PerfectHash.build(keys)
    again, _ = token_files.PerfectHash.load(memoryview(built.dump()))
    assert sorted(again.slots(keys).tolist()) == list(range(len(keys)))


def check_packed(rows, texts, library, size=1024):
    ids = defaultdict(list)
    for doc, text in texts:
        ids[doc].append(library(text) + [2])
    places = defaultdict(list)
    for doc, piece, start, length, crc, sequence, offset in rows:
        assert 1 <= length <= size
        assert any(zlib.crc32(np.array(x[start : start + length], dtype="<u4").tobytes()) == crc for x in ids[doc])
        if piece or length == size:
            assert piece == 0 or length == size
        places[sequence].append((offset, length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    assert sum(r[3] for r in rows) == sum(len(x) for many in ids.values() for x in many)
    return len(places)


def test_packing_uses_few_sequences(spark, documents, library):
    texts = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    rows = [tuple(r) for r in packing.pack(documents, vocabulary(BPE)).collect()]
    used = check_packed(rows, texts, library)
    total = sum(r[3] for r in rows)
    assert used <= -(-total // 1024) * 1.03 + 1


def test_packing_odd_rows(spark, odd, empty, library):
    texts = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    check_packed([tuple(r) for r in packing.pack(odd, vocabulary(BPE)).collect()], texts, library)
    assert packing.pack(empty, vocabulary(BPE)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 400), max_size=30))
def test_plans_use_every_piece_once(histogram):
    used = Counter()
    for pattern, times in packing.plan(histogram, 64):
        assert sum(pattern) <= 64 and times > 0
        for length in pattern:
            used[length] += times
    assert used == Counter(histogram)


def test_least_squares_finds_exact_repeats():
    rows = np.array([[40, 24, 0], [32, 32, 0], [64, 0, 0]])
    target = np.zeros(65)
    target[[40, 24, 32, 64]] = [500, 500, 600, 70]
    assert np.allclose(packing.least_squares(rows, target, 2000), [500, 300, 70], atol=1)


def test_pieces_without_dropout_are_the_librarys():
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary(PIECE))
    coder = pieces.Encoder(vocabulary(PIECE))
    for text in ("", " ", "  two  spaces ", "lines\n\nand\ttabs", "日本語 and é", "a" * 200, "\U0001f600"):
        assert coder.encode([1], [text])[0].tolist() == library.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80), st.integers(0, 5))
def test_pieces_with_dropout_decode(text, doc):
    coder = pieces.encoder(vocabulary(PIECE), 7, 0.3)
    assert coder.decode(coder.encode([doc], [text])[0]) == text


def test_dropout_is_seeded_and_varied(documents):
    texts = [r["text"] for r in documents.orderBy("doc_id").limit(20).collect()]
    a, b, c = (pieces.Encoder(vocabulary(PIECE), seed, 0.2) for seed in (1, 1, 2))
    one, two, three = (e.encode(list(range(20)), texts) for e in (a, b, c))
    assert all((x == y).all() for x, y in zip(one, two))
    assert any(len(x) != len(y) or (x != y).any() for x, y in zip(one, three))


def test_arrays_and_heap_agree(monkeypatch, documents):
    texts = [r["text"] for r in documents.orderBy("doc_id").limit(10).collect()]
    fast = pieces.Encoder(vocabulary(PIECE), 3, 0.2).encode(list(range(10)), texts)
    monkeypatch.setattr(pieces, "SHORT", 0)
    slow = pieces.Encoder(vocabulary(PIECE), 3, 0.2).encode(list(range(10)), texts)
    assert all(x.tolist() == y.tolist() for x, y in zip(fast, slow))


def test_pieces_of_odd_rows(odd, empty):
    path = vocabulary(PIECE)
    texts = sorted((r["text"] or "" for r in odd.collect()))
    assert sorted(r["text"] for r in pieces.decode(pieces.encode(odd, path), path).collect()) == texts
    assert all(r["lossless"] for r in pieces.round_trip(odd, vocabulary(PIECE)).collect())
    assert pieces.round_trip(empty, vocabulary(PIECE)).count() == 0

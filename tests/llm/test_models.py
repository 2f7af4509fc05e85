"""Quality, toxicity, rules and the language model."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import common, fit, katz, line_crf, rules, toxicity
from tidemark.llm.queries import fertility_vocabularies, vocabulary

SF = "/root/testdata/sf0.01"


def accuracy(scored, labels, column):
    known = {r["doc_id"]: r[column] for r in labels.collect()}
    rows = [(r["predicted"], known[r["doc_id"]]) for r in scored.collect() if r["held_out"] and r["doc_id"] in known]
    return sum(p == y for p, y in rows) / len(rows), max(Counter(y for _, y in rows).values()) / len(rows)


@pytest.fixture(scope="module")
def tables(spark):
    return common.table(spark, SF, "documents"), common.table(spark, SF, "labels")


def test_lines_tell_quality(tables):
    documents, labels = tables
    model = line_crf.train(documents, labels)
    found, majority = accuracy(line_crf.score(documents, model), labels, "quality")
    assert found >= 0.97 > majority


def test_n_grams_tell_toxicity(tables):
    documents, labels = tables
    model = toxicity.train(documents, labels)
    found, majority = accuracy(toxicity.score(documents, model), labels, "toxic")
    assert found > majority


def test_held_out_rows_are_never_learned(tables):
    documents, labels = tables
    sample, _ = fit.labelled_sample(documents, labels, "toxic", 5, 0, 10_000)
    out = {r["doc_id"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    only_out = {texts[d] for d in out if d in texts} - {texts[d] for d in texts if d not in out}
    assert not only_out & {text for text, _ in sample}


@pytest.mark.parametrize("module", [line_crf, toxicity])
def test_scores_of_odd_rows(module, odd, empty):
    sample = [("good words in a row and more of them", 1), ("BAD!! BAD!! BAD!!", 0)] * 6
    for model in (module.fit_model(sample, 0.5), module.fit_model([], 0.2)):
        rows = module.score(odd, model).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)
        assert module.score(empty, model).count() == 0
        same = [r["score"] for r in rows if r["doc_id"] == 5]
        assert same[0] == same[1]


def test_marginals_by_enumeration():
    """Forward-backward against the sum over all labelings."""
    rng = np.random.default_rng(0)
    counts = np.array([3, 1, 4, 2])
    emission, transition = rng.normal(size=10), rng.normal(size=(2, 2))
    marginal, expected, _, total = line_crf.Chains(counts).passes(emission, transition)
    at, logs, moves = 0, 0.0, np.zeros((2, 2))
    for n in counts:
        weights, ones = [], np.zeros(n)
        step = np.zeros((2, 2))
        for code in range(2**n):
            y = [code >> k & 1 for k in range(n)]
            w = math.exp(sum(emission[at + k] * y[k] for k in range(n)) + sum(transition[a, b] for a, b in zip(y, y[1:])))
            weights.append(w)
            ones += w * np.array(y)
            for a, b in zip(y, y[1:]):
                step[a, b] += w
        assert np.allclose(marginal[at : at + n], ones / sum(weights))
        moves += step / sum(weights)
        logs += math.log(sum(weights))
        at += n
    assert np.allclose(expected, moves) and abs(total - logs) < 1e-9


def brute_rules(text):
    words = common.WORD.findall(text or "")
    windows = defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k : k + 8])].append(k)
    covered = {k + j for ks in windows.values() if len(ks) > 1 for k in ks for j in range(8)}
    lines = [line for line in (text or "").split("\n") if common.WORD.search(line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def test_base_rules(spark, documents, odd, empty):
    for frame in (documents, odd):
        texts = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
        got = [tuple(r)[:7] for r in rules.score(frame, fertility_vocabularies()).collect()]
        assert sorted(got, key=repr) == sorted([(d, *brute_rules(t)) for d, t in texts], key=repr)
    assert rules.score(empty, fertility_vocabularies()).count() == 0


def test_rules_keep_clean_and_reject_bad_text(spark, tables):
    documents, labels = tables
    scored = rules.score(documents, fertility_vocabularies()).join(labels, "doc_id").collect()
    clean = [r for r in scored if r["quality"] == 1 and not r["base_failed"]]
    assert all(r["kept"] for r in clean)
    coded = "".join(chr(0x2500 + k * 7 % 300) for k in range(400))
    frame = spark.createDataFrame([(1, " ".join(coded[k : k + 16] for k in range(0, 400, 16)))], "doc_id long, text string")
    row = rules.score(frame, fertility_vocabularies()).first()
    assert not row["base_failed"] and not row["kept"] and row["fallback_share"] > 0.2


def brute_katz(rows, order, folds):
    """The model by its definition, over dictionaries."""
    words = [(d, common.lower_words(t) + [b""]) for d, t in rows]
    grams = [Counter() for _ in range(order + 1)]
    for d, w in words:
        if not katz.held_out(d, folds):
            padded = [b"\n"] * (order - 1) + w
            for k in range(1, order + 1):
                grams[k].update(tuple(padded[j - k + 1 : j + 1]) for j in range(order - 1, len(padded)))
    d = [None] + [katz.discounts(np.bincount(np.minimum(list(grams[k].values()) or [0], 7), minlength=8)[:7]) for k in range(1, order + 1)]
    off = lambda k, c: d[k][min(c, 6)] * c
    total = sum(grams[1].values())
    kept = sum(off(1, c) for c in grams[1].values())
    z1 = max(total, kept + 0.5) if total else 1
    contexts = [{} for _ in range(order + 1)]

    def p(g):
        if len(g) == 1:
            return off(1, grams[1][g]) / z1 if grams[1][g] else (1 - kept / z1 if total else 1.0)
        if g[:-1] not in contexts[len(g)]:
            return p(g[1:])
        z, alpha = contexts[len(g)][g[:-1]]
        c = grams[len(g)][g]
        return off(len(g), c) / z if c else alpha * p(g[1:])

    for k in range(2, order + 1):
        sums = defaultdict(lambda: [0, 0.0, 0.0])
        for g, c in grams[k].items():
            s = sums[g[:-1]]
            s[0], s[1], s[2] = s[0] + c, s[1] + off(k, c), s[2] + p(g[1:])
        for h, (c, s, low) in sums.items():
            contexts[k][h] = (max(c, s + 0.5), (1 - s / max(c, s + 0.5)) / (1 - low))
    out = []
    for doc, w in words:
        padded = [b"\n"] * (order - 1) + w
        own = sum(math.log10(p(tuple(padded[j - order + 1 : j + 1]))) for j in range(order - 1, len(padded)))
        known = sum(1 for x in w if grams[1][(x,)])
        base = sum(math.log10((grams[1][(x,)] + 0.1) / (total + 0.1 * (len(grams[1]) + 1))) for x in w)
        out.append((doc, katz.held_out(doc, folds), len(w), known, total, round(base, 6), round(own, 6)))
    return out, p, grams, contexts


@pytest.mark.parametrize("order", [1, 2, 3])
def test_katz_by_definition(documents, odd, order):
    for frame in (documents, odd):
        rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
        expected, p, grams, contexts = brute_katz(rows, order, 10)
        got = [(*r[:5], round(r[5], 6), round(r[6], 6)) for r in katz.score(frame.repartition(3), order=order).collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)
        for k in range(2, order + 1):
            for h in list(contexts[k])[:3]:
                assert abs(sum(p((*h, *w)) for w in grams[1]) + p((*h, b"\0never")) - 1) < 1e-9


def test_katz_without_rows_or_training(spark, empty):
    assert katz.score(empty).count() == 0
    held = next(k for k in range(100) if katz.held_out(k, 10))
    row = katz.score(spark.createDataFrame([(held, "some words")], "doc_id long, text string")).first()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and row["score"] == 0.0


def test_katz_beats_the_base(tables):
    rows = [r for r in katz.score(tables[0]).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.8 * sum(r["base_score"] for r in rows)


def brute_score(model, text):
    """The logistic of the weights of a text's distinct n-grams, each looked up by itself."""
    spaced = "".join(c if ord(c) > 32 else " " for c in f" {text.lower()} ")
    weights = dict(zip(model.codes.tolist(), model.weights.tolist()))
    found = {int(toxicity.codes(np.array([ord(c) for c in spaced[k : k + n]], dtype="<u4"), n)[0]) for n in toxicity.ORDERS for k in range(len(spaced) - n + 1)}
    return 1 / (1 + math.exp(-sum(weights.get(c, 0.0) for c in found) - model.bias))


def test_toxicity_by_definition(tables):
    documents, labels = tables
    model = toxicity.train(documents, labels)
    texts = [r["text"] or "" for r in documents.orderBy("doc_id").limit(25).collect()] + ["", "x", "ABC abc\u2028é"]
    assert np.allclose(toxicity.Scorer(model)(texts), [brute_score(model, t) for t in texts])


def test_labelled_sample_is_bounded(spark):
    rows = [(1, "a" * 50, 0)] * 400 + [(1, "b", 1), (2, None, 0), (3, "c" * 80, 1), (4, "d" * 10, 1)]
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 0), (3, 1), (4, 1), (9, 1), (None, 1)], "doc_id long, toxic int")
    sample, share = fit.labelled_sample(documents, labels, "toxic", 1000, 1, 10)
    assert sorted(sample) == sorted([("a" * 50, 0), ("", 0), ("c" * 80, 1), ("d" * 10, 1)]) and share == 3 / 5
    small, _ = fit.labelled_sample(documents, labels, "toxic", 1000, 1, 10, most_chars=70)
    assert sum(len(t) for t, _ in small) <= 70 and ("", 0) in small
    assert len(fit.labelled_sample(documents, labels, "toxic", 1000, 1, 1)[0]) <= 2


@pytest.mark.parametrize("order", [1, 2, 3])
def test_stored_tables_score_other_texts(spark, documents, odd, order):
    folder = common.work_dir(spark, "stored")
    trained = {(r["doc_id"]): (r["n_tokens"], r["n_known"], round(r["score"], 9)) for r in katz.train(documents.repartition(3), folder, order=order, folds=10).collect()}
    again = {(r["doc_id"]): (r["n_tokens"], r["n_known"], round(r["score"], 9)) for r in katz.score_stored(documents.repartition(2), folder).collect()}
    assert again == trained
    scored = katz.score_stored(odd, folder).collect()
    assert len(scored) == odd.count() and all(r["held_out"] and r["score"] <= 0 for r in scored)
    assert katz.score_stored(odd.limit(0), folder).count() == 0

"""Near copies, nearest vectors and pages against brute force."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import common, components, jaccard, kdtree, pages


def brute_join(rows, size=5, percent=75):
    sets = []
    for _, text in rows:
        w = common.lower_words(text)
        sets.append({tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set()))
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    forest = components.Forest()
    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g] if j < i).items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                forest.join(i, j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        root = forest.find(i)
        known = [x for x in (least.get(root), doc) if x is not None]
        least[root] = min(known) if known else None
    return [(doc, len(s), least[forest.find(i)]) for i, ((doc, _), s) in enumerate(zip(rows, sets))]


def near_copies(seed, groups=6, each=25, words=80):
    """Groups of near copies on both sides of the limit, a passage that all share, and single texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, number = [], 0
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(20, words))]
        for _ in range(each):
            text = list(base)
            for _ in range(rng.randrange(0, 5)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((number, " ".join(text[: len(text) - rng.randrange(0, 8)])))
            number += 1
    for _ in range(60):
        own = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 120))]
        rows.append((number, " ".join(own + passage)))
        number += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk", [500_000, 700])
def test_join_equals_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    rows = near_copies(chunk)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, jaccard.join(frame).collect())) == sorted(brute_join(rows))


def test_join_of_small_batches(spark, documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BATCH_TOKENS", 5_000)
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, jaccard.join(documents).collect())) == sorted(brute_join(rows))


def test_join_of_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert sorted(map(tuple, jaccard.join(odd).collect()), key=repr) == sorted(brute_join(rows), key=repr)
    assert jaccard.join(empty).count() == 0


def test_one_of_each_group_stays(odd, documents):
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=repr)
    assert ids == sorted([1, 2, 3, 4, 6, 7, 9, 10, None, None], key=repr)  # 5, 5 and 8 go
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert sorted(r["doc_id"] for r in jaccard.keep_one(documents).collect()) == sorted(d for d, n, c in brute_join(rows) if d == c or not n)


def test_tree_bounds_never_lose_a_link():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 90, rng.integers(5, 60)).astype(np.uint64)) for _ in range(70)]
    forest, expected = components.Forest(), components.Forest()
    jaccard.SignatureTree(list(range(70)), sets, 75).links(forest)
    for i, j in itertools.combinations(range(70), 2):
        same = len(set(sets[i].tolist()) & set(sets[j].tolist()))
        if 100 * same >= 75 * (len(sets[i]) + len(sets[j]) - same):
            expected.join(i, j)
    assert [forest.find(k) for k in range(70)] == [expected.find(k) for k in range(70)]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(0, 300)] + [(1000, k) for k in range(1001, 1200)]
    links += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(200)]
    forest = components.Forest()
    for a, b in links:
        forest.join(a, b)
    frame = spark.createDataFrame(links, components.LINKS).repartition(7)
    got = {r["node"]: r["root"] for r in components.components(frame).collect()}
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert got == {x: forest.find(x) for x in linked}
    assert components.components(spark.createDataFrame([], components.LINKS)).count() == 0


def brute_top(rows, k, every, scale):
    good = [(i, np.floor(np.array(v, dtype=float) * scale).astype(int)) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for a, (query, q) in enumerate(good):
        if query % every == 0:
            scored = sorted(((-int(q @ v), i) for b, (i, v) in enumerate(good) if b != a and len(v) == len(q)))[:k]
            out += [(query, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return out


@pytest.mark.parametrize("shard,visited", [(8192, 32), (60, 2)])
def test_top_k_equals_brute_force(spark, data, monkeypatch, shard, visited):
    monkeypatch.setattr(kdtree, "SHARD", shard)
    monkeypatch.setattr(kdtree, "VISITED", visited)
    frame = spark.read.parquet(f"{data}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    assert sorted(map(tuple, kdtree.top_k(frame).collect())) == sorted(brute_top(rows, 20, 20, 64))


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (20, [1.0, 2.0]), (40, None), (60, [nan, 1.0]), (80, [1.0, inf]), (100, [1.0, None]), (None, [1.0, 1.0]), (7, [0.5, -0.25]), (9, [1.0, 2.0, 3.0]), (120, [])]
    rows += [(k, [1.0, 2.0]) for k in range(200, 260)] + [(20, [3.0, 3.0])]
    frame = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, label int, score double")
    assert sorted(map(tuple, kdtree.top_k(frame).collect())) == sorted(brute_top(rows, 20, 20, 64))
    assert kdtree.top_k(frame.limit(0)).count() == 0


def test_top_k_of_huge_and_equal_vectors(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "SHARD", 40)
    rng = random.Random(3)
    rows = [(k, [rng.choice((1e30, -1e17, 3.0, 0.0, 2.5e9)) for _ in range(3)]) for k in range(60)]
    rows += [(k, [1.0, 0.5, -0.25]) for k in range(60, 400)] + [(k, [rng.uniform(-1, 1) for _ in range(3)]) for k in range(400, 700)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    exact = [(i, [int(np.floor(x * 64)) for x in v]) for i, v in rows]
    expected = []
    for i, q in exact:
        if i % 20 == 0:
            scored = sorted((-min(max(sum(a * b for a, b in zip(q, v)), -(2**63)), 2**63 - 1), j) for j, v in exact if j != i)[:20]
            expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scored)]
    assert sorted(map(tuple, kdtree.top_k(frame).collect())) == sorted(expected)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><header><p>The site's own header, which is long enough to look like prose, but isn't.</p></header>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div id="cookie-notice"><p>We use cookies and say so at some length here.</p></div>
<div class="wrap-{n}"><div class="post-{n} content"><h1>Head &amp; line {n}</h1><p>First paragraph of page {n} with
 white   space&nbsp;in it, and enough words to count.</p><div class="ad">Buy now, buy now, buy now.</div>
<p>Second <b>bold</b> one<br>after a break &lt;tag&gt;, with words that go on for a while.</p><form><p>Your mail</p><input></form>
<script>var a = "<p>no</p>";</script><ul><li>an item</li><li>another</li></ul></div>
<aside><p>Sidebar text that is also quite long and has many words in it to tempt a scorer.</p></aside>
<section class="comments"><p>Reader comment, long-winded and with no end to it, as they are, and longer still.</p></section></div><footer>&copy; x</footer></body></html>"""


def test_pages(spark):
    rows = [(k, f"https://www.x.org/{k}", PAGE.format(n=k), 1) for k in range(6)]
    rows += [(6, "https://x.org/none", None, 1), (7, None, "", 1), (8, "::bad::", "plain text &eacute;", 1), (9, "https://x.org/cut", "<div class='post-9 content'><p>Cut off in a tag<di", 1)]
    got = {r["page_id"]: r for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, host int")).collect()}
    for k in range(6):
        assert got[k]["text"] == f"Head & line {k}\n\nFirst paragraph of page {k} with white space in it, and enough words to count.\n\nSecond bold one after a break <tag>, with words that go on for a while.\n\nan item\n\nanother"
    assert got[6]["text"] == got[7]["text"] == ""
    assert got[8]["text"] == "plain text é" and got[9]["text"] == "Cut off in a tag"
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_layout_words_around_an_article():
    long = "words of an article that go on for a good while, and then some more of them"
    comments = "<section class='comments'><article><p>" + "a long reader comment " * 40 + "</p></article></section>"
    for page in (
        f'<div class="layout with-sidebar"><article><h1>T</h1><p>{long}</p></article><div class="sidebar"><p>side</p></div></div>',
        f'<article class="post comments-open"><h1>T</h1><p>{long}</p>{comments}</article>',
        f'<div class="post no-comments"><h1>T</h1><p>{long}</p></div>',
        f'<article><header class="entry-header"><h1>T</h1></header><p>{long}</p></article>',
        f'<article><div class="entry-header"><h1>T</h1></div><p>{long}</p></article>',
        f'<main><article><h1>T</h1><p>{long}</p></article>{comments}</main>',
        "<div>" * 3000 + f"<article><h1>T</h1><p>{long}</p></article>" + "</div>" * 3000,
        f'<div class="a b c d e1"><article><h1>T</h1><p>{long}</p></article></div>',
    ):
        assert pages.extract(page, None) == f"T\n\n{long}", page[:120]


def test_extraction_follows_the_hosts_votes(spark, monkeypatch):
    """Against the definition: per host the path with most votes, extracted by it where the page has it."""
    monkeypatch.setattr(pages, "FILE_HOSTS", 2)
    body = lambda kind, n: f'<html><body><div class="{kind}"><p>{"words of this one " * n}</p></div><div class="other"><p>{"another part here " * 9}</p></div></body></html>'
    rows = [(k, f"http://h{k % 7}.net/{k}", body("content" if k % 3 else "thing", 4 + k % 11)) for k in range(120)]
    votes = defaultdict(Counter)
    for _, url, source in rows:
        votes[pages.host_of(url)][pages.vote(source)[0]] += 1
    got = {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()}
    for k, url, source in rows:
        ranked = votes[pages.host_of(url)].most_common(2)
        if len(ranked) == 1 or ranked[0][1] > ranked[1][1]:
            assert got[k] == pages.extract(source, ranked[0][0])


def test_no_pages(spark):
    assert pages.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_hosts_vote(spark):
    rows = [(k, "http://h.net/x", PAGE.format(n=k)) for k in range(4)]
    found = pages.host_paths(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [(r["host"], r["path"]) for r in found] == [("h.net", "/html/body/div.wrap-0/div.content.post-0")]

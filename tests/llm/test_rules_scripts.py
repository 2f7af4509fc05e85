"""Quality rules on prose of many scripts: the translated messages of this machine's programs."""

import gettext
import glob
import math
import os
import re
from collections import Counter

import pytest

from tidemark.llm import rules
from tidemark.llm.queries import fertility_vocabularies

MODEL = fertility_vocabularies()
#: Languages by the script that their texts must be found in.
LANGUAGES = {
    "el": "greek", "ru": "cyrillic", "he": "hebrew", "ar": "arabic", "fa": "arabic", "hi": "indic", "bn": "indic",
    "pa": "indic", "gu": "indic", "ml": "indic", "te": "indic", "kn": "indic", "ta": "indic", "or": "indic", "th": "thai",
    "ko": "hangul", "zh_CN": "han", "ka": "other", "hy": "other", "km": "other", "my": "other", "dz": "other",
    "vi": "latin_extended", "fr": "latin",
}


def prose(language):
    """The words of a language's message catalogues, without commands and placeholders."""
    out = set()
    for path in glob.glob(f"/usr/share/locale*/{language}/LC_MESSAGES/*.mo"):
        if not os.path.basename(path).startswith("iso"):
            with open(path, "rb") as file:
                messages = gettext.GNUTranslations(file)._catalog
            out |= {v for k, v in messages.items() if k and isinstance(v, str) and v != k and len(v) > 15}
    texts = [re.sub(r"%[-#0-9$.*l]*[a-zA-Z]|<[^>]*>|--?[a-zA-Z-]+|[_&]", " ", v) for v in sorted(out, key=lambda v: (len(v) * 7919 % 101, v))]  # like messages apart
    latin = language in ("vi", "fr")
    return [w for t in texts if latin or sum(c > "\x7f" for c in t if c.isalpha()) > 0.8 * sum(map(str.isalpha, t)) for w in t.split()]


@pytest.mark.parametrize("language", LANGUAGES)
def test_prose_of_every_script_is_kept(language):
    words = prose(language)
    if len(words) < 50:
        pytest.skip("no catalogues")
    for n in (50, 500, 5000):
        texts = [" ".join(words[at : at + n]) for at in range(0, len(words) - n + 1, n)][:20]
        rows = [r for r in rules.measure([0] * len(texts), texts, MODEL, rules.BANDS) if not r[6]]
        assert all(r[7] for r in rows), [r[8:] for r in rows if not r[7]][:3]
        assert {r[8] for r in rows} <= {LANGUAGES[language]}


def test_text_in_a_wrong_encoding_is_rejected():
    for language in ("ru", "el", "ar", "hi"):
        texts = [" ".join(prose(language)[:500]).encode().decode("latin-1")]
        if len(texts[0]) < 500:
            pytest.skip("no catalogues")
        assert not any(r[7] for r in rules.measure([0], texts, MODEL, rules.BANDS))


def test_long_varied_texts_are_kept():
    library = rules.PieceVocabulary(MODEL[0]).library
    names = [library.id_to_piece(i).strip("▁") for i in range(1000, library.get_piece_size())]
    names = [w for w in dict.fromkeys(names) if w.isascii() and w.isalpha() and len(w) > 3]
    lengths = (200, 400, 600, 1500, 3000)
    rows = rules.measure([0] * 5, [" ".join(names[:n]) for n in lengths], MODEL, rules.BANDS)
    assert all(r[7] and r[11] <= 1.0 and r[14] <= 1.0 for r in rows), [(r[0], r[11], r[14]) for r in rows]
    assert [sum(map(len, library.encode(names[:n]))) > 1000 for n in (200, 3000)] == [False, True]


def test_words_with_symbols_stuck_to_them_are_rejected():
    """Prose whose words each carry a run of one symbol; the base rules see nothing wrong with it."""
    for language in ("fr", "ru", "el"):
        words = prose(language)[:400]
        if len(words) < 400:
            pytest.skip("no catalogues")
        texts = [" ".join(words), " ".join(w + "#$%&*"[len(w) % 5] * 3 for w in words)]
        plain, marked = rules.measure([0, 1], texts, MODEL, rules.BANDS)
        assert plain[7] and not marked[6]
        assert marked[14] < plain[14] - 0.1  # a poorer choice of tokens


def brute_measures(text, path):
    """Characters per token, fallback share and entropy share by their definitions."""
    words = [w for w in re.split("[ \t-\r]+", text or "") if w]
    vocabulary = rules.KINDS[rules.kind_of(path)](path)
    ids = [i for w in words for i in vocabulary.encode([w])[0]]
    n = len(ids)
    if not n:
        return 0.0, 0.0, 1.0
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(ids).values())
    return sum(map(len, words)) / n, sum(bool(vocabulary.fallback[i]) for i in ids) / n, min(1.0, entropy / math.log2(min(n, 1000))) if n > 1 else 1.0


def test_measures_by_definition(odd, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.orderBy("doc_id").limit(40).collect()] + [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = rules.measure([d for d, _ in rows], [t for _, t in rows], MODEL, rules.BANDS)
    for (_, text), row in zip(rows, got):
        expected = [x for path in MODEL for x in brute_measures(text, path)]
        assert row[9:] == pytest.approx(expected, abs=1e-9)
        bands = [(rules.BANDS[rules.kind_of(p)][row[8]], expected[3 * k : 3 * k + 3]) for k, p in enumerate(MODEL)]
        inside = all(low <= x <= high for b, m in bands for x, (low, high) in zip(m, (b.chars_per_token, b.fallback_share, b.entropy_share)))
        assert row[7] == (inside and not row[6])

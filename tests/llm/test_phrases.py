import re
from collections import Counter

import numpy as np
import pytest

from llm_helpers import make_docs  # noqa: F401
from mentionscope.llm import phrases


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute_counts(rows, depth=3):
    out = {}
    for text, lang in rows:
        c = out.setdefault("und" if lang is None else lang, Counter())
        for ws in pieces(text):
            for k in range(1, depth + 1):
                c.update(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1))
    return out


def brute(rows, depth=3, least=10, covered=50, top=2000):
    out = []
    for lang, f in brute_counts(rows, depth).items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inner = {}
        for p, a in found.items():
            for s in range(2, len(p)):
                for i in range(len(p) - s + 1):
                    inner[p[i:i + s]] = max(inner.get(p[i:i + s], 0), a)
        scored = []
        for p, a in found.items():
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            if 100 * inner.get(p, 0) < covered * a:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def corpus(seed=3, docs=60):
    rng = np.random.default_rng(seed)
    words = np.array(["the", "of", "New", "york", "city", "Ünder", "état", "a", "b", "c", "3.14", "x\x00y", "\xa0z"] + [f"w{i}" for i in range(40)])
    p = np.array([30, 25, 8, 8, 8, 5, 5, 5, 4, 4, 3, 3, 3] + [1] * 40, float)
    rows = []
    for i in range(docs):
        ws = rng.choice(words, int(rng.integers(0, 200)), p=p / p.sum())
        seps = rng.choice([" ", "  ", "\t", ". ", ",", "\n", "!? ", "\r\n", "\x0b"], len(ws), p=[.6, .1, .05, .05, .05, .05, .05, .03, .02])
        text = "".join(w + s for w, s in zip(ws, seps, strict=True)) + " New York City" * 3
        rows.append((i, text, ["en", "fr", None, "und"][i % 4]))
    return rows + [(100, None, "en"), (101, "", "fr"), (102, " .,; \n", "en"), (103, "aa " * 30_000, "en"), (104, "one two " * 40, "es")] + [rows[0]] * 3


@pytest.mark.parametrize("budget,window", [(1 << 19, 4 << 20), (200, 4 << 20), (15, 64)])
def test_equal_to_brute_force(make_docs, spark, monkeypatch, budget, window):
    """One group; words that are too large; pairs too, in windows of a few words."""
    rows = corpus()
    docs = make_docs(rows, extra=["n", "phrase", "score", "part"])
    parts = list(phrases.windows([r[1].encode() for r in rows if r[1]], 3, window))
    assert (len(parts) > 100) == (window == 64)
    got = sorted(tuple(r) for r in phrases.top_collocations(docs, budget=budget).collect())
    assert got == brute([(r[1], r[2]) for r in rows])


def test_windows_own_each_word_once():
    texts = [b"a b c. d e", b"", b"f " * 50, b"g"]
    for limit in (1, 3, 7, 1000):
        got = [(tuple(t[i:i + 3])) for t, owned in phrases.windows(texts, 3, limit) for i in range(owned)]
        data = b"\xff".join(texts).replace(b".", b"\xff").replace(b"\xff", b" \xff ").split() + [b"\xff"] * 2
        assert got == [tuple(data[i:i + 3]) for i in range(len(data) - 2)]


def test_other_lengths_and_empty(make_docs, spark):
    rows = corpus(5, 30)
    docs = make_docs(rows)
    for depth in (2, 4):
        got = sorted(tuple(r) for r in phrases.top_collocations(docs, depth=depth, least=4, budget=300, top=50).collect())
        assert got == brute([(r[1], r[2]) for r in rows], depth, 4, top=50)
    assert phrases.top_collocations(make_docs([])).collect() == []


def test_scores_beyond_64_bits(spark, monkeypatch, make_docs):
    counts = spark.createDataFrame([("en", 1, "p", 3_000_000_007), ("en", 1, "q", 5_000_000_029), ("en", 2, "p q", 2_999_999_999)], "lang string, size int, phrase string, n long")
    totals = spark.createDataFrame([("en", 10_000_000_000)], "lang string, n long")
    monkeypatch.setattr(phrases, "phrase_counts", lambda *a: (counts, totals))
    r = phrases.collocations(None).collect()[0]
    assert r["score"] == 1000000 * 2_999_999_999 ** 2 // (3_000_000_007 * 5_000_000_029)

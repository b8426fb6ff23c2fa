"""Ranked search against scores of every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from linkindex.llm import ranking

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, k):
    held = [(i, Counter(terms(t))) for i, t, *_ in docs if terms(t)]
    n, words = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in set((i, t) for i, t, *_ in items):
        scores = []
        for doc_id, counts in held:
            m = 100 - 75 + (75 * counts.total() * n) // words
            score = sum(q * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * ((1000000000 * counts[t]) // (1000 * counts[t] + 8 * m))
                        for t, q in Counter(terms(text)).items() if counts[t])
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def search(spark, docs, items, k, docs_schema=DOCS, items_schema=ITEMS):
    found = ranking.ranked(spark.createDataFrame(docs, docs_schema), spark.createDataFrame(items, items_schema), k=k)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=repr)


def tables(seed, n, vocabulary, longest):
    draw = random.Random(seed)
    words = [f"w{int(draw.paretovariate(0.7)) % vocabulary}" for _ in range(5000)]
    text = lambda most: " ".join(draw.choice(words) for _ in range(draw.randrange(most)))
    docs = [(i, text(longest)) for i in draw.sample(range(10 * n), n)]
    items = [(i, text(30)) for i in range(20)] + [(30, docs[3][1]), (31, " ".join(docs[5][1].split()[:40]))]
    return docs, items


@pytest.mark.parametrize("seed, n, vocabulary, longest, k", [(1, 300, 40, 60, 10), (2, 900, 400, 200, 5), (3, 40, 10, 9, 10)])
def test_against_every_score(spark, monkeypatch, seed, n, vocabulary, longest, k):
    monkeypatch.setattr(ranking, "BLOCK_DOCS", 100)
    docs, items = tables(seed, n, vocabulary, longest)
    assert search(spark, docs, items, k) == brute(docs, items, k)


def test_windows_and_short_lists(spark):
    """Blocks of many windows, all lists long or all short, a hot term, copies that tie."""
    docs, items = tables(4, 3000, 3000, 40)
    docs = [(i, f"hot {t}") for i, t in docs] + [(100_000 + i, docs[0][1]) for i in range(500)]
    items += [(40, "hot"), (41, "hot hot w1"), (42, docs[0][1])]
    assert search(spark, docs, items, 10) == brute(docs, items, 10)


def test_segments(spark, monkeypatch):
    monkeypatch.setattr(ranking, "SEGMENT_WORDS", 20)
    docs, items = tables(5, 100, 50, 40)
    assert search(spark, docs, items[:9], 3) == brute(docs, items[:9], 3)


def test_edges(spark):
    docs = [(None, "alpha beta"), (2, "alpha beta"), (2, "alpha beta"), (1, None), (3, ""), (4, "..!"),
            (5, "ÀLPHA alpha beta ALPHA"), (6, "  \x7f\x80 İ K"), (-1, "Beta " * 3000), (None, None)]
    items = [(1, "Alpha"), (1, "Alpha"), (1, "beta beta"), (None, "alpha beta"), (2, None), (3, ""),
             (4, "  İ k"), (5, "àlpha ÀLPHA"), (6, "unheard of")]
    assert search(spark, docs, items, 3) == brute(docs, items, 3)
    wide = search(spark, [(*d, 1.5) for d in docs], [(*i, "x") for i in items], 3,
                  f"{DOCS}, rank double", f"{ITEMS}, score string")
    assert wide == brute(docs, items, 3)
    assert search(spark, [], items, 3) == search(spark, docs, [], 3) == []
    assert search(spark, [(1, None)], items, 3) == search(spark, docs, [(1, "?")], 3) == []

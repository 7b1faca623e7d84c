"""Ranked search against scoring every document, in segments and blocks of any size."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerwright.llm import lexical_search

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in WORD.findall(text or "")]


def ranked_by_force(docs, items, k=10):
    counted = [(i, words_of(t)) for i, t in docs]
    n_docs, n_terms = sum(bool(w) for _, w in counted), sum(len(w) for _, w in counted)
    df = Counter(t for _, w in counted for t in set(w))
    asked = {}
    for item, text in items:
        asked.setdefault(item, []).extend(words_of(text))
    out = []
    for item, terms in asked.items():
        scores = []
        for i, words in counted:
            tf = Counter(words)
            m = 25 + 75 * len(words) * n_docs // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 8 * m))
                        for t in terms if tf[t])
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def found(df):
    return Counter((r["item"], r["rank"], r["id"], r["score"]) for r in df.collect())


DOCS = [
    (1, "The quick brown fox"), (2, "the lazy dog, the DOG"), (3, None), (4, ""), (5, "--- !!"), (6, "fox fox fox"), (7, "fox fox fox"),
    (7, "fox fox fox"), (None, "the quick é日本 dog"), (None, "the"), (8, "word " * 60_000 + "fox"), (9, "x1 X1 x1_x1"),
]
ITEMS = [("a", "quick FOX fox"), ("b", None), ("c", "..."), ("d", "the the dog"), (None, "x1"), (None, "fox"), ("a", "lazy"), ("e", "nowhere"), ("e", "日本")]


@pytest.mark.parametrize("options", [{}, {"segment_docs": 1}, {"segment_docs": 3, "max_item_chars": 5}, {"k": 2}])
def test_small_cases(spark, options):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(2)
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    for name in ("id", "item", "no", "rank", "score"):
        docs, items = docs.withColumn(name, F.lit("mine")), items.withColumn(name, F.lit("mine"))
    got = lexical_search.ranked_search(docs, items, **options)
    assert got.columns == ["item", "rank", "id", "score"]
    assert found(got) == ranked_by_force(DOCS, ITEMS, options.get("k", 10))
    assert found(lexical_search.ranked_search(docs.limit(0), items)) == found(lexical_search.ranked_search(docs, items.limit(0))) == Counter()


@pytest.mark.parametrize("short_share,block", [(0.0, 7), (0.25, 16), (0.5, 64), (10.0, 1000)])
def test_skipping_loses_nothing(short_share, block):
    """Ties included, and with a threshold that stands from the first segment on."""
    draw = random.Random(block)
    vocabulary = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(draw.choices(vocabulary, [60 / (j + 1) for j in range(60)], k=draw.randint(0, 25)))) for i in range(600)]
    draw.shuffle(docs)
    items = [(f"q{q}", " ".join(draw.choices(vocabulary, k=draw.randint(1, 12)))) for q in range(40)]
    numbers = {w.encode(): i for i, w in enumerate(vocabulary)}
    parts = [docs[at:at + 90] for at in range(0, 600, 90)]
    rows = [lexical_search.segment(np.array([i for i, _ in p]), [t for _, t in p], numbers) for p in parts]
    n_docs, n_terms = sum(r["n_docs"] for r in rows), sum(r["n_terms"] for r in rows)
    df = Counter()
    for r in rows:
        df.update(dict(zip(r["terms"].tolist(), r["dfs"].tolist())))
    got = Counter()
    for item, text in items:
        best = lexical_search.Best(10)
        query = [(numbers[w.encode()], c * lexical_search.weight_of(df[numbers[w.encode()]], n_docs)) for w, c in Counter(text.split()).items()]
        for r in rows:
            lexical_search.search_segment(lexical_search.Postings(r, n_docs, n_terms, 8, 75), query, best, short_share, block)
        got.update((item, rank, i, s) for rank, (i, s) in enumerate(zip(best.ids.tolist(), best.scores.tolist()), 1))
    assert got == ranked_by_force(docs, items)

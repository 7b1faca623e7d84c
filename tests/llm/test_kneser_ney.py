"""The language model against the textbook's formulas over plain counters, and its small cases."""

from __future__ import annotations

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from layerwright.llm import kneser_ney, queries

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
CASES = [
    (1, "the cat sat on the mat the cat ate"), (2, "The cat sat"), (3, None), (4, ""), (5, " \t\x0b "), (6, "a a a a a a b a a"),
    (6, "a a a a a a b a a"), (None, "the dog sat on the mat é日本"), (7, "word " * 30_000 + "last"), (8, "new unseen words sat on"),
]


def words_of(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in SPACE.findall(text or "")] + ["</s>"]


class Plain:
    """The same model with counters of tuples."""

    def __init__(self, texts, order):
        self.order = order
        self.raw = [Counter() for _ in range(order + 1)]
        for text in texts:
            found = ["<s>"] * (order - 1) + words_of(text)
            for i in range(order - 1, len(found)):
                for n in range(1, order + 1):
                    self.raw[n][tuple(found[i - n + 1:i + 1])] += 1
        self.counts = [Counter() for _ in range(order + 1)]
        self.counts[order] = self.raw[order]
        for n in range(order - 1, 0, -1):
            for gram in self.counts[n + 1]:
                self.counts[n][gram[1:]] += 1
            if n > 1:
                for gram in self.counts[n]:
                    if gram[0] == "<s>":
                        self.counts[n][gram] = self.raw[n][gram]
        self.discounts = [None, *(self.discount(c) for c in self.counts[1:])]
        self.follow = [defaultdict(list) for _ in range(order + 1)]
        for n in range(1, order + 1):
            for gram, c in self.counts[n].items():
                self.follow[n][gram[:-1]].append(c)
        self.sums = [None, *({g: (sum(after), sum(self.discounts[n][min(x, 3) - 1] for x in after)) for g, after in self.follow[n].items()}
                             for n in range(1, order + 1))]

    @staticmethod
    def discount(counts):
        c = Counter(counts.values())
        if not all(c[i] for i in (1, 2, 3, 4)):
            return kneser_ney.USUAL
        y = c[1] / (c[1] + 2 * c[2])
        found = tuple(i - (i + 1) * y * c[i + 1] / c[i] for i in (1, 2, 3))
        return found if all(0 < d <= i for i, d in enumerate(found, 1)) else kneser_ney.USUAL

    def p(self, gram, n):
        if n == 0:
            return 1 / (len(self.counts[1]) + 1)
        own = gram[-n:]
        lower = self.p(gram, n - 1)
        if own[:-1] not in self.sums[n]:
            return lower
        total, left = self.sums[n][own[:-1]]
        d = self.discounts[n]
        c = self.counts[n].get(own, 0)
        return ((c - d[min(c, 3) - 1] if c else 0) + left * lower) / total

    def score(self, text):
        found = ["<s>"] * (self.order - 1) + words_of(text)
        known, n, v = self.raw[1], sum(self.raw[1].values()), len(self.raw[1])
        own = found[self.order - 1:]
        base = sum(math.log10((known.get((w,), 0) + 0.1) / (n + 0.1 * (v + 1))) for w in own)
        full = sum(math.log10(self.p(tuple(found[max(0, i - self.order + 1):i + 1]), self.order)) for i in range(self.order - 1, len(found)))
        return len(own), sum((w,) in known for w in own), n, base, full


def assert_scores(rows, plain):
    for r in rows:
        n, known, total, base, full = plain.score(r.text)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9) and r.score == pytest.approx(full, rel=1e-9, abs=1e-9)
        assert r.perplexity == pytest.approx(10 ** (-full / n), rel=1e-6)


@pytest.mark.parametrize("order,shard_bytes", [(2, 1_000_000), (2, 20_000), (3, 20_000), (4, 40_000)])
def test_small_cases(spark, order, shard_bytes):
    docs = spark.createDataFrame(CASES, "doc_id long, text string").repartition(3)
    for name in ("row", "score", "N_Tokens", "found", "shard", "words"):
        docs = docs.withColumn(name, F.lit("mine"))
    model = kneser_ney.train(docs.filter("doc_id IS NULL OR doc_id <> 8"), order=order, shard_bytes=shard_bytes, batch_tokens=20_000)
    scored = kneser_ney.score(docs, model)
    assert scored.columns == ["doc_id", "text", "row", "score", "N_Tokens", "found", "shard", "words", "n_known", "train_tokens", "base_score", "perplexity"]
    rows = scored.collect()
    assert len(rows) == len(CASES) and {r.shard for r in rows} == {"mine"}
    assert_scores([r.__class__(**{**r.asDict(), "n_tokens": r["N_Tokens"]}) for r in rows], Plain([t for i, t in CASES if i != 8], order))


@pytest.mark.parametrize("order", [2, 3])
def test_drawn_texts_and_sum_to_one(spark, order):
    draw = random.Random(order)
    vocabulary = [f"{c}{i}" for i in range(10) for c in "abcdefgh"]
    texts = [" ".join(draw.choices(vocabulary, [80 / (i + 1) for i in range(80)], k=draw.randint(0, 30))) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = kneser_ney.train(docs, order=order, shard_bytes=500)
    plain = Plain(texts, order)
    assert plain.discounts[order] != kneser_ney.USUAL and model.shards > 4
    assert_scores(kneser_ney.score(docs, model).collect(), plain)
    for context in (("<s>",) * (order - 1), ("a0",) * (order - 1), ("a0", "b0")[:order - 1], ("z",) * (order - 1)):
        total = sum(plain.p((*context, w), order) for w in [*(g[0] for g in plain.counts[1]), "never seen"])
        assert total == pytest.approx(1)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    model = kneser_ney.train(docs.limit(0))
    rows = {r.doc_id: r for r in kneser_ney.score(docs, model).collect()}
    assert (rows[1].n_tokens, rows[1].n_known, rows[1].train_tokens, rows[1].base_score, rows[1].score) == (3, 0, 0, 0.0, 0.0)
    assert rows[2].n_tokens == 1
    assert kneser_ney.score(docs.limit(0), kneser_ney.train(docs)).count() == 0
    with pytest.raises(ValueError, match="order"):
        kneser_ney.train(docs, order=1)
    with pytest.raises(ValueError, match="model_dir"):
        kneser_ney.train(docs, model_dir="viewfs://somewhere/else")


def test_arrays_are_sorted_and_whole(spark, tmp_path):
    import numpy as np

    docs = spark.createDataFrame([(i, f"w{i % 7} w{i % 5} common words") for i in range(200)], "doc_id long, text string")
    model = kneser_ney.train(docs, model_dir=str(tmp_path), shard_bytes=400)
    names = os.listdir(model.folder)
    assert not [n for n in names if n.startswith(".")]
    held = 0
    for name in names:
        if name.startswith("2-") and name.endswith("key.npy"):
            key = np.load(f"{model.folder}/{name}", mmap_mode="r")
            assert (key[1:] > key[:-1]).all()
            assert set(kneser_ney.shard_of(np.asarray(key), model.shards).tolist()) == {int(name.split("-")[1])}
            held += len(key)
    assert held == model.levels[2].n_grams == len(Plain([f"w{i % 7} w{i % 5} common words" for i in range(200)], 2).counts[2])


def test_query_equals_plain_model(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    plain = Plain([t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10], 2)
    rows = queries.op11_kneser_ney(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, known, total, base, full = plain.score(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(full, rel=1e-9)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)

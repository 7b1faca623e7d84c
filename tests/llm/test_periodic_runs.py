"""Runs against a scan for every period, and the query against the contract spelled out."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerwright.llm import periodic_runs, queries


def runs_by_force(words):
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                found.setdefault((start, i + q - start), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed_by_force(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def drawn(draw):
    n, k = draw.randint(0, 150), draw.choice([1, 2, 2, 3, 5, 20])
    words = [draw.randint(1, k) for _ in range(n)]
    if n and draw.random() < 0.6:
        a = draw.randrange(n)
        p = draw.randint(1, max(1, (n - a) // 3))
        for i in range(a, n):
            words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("seed", range(4))
def test_runs_equal_scan(seed):
    draw = random.Random(seed)
    for _ in range(500):
        words = drawn(draw)
        got = [tuple(map(int, r)) for r in periodic_runs.runs_of(np.array(words, np.int64))]
        assert got == runs_by_force(words)


def test_long_texts_go_by_blocks(monkeypatch):
    monkeypatch.setattr(periodic_runs, "KEPT_WORDS", 16)
    monkeypatch.setattr(periodic_runs, "BLOCK", 50)
    draw = random.Random(9)
    for _ in range(200):
        words = drawn(draw)
        got = [tuple(map(int, r)) for r in periodic_runs.runs_of(np.array(words, np.int64))]
        assert got == runs_by_force(words)


def test_common_extensions_equal_comparison():
    draw = random.Random(2)
    for n in (1, 2, 12, 13, 14, 40, 200):
        words = np.array([draw.randint(1, 2) for _ in range(n)], np.int64)
        words[n // 2:] = words[:n - n // 2]
        i, j = (a.ravel() for a in np.meshgrid(np.arange(n + 1), np.arange(n + 1)))
        i, j = i[i != j], j[i != j]
        want = []
        for a, b in zip(i, j):
            k = 0
            while max(a, b) + k < n and words[a + k] == words[b + k]:
                k += 1
            want.append(k)
        assert periodic_runs.Extensions(words).common(i, j).tolist() == want


def test_small_cases(spark):
    rows = [
        (1, "a b " * 10), (1, "a b " * 10), (2, None), (3, ""), (4, " \t\x0b "), (None, "é　x é　x é　x é　x é　x é　x y"),
        (5, "start " + "one two three " * 5 + "one end"), (6, "a " * 5), (7, "a " * 6), (8, "A a A a A a A a"), (9, "x " * 40_000 + "y z " * 20_000),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("row", "runs", "N_Words", "found", "start"):
        docs = docs.withColumn(name, F.lit("mine"))
    out = periodic_runs.find_runs(docs)
    assert out.columns == ["doc_id", "text", "row", "runs", "N_Words", "found", "start", "collapsed"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = [(0, 40_001, 1), (40_001, 40_000, 2)] if r.doc_id == 9 else runs_by_force(words)
        if r.doc_id == 9:
            runs = [(0, 40_000, 1), (40_000, 40_000, 2)]
        assert (r.N_Words, [tuple(x) for x in r.runs], r.collapsed) == (len(words), runs, collapsed_by_force(words, runs))
    assert periodic_runs.find_runs(docs.limit(0)).count() == 0


def test_query_equals_scan(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op12_periodic_runs(spark, sf_dir).collect()
    assert len(got) == len(texts) and sum(r.n_runs > 0 for r in got) > 0.05 * len(got)
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            original = list(words)
            for i in range(a, n):
                words[i] = original[a + (i - a) % p]
        if n > 3000 and h % 10:
            continue  # the scan takes a square of the words
        runs = runs_by_force(words)
        text = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        want = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (r.n_runs, (r.start, r.length, r.period, r.exponent_milli)) == (len(runs), want)
        assert r.runs_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed_by_force(words, runs).encode()).hexdigest()

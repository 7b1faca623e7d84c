"""URL filter and language identification against plain forms of their methods, on whole tables."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerwright.llm import language_id, queries


def url_parts(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = rest.split("/")[0].split("?")[0].split("#")[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    return host.lower(), path


def url_tokens(url):
    host, path = url_parts(url)
    return frozenset([f"h:{x}" for x in host.split(".") if x] + [f"p:{x}" for x in path.split("/") if x])


@pytest.mark.parametrize("size", ["0.001", "0.01"])
def test_mined_verdicts_on_pages_equal_force(spark, size):
    """Every combination of tokens that are frequent enough, tried on every page, with the query's own parameters."""
    sf = f"/root/testdata/sf{size}"
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    baskets = [(url_tokens(pages[r.doc_id]), r.toxic == 1 or r.quality == 0) for r in labels if pages.get(r.doc_id) is not None]
    least = max(20, math.ceil(len(baskets) * 0.002))
    places = defaultdict(set)
    for i, (tokens, _) in enumerate(baskets):
        for t in tokens:
            places[t].add(i)
    first = {}  # tokens that are always together: the first stands for all
    for t in sorted(places):
        if len(places[t]) >= least:
            first.setdefault(frozenset(places[t]), t)
    singles, blocked = sorted(first.values()), {i for i, (_, b) in enumerate(baskets) if b}
    rules, level = {}, [((t,), places[t]) for t in singles]
    while level:
        for items, own in level:
            bad = len(own & blocked)
            if bad >= least and bad / len(own) >= 0.6:
                rules[frozenset(items)] = bad / len(own)
        longer = [((*items, t), own & places[t]) for items, own in level for t in singles if t > items[-1]]
        level = [(items, own) for items, own in longer if len(own) >= least]
    got = queries.op5_url_filter(spark, sf).collect()
    assert len(got) == len(pages)
    mined = 0
    for r in got:
        assert (r.host, r.path) == url_parts(pages[r.page_id])
        if r.rule is None:
            tokens = url_tokens(pages[r.page_id])
            assert r.verdict == ("block" if any(rule <= tokens for rule in rules) else "allow"), pages[r.page_id]
            mined += r.verdict == "block"
    assert (mined > 0) == any(rule <= url_tokens(pages[r.page_id]) for r in got if r.rule is None for rule in rules)


def plain_ftrl(samples, classes, epochs=3, alpha=0.5, beta=1.0, l1=0.05, l2=0.001):
    """Follow the regularised leader, one coordinate after the other."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(key):
        if abs(z[key]) <= l1:
            return 0.0
        return -(z[key] - math.copysign(l1, z[key])) / ((beta + math.sqrt(n[key])) / alpha + l2)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for i in order.permutation(len(samples)):
            x, label = samples[i]
            x = {**x, "bias": 1.0}
            w = {(f, c): weight((f, c)) for f in x for c in range(classes)}
            raw = [sum(v * w[f, c] for f, v in x.items()) for c in range(classes)]
            top = max(raw)
            e = [math.exp(r - top) for r in raw]
            for c in range(classes):
                error = e[c] / sum(e) - (c == label)
                for f, v in x.items():
                    g = v * error
                    z[f, c] += g - (math.sqrt(n[f, c] + g * g) - math.sqrt(n[f, c])) / alpha * w[f, c]
                    n[f, c] += g * g
    return weight


def test_language_equals_plain_form(spark, sf_dir):
    """TF-IDF, weights, temperature and every prediction, from the same sample in the same order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    rows = docs.collect()
    learnt = [r for r in rows if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    grams = {r.doc_id: Counter(language_id.ngrams(r.text).tolist()) for r in rows}
    df = Counter(f for r in learnt for f in grams[r.doc_id])
    idf = {f: math.log((1 + len(learnt)) / (1 + n)) + 1 for f, n in df.items()}
    own = spark.createDataFrame([(r.doc_id, r.text, r.lang) for r in learnt], "id long, text string, lang string")
    nth = {r.id: r.nth for r in language_id._sample(own, 2_000).collect()}
    assert len(nth) == len(learnt)
    languages = sorted({r.lang for r in learnt})

    def features(r):
        size = sum(grams[r.doc_id].values())
        return {f: c * idf.get(f, math.log(1 + len(learnt)) + 1) * language_id.SCALE / size for f, c in grams[r.doc_id].items()}

    ordered = [r for r in sorted(learnt, key=lambda r: (nth[r.doc_id], r.lang)) if grams[r.doc_id]]
    weight = plain_ftrl([(features(r), languages.index(r.lang)) for r in ordered if nth[r.doc_id] % 5], len(languages))

    def margins(r):
        x = {**features(r), "bias": 1.0}
        return np.array([sum(v * weight((f, c)) for f, v in x.items()) for c in range(len(languages))])

    tuning = [(margins(r), languages.index(r.lang)) for r in ordered if nth[r.doc_id] % 5 == 0]

    def loss(heat):
        total = 0.0
        for m, label in tuning:
            e = np.exp(m / heat - (m / heat).max())
            total -= math.log(max(e[label] / e.sum(), 1e-300))
        return total

    heat = min((2.0 ** k for k in np.arange(-1, 3.01, 0.125)), key=loss) if tuning else 1.0
    got = {r.doc_id: r for r in queries.op8_language_id(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        if not grams[r.doc_id]:
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        m = margins(r) / heat
        p = np.exp(m - m.max()) / np.exp(m - m.max()).sum()
        assert got[r.doc_id].score == pytest.approx(p.max(), abs=1e-3)
        assert got[r.doc_id].lang_pred == languages[int(p.argmax())]
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_penalties_leave_weights_at_zero():
    draw = np.random.default_rng(3)
    samples = [(np.unique(draw.integers(0, 50, 8)), None, int(i % 3)) for i in range(60)]
    samples = [(at, draw.random(len(at)), label) for at, _, label in samples]
    for l1, l2 in ((0.05, 0.001), (2.0, 0.5)):
        weights, bias = language_id.ftrl(samples, 3, l1=l1, l2=l2)
        plain = plain_ftrl([(dict(zip(at.tolist(), x.tolist())), label) for at, x, label in samples], 3, l1=l1, l2=l2)
        for f in range(50):
            assert weights[f].tolist() == pytest.approx([plain((f, c)) for c in range(3)], abs=1e-9)
        assert bias.tolist() == pytest.approx([plain(("bias", c)) for c in range(3)], abs=1e-9)
        assert (weights[50:] == 0).all()
    assert (weights[:50] == 0).mean() > 0.5  # strong penalties leave few


def test_no_label_is_an_input_of_a_prediction(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = language_id.held_out(F.col("doc_id"))
    swapped = docs.withColumn("lang", F.when(held, F.lit("xx")).otherwise(F.col("lang")))
    one, two = ({r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(d).collect()} for d in (docs, swapped))
    assert one == two

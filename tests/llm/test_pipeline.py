"""Each stage of the pipeline against brute force on what the stage before has kept."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
from test_llm_operators import DOCS, components_by_force, frame, lines_by_force


def as_rows(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def contaminated_by_force(text, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))

    own, hit = words(text), set()
    windows = {tuple(w[i:i + min(13, len(w))]) for w in map(words, items) if w for i in range(len(w) - min(13, len(w)) + 1)}
    for n in {len(w) for w in windows}:
        for i in range(len(own) - n + 1):
            if tuple(own[i:i + n]) in windows:
                hit.update(range(i, i + n))
    return bool(hit) and 20 * len(hit) >= len(own)


def test_stages_equal_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "decontamination", "mix"]
    before, kept = as_rows(docs), docs
    for name, stage in corpus_pipeline.STAGES:
        kept = spark.createDataFrame(stage(spark, kept, sf_dir).collect(), kept.schema if name != "mix" else None)
        rows = as_rows(kept)
        if name == "language_id":
            assert kept.columns == names and len(rows) >= 0.98 * len(before)
            assert not Counter(rows) - Counter(before)
        elif name == "line_dedup":
            assert Counter((i, t) for i, t, *_ in rows) == Counter((i, t) for i, t, *_ in lines_by_force(before).elements())
            assert all(r.n_chars == len(r.text) for r in kept.collect())
        elif name == "ngram_join":
            first = {i for i, _, c in components_by_force(before, 5, 80) if i == c}
            assert Counter(rows) == Counter(r for r in before if r[0] in first)
        elif name == "decontamination":
            items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
            assert Counter(rows) == Counter(r for r in before if not contaminated_by_force(r[1], items))
        else:
            sizes = {i: len((t or "").split()) for i, t, *_ in before}
            copies = Counter(i for i, *_ in rows)
            assert max(copies.values()) <= 2 and set(copies) <= {i for i, n in sizes.items() if n}
            assert abs(sum(sizes[i] * n for i, n in copies.items()) - 1.5 * sum(sizes.values())) <= max(sizes.values())
        if name != "mix":
            assert kept.columns == names
        before = rows


def test_stages_without_rows_and_with_nulls(spark, sf_dir):
    odd = frame(spark, [(1, None, None, None), (None, "a line of text without an id", "en", None), (2, "", "en", "a")], DOCS).selectExpr(
        "*", "cast(null as bigint) as n_chars")
    for rows in (odd, odd.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, sf_dir)
            assert out.columns[:5] == rows.columns and out.count() <= 2 * rows.count()


def test_repeated_rows_and_rows_without_id(spark, sf_dir):
    long, other = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    near, lone = long + " tail", " ".join(f"u{i}" for i in range(40))
    rows = [(1, long, "en", "a"), (1, long, "en", "a"), (1, other, "en", "a"), (2, near, "en", "a"), (None, near, "en", "a"),
            (None, lone, None, None), (None, lone, None, None), (3, other + " more words here", "en", None), (4, "", None, None)]
    docs = frame(spark, rows, DOCS).selectExpr("*", "length(text) as n_chars").withColumn("n_shingles", corpus_pipeline.F.lit("mine"))
    kept = corpus_pipeline.without_near_copies(spark, docs, sf_dir)
    assert kept.columns == docs.columns and {r.n_shingles for r in kept.collect()} == {"mine"}
    assert Counter(as_rows(kept)) == Counter([(1, long, "en", "a"), (1, other, "en", "a"), (None, lone, None, None), (4, "", None, None)])
    deduplicated = corpus_pipeline.without_repeated_lines(spark, docs, sf_dir)
    assert Counter(as_rows(deduplicated)) == Counter((i, t, r[2], r[3]) for r, (i, t) in zip(rows, [
        (1, long), (1, long), (1, other), (2, near), (None, ""), (None, rows[5][1]), (None, rows[5][1]), (3, rows[7][1]), (4, "")]))

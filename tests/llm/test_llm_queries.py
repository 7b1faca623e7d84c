"""The queries against their SQL, and against brute force where SQL can't express them."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry_module
import oracle
from layerwright.llm import queries


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = oracle.connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert oracle.differences(queries.QUERIES[name](spark, sf_dir), con, queries.SQL[name]) == []


def test_all_are_registered():
    known = entry_module.queries()
    assert set(queries.QUERIES) <= set(known) and "pipeline" in known
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_token_counts_equal_library(spark, sf_dir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = queries.op3_token_counts(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for row in got:
        n = len(library.encode(texts[row.doc_id], add_special_tokens=False))
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(texts[row.doc_id].encode()), n, n > 512)


def removed_by_force(docs: list[tuple[int, str]], least: int) -> dict:
    first: dict[bytes, int] = {}
    raws = [(i, (t or "").encode()) for i, t in sorted(docs)]
    for i, raw in raws:
        for at in range(len(raw) - least + 1):
            first.setdefault(raw[at:at + least], i)
    out = {}
    for i, raw in raws:
        gone = bytearray(len(raw))
        for at in range(len(raw) - least + 1):
            if first[raw[at:at + least]] < i:
                gone[at:at + least] = b"\1" * least
        spans = sum(1 for at in range(len(gone)) if gone[at] and not (at and gone[at - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup_equals_force(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op6_suffix_dedup(spark, sf_dir).collect()}
    assert got == removed_by_force(docs, 50)


def test_language_on_held_out(spark, sf_dir):
    rows = queries.op8_language_id(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id").collect()
    out = [r for r in rows if r.held_out and r.lang]
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.mark.parametrize("size", ["0.001", "0.01", "0.1"])
def test_nearest_recall(spark, size):
    sf_dir = f"/root/testdata/sf{size}"
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()
    ids = np.array([r.vec_id for r in rows])
    vectors = np.array([r.embedding for r in rows], dtype=float)
    got: dict[int, list] = {}
    for r in queries.op9_nearest_vectors(spark, sf_dir).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    found = total = 0
    for q in ids[ids % 20 == 0]:
        score = (vectors * vectors[ids == q][0]).sum(axis=1)
        best = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        assert [s for _, s in got[q]] == [float(score[ids == v][0]) for v, _ in got[q]]
        found += len({int(ids[i]) for i in best} & {v for v, _ in got[q]})
        total += len(best)
    assert found == total


def test_url_verdicts(spark, sf_dir):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op5_url_filter(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        rest = pages[r.page_id].partition("://")[2]
        host = rest.split("/")[0].split("?")[0].split("#")[0]
        path = rest[len(host):].split("?")[0].split("#")[0]
        fits = [(h + p, v) for v, h, p in queries.URL_RULES
                if (host.lower() == h or host.lower().endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, r.verdict))
        assert (r.host, r.path, r.rule, r.verdict) == (host.lower(), path, rule, verdict)
        assert r.verdict in ("allow", "block")

"""Small cases of each operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from layerwright.llm import (
    bwt, chat_format, components, decontamination, language_id, line_dedup, mixing, nearest, ngram_join, shingles,
    suffix_dedup, token_counts, url_filter,
)
from layerwright.llm.common import running_total

DOCS = "doc_id long, text string, lang string, source string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def empty(spark, schema=DOCS):
    return frame(spark, [], schema)


ODD = [
    (1, "the quick brown fox jumps over the lazy dog again\nShared line number one", "en", "a"),
    (2, "  SHARED LINE NUMBER ONE \nshort\nshort", "en", "b"),
    (2, "another text under the same id\nshared line number one", "en", None),
    (3, None, None, None),
    (4, "", "en", "a"),
    (5, " \t\x0b ", "fr", "a"),
    (None, "shared line number one", None, "b"),
    (None, "shared line number one", None, "b"),
    (6, "no such line\n\n\n", "en", "b"),
    (6, "no such line\n\n\n", "en", "b"),
    (7, "é日本 \U0001F600 <|endoftext|> ÀÉ\nShared Line Number One\x0c", "de", "c"),
]


def with_clashes(df):
    """Extra columns named like those inside and in the results of the operators."""
    for name in ("id", "row", "key", "n_lines", "N_Tokens", "size", "component_id", "score", "n_words", "kept", "verdict", "pos"):
        df = df.withColumn(name, F.lit("mine"))
    return df


# line dedup

def lines_by_force(rows, least=10):
    held = {}
    def key(x):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    def order(i):
        return (i is None, i or 0)
    for i, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least:
                held.setdefault(key(line), set()).add(order(i))
    out = []
    for i, text, *_ in rows:
        lines = (text or "").split("\n")
        gone = [len(held.get(key(x), ())) > 1 and min(held[key(x)]) != order(i) for x in lines]
        out.append((i, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return Counter(out)


def test_lines(spark):
    rows = [*ODD, (8, "\n".join(["shared line number one"] * 3 + [f"line of its own {i}" for i in range(4000)]), "en", "a")]
    got = line_dedup.drop_repeated_lines(frame(spark, rows))
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == lines_by_force(rows)
    clashing = line_dedup.drop_repeated_lines(with_clashes(frame(spark, rows)))
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in clashing.collect()) == lines_by_force(rows)
    assert clashing.columns.count("n_lines") == 1 and {r.key for r in clashing.collect()} == {"mine"}
    assert line_dedup.drop_repeated_lines(empty(spark)).count() == 0


# chat formatting

def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string, extra string"
    rows = [
        (1, 0, "user", "hello"), (1, 1, "assistant", "a <turn> \\ </turn>\n x"), (1, 2, "user", None),
        (2, 0, "user", "hello"), (2, 1, "assistant", "another"),
        (3, 0, "user", "hello"), (3, 1, "assistant", "a <turn> \\ </turn>\n x"),
        (4, None, None, ""), (4, 5, "assistant", "\\n"), (4, 5, "assistant", "\\n"),
        (None, 1, "assi\nstant", "x"), (None, 0, "user", "long " * 50_000),
    ]
    packed = chat_format.pack(frame(spark, [(*r, "x") for r in rows], schema))
    turns = packed.turns.collect()
    # Shared turns are there once, and a tree's text has no gaps.
    assert len(turns) == len({(r[0] if r[0] not in (2, 3) or r[3] == "another" else 1, r[1], r[3]) for r in rows}) + 1
    for tree in {bytes(t.tree) for t in turns}:
        own = sorted((t.start, t.end) for t in turns if bytes(t.tree) == tree)
        assert own[0][0] == 0 and all(a[1] == b[0] for a, b in zip(own, own[1:]))
        text = "".join(t.text for t in sorted((t for t in turns if bytes(t.tree) == tree), key=lambda t: t.start))
        for t in turns:
            if bytes(t.tree) == tree:
                above = "".join(text[x.start:x.end] for x in t.attends)
                assert len(above) == t.position  # it attends to its own path and nothing else
    got = {r.conv: r for r in chat_format.read_back(packed).collect()}
    assert set(got) == {1, 2, 3, 4, None}
    import hashlib
    for conv in got:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert got[conv].formatted_chars == sum(len(chat_format.format_turn(r[2] or "", r[3] or "")[0]) for r in own)
    assert chat_format.read_back(chat_format.pack(empty(spark, schema))).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "<", "\\<", "\\n", "a\nb", "</turn>", "\\\\<turn>\\"])
def test_escape_is_reversible(text):
    assert chat_format.parse_turn(chat_format.format_turn(text, text)[0]) == (text, text)


# token counts

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_token_splicing():
    tokenizer, margin = token_counts.load(TOKENIZER)
    draw = random.Random(4)
    parts = ["a", "b", " ", "  ", "\n", "\t", "é", "日", "'s", "1", "<|endoftext|>", "!", "the ", "ing", "\u3000", "\u00a0", "oftext|>", "<|end"]
    pieces = token_counts.PieceCounts(tokenizer, most=40)
    for _ in range(400):
        texts = []
        for _ in range(5):
            weights = [draw.random() ** 3 for _ in parts]
            texts.append("".join(draw.choices(parts, weights, k=draw.randint(1, 150))))
        counts = [len(e) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert pieces.count(list(texts)) == counts
        for text, n in zip(texts, counts):
            chunk, overlap = draw.randint(5, 40), draw.randint(2, 20)
            if len(text) > chunk + overlap:
                assert token_counts.spliced_count(text, tokenizer, margin, chunk, overlap) == n


def test_token_edge_cases(spark):
    tokenizer, _ = token_counts.load(TOKENIZER)
    rows = [*ODD, (8, "x" * 70_000, "en", "a"), (9, "word and " * 20_000, "en", "a")]
    got = token_counts.count_tokens(with_clashes(frame(spark, rows)), TOKENIZER, chunk_chars=2_000, overlap_chars=50)
    assert got.columns.count("N_Tokens") == 1 and "n_tokens" not in got.columns
    want = Counter((i, len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False))) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.n_bytes, r.N_Tokens) for r in got.collect()) == want
    assert token_counts.count_tokens(empty(spark), TOKENIZER).count() == 0


# mixing

def test_mix(spark):
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 5}") for i in range(400)] + [(i, "tiny", "en", "few") for i in range(400, 402)] + ODD
    docs = with_clashes(frame(spark, rows))
    plan = mixing.mix_plan(docs)
    got = plan.collect()
    assert len(got) == len(rows)
    assert Counter((r.id, r.taken) for r in got) == Counter((r.id, r.taken) for r in mixing.mix_plan(docs.repartition(7)).collect())
    total = sum(r.size for r in got)
    targets = {r.source: r.target for r in got}
    assert abs(sum(targets.values()) - 1.5 * total) < 1e-6
    for source, target in targets.items():
        own = [r for r in got if r.source == source]
        assert target <= 2 * sum(r.size for r in own) and all(r.taken <= 2 * r.size for r in own)
        assert abs(sum(r.taken for r in own) - target) <= 2 * max(r.size for r in own) + 1
    copies = mixing.mix(frame(spark, rows).withColumn("copy", F.lit("mine")))
    assert copies.columns == ["doc_id", "text", "lang", "source", "copy"]
    assert copies.count() == sum(r.copies for r in got)
    assert mixing.mix_plan(empty(spark)).count() == 0 and mixing.mix(empty(spark)).count() == 0
    blank = frame(spark, [(1, None, None, None), (2, "", "en", "a")])
    assert {(r.size, r.taken) for r in mixing.mix_plan(blank).collect()} == {(0, 0)}


def test_word_count(spark):
    texts = ["", " ", "a", " a", "a ", "\ta\x0bb\x0cc\rd\n", "é\u00a0x", None]
    got = frame(spark, [(i, t, None, None) for i, t in enumerate(texts)]).select("doc_id", mixing.word_count(F.col("text")).alias("n"))
    assert [r.n for r in got.orderBy("doc_id").collect()] == [0, 0, 1, 1, 1, 4, 1, 0]


def test_running_total(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("k"), F.xxhash64("id").alias("o"), (F.col("id") % 11).alias("v"))
    got = running_total(df, ["k"], ["o"], "v", "t", "test").collect()
    for k in range(3):
        total = 0
        for r in sorted((r for r in got if r.k == k), key=lambda r: r.o):
            total += r.v
            assert r.t == total


# URL filter

PAGES = "page_id long, url string"


def test_url_edge_cases(spark):
    urls = [None, "", "nothing", "http://", "HTTP://WWW.Example.com/en/x?y#z", "x://example.com", "x://a.net/es/", "x://a.net/ES/",
            "x://notexample.com/en/", "x://com/", "a://b://c/d", "x://www.example.com/en/", "x://sub.example.com/en/"]
    rows = [(i, u) for i, u in enumerate(urls)] * 2
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/")]
    labelled = empty(spark, "url string, blocked boolean")
    got = url_filter.judge_urls(with_clashes(frame(spark, rows, PAGES)).withColumn("host", F.lit("mine")), labelled, rules)
    assert got.columns.count("host") == 1 and got.count() == len(rows)
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got.collect()}
    assert found[0] == found[1] == found[2] == found[3] == ("", "", None, "allow")
    assert found[4] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert found[5] == ("example.com", "", None, "allow")
    assert found[6] == ("a.net", "/es/", "net/es/", "block") and found[7] == ("a.net", "/ES/", None, "allow")
    assert found[8] == ("notexample.com", "/en/", "com/", "allow")
    assert found[9] == ("com", "/", "com/", "allow")
    assert found[10] == ("b:", "//c/d", None, "allow")
    assert found[12][2:] == ("example.com/en/", "block")
    assert url_filter.judge_urls(empty(spark, PAGES), labelled, rules).count() == 0


def test_mined_rules_equal_force(spark):
    draw = random.Random(3)
    pages, labels = [], []
    for i in range(600):
        host = ".".join([draw.choice(["shop", "blog", "m"]), draw.choice(["pills", "news", "cats"]), draw.choice(["org", "info"])])
        path = "/" + "/".join(draw.choices(["buy", "en", "now", "deep"], k=draw.randint(0, 2))) + f"/{i}"
        url = f"http://{host}{path}"
        pages.append((i, url))
        if i % 2:
            labels.append((url, ("pills" in host and "buy" in path) if draw.random() < 0.95 else True))
    support, count, confidence = 0.02, 5, 0.8
    labelled = frame(spark, labels, "url string, blocked boolean")
    got = {r.page_id: r for r in url_filter.judge_urls(frame(spark, pages, PAGES), labelled, [], min_support=support, min_count=count,
                                                        min_confidence=confidence).collect()}

    def tokens(url):
        host, _, path = url.partition("://")[2].partition("/")
        return frozenset([f"h:{x}" for x in host.split(".") if x] + [f"p:{x}" for x in path.split("/") if x])

    baskets = [(tokens(u), b) for u, b in labels]
    least = max(count, int(np.ceil(len(baskets) * support)))
    frequent = {t for t, n in Counter(t for b, _ in baskets for t in b).items() if n >= least}
    rules = {}
    for size in range(1, 6):
        for items in {c for b, _ in baskets for c in combinations(sorted(b & frequent), size)}:
            own = [blocked for b, blocked in baskets if b >= set(items)]
            if sum(own) >= least and sum(own) / len(own) >= confidence:
                rules[frozenset(items)] = sum(own) / len(own)
    assert rules
    for i, url in pages:
        fits = [c for r, c in rules.items() if r <= tokens(url)]
        assert (got[i].verdict, got[i].confidence) == (("block", pytest.approx(max(fits))) if fits else ("allow", None))


# suffix dedup

@pytest.mark.parametrize("hot", [1, 20_000])
def test_repeats(spark, monkeypatch, hot):
    from test_llm_queries import removed_by_force

    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 3_000)
    monkeypatch.setattr(suffix_dedup, "TASK_BYTES", 4_000)
    draw = random.Random(hot)
    passages = ["".join(draw.choices("abé日 ", k=draw.randint(20, 90))) for _ in range(12)]
    texts = ["".join(draw.choices(passages, k=draw.randint(0, 4))) + "".join(draw.choices("xyz", k=draw.randint(0, 60))) for _ in range(60)]
    rows = [(i, t, None, None) for i, t in enumerate(texts)] + [(60, None, None, None), (61, "", None, None), (62, "ab" * 40, None, None),
                                                               (63, "ab" * 40, None, None), (64, "a" * 300, None, None), (65, "a" * 60, None, None)]
    rows.append((66, passages[0] * 400, None, None))
    got = suffix_dedup.remove_repeats(with_clashes(frame(spark, rows)), least=24)
    import hashlib
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got.collect()}
    assert found == removed_by_force([(i, t) for i, t, *_ in rows], 24)
    assert got.columns.count("kept") == 1 and "text" not in got.columns
    assert suffix_dedup.remove_repeats(empty(spark)).count() == 0


def test_repeats_of_repeated_ids(spark):
    line = "a line that is long enough to be found again, fifty bytes and more"
    got = suffix_dedup.remove_repeats(frame(spark, [(1, line, None, None), (1, line, None, None), (None, line, None, None), (None, "x" + line, None, None)]))
    assert sorted((r.doc_id is None, r.n_removed) for r in got.collect()) == [(False, 0), (False, 0), (True, len(line)), (True, len(line))]


@pytest.mark.parametrize("texts", [["a text that stands alone, longer than the least that is looked for"], ["short", "", None],
                                   ["a" * 14 + "s" * 20 + "the-smallest-one" + c * 30 for c in "bcd"],
                                   [c * 30 + "seventeen of it: the same piece of text: and seventeen" + d * 30 for c, d in ("ab", "cd", "ef")]])
def test_repeats_that_are_none(spark, texts):
    from test_llm_queries import removed_by_force

    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    for least in (20, 50, 60):
        got = suffix_dedup.remove_repeats(frame(spark, rows), least=least).collect()
        want = removed_by_force([(i, t) for i, t, *_ in rows], least)
        assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans) for r in got} == {i: w[:3] for i, w in want.items()}


class Frame:
    """In place of a DataFrame: hands out the function that a step runs on a group."""

    def groupBy(self, *_):
        return self

    def applyInArrow(self, run, _):
        return run


def test_only_strings_that_another_stretch_may_have_are_sorted(monkeypatch):
    import numpy as np
    import pyarrow as pa

    sorted_bytes = []
    plain = suffix_dedup.suffix_array
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda text, least: (sorted_bytes.append(len(text)), plain(text, least))[1])
    run = suffix_dedup._smaller(Frame(), 50)

    def runs_of(texts):
        """For each text, as one stretch with the minimizer at its 35th byte, the runs that a smaller id has."""
        packs = [suffix_dedup._pack_parts(*(np.array([x]) for x in (i + 1, i, i, len(t) - 49, 34)), np.frombuffer(t, np.uint8)) for i, t in enumerate(texts)]
        found = run(pa.table({"block": pa.array(range(len(texts)), pa.int64()), "stretches": pa.array(packs, pa.binary())}))
        parts = {b: suffix_dedup._unpack_parts(x, 4) for b, x in zip(found["block"].to_pylist(), found["runs"].to_pylist(), strict=True)}
        return {b: list(zip(low.tolist(), (first >> 1).tolist(), last.tolist(), strict=True)) for b, (_, low, first, last) in parts.items()}

    piece = b"the-smallest-one"  # 40 bytes in common with it, more than half of the others on the left
    assert runs_of([b"a" * 14 + b"s" * 20 + piece + b"next" + b"b" * 30, b"c" * 14 + b"s" * 20 + piece + b"next" + b"d" * 30]) == {}
    assert sum(sorted_bytes) == 0
    # 52 bytes in common: three strings, from the 15th on. A few bytes more each way are let through, as depths are looked at in steps.
    assert runs_of([b"a" * 14 + b"s" * 20 + piece + b"u" * 16 + b"b" * 18, b"c" * 14 + b"s" * 20 + piece + b"u" * 16 + b"d" * 18]) == {1: [(0, 14, 16)]}
    assert 2 * 52 < sum(sorted_bytes) < 2 * 65


@pytest.mark.parametrize("least", [3, 50])
def test_stretches_of_many_texts(monkeypatch, least):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "CHUNK", 400)
    draw = random.Random(least)
    texts = ["".join(draw.choices("abé", k=draw.choice([0, 1, 30, 48, 49, 50, 51, 90, 300, 900]))) for _ in range(60)] + ["a" * 1_000, ""]
    texts += texts[:20] + [texts[5] + texts[7]]
    raw, limits = suffix_dedup._texts(pa.array(["before", *texts, "behind"]).slice(1, len(texts)))
    data = raw.tobytes()
    assert [data[s:e].decode() for s, e in zip(limits, limits[1:], strict=False)] == texts
    own = suffix_dedup.Stretches(raw, limits, least)
    strings = [(t, i) for t, f, e in zip(own.text.tolist(), own.first.tolist(), own.last.tolist(), strict=True) for i in range(f, e + 1)]
    assert strings == [(t, i) for t, (s, e) in enumerate(zip(limits.tolist(), limits[1:].tolist(), strict=False)) for i in range(s, e - least + 1)]
    minimizers, keys = {}, {}
    piece = min(suffix_dedup.PIECE, least)
    for m, f, e, k, p in zip(*(x.tolist() for x in (own.minimizer, own.first, own.last, own.key, own.place)), strict=True):
        assert e <= p and p + piece <= f + least  # each string of the stretch holds it
        assert keys.setdefault(k, data[f:e + least]) == data[f:e + least]
        for i in range(f, e + 1):
            assert minimizers.setdefault(data[i:i + least], (m, p - i)) == (m, p - i)
    assert len(np.unique(own.key)) == len({data[f:e + least] for f, e in zip(own.first.tolist(), own.last.tolist(), strict=True)})
    none = suffix_dedup.Stretches(*suffix_dedup._texts(pa.array([], pa.string())), least)
    assert len(none.key) == len(none.text) == 0


def test_groups_of_transform():
    draw = np.random.default_rng(5)
    for _ in range(60):
        text = draw.integers(2, draw.integers(4, 7), draw.integers(1, 90)).astype(np.uint8)
        text = np.concatenate([text, [1], text[3:40], [1], text, [0]]).astype(np.uint8)
        least = int(draw.integers(1, 13))
        order, raw = bwt.suffix_array(text, least), text.tobytes()
        assert sorted(order.tolist()) == list(range(len(text)))
        want = [True] + [raw[a:a + least] != raw[b:b + least] for a, b in zip(order, order[1:])]
        assert bwt.long_groups(text, order, least).tolist() == want


# n-gram join

def components_by_force(rows, words, percent):
    import re
    sets = []
    for i, text, *_ in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        n = min(words, len(w))
        sets.append({tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if w else set())
    root = list(range(len(rows)))
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    out = []
    for x, (i, *_) in enumerate(rows):
        ids = [rows[y][0] for y in range(len(rows)) if find(y) == find(x) and rows[y][0] is not None]
        out.append((i, len(sets[x]), min(ids, default=None)))
    return Counter(out)


@pytest.mark.parametrize(("words", "percent", "frequent"), [(5, 80, 24), (4, 85, 2), (2, 50, 3), (1, 60, 1)])
def test_similar(spark, monkeypatch, words, percent, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    monkeypatch.setattr(ngram_join, "PIECE", 3)
    monkeypatch.setattr(ngram_join, "QUERIES", 4)
    monkeypatch.setattr(ngram_join, "TASK_SHINGLES", 500)
    draw = random.Random(words)
    bases = [[draw.choice("abcdefghij") * draw.randint(1, 3) for _ in range(draw.randint(1, 60))] for _ in range(25)]
    rows = []
    for i in range(220):
        own = list(draw.choice(bases))
        for _ in range(draw.randint(0, 3)):
            own[draw.randrange(len(own))] = draw.choice("klmno")
        rows.append((i, " ".join(own), None, None))
    rows += [*ODD, (500, "w " * 30_000, None, None), (501, "W " * 30_000, None, None)]
    got = ngram_join.similar_sets(frame(spark, rows), words=words, percent=percent)
    assert Counter((r.id, r.n_shingles, r.component_id) for r in got.collect()) == components_by_force(rows, words, percent)


def test_similar_keeps_columns(spark):
    got = ngram_join.similar_components(with_clashes(frame(spark, ODD)))
    assert got.count() == len(ODD) and got.columns.count("component_id") == 1
    assert {r.key for r in got.collect()} == {"mine"}
    assert ngram_join.similar_components(empty(spark)).count() == 0


def test_shingles():
    assert len(shingles.shingles(None, 3)) == len(shingles.shingles(" \n\x0b", 3)) == 0
    assert len(shingles.shingles("One two", 3)) == 1 and (shingles.shingles("One two", 3) == shingles.shingles("one\tTWO ", 3)).all()
    assert len(shingles.shingles("a b c a b c a b c", 3)) == 3


def test_connected(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (100, 300), (300, 400), (5, 5)]
    got = {r.node: r.component for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (100, 200, 300, 400)}
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


# language

def test_language_edge_cases(spark):
    english, french = "the cat and the dog are here with that thing ", "le chat et la souris sont ici avec une chose "
    rows = [(i, (english if i % 2 else french) * 3 + str(i), "en" if i % 2 else "fr", None) for i in range(80)] + ODD + [(900, "12 34 !?", "en", None)]
    got = language_id.identify(with_clashes(frame(spark, rows)))
    assert got.columns.count("score") == 1 and got.count() == len(rows)
    for r in got.collect():
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None and r.doc_id < 80 and len(r.text) > 100:
            assert r.lang_pred == r.lang
    assert language_id.identify(empty(spark)).count() == 0
    unlabelled = language_id.identify(frame(spark, [(1, "some text", None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]


# nearest

def test_nearest_edge_cases(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.standard_normal(6).tolist()) for i in range(300)]
    same = draw.standard_normal(6).tolist()
    rows += [(i, same) for i in range(300, 400)]
    rows += [(400, None), (401, []), (402, [0.0] * 6), (403, [float("nan")] + [1.0] * 5), (404, [None] + [1.0] * 5), (405, [float("inf")] * 6),
             (420, [1.0, 2.0]), (440, [2.0, 1.0]), (None, same), (20, rows[20][1])]
    df = frame(spark, rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit("mine"), "score": F.lit("mine")})
    got: dict[int, list] = {}
    for r in nearest.nearest(df, F.col("vec_id") % 20 == 0, k=5, cell_vectors=64, cell_queries=8).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    good = {i: np.array(v, float) for i, v in rows if i is not None and i < 400 and v}
    for q in [i for i in good if i % 20 == 0]:
        score = {i: float((v * good[q]).sum()) for i, v in good.items() if i != q}
        assert [v for v, _ in got[q]] == sorted(score, key=lambda i: (-score[i], i))[:5]
    assert got[420] == [(440, 4.0)] and got[440] == [(420, 4.0)]
    assert not set(got) & {400, 402}
    assert nearest.nearest(empty(spark, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0).count() == 0


# decontamination

def test_wu_manber_equals_force():
    draw = random.Random(8)
    for _ in range(200):
        vocabulary = [w.encode() for w in "abcd"[:draw.randint(1, 4)]]
        length = draw.randint(1, 6)
        patterns = {tuple(draw.choices(vocabulary, k=length)): (i,) for i in range(draw.randint(1, 6))}
        text = draw.choices(vocabulary, k=draw.randint(0, 60))
        want = sorted((i, patterns[tuple(text[i:i + length])]) for i in range(len(text) - length + 1) if tuple(text[i:i + length]) in patterns)
        assert sorted(decontamination.WuManber(length, patterns).find(text)) == want


@pytest.mark.parametrize("most", [50_000_000, 40])
def test_contaminated(spark, most):
    items = [(1, "One two, three FOUR"), (1, "One two, three FOUR"), (2, "é-日本"), (3, None), (4, "..."), (None, "null item here"), (10, "one two three four five")]
    benchmark = frame(spark, items, "item_id long, text string")
    rows = [(1, "x one TWO three four five y", None, None), (2, "é 日本 z", None, None), (3, None, None, None), (4, "", None, None),
            (5, "null. item! here", None, None), (6, "one two three", None, None), (7, "w " * 200_000 + "one two three four", None, None)] * 2
    got = decontamination.contaminated_documents(with_clashes(frame(spark, rows)), benchmark, window=4, max_benchmark_chars=most).collect()
    found = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in got}
    assert len(got) == len(rows)
    assert found == {1: (7, 5, ["1", "10"], True), 2: (3, 2, ["2"], True), 3: (0, 0, [], False), 4: (0, 0, [], False),
                     5: (3, 3, ["null"], True), 6: (3, 0, [], False), 7: (200_004, 4, ["1", "10"], False)}
    none = decontamination.contaminated_documents(frame(spark, rows), frame(spark, [], "item_id long, text string"))
    assert {r.n_hit for r in none.collect()} == {0}
    assert decontamination.contaminated_documents(empty(spark), benchmark).count() == 0


def test_only_one_part_of_a_benchmark_is_held(spark, monkeypatch):
    """Whatever the benchmark's size, what the driver collects and tasks get at a time stays within the bound."""
    draw = random.Random(6)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(draw.choices(vocabulary, k=20))) for i in range(120)]
    texts = [(i, " ".join([*draw.choices(vocabulary, k=30), items[i % 120][1], items[(7 * i + 3) % 120][1]]), None, None) for i in range(150)]
    benchmark, docs = frame(spark, items, "item_id long, text string"), frame(spark, texts)
    whole = {r.doc_id: (r.n_words, r.n_hit, r.item_ids, [tuple(x) for x in r.hit_runs], r.contaminated)
             for r in decontamination.contaminated_documents(docs, benchmark).collect()}
    size, alive, most = sum(len(t) for _, t in items), [], []
    context = type(spark.sparkContext)
    real = context.broadcast

    def noting(self, value):
        out = real(self, value)
        if isinstance(value, list):
            alive.append(out)
            most.append(sum(len(t) for _, t in value))
            assert len(alive) == 1
            let_go = out.destroy
            out.destroy = lambda blocking=False: (alive.remove(out), let_go(blocking))
        return out

    monkeypatch.setattr(context, "broadcast", noting)
    got = decontamination.contaminated_documents(docs, benchmark, max_benchmark_chars=size // 10)
    assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids, [tuple(x) for x in r.hit_runs], r.contaminated) for r in got.collect()} == whole
    assert len(most) >= 10 and max(most) < 2.5 * size / 10 and not alive and sum(w[1] > 0 for w in whole.values()) == 150


def test_suffix_dedup_arguments(spark):
    docs = frame(spark, [("a", "text")], "doc_id string, text string")
    with pytest.raises(ValueError, match="no integer"):
        suffix_dedup.remove_repeats(docs)
    with pytest.raises(ValueError, match="1 to 32,767"):
        suffix_dedup.remove_repeats(empty(spark), least=40_000)


def test_suffixes_are_sorted_by_as_many_characters_as_asked():
    import numpy as np

    from layerwright.llm.bwt import long_groups, suffix_array

    draw = np.random.default_rng(5)
    for size, letters, depth in ((1, 2, 50), (9, 2, 50), (300, 2, 5), (300, 2, 20), (400, 1, 50), (500, 3, 50), (500, 200, 50)):
        for again in (1, 4):
            body = np.tile(draw.integers(1, letters + 1, size), again).astype(np.uint8)
            text = np.append(body, 0).astype(np.uint8)
            data = text.tobytes()
            order = suffix_array(text, depth)
            assert sorted(order.tolist()) == list(range(len(text)))
            heads = [data[i:i + depth] for i in order.tolist()]
            assert heads == sorted(heads)
            begins = long_groups(text, order, depth).tolist()
            assert begins == [i == 0 or heads[i] != heads[i - 1] for i in range(len(heads))]

"""Benchmark decontamination by Wu-Manber search over words.

The patterns are windows of consecutive item words. All patterns of one length are searched at once: a block is
the last two words under the window, a shift table says how far the window may move because no pattern has that block
any nearer to its end, and where the shift is zero a bucket of the patterns that end with this block is compared
directly. Blocks of words instead of characters keep the shifts long: a block that no item has moves on by almost a whole window.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import packed, unpacked
from layerwright.session import materialize

#: A-Z lower-cased; every other ASCII character but 0-9 and a-z separates words; bytes of other characters stay.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    r"""The words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of a text, A-Z lower-cased, as UTF-8."""
    return text.encode().translate(_WORD_BYTES).split() if text else []


class WuManber:
    """Finds all occurrences of word patterns of one length."""

    def __init__(self, length: int, patterns: dict[tuple[bytes, ...], tuple]) -> None:
        self.length, self.block = length, min(2, length)
        self.far = length - self.block + 1
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], tuple]]] = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block:end]
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            self.buckets[pattern[length - self.block:]].append((pattern, items))

    def find(self, text: list[bytes]) -> Iterator[tuple[int, tuple]]:
        """Start and items of each occurrence."""
        length, block, far, shift, n = self.length, self.block, self.far, self.shift, len(text)
        end = length
        while end <= n:
            key = tuple(text[end - block:end])
            move = shift.get(key, far)
            if move == 0:
                start = end - length
                for pattern, items in self.buckets[key]:
                    if text[start] == pattern[0] and tuple(text[start:end]) == pattern:
                        yield start, items
                move = 1
            end += move


def searchers(items: list[tuple[str, str | None]], window: int) -> list[WuManber]:
    """One searcher per pattern length: windows of ``window`` words, and whole items that are shorter."""
    by_length: dict[int, dict[tuple[bytes, ...], set]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        found = words(text)
        length = min(window, len(found))
        for i in range(len(found) - length + 1 if found else 0):
            by_length[length][tuple(found[i:i + length])].add(item)
    return [WuManber(n, {p: tuple(sorted(ids)) for p, ids in patterns.items()}) for n, patterns in sorted(by_length.items())]


def hits(text: str | None, search: list[WuManber]) -> tuple[int, int, list[str], list[tuple[int, int]]]:
    """Number of words, of hit words, the items found, and the runs of hit words (from, to)."""
    found = words(text)
    spans, items = [], set()
    for searcher in search:
        for start, ids in searcher.find(found):
            spans.append((start, start + searcher.length))
            items.update(ids)
    runs: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return len(found), sum(e - s for s, e in runs), sorted(items), runs


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", *, item_col: str = "item_id",
                           item_text_col: str = "text", window: int = 13, least_share: int = 20,
                           max_benchmark_chars: int = 2_000_000) -> DataFrame:
    """``docs`` plus ``n_words, n_hit, item_ids, hit_runs, contaminated``.

    A document word inside an occurrence of a window of an item is hit; a document is contaminated when it has hits and
    ``least_share * n_hit >= n_words``. An item of fewer words than a window is one window; an item without words
    has none. ``item_ids`` are strings in code point order, ``hit_runs`` runs of words (from, to). Null and empty texts
    have no words and are clean. Items of a null id count as item ``null``, repeated items once; an empty benchmark hits
    nothing. Columns of the input with these names are replaced.

    The benchmark goes to every task, as tables of about a hundred times its size, so that is looked at first: beyond ``max_benchmark_chars`` it is
    searched in parts of about that size (an item is never cut), one after the other: each is collected, searched for in all texts and let go
    before the next, and what the parts have found of a row is put together in the end.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("null")).alias("item"),
                             F.coalesce(F.col(f"`{item_text_col}`"), F.lit("")).alias("text")).distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = -(-size // max_benchmark_chars) or 1
    if parts == 1:
        patterns = spark.sparkContext.broadcast([tuple(r) for r in items.collect()])
        found = packed(docs).select("row", _searching(patterns, window)(f"row.`{text_col}`").alias("found"))
        out = found.select("row", "found.*")
    else:
        out = _by_parts(packed(docs), items, text_col, parts, window)
    hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    out = out.withColumn("n_hit", hit)
    enough = F.lit(least_share) * F.col("n_hit") >= F.col("n_words")
    return unpacked(out, docs.columns, n_words=F.col("n_words"), n_hit=F.col("n_hit"), item_ids=F.col("item_ids"),
                    hit_runs=F.col("hit_runs"), contaminated=(F.col("n_hit") > 0) & enough)


def _by_parts(base: DataFrame, items: DataFrame, text_col: str, parts: int, window: int) -> DataFrame:
    """``row, n_words, item_ids, hit_runs``, the benchmark searched part by part. Only what is found waits, written, for the other parts."""
    spark = base.sparkSession
    numbered = materialize(base.withColumn("no", F.monotonically_increasing_id()), "numbered")
    found = counts = None
    for part in range(parts):
        own = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        patterns = spark.sparkContext.broadcast([tuple(r) for r in own.collect()])
        searched = numbered.select("no", _searching(patterns, window)(f"row.`{text_col}`").alias("found")).select("no", "found.*")
        if part:
            searched = materialize(searched.filter(F.size("item_ids") > 0), "found")
        else:  # the first part counts the words, too
            searched = materialize(searched, "found")
            counts = searched.select("no", "n_words")
        patterns.destroy()
        hits_of = searched.filter(F.size("item_ids") > 0).select("no", "item_ids", "hit_runs")
        found = hits_of if found is None else found.unionByName(hits_of)
    together = found.groupBy("no").agg(F.flatten(F.collect_list("item_ids")).alias("item_ids"), F.flatten(F.collect_list("hit_runs")).alias("hit_runs"))
    runs = F.coalesce("hit_runs", F.array().cast("array<struct<start:int,end:int>>"))
    ids = F.coalesce("item_ids", F.array().cast("array<string>"))
    joined = numbered.join(counts, "no").join(together, "no", "left")
    return joined.select("row", "n_words", F.array_sort(F.array_distinct(ids)).alias("item_ids"), _merged_runs(runs).alias("hit_runs"))


def _searching(patterns, window: int):
    """The search for the broadcast items as a column function; the tables are built once per task."""

    @F.arrow_udf("n_words long, item_ids array<string>, hit_runs array<struct<start:int,end:int>>")
    def search(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tables = searchers(patterns.value, window)
        kind = pa.struct([("n_words", pa.int64()), ("item_ids", pa.list_(pa.string())),
                          ("hit_runs", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])
        for texts in batches:
            rows = []
            for text in texts:
                n, _, ids, runs = hits(text.as_py(), tables)
                rows.append({"n_words": n, "item_ids": ids, "hit_runs": [{"start": s, "end": e} for s, e in runs]})
            yield pa.array(rows, kind)

    return search


def _merged_runs(runs: Column) -> Column:
    """Runs that touch or overlap as one."""
    def add(done: Column, run: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (run["start"] <= F.get(done, F.size(done) - 1)["end"])
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], run["end"]).alias("end"))
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider))).otherwise(F.concat(done, F.array(run)))

    return F.aggregate(F.array_sort(runs), F.array().cast("array<struct<start:int,end:int>>"), add)

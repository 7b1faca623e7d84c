"""Ranked lexical search: a hybrid of term-at-a-time and document-at-a-time evaluation.

Documents are cut into segments with posting lists for the words that the queries ask for; counts over all segments give
the words' weights. In a segment a query's short lists are summed at once, into accumulators. These then stand as one more
list beside the long ones, with their greatest sum as its bound: a block of documents after the other, lists whose bounds
together cannot reach the k-th best score so far are not walked but only looked up, for the documents that still can.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.llm.decontamination import words
from layerwright.session import materialize

SEGMENT = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("terms", pa.list_(pa.int32())), ("dfs", pa.list_(pa.int64())),
                     ("ids", pa.binary()), ("sizes", pa.binary()), ("places", pa.binary()), ("tfs", pa.binary())])
SEGMENT_DDL = "n_docs long, n_terms long, terms array<int>, dfs array<long>, ids binary, sizes binary, places binary, tfs binary"
#: Stands for a missing id, which comes after all others.
NO_ID = np.iinfo(np.int64).max


def segment(ids: np.ndarray, texts: list[str | None], vocabulary: dict[bytes, int]) -> dict:
    """Posting lists of the documents, for the words of the vocabulary: by word, then by place in the segment."""
    sizes = np.zeros(len(texts), np.int64)
    keys = [np.empty(0, np.int64)]
    for place, text in enumerate(texts):
        found = words(text)
        sizes[place] = len(found)
        asked = [vocabulary[w] for w in found if w in vocabulary]
        if asked:
            keys.append(np.array(asked, np.int64) * len(texts) + place)
    key, tfs = np.unique(np.concatenate(keys), return_counts=True)
    terms, dfs = np.unique(key // max(1, len(texts)), return_counts=True)
    return {"n_docs": int((sizes > 0).sum()), "n_terms": int(sizes.sum()), "terms": terms.astype(np.int32), "dfs": dfs,
            "ids": ids.tobytes(), "sizes": sizes.tobytes(), "places": (key % max(1, len(texts))).astype(np.int32).tobytes(),
            "tfs": tfs.astype(np.int32).tobytes()}


class Postings:
    """A segment's lists with the share of a score that each posting is worth, before the word's weight."""

    def __init__(self, row: dict, n_docs: int, n_terms: int, k1: int, b: int) -> None:
        self.ids, sizes = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["sizes"], np.int64)
        length = 100 - b + b * sizes * n_docs // max(1, n_terms)
        self.places, tfs = np.frombuffer(row["places"], np.int32), np.frombuffer(row["tfs"], np.int32).astype(np.int64)
        self.worth = 1_000_000_000 * tfs // (1000 * tfs + k1 * length[self.places])
        ends = np.cumsum(row["dfs"])
        starts = ends - row["dfs"]
        most = np.maximum.reduceat(self.worth, starts) if len(starts) else []
        self.lists = {int(t): (int(s), int(e), int(m)) for t, s, e, m in zip(row["terms"], starts, ends, most, strict=True)}


class Best:
    """The k best documents so far of a query; equal scores by smaller id."""

    def __init__(self, k: int) -> None:
        self.k, self.ids, self.scores = k, np.empty(0, np.int64), np.empty(0, np.int64)

    @property
    def least(self) -> int:
        """A document with a smaller score can't come in."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
        order = np.lexsort((ids, -scores))[:self.k]
        self.ids, self.scores = ids[order], scores[order]


def search_segment(postings: Postings, query: list[tuple[int, int]], best: Best, short_share: float = 0.25, block: int = 2_048) -> None:
    """Adds a segment's documents to a query's best. ``query`` has its words' numbers and weights, repeats added up."""
    present = sorted(((*postings.lists[t], w) for t, w in query if t in postings.lists and w > 0), key=lambda x: (x[1] - x[0], x[0]))
    if not present:
        return
    n = len(postings.ids)
    # Term at a time: the short lists, up to a share of the segment's documents together.
    sums, used, summed = np.zeros(n, np.int64), 0, 0
    for start, end, _, weight in present:
        if summed + end - start > short_share * n:
            break
        sums[postings.places[start:end]] += weight * postings.worth[start:end]
        summed += end - start
        used += 1
    lists = [(most * weight, postings.places[start:end], postings.worth[start:end], weight) for start, end, most, weight in present[used:]]
    if used:
        places = np.flatnonzero(sums)
        lists.append((int(sums[places].max()), places, sums[places], 1))
    # Document at a time over the accumulators and the long lists, by falling bound.
    lists.sort(key=lambda x: -x[0])
    rest = [0] * (len(lists) + 1)
    for i in range(len(lists) - 1, -1, -1):
        rest[i] = rest[i + 1] + lists[i][0]
    for first in range(0, n, block):
        least = best.least
        if rest[0] < least:
            return
        walked = next(i for i in range(len(lists) + 1) if rest[i] < least)  # the others together are too little
        scores = np.zeros(min(block, n - first), np.int64)
        for _, places, worth, weight in lists[:walked]:
            low, high = np.searchsorted(places, (first, first + block))
            scores[places[low:high] - first] += weight * worth[low:high]
        here = np.flatnonzero(scores)
        scores = scores[here]
        for i in range(walked, len(lists)):
            able = scores + rest[i] >= least
            here, scores = here[able], scores[able]
            if not len(here):
                break
            _, places, worth, weight = lists[i]
            at = np.minimum(np.searchsorted(places, here + first), len(places) - 1)
            scores = scores + np.where(places[at] == here + first, weight * worth[at], 0)
        able = scores >= least
        if able.any():
            best.add(postings.ids[here[able] + first], scores[able])


def weight_of(df: int, n_docs: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", *, k: int = 10, k1: int = 8, b: int = 75, segment_docs: int = 8_192,
                  max_item_chars: int = 20_000_000) -> DataFrame:
    r"""``item, rank, id, score``: the ``k`` documents of the highest score above 0 for each item, all if there are fewer.

    Words are ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+``, A-Z lower-cased, of whole texts. With N documents that have a word, L words in them, n in a
    document, and df documents with a word, the weight is w = floor(1000 ln((2N+2)/(2df+1))) and a document's length m = 100-b +
    b*n*N div L; a score is the sum over the item's words, repeats included, of w * (10^9 tf div (1000 tf + k1*m)) in 64-bit integers.

    Equal scores go by smaller id. Null and empty texts have no words and come into no result. Each row is a document of its own, so a repeated
    id may be named twice; a document without id counts, and comes after equal scores with one. Rows of one item id,
    a null one too, are one item. No documents or no items give no rows. Other columns are not looked at.

    Items go to every task, so their size is looked at first: beyond ``max_item_chars`` they are searched in blocks of
    about that size, one after the other. ``k1`` is in tenths, ``b`` in hundredths.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item"), F.coalesce(F.col(f"`{item_text_col}`"), F.lit("")).alias("text"))
    size = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-size // max_item_chars) or 1
    found = None
    for number in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()
        part = _search_block(rows, own, asked.schema["item"].dataType, k, k1, b, segment_docs)
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("no", "item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("item", "rank", "id", "score")


def _search_block(rows: DataFrame, own: list, kind: T.DataType, k: int, k1: int, b: int, segment_docs: int) -> DataFrame:
    """The best documents of each task for a block of items, with the item's number and id."""
    spark = rows.sparkSession
    by_item: dict = {}
    for row in own:
        by_item.setdefault(row["item"], Counter()).update(words(row["text"]))
    vocabulary = {w: i for i, w in enumerate(sorted({w for counts in by_item.values() for w in counts}))}
    shared = spark.sparkContext.broadcast(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, segment_docs):
                piece = batch.slice(first, segment_docs)
                ids = piece.column("id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_pylist([segment(ids, piece.column("text").to_pylist(), shared.value)], SEGMENT)

    segments = materialize(rows.mapInArrow(cut, SEGMENT_DDL), "segments")
    total = segments.agg(F.sum("n_docs").alias("docs"), F.sum("n_terms").alias("terms")).first()
    n_docs, n_terms = total["docs"] or 0, total["terms"] or 0
    pairs = segments.select(F.explode(F.arrays_zip("terms", "dfs")).alias("pair"))
    dfs = {r["term"]: r["df"] for r in pairs.groupBy(F.col("pair.terms").alias("term")).agg(F.sum("pair.dfs").alias("df")).collect()}
    queries = [[(vocabulary[w], count * weight_of(dfs[vocabulary[w]], n_docs)) for w, count in sorted(counts.items()) if vocabulary[w] in dfs]
               for counts in by_item.values()]
    plan = spark.sparkContext.broadcast(queries)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in plan.value]
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in ("ids", "sizes", "places", "tfs")}
                row |= {name: batch.column(name)[at].values.to_numpy() for name in ("terms", "dfs")}
                postings = Postings(row, n_docs, n_terms, k1, b)
                for query, kept in zip(plan.value, best, strict=True):
                    search_segment(postings, query, kept)
        numbers = np.repeat(np.arange(len(best)), np.array([len(x.ids) for x in best], np.int64))
        columns = [np.concatenate([np.empty(0, np.int64), *[getattr(x, name) for x in best]]) for name in ("ids", "scores")]
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), *map(pa.array, columns)], names=["no", "id", "score"])

    names = spark.createDataFrame([(i, item) for i, item in enumerate(by_item)],
                                  T.StructType([T.StructField("no", T.LongType()), T.StructField("item", kind)]))
    found = segments.select("ids", "sizes", "places", "tfs", "terms", "dfs").mapInArrow(search, "no long, id long, score long")
    return found.withColumn("id", F.nullif("id", F.lit(int(NO_ID)))).join(F.broadcast(names), "no")

"""An interpolated modified Kneser-Ney model of words, counted in Spark and mapped by the workers that score.

Words are numbered by their place among the sorted hashes of all words, which are written first; an n-gram is the hash of its words'
numbers. Tasks count the n-grams of their documents and deal them to shards by the n-gram's own hash, so no frequent word
or context makes a shard large. A shard adds up its n-grams, writes them as sorted arrays to the shared folder and hands on what it
adds to the next lower order: sums of contexts and the numbers of different words before. Workers that look n-grams up sort theirs, too, and
go through the arrays shard by shard, mapped into memory one at a time.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.llm.common import finished, packed, unpacked
from layerwright.llm.shingles import mix, word_hashes
from layerwright.session import materialize, new_work_path

#: Numbers of what stands before a text and after it and of a word that was never seen; others follow. The hash of the empty n-gram.
BEGIN, END, UNSEEN, FIRST = 0, 1, 2, 3
EMPTY = np.uint64(0x8C2F9A1D6E0B3F57)
#: Numbers of an n-gram, added up over tasks: different words before it, occurrences, and as a context: the sum of its
#: followers' counts and how many of them count one, two, and more.
COUNTS = ("adjusted", "raw", "follow", "ones", "twos", "more")
NUMBERS = ("n_grams", "total", "raw_total", "c1", "c2", "c3", "c4", "more")
#: Discounts of counts one, two and more where the counts of counts give none.
USUAL = (0.5, 1.0, 1.5)


def gram_hash(words: list[np.ndarray]) -> np.ndarray:
    """The hash of n-grams given by their first, second ... words."""
    out = np.full(len(words[0]), EMPTY)
    for word in words:
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + word.astype(np.uint64))
    return out


def tokens(texts: list[np.ndarray], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all texts' words, given by hashes, one behind the other, each text between begins and one end; and the texts' ends."""
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes + model.order)
    out = np.full(int(ends[-1]) if len(ends) else 0, BEGIN, model.number)
    out[ends - 1] = END
    words = np.concatenate([np.empty(0, np.uint64), *texts])
    out[np.arange(len(words)) + np.repeat(ends - 1 - np.cumsum(sizes), sizes)] = model.numbers_of(words)
    return out, ends


def added_up(words: list[np.ndarray], counts: dict[str, np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], dict[str, np.ndarray]]:
    """Sorted hashes of the different n-grams, their words, and sums of the counts."""
    key = gram_hash(words)
    by_key = np.argsort(key)
    key = key[by_key]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, np.int64)
    total = {name: np.add.reduceat(c[by_key], first) if len(first) else c for name, c in counts.items()}
    return key[first], [w[by_key[first]] for w in words], total


def smallest(values: np.ndarray) -> np.ndarray:
    return values.astype(np.min_scalar_type(int(values.max(initial=0))))


def dealt(key: np.ndarray, words: list[np.ndarray], counts: dict[str, np.ndarray], shards: int, level: int) -> Iterator[dict]:
    """A row for each shard: the n-grams whose hashes fall into its range."""
    edges = np.searchsorted(shard_of(key, shards), np.arange(shards + 1))
    for shard in np.flatnonzero(edges[1:] > edges[:-1]):
        part = slice(edges[shard], edges[shard + 1])
        kept = {name: smallest(c[part]) for name, c in counts.items()}
        yield {"level": level, "shard": int(shard), "words": [w[part].tobytes() for w in words],
               "names": list(kept), "counts": [c.tobytes() for c in kept.values()], "kinds": [c.dtype.str for c in kept.values()]}


BLOB_DDL = "level int, shard int, words array<binary>, names array<string>, counts array<binary>, kinds array<string>"
BLOB = pa.schema([("level", pa.int32()), ("shard", pa.int32()), ("words", pa.list_(pa.binary())), ("names", pa.list_(pa.string())),
                  ("counts", pa.list_(pa.binary())), ("kinds", pa.list_(pa.string()))])
DONE_DDL = "numbers array<long>, " + BLOB_DDL
DONE = pa.schema([("numbers", pa.list_(pa.int64())), *BLOB])


def shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hashes' upper halves, in order."""
    return ((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def hashed(batches: Iterator[pa.RecordBatch], batch_tokens: int) -> Iterator[list[np.ndarray]]:
    """The hashes of the words of a task's texts, for about ``batch_tokens`` words at a time."""
    held, size = [], 0
    for batch in batches:
        for text in batch.column(0):
            held.append(word_hashes(text.as_py() or ""))
            size += len(held[-1]) + 1
            if size >= batch_tokens:
                full, held, size = held, [], 0
                yield full
                del full
    if held:
        yield held


def list_words(batches: Iterator[pa.RecordBatch], shards: int, batch_tokens: int) -> Iterator[pa.RecordBatch]:
    """The different words of a task's documents."""
    for texts in hashed(batches, batch_tokens):
        words = np.sort(np.concatenate(texts))
        words = words[np.r_[True, words[1:] != words[:-1]]] if len(words) else words
        yield pa.RecordBatch.from_pylist(list(dealt(words, [words], {}, shards, 0)), BLOB)


def count_tokens(batches: Iterator[pa.RecordBatch], model: Model, batch_tokens: int) -> Iterator[pa.RecordBatch]:
    """The n-grams of the highest order in a task's documents."""
    for texts in hashed(batches, batch_tokens):
        words, _ = model.grams(tokens(texts, model)[0])
        texts.clear()
        key, words, counts = added_up(words, {"adjusted": np.ones(len(words[0]), np.int64)})
        yield pa.RecordBatch.from_pylist(list(dealt(key, words, counts | {"raw": counts["adjusted"]}, model.shards, model.order)), BLOB)


def write_array(folder: str, name: str, values: np.ndarray) -> None:
    """A file in the shared folder, there as a whole or not at all: a task that is run again writes the same."""
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        np.save(out, values)
    os.replace(part, f"{folder}/{name}.npy")


def write_words(table: pa.Table, folder: str) -> pa.Table:
    """Writes a shard's words as a sorted array; gives how many there are."""
    words = np.unique(np.concatenate([np.frombuffer(parts[0], np.uint64) for parts in table.column("words").to_pylist()]))
    shard = table.column("shard")[0].as_py()
    write_array(folder, f"0-{shard}-key", words)
    return pa.Table.from_pylist([{"numbers": [len(words)], "level": 0, "shard": shard}], DONE)


def add_shard(table: pa.Table, model: Model, level: int) -> pa.Table:
    """Writes a shard's n-grams as sorted arrays; gives its numbers and what it adds to the next lower order."""
    folder, shards, order = model.folder, model.shards, model.order
    rows = table.to_pylist()
    words = [np.concatenate([np.frombuffer(r["words"][i], model.number) for r in rows]) for i in range(level)]
    names = COUNTS[:2] if level == order else COUNTS
    counts: dict[str, list[np.ndarray]] = {name: [] for name in names}
    for r in rows:
        size = len(r["words"][0]) // model.number.itemsize
        own = {n: np.frombuffer(c, np.dtype(k)) for n, c, k in zip(r["names"], r["counts"], r["kinds"], strict=True)}
        for name in names:
            counts[name].append(own.get(name, np.zeros(size, np.int64)).astype(np.int64))
    key, words, total = added_up(words, {name: np.concatenate(parts) for name, parts in counts.items()})
    if 1 < level < order:  # nothing stands before a text, so what begins with its begin is counted as it occurs
        total["adjusted"] = np.where(words[0] == BEGIN, total["raw"], total["adjusted"])
    adjusted, raw = total["adjusted"], total["raw"]
    shard = rows[0]["shard"]
    write_array(folder, f"{level}-{shard}-key", key)
    for name in names:
        if level == 1 or name != "raw":
            write_array(folder, f"{level}-{shard}-{name}", smallest(total[name]))
    real = adjusted > 0
    counted = adjusted[real]
    numbers = [int(real.sum()), int(counted.sum()), int(raw.sum()), *(int((counted == c).sum()) for c in (1, 2, 3, 4)), int((counted > 2).sum())]
    out = [{"numbers": numbers, "level": level, "shard": shard}]
    if level > 1:
        words, raw = [w[real] for w in words], raw[real]
        one = np.ones(len(counted), np.int64)
        follow = {"follow": counted, "ones": (counted == 1).astype(np.int64), "twos": (counted == 2).astype(np.int64), "more": (counted > 2).astype(np.int64)}
        as_context = added_up(words[:-1], follow)
        as_suffix = added_up(words[1:], {"adjusted": one, "raw": raw})
        for part in (as_context, as_suffix):
            out += dealt(*part, shards, level - 1)
    return pa.Table.from_pylist(out, DONE)


@dataclass(frozen=True)
class Level:
    """Numbers over all n-grams of an order."""

    n_grams: int = 0
    total: int = 0
    raw_total: int = 0
    c1: int = 0
    c2: int = 0
    c3: int = 0
    c4: int = 0
    more: int = 0

    @property
    def discounts(self) -> tuple[float, float, float]:
        """What is taken off counts of one, two and more, by the counts of counts."""
        if not (self.c1 and self.c2 and self.c3 and self.c4):
            return USUAL
        y = self.c1 / (self.c1 + 2 * self.c2)
        found = (1 - 2 * y * self.c2 / self.c1, 2 - 3 * y * self.c3 / self.c2, 3 - 4 * y * self.c4 / self.c3)
        return found if all(0 < d <= i for i, d in enumerate(found, 1)) else USUAL


@dataclass
class Model:
    """Where the arrays are, the number of each shard's first word, and the numbers of each order."""

    folder: str
    order: int
    shards: int
    starts: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    levels: dict[int, Level] = field(default_factory=dict)

    @property
    def number(self) -> np.dtype:
        """The type of words' numbers."""
        return np.dtype(np.uint32 if self.starts[-1] < 1 << 32 else np.uint64)

    def numbers_of(self, words: np.ndarray) -> np.ndarray:
        """The numbers of words given by their hashes."""
        asked, place = np.unique(words, return_inverse=True)
        out = np.full(len(asked), UNSEEN, self.number)
        for shard, part in self._by_shard(asked):
            known = np.load(f"{self.folder}/0-{shard}-key.npy", mmap_mode="r")
            at = np.minimum(np.searchsorted(known, asked[part]), len(known) - 1)
            out[part] = np.where(known[at] == asked[part], self.starts[shard] + at, UNSEEN)
        return out[place]

    def grams(self, found: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The words of the n-grams of the highest order that end with a token of a text, and where these end."""
        real = np.flatnonzero(found[self.order - 1:] != BEGIN) + self.order - 1
        return [found[real - self.order + 1 + i] for i in range(self.order)], real

    def _by_shard(self, asked: np.ndarray, level: int = 0) -> Iterator[tuple[int, slice]]:
        """The shards that have an array of a level, each with its stretch of sorted hashes."""
        edges = np.searchsorted(shard_of(asked, self.shards), np.arange(self.shards + 1))
        for shard in np.flatnonzero(edges[1:] > edges[:-1]):
            if os.path.exists(f"{self.folder}/{level}-{shard}-key.npy"):  # else nothing of the corpus is in its range
                yield int(shard), slice(edges[shard], edges[shard + 1])

    def look_up(self, level: int, key: np.ndarray, names: tuple[str, ...]) -> dict[str, np.ndarray]:
        """Counts of n-grams by hash, 0 where there are none. Arrays are mapped shard by shard and let go."""
        asked, place = np.unique(key, return_inverse=True)
        out = {name: np.zeros(len(asked), np.int64) for name in names}
        for shard, part in self._by_shard(asked, level):
            stem = f"{self.folder}/{level}-{shard}-"
            known = np.load(f"{stem}key.npy", mmap_mode="r")
            at = np.minimum(np.searchsorted(known, asked[part]), len(known) - 1)
            hit = np.flatnonzero(known[at] == asked[part])
            for name in names:
                if os.path.exists(f"{stem}{name}.npy"):
                    out[name][part.start + hit] = np.load(f"{stem}{name}.npy", mmap_mode="r")[at[hit]]
        return {name: values[place] for name, values in out.items()}


def _mounted(path: str) -> str:
    """A folder of the shared file system as a path that tasks can map files of."""
    parsed = urlparse(path)
    if parsed.scheme not in ("", "file"):
        raise ValueError(f"workers map the model's files, so they must reach its folder as a path; {path} is none: give model_dir")
    return parsed.path


def train(docs: DataFrame, text_col: str = "text", *, order: int = 2, model_dir: str | None = None, shard_bytes: int = 16_000_000,
          batch_tokens: int = 1_000_000) -> Model:
    """A model of the words of all texts, A-Z lower-cased, each text ended by a token of its own.

    Every n-gram of every text is kept: none is pruned. Null and empty texts are one end. No documents give a model that
    knows nothing. Repeated rows count as often as they come; a text of any length is read as a whole, its n-grams are counted in parts.

    The arrays are written by tasks to a new folder under ``model_dir``, by default the shared folder, which workers must reach as a path. A
    shard has the n-grams of about ``shard_bytes`` of text.
    """
    if order < 2:
        raise ValueError("the order is 2 at least")
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    folder = _mounted(f"{model_dir.rstrip('/')}/kneser-ney-{uuid.uuid4().hex}" if model_dir else new_work_path(spark, "kneser-ney"))
    os.makedirs(folder)
    model = Model(folder, order, shards)
    listed = texts.mapInArrow(lambda batches: list_words(batches, shards, batch_tokens), BLOB_DDL)
    sizes = _shards(spark, listed, lambda table: write_words(table, folder)).select("shard", F.get("numbers", F.lit(0)).alias("n"))
    starts = np.full(shards + 1, FIRST, np.int64)
    for row in sizes.collect():
        starts[row["shard"] + 1:] += row["n"]
    model.starts = starts
    blobs = texts.mapInArrow(lambda batches: count_tokens(batches, model, batch_tokens), BLOB_DDL)
    for level in range(order, 0, -1):
        done = _shards(spark, blobs, lambda table, level=level: add_shard(table, model, level))
        sums = [F.coalesce(F.sum(F.get("numbers", F.lit(i))), F.lit(0)).alias(name) for i, name in enumerate(NUMBERS)]
        model.levels[level] = Level(**done.filter(F.col("numbers").isNotNull()).select("numbers").agg(*sums).first().asDict())
        blobs = done.filter(F.col("numbers").isNull()).drop("numbers")
    return model


def _shards(spark: SparkSession, blobs: DataFrame, work: Callable[[pa.Table], pa.Table]) -> DataFrame:
    """What ``work`` makes of each shard, written."""
    def run(table: pa.Table) -> pa.Table:
        return work(table)

    done = materialize(blobs.groupBy("shard").applyInArrow(run, DONE_DDL), "n-grams")
    finished(spark)
    return done


def log_probabilities(model: Model, texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """For each text: tokens, known tokens, log10 probability of the add-0.1 unigram model and of the model."""
    order = model.order
    found, ends = tokens([word_hashes(t or "") for t in texts], model)
    words, real = model.grams(found)
    unigrams = model.levels[1]
    lowest = model.look_up(1, gram_hash(words[-1:]), ("adjusted", "raw"))
    base = np.log10((lowest["raw"] + 0.1) / (unigrams.raw_total + 0.1 * (unigrams.n_grams + 1)))
    p = np.full(len(real), 1 / (unigrams.n_grams + 1))
    for n in range(1, order + 1):
        stats = model.levels[n]
        one, two, more = stats.discounts
        if n == 1:
            count = lowest["adjusted"]
            follow = np.full(len(real), float(stats.total))
            left = np.full(len(real), one * stats.c1 + two * stats.c2 + more * stats.more)
        else:
            count = model.look_up(n, gram_hash(words[-n:]), ("adjusted",))["adjusted"]
            context = model.look_up(n - 1, gram_hash(words[-n:-1]), ("follow", "ones", "twos", "more"))
            follow = context["follow"].astype(np.float64)
            left = one * context["ones"] + two * context["twos"] + more * context["more"]
        off = np.choose(np.minimum(count, 3), (0.0, one, two, more))
        seen = follow > 0
        p[seen] = (count[seen] - off[seen] + left[seen] * p[seen]) / follow[seen]
    text = np.searchsorted(ends, real, "right")
    n = len(texts)
    return (np.bincount(text, minlength=n), np.bincount(text, lowest["raw"] > 0, n).astype(np.int64),
            np.bincount(text, base, n), np.bincount(text, np.log10(p), n))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``n_tokens, n_known, train_tokens, base_score, score, perplexity``.

    Tokens are the words and one end; a known one occurs in the training texts. Scores are log10 probabilities of the whole text under
    add-0.1 unigrams and under the model; ``perplexity`` is per token. Null and empty texts are one end. Rows are scored one
    by one, so repeated ones give the same; an empty table gives an empty one. Columns of the input with these names are replaced.
    """
    kind = pa.struct([("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    @F.arrow_udf("n_tokens long, n_known long, base_score double, score double")
    def scored(texts: pa.Array) -> pa.Array:
        parts = [log_probabilities(model, part) for part in _chunks(texts)]
        columns = [pa.array(np.concatenate([p[i] for p in parts]) if parts else [], f.type) for i, f in enumerate(kind)]
        return pa.StructArray.from_arrays(columns, fields=list(kind))

    out = packed(docs).select("row", scored(F.col(f"row.`{text_col}`")).alias("found"))
    number = F.col("found.n_tokens")
    return unpacked(out, docs.columns, n_tokens=number, n_known=F.col("found.n_known"), train_tokens=F.lit(model.levels[1].raw_total).cast("long"),
                    base_score=F.col("found.base_score"), score=F.col("found.score"), perplexity=F.pow(F.lit(10.0), -F.col("found.score") / number))


def _chunks(texts: pa.Array, chars: int = 6_000_000) -> Iterator[list[str | None]]:
    """Texts in pieces of about so many characters at most, to bound the memory of a look-up."""
    held, size = [], 0
    for text in texts:
        value = text.as_py()
        held.append(value)
        size += len(value or "")
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held

"""N-gram Jaccard join by a token-group matrix: documents whose shingle sets are similar, and what they are connected with.

1. Equal sets are one class, whatever their number.
2. Candidates share a shingle among their rarest: the first ``n - ceil(s * n) + 1`` shingles of a set, in an order of hashes with
   frequent shingles last, of which two similar sets always have one in common. Only these are shuffled.
3. Similar classes are partitioned into groups: classes are compared with the first class that has the same rare
   shingle, and those that link are one group; others are grouped by that first class. Groups are cut into pieces.
4. The matrix of rare shingles and groups gives the pairs of groups to look at, whatever number of their classes share a shingle. Shingles as
   bits of a class and of a group's union bound how many of its shingles a class can have in common with the group: with fewer than any
   link needs the group stays closed. Members of open groups are bounded in the same way, and what is left is compared exactly, by the texts. Pairs that
   are connected already are not compared.

The frequent shingles only set the order, so which ones are listed has no influence on the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.common import discard, finished, packed, unpacked
from layerwright.llm.components import connected
from layerwright.llm.shingles import shingles, signature
from layerwright.session import materialize

#: A shingle in more classes than this goes to the end of the order, the most frequent ``MOST_FREQUENT`` of a round at most.
FREQUENT, MOST_FREQUENT, ROUNDS = 24, 2_000_000, 4
#: Rows of a frequent shingle are dealt to so many tasks.
SALTS = 64
PIECE, QUERIES = 16, 256
#: Shingles in a task that opens groups.
TASK_SHINGLES = 4_000_000
#: Of the first hashes of a set, this multiple of what the order needs at least is kept, as some turn out to be frequent.
SPARE = 3
MOST_BITS = 1 << 16


def needed(n: int, percent: int) -> int:
    """Shingles that a set of n must have in common with any set that it links with."""
    return -(-percent * n // 100)


def rarest(tokens: np.ndarray, n: int, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """The first shingles in the common order of a set of ``n``, which of them are frequent, and whether they are surely right.

    ``tokens`` are the first hashes of the set, sorted; where they are not all, so many may be frequent that more are needed.
    """
    length = n - needed(n, percent) + 1
    last = _among(tokens, frequent)
    plain = tokens[~last][:length]
    rest = tokens[last][:length - len(plain)]
    return np.concatenate([plain, rest]), np.arange(len(plain) + len(rest)) >= len(plain), len(plain) == length or len(tokens) == n


def _among(tokens: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return np.zeros(len(tokens), bool)
    at = np.searchsorted(frequent, tokens)
    return frequent[np.minimum(at, len(frequent) - 1)] == tokens


def _fold(tokens: np.ndarray) -> np.ndarray:
    """48 bits of sorted hashes, enough to find candidates by; the order stays."""
    return (tokens >> np.uint64(16)).astype(np.int64)


def _bits(tokens: np.ndarray) -> bytes:
    """A bit for each shingle, in a power of two of them: eight times as many as shingles at least in small sets, of which a few
    bits in common by chance would let many pairs through, four times as many in larger and twice as many in large ones, as long as that is not too many."""
    n = len(tokens)
    wanted = n * (8 if n <= 128 else 4 if n <= 512 else 2)
    size = 64
    while size < wanted and size < MOST_BITS:
        size *= 2
    out = np.zeros(size, bool)
    out[(tokens & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(out, bitorder="little").tobytes()


class Bits:
    """A set's bits as a whole number, folded to fewer bits on request."""

    __slots__ = ("size", "by_size")

    def __init__(self, size: int, value: int) -> None:
        self.size, self.by_size = size, {size: value}

    @classmethod
    def of(cls, data: bytes) -> Bits:
        return cls(len(data) * 8, int.from_bytes(data, "little"))

    def folded(self, size: int) -> int:
        if size not in self.by_size:
            wide = self.folded(size * 2)
            self.by_size[size] = (wide >> size) | (wide & ((1 << size) - 1))
        return self.by_size[size]

    def union(self, other: Bits) -> Bits:
        size = min(self.size, other.size)
        return Bits(size, self.folded(size) | other.folded(size))

    def most_shared(self, n: int, other: Bits) -> int:
        """How many of ``n`` shingles the other can have at most: each bit of its own that the other lacks is one that it can't."""
        size = min(self.size, other.size)
        own = self.folded(size)
        return n - own.bit_count() + (own & other.folded(size)).bit_count()


def _sets(base: DataFrame, size: int, percent: int) -> DataFrame:
    """``id, fp, n, c, half, low, bits``: each row's number of shingles and, where it has any, its set's signature and the
    first half of it, its first hashes and its bits."""

    @F.arrow_udf("n long, c binary, half long, low binary, bits binary")
    def describe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for text in texts:
                found = shingles(text.as_py(), size)
                n = len(found)
                if n:
                    key = signature(found)
                    low = _fold(found[:SPARE * (n - needed(n, percent) + 1) + 32]).astype("<i8").view(np.uint8).reshape(-1, 8)[:, :6]
                    rows.append((n, key, _half(key), low.tobytes(), _bits(found)))
                else:
                    rows.append((0, None, None, None, None))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["n", "c", "half", "low", "bits"])

    return base.select("id", "fp", describe("text").alias("set")).select("id", "fp", "set.*")


def _low(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<i8")[:, 0]


def _half(key: bytes) -> int:
    return int(np.frombuffer(key[:8], np.int64)[0])


def _frequent(sets: DataFrame, percent: int) -> np.ndarray:
    """Shingles to put last, sorted: found in rounds, as those put last bring others to the front.

    A round counts only what it has brought to the front. At most ``ROUNDS * MOST_FREQUENT`` hashes come to the driver.
    """
    spark = sets.sparkSession
    known, before = np.empty(0, np.int64), None
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast((known, before))

        def count(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            last, earlier = shared.value
            for batch in batches:
                seen, out = set(), []
                for n, key, low in zip(*(batch.column(c).to_pylist() for c in ("n", "c", "low")), strict=True):
                    if key not in seen:
                        seen.add(key)
                        tokens = _low(low)
                        first = rarest(tokens, n, last, percent)[0]
                        out.append(first if earlier is None else np.setdiff1d(first, rarest(tokens, n, earlier, percent)[0], True))
                tokens, n = np.unique(np.concatenate(out) if out else np.empty(0, np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(n.astype(np.int32))], names=["token", "n"])

        found = sets.filter("c IS NOT NULL").select("n", "c", "low").mapInArrow(count, "token long, n int")
        new = materialize(found.groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") > FREQUENT), "frequent")
        finished(spark)
        if new.count() > MOST_FREQUENT:
            new = new.orderBy(F.desc("n"), "token").limit(MOST_FREQUENT)
        new = new.select("token").toPandas()
        if not len(new):
            break
        known, before = np.union1d(known, new["token"].to_numpy(np.int64)), known
    return known


def _rare_rows(sets: DataFrame, base: DataFrame, classes: DataFrame, size: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """``token, salt, c, n``: the rarest shingles of each set. ``c`` is the first half of the signature; salt 0 is for those not frequent.

    Sets so full of frequent shingles that their first hashes don't do are made again from the text, one of each class.
    """
    shared = sets.sparkSession.sparkContext.broadcast(frequent)

    def rows_of(found: list[tuple[int, bytes, np.ndarray]]) -> tuple[list[np.ndarray], list[bytes]]:
        seen: set[bytes] = set()
        parts, short = [], []
        for n, key, tokens in found:
            if key in seen:
                continue
            seen.add(key)
            first, last, right = rarest(tokens, n, shared.value, percent)
            if not right:
                short.append(key)
                continue
            half = _half(key)
            parts.append(np.stack([first, np.where(last, 1 + half % SALTS, 0), np.full(len(first), half), np.full(len(first), n)]))
        return parts, short

    def table(parts: list[np.ndarray]) -> pa.RecordBatch:
        whole = np.concatenate(parts, axis=1) if parts else np.empty((4, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(whole[0]), pa.array(whole[1].astype(np.int32)), pa.array(whole[2]), pa.array(whole[3].astype(np.int32))],
                                          names=["token", "salt", "c", "n"])

    def kept(batch: pa.RecordBatch) -> tuple[list[np.ndarray], list[bytes]]:
        columns = (batch.column(c).to_pylist() for c in ("n", "c", "low"))
        return rows_of([(n, key, _low(low)) for n, key, low in zip(*columns, strict=True)])

    def from_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield table(kept(batch)[0])

    def short_ones(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(kept(batch)[1], pa.binary())], names=["c"])

    def from_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text"):
                tokens = shingles(text.as_py(), size)
                found.append((len(tokens), signature(tokens), _fold(tokens)))
            yield table(rows_of(found)[0])

    kind, known = "token long, salt int, c long, n int", sets.filter("c IS NOT NULL").select("n", "c", "low")
    rows = known.mapInArrow(from_sets, kind)
    if not len(frequent):
        return rows
    short = materialize(known.mapInArrow(short_ones, "c binary").distinct(), "short")
    return rows.union(_chosen(base, classes.join(short, "c")).select("text").mapInArrow(from_texts, kind))


def _chosen(base: DataFrame, classes: DataFrame) -> DataFrame:
    """``c, half, text``: the text of one document of each class."""
    one = classes.select("c", "half", F.col("id").alias("one_id"), F.col("fp").alias("one_fp"))
    return base.join(one, F.col("id").eqNullSafe(F.col("one_id")) & (F.col("fp") == F.col("one_fp"))).select("c", "half", "text")


def _near(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can be similar."""
    return F.least(a, b) * F.lit(100) >= F.greatest(a, b) * F.lit(percent)


def _bounded(asked: DataFrame, members: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """``a, b, n``: pairs (half signatures) of a class and a member of a group that it asks for which may be similar, and the size of ``a``.

    ``asked`` has ``g, c, n, label`` and ``members`` ``g, c, label``; equal labels are connected already. ``bits`` has ``half, n, bits``.
    Queries of a group that many ask for are dealt to several tasks, each with all members of the piece.
    """
    asked = written = materialize(asked, "asked")
    tasks = max(1, -(-(asked.agg(F.sum("n")).first()[0] or 0) // TASK_SHINGLES))
    per_group = asked.groupBy("g").agg(F.ceil(F.count("*") / F.lit(QUERIES)).cast("int").alias("parts"))
    asked = asked.drop("n").join(per_group, "g").withColumn("part", F.pmod(F.xxhash64("c"), F.col("parts")).cast("int"))
    held = members.join(per_group, "g").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    task = F.pmod(F.xxhash64("g", "part"), F.lit(tasks)).cast("int").alias("task")
    columns = [task, "g", "part", "c", "n", "label", "bits"]
    queries = asked.join(bits, F.col("c") == F.col("half")).select(*columns)
    held = held.join(bits, F.col("c") == F.col("half")).select(*columns)
    held = held.toDF(*held.columns)  # both sides read the same bits: columns of its own

    def open_groups(left: pa.Table, right: pa.Table) -> pa.Table:
        pieces: dict[tuple, tuple[list, list]] = {}
        known: dict[int, Bits] = {}
        for side, rows in enumerate((left, right)):
            for g, part, c, n, label, data in zip(*(rows.column(x).to_pylist() for x in ("g", "part", "c", "n", "label", "bits")), strict=True):
                if c not in known:
                    known[c] = Bits.of(data)
                pieces.setdefault((g, part), ([], []))[side].append((c, n, label, known[c]))
        pairs: dict[tuple[int, int], int] = {}
        for asking, group in pieces.values():
            if not asking or not group:
                continue
            union = group[0][3]
            for member in group[1:]:
                union = union.union(member[3])
            for c, n, label, own in asking:
                least = needed(n, percent)
                if own.most_shared(n, union) < least:
                    continue  # no member can be similar enough
                for other, m, its, theirs in group:
                    if its == label or other == c or min(n, m) * 100 < percent * max(n, m):
                        continue
                    # 100 * both >= percent * (n + m - both)
                    both = min(own.most_shared(n, theirs), theirs.most_shared(m, own))
                    if both * 100 >= percent * (n + m - both):
                        pairs[max(c, other), min(c, other)] = n if c > other else m
        found = sorted(pairs)
        return pa.table([*[pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], pa.array([pairs[x] for x in found], pa.int32())], names=["a", "b", "n"])

    found = queries.groupBy("task").cogroup(held.groupBy("task")).applyInArrow(open_groups, "a long, b long, n int").distinct()
    pairs = materialize(found, "pairs")
    finished(asked.sparkSession)
    discard(written)
    return pairs


def _links(pairs: DataFrame, base: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Links ``a, b`` (whole signatures) among the pairs, by the texts of one document of each class.

    Pairs are dealt by their second class, cut into parts where it has many.
    """
    written = pairs
    wanted = pairs.select(F.col("a").alias("half")).union(pairs.select("b")).distinct()
    texts = _chosen(base, classes.join(wanted, "half")).withColumnRenamed("c", "whole")
    texts = materialize(texts, "texts")
    finished(base.sparkSession)
    total = pairs.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, -(-total // TASK_SHINGLES))
    per_class = pairs.groupBy("b").agg(F.ceil(F.count("*") / F.lit(QUERIES)).cast("int").alias("parts"))
    pairs = pairs.join(per_class, "b").withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int"))
    held = per_class.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    task = F.pmod(F.xxhash64("b", "part"), F.lit(tasks)).cast("int").alias("task")
    left = pairs.join(texts, F.col("a") == F.col("half")).select(task, "b", "part", "whole", "text")
    right = held.join(texts, F.col("b") == F.col("half")).select(task, "b", "part", "whole", "text")
    right = right.toDF(*right.columns)

    def compare(queries: pa.Table, members: pa.Table) -> pa.Table:
        sets: dict[bytes, np.ndarray] = {}
        pieces: dict[tuple, tuple[list, list]] = {}
        for side, rows in enumerate((queries, members)):
            for b, part, whole, text in zip(*(rows.column(x) for x in ("b", "part", "whole", "text")), strict=True):
                key = whole.as_py()
                if key not in sets:
                    sets[key] = shingles(text.as_py(), size)
                pieces.setdefault((b.as_py(), part.as_py()), ([], []))[side].append(key)
        links = set()
        for asking, group in pieces.values():
            for query in asking:
                for member in group:
                    own, theirs = sets[query], sets[member]
                    both = _shared(own, theirs)
                    if query != member and both * 100 >= percent * (len(own) + len(theirs) - both):
                        links.add((max(query, member), min(query, member)))
        found = sorted(links)
        return pa.table([pa.array([x[i] for x in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

    links = left.groupBy("task").cogroup(right.groupBy("task")).applyInArrow(compare, "a binary, b binary").distinct()
    links = materialize(links, "links")
    finished(base.sparkSession)
    discard(written, texts)
    return links


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum())


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5, percent: int = 80) -> DataFrame:
    r"""``id, fp, n_shingles, component_id``: one row for each row of ``docs``; ``fp`` is a hash of the text.

    A text's set are its distinct shingles of ``words`` words (``[^\x20\x09-\x0D]+``, A-Z lower-cased); with fewer words the whole
    sequence is one. Documents link when 100 * intersection >= ``percent`` * union; ``component_id`` is the smallest
    id that links lead to, the own included. Null texts and texts without words have no set and are alone. The null id comes after all
    others: a component of nothing else has a null id. Rows that repeat an id are documents of their own with the same id. An empty
    table gives an empty table. Shingles are compared as 64-bit hashes.
    """
    spark = docs.sparkSession
    base = packed(docs, id=id_col, text=text_col).select("id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("fp"))
    sets = materialize(_sets(base, words, percent), "sets")
    one = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "fp")).alias("one")
    classes = sets.filter("c IS NOT NULL").groupBy("c", "half").agg(one, F.first("n").alias("n"), F.first("bits").alias("bits"))
    classes = materialize(classes.select("c", "half", "n", "bits", "one.id", "one.fp"), "classes")
    bits = classes.select("half", "n", "bits")
    frequent = _frequent(sets, percent)
    shared = materialize(_with_pivots(_rare_rows(sets, base, classes, words, percent, frequent)), "rare")
    finished(spark)
    stars = materialize(_stars(shared), "stars")

    near = stars.filter(_near("n", "pn", percent))
    asked = near.select(F.col("pc").alias("g"), "c", "n", F.col("c").cast("string").alias("label"))
    pivots = near.select(F.col("pc").alias("g"), F.col("pc").alias("c"), F.col("pc").cast("string").alias("label")).distinct()
    links = _links(_bounded(asked, pivots, bits, percent), base, classes, words, percent)

    # What is connected by now is a group; a class that is alone goes with the first class of one of its shingles.
    known = stars.select(F.col("c").alias("half")).union(stars.select("pc")).distinct().join(classes.select("half", F.col("c").alias("whole")), "half")
    labels = materialize(_groups(known, connected(links), stars), "groups")
    discard(stars)
    members = labels.select("g", F.col("half").alias("c"), "label")
    pairs = materialize(_group_pairs(shared, labels, percent), "group-pairs")
    finished(spark)
    discard(shared)
    asked = pairs.join(members, "g").join(classes.select("half", "n"), F.col("c") == F.col("half")).select(F.col("other").alias("g"), "c", "n", "label")
    more = _links(_bounded(asked, members, bits, percent), base, classes, words, percent)
    joined = connected(links.union(more))
    finished(spark)

    firsts = classes.join(joined, classes["c"] == joined["node"], "left").select("c", "id", F.coalesce("component", "c").alias("component"))
    least = firsts.groupBy("component").agg(F.min("id").alias("component_id"))
    found = materialize(firsts.join(least, "component").select(F.col("c").alias("class"), "component_id"), "components")
    out = sets.select("id", "fp", "n", "c").join(found, F.col("c") == F.col("class"), "left")
    component = F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "fp", F.col("n").alias("n_shingles"), component.alias("component_id"))


def _with_pivots(rows: DataFrame) -> DataFrame:
    """Rows whose shingle (frequent ones: of their salt) another class has too, with the first class that has it as ``pc, pn``."""
    over = Window.partitionBy("token", "salt")
    rows = rows.withColumns({"pivot": F.min(F.struct("c", "n")).over(over), "top": F.max("c").over(over)})
    rows = rows.filter((F.col("top") > F.col("pivot.c")) | (F.col("salt") > 0))
    return rows.select("token", "salt", "c", "n", F.col("pivot.c").alias("pc"), F.col("pivot.n").alias("pn"))


def _stars(shared: DataFrame) -> DataFrame:
    """Each class with the first class of each of its rare shingles; the first classes of a frequent one's salts with the first of all."""
    first = shared.filter("salt > 0 AND c = pc").select("token", "c", "n").distinct()
    over = first.groupBy("token").agg(F.min(F.struct("c", "n")).alias("pivot"))
    first = first.join(over, "token").select("c", "n", F.col("pivot.c").alias("pc"), F.col("pivot.n").alias("pn"))
    return shared.select("c", "n", "pc", "pn").union(first).filter("c <> pc").distinct()


def _groups(known: DataFrame, joined: DataFrame, stars: DataFrame) -> DataFrame:
    """``half, label, g``: what a class is connected with and its group, a piece of what is connected or of classes that share a first class."""
    labels = (known.join(joined, known["whole"] == joined["node"], "left").groupBy("half")
              .agg(F.min(F.hex(F.coalesce("component", "whole"))).alias("label"), F.max(F.col("component").isNotNull()).alias("linked")))
    homes = stars.groupBy(F.col("c").alias("half")).agg(F.min("pc").alias("pc"))
    home = F.when(F.col("linked"), F.col("label")).otherwise(F.coalesce("pc", "half").cast("string"))
    labels = labels.join(homes, "half", "left").select("half", "label", home.alias("home"))
    sizes = labels.groupBy("home").agg(F.ceil(F.count("*") / F.lit(PIECE)).cast("int").alias("pieces"))
    piece = F.pmod(F.xxhash64("half"), F.col("pieces"))
    return labels.join(sizes, "home").select("half", "label", F.xxhash64("home", piece).alias("g"))


def _group_pairs(shared: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """``g, other``: pairs of groups, a group with itself included, that have a rare shingle in common, sizes that fit, and are not wholly connected."""
    placed = shared.select("token", "c", "n").join(labels, F.col("c") == F.col("half"))
    matrix = placed.groupBy("token", "g").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                              F.min("n").alias("least"), F.max("n").alias("most"))
    matrix = materialize(matrix, "matrix")
    several = matrix.groupBy("token").agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low <> high").select("token")
    matrix = matrix.join(several, "token")
    others = matrix.select("token", *[F.col(c).alias(f"other_{c}") for c in ("g", "low", "high", "least", "most")])
    fits = (F.col("most") * 100 >= F.col("other_least") * percent) & (F.col("other_most") * 100 >= F.col("least") * percent)
    apart = (F.col("low") != F.col("other_high")) | (F.col("high") != F.col("other_low"))
    pairs = matrix.join(others, "token").filter((F.col("g") <= F.col("other_g")) & apart & fits)
    return pairs.select("g", F.col("other_g").alias("other")).distinct()


def similar_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` plus ``n_shingles`` and ``component_id`` of :func:`similar_sets`. Columns of the input with these names are replaced."""
    found = similar_sets(docs, id_col, text_col, words=words, percent=percent).dropDuplicates(["id", "fp"])
    base = packed(docs, id=id_col, fp=F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    out = base.join(found, base["id"].eqNullSafe(found["id"]) & (base["fp"] == found["fp"]), "left")
    return unpacked(out, docs.columns, n_shingles=F.col("n_shingles"), component_id=F.col("component_id"))

"""Runs of words that repeat with a period, found by common extensions over a difference cover.

A run of period q that is at least 4q words long covers several points of the grid of multiples of q. Grid points whose
next steps hold the same words are extended to both sides by longest common extensions, which give the run's ends at
once, whatever its length. An extension takes few words: positions are sampled by a difference cover, so any two positions reach sampled
ones by the same short walk; only sampled suffixes are sorted, and a sparse table over the common prefixes of neighbours
answers the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import packed, unpacked

#: A difference cover: every distance modulo MODULUS is the difference of two members.
MODULUS, COVER = 13, (0, 1, 3, 9)
LEAST_LENGTH, LEAST_EXPONENT = 6, 4
#: Grids up to this many words are kept by workers; longer texts go by blocks of the grid.
KEPT_WORDS, BLOCK = 1 << 17, 1 << 20


def _walks() -> np.ndarray:
    """The fewest steps that take two positions, by their remainders, to sampled ones."""
    out = np.zeros((MODULUS, MODULUS), np.int64)
    for i in range(MODULUS):
        for j in range(MODULUS):
            out[i, j] = next(d for d in range(MODULUS) if (i + d) % MODULUS in COVER and (j + d) % MODULUS in COVER)
    return out


WALKS = _walks()


class Extensions:
    """Longest common extensions to the right between any two places of a sequence of numbers from 1."""

    def __init__(self, words: np.ndarray) -> None:
        n = self.n = len(words)
        self.words = np.concatenate([words, np.zeros(MODULUS + 1, words.dtype)])
        sampled = np.flatnonzero(np.isin(np.arange(n) % MODULUS, COVER))
        ranks, order = self._sorted_suffixes(sampled)
        self.place = np.zeros(n + 1, np.int64)
        self.place[order] = np.arange(len(order))
        self.least = [self._common_prefixes(order, ranks)]
        while len(self.least[-1]) > (half := 1 << (len(self.least) - 1)):
            last = self.least[-1]
            self.least.append(np.minimum(last[:-half], last[half:]))

    def _sorted_suffixes(self, sampled: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Ranks of the sampled windows of MODULUS words, twice as many, and so on; and the sampled suffixes in order."""
        n, m = self.n, len(sampled)
        bits = max(1, int(self.words.max(initial=0)).bit_length())
        step = max(1, 63 // bits)
        keys = []
        for first in range(0, MODULUS, step):
            key = np.zeros(m, np.int64)
            for at in range(first, min(first + step, MODULUS)):
                key = (key << bits) | self.words[sampled + at]
            keys.append(key)
        ranks, width = [], MODULUS
        while True:
            by_key = np.lexsort(keys[::-1])
            new = np.zeros(m, bool)
            for key in keys:
                new[1:] |= key[by_key[1:]] != key[by_key[:-1]]
            rank = np.zeros(n + 1, np.int64)  # 0 beyond the end
            rank[sampled[by_key]] = np.cumsum(new) + 1
            ranks.append(rank)
            if m == 0 or rank.max() == m:
                return ranks, sampled[by_key]
            keys = [rank[sampled], rank[np.minimum(sampled + width, n)]]
            width *= 2

    def _common_prefixes(self, order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
        """The length of the common prefix of each sampled suffix and the next one in order."""
        a, b = order[:-1].copy(), order[1:].copy()
        start = a.copy()
        for level in range(len(ranks) - 1, -1, -1):
            same = (ranks[level][a] == ranks[level][b]) & (ranks[level][a] > 0)
            a += same * (MODULUS << level)
            b += same * (MODULUS << level)
        going = np.ones(len(a), bool)
        for _ in range(MODULUS):  # less than a window is left; the end differs from every word
            going &= self.words[a] == self.words[b]
            a += going
            b += going
        return (a - start).astype(np.int32)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from place i on equal those from place j on, for arrays of different places."""
        walk = WALKS[i % MODULUS, j % MODULUS]
        length = np.zeros(len(i), np.int64)
        going = np.ones(len(i), bool)
        for step in range(int(walk.max(initial=0))):
            look = np.flatnonzero(going & (step < walk))
            same = self.words[i[look] + step] == self.words[j[look] + step]
            going[look] = same
            length[look] += same
        far = np.flatnonzero(going & (np.maximum(i, j) + walk < self.n))
        one, two = self.place[i[far] + walk[far]], self.place[j[far] + walk[far]]
        low, high = np.minimum(one, two), np.maximum(one, two)
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        for at in np.unique(level):
            here = level == at
            table = self.least[at]
            length[far[here]] += np.minimum(table[low[here]], table[high[here] - (1 << int(at))])
        return length


@lru_cache(maxsize=8)
def _kept_grid(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grid points x and periods q with x + 3q < size, by the word that they reach."""
    periods = np.arange(1, size // LEAST_EXPONENT + 1)
    counts = (size - 1 - 3 * periods) // periods + 1
    q = np.repeat(periods, counts)
    x = (np.arange(len(q)) - np.repeat(np.cumsum(counts) - counts, counts)) * q
    by_end = np.argsort(x + 3 * q, kind="stable")
    x, q = x[by_end].astype(np.int32), q[by_end].astype(np.int32)
    return x, q, x + 3 * q


def _grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All points of the harmonic grid of a text of n words, with their periods, in blocks."""
    if n <= KEPT_WORDS:
        x, q, end = _kept_grid(max(64, 1 << (n - 1).bit_length()))
        known = np.searchsorted(end, n)
        yield x[:known], q[:known]
        return
    held, size = [], 0
    for period in range(1, n // LEAST_EXPONENT + 1):
        points = np.arange(0, n - 3 * period, period)
        for at in range(0, len(points), BLOCK):
            part = points[at:at + BLOCK]
            held.append((part, np.full(len(part), period)))
            size += len(part)
            if size >= BLOCK:
                yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
                held, size = [], 0
    if held:
        yield np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])


def runs_of(words: np.ndarray) -> np.ndarray:
    """``start, length, period`` of all runs of a sequence of numbers from 1, by start and period.

    The first grid point in a run has whole two periods and more of the run behind it, so its word comes again after
    one, two and three periods and the next word after one and two: other points begin no run and are left out before extending.
    """
    n = len(words)
    found = [np.empty((0, 3), np.int64)]
    if n < LEAST_LENGTH:
        return found[0]
    ahead = behind = None
    for x, q in _grid(n):
        for steps in ((0, 0, 1), (0, 1, 2), (1, 0, 1), (0, 2, 3), (1, 1, 2)):
            more, one, two = steps
            kept = words[x + more + one * q] == words[x + more + two * q]
            x, q = x[kept], q[kept]
        if not len(x):
            continue
        if ahead is None:
            ahead, behind = Extensions(words), Extensions(words[::-1])
        x, q = x.astype(np.int64), q.astype(np.int64)
        start = x - behind.common(n - x, n - x - q)
        end = x + q + ahead.common(x, x + q)
        long = end - start >= np.maximum(LEAST_LENGTH, LEAST_EXPONENT * q)
        found.append(np.unique(np.stack([start, end - start, q], axis=1)[long], axis=0))
    rows = np.unique(np.concatenate(found), axis=0)  # a stretch comes with multiples of its smallest period too
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[first]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapse(text: str | None) -> tuple[int, np.ndarray, str]:
    """The number of words of a text, its runs, and the words outside of runs and in their first periods."""
    words = text.encode().split() if text else []
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words), 1)}
    runs = runs_of(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
    if len(runs):
        depth = np.zeros(len(words) + 1, np.int64)
        np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
        np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0)]
        return len(depth) - 1, runs, b" ".join(words).decode()
    return len(words), runs, b" ".join(words).decode()


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])


def find_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    r"""``docs`` plus ``n_words``, ``runs`` (``start, length, period`` in words, by start and period) and ``collapsed``.

    Words are ``[^\x20\x09-\x0D]+``, compared as they are. A run is a stretch with a smallest period q, of at least six words and four
    periods, that no neighbouring word extends; runs may overlap. ``collapsed`` has the words that no run holds after
    its first period, joined by one space. Null and empty texts have no words and no runs and collapse to an empty text. A
    text is worked on as a whole, by one task; its memory grows with its words (a grid of n log n points goes in blocks). Rows
    are independent: repeated rows give the same again, an empty table an empty one. Columns of the input with these
    names are replaced.
    """
    @F.arrow_udf("n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
    def found(texts: pa.Array) -> pa.Array:
        counts, ends, rows, kept = [], [0], [], []
        for text in texts:
            n, runs, collapsed = collapse(text.as_py())
            counts.append(n)
            rows.append(runs)
            ends.append(ends[-1] + len(runs))
            kept.append(collapsed)
        all_rows = np.concatenate([np.empty((0, 3), np.int64), *rows])
        runs = pa.StructArray.from_arrays([pa.array(all_rows[:, i]) for i in range(3)], fields=list(RUN))
        return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
                                           pa.array(kept, pa.string())], fields=list(FOUND))

    out = packed(docs).select("row", found(F.col(f"row.`{text_col}`")).alias("found"))
    return unpacked(out, docs.columns, n_words=F.col("found.n_words"), runs=F.col("found.runs"), collapsed=F.col("found.collapsed"))

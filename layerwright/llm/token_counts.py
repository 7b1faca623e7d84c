"""Token counts of whole texts by a public tokenizer, huge texts in overlapping chunks.

A chunk is encoded with offsets on its own, so its first words may be cut differently than in the whole text. Two
neighbours are spliced at a boundary between words (the pieces that the tokenizer cuts before merging) that both have:
the left chunk's is right because it has read the text from a right boundary on and enough text beyond, and from a
common boundary on the right chunk reads the same text from the same state. Where the overlap has no such boundary it is
widened, up to the whole text.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import packed, unpacked


@lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer and the number of characters that must follow a boundary before it can be relied on.

    A boundary depends on the text behind it only through one character of lookahead and through special strings that
    begin before the chunk's end and end beyond it.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one task per core already
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as file:
        special = [t["content"] for t in json.load(file).get("added_tokens") or []]
    return tokenizer, max([0, *map(len, special)]) + 2


def word_starts(encoding, base: int) -> list[tuple[int, int]]:
    """(character offset in the whole text, number of tokens before it) of the first token of each word."""
    out, last = [], object()
    for i, (word, (start, _)) in enumerate(zip(encoding.word_ids, encoding.offsets, strict=True)):
        if word != last:
            out.append((base + start, i))
            last = word
    return out


def spliced_count(text: str, tokenizer, margin: int, chunk: int, overlap: int) -> int:
    """Tokens of a text that is longer than a chunk.

    ``spaces`` in front of a word may belong to no token's offsets, so only offsets that both chunks report are used:
    a pair (offset, character before it) that is equal in both is the same boundary of the same text.
    """
    def encode(start: int, end: int):
        return tokenizer.encode(text[start:end], add_special_tokens=False)

    size, total = len(text), 0
    left_start, left_end = 0, min(size, chunk + overlap)
    left, done = encode(left_start, left_end), 0  # tokens of ``left`` before ``done`` are counted already
    while left_end < size:
        wide = overlap
        right_start = left_end - overlap
        while True:
            right_end = min(size, right_start + chunk + wide)
            right = encode(right_start, right_end)
            ours = {at: n for at, n in word_starts(left, left_start) if right_start < at <= left_end - margin and n >= done}
            common = next(((at, n) for at, n in word_starts(right, right_start) if at in ours and at > right_start), None)
            if common:
                break
            wide *= 2  # no common boundary: the left chunk reads on
            left_end = min(size, right_start + wide)
            left = encode(left_start, left_end)
            if left_end == size:
                return total + len(left.ids) - done
        at, n = common
        total += ours[at] - done
        left, left_start, left_end, done = right, right_start, right_end, n
    return total + len(left.ids) - done


class PieceCounts:
    """Token counts of texts by way of the pieces between spaces, most of which come again and again.

    A space behind a letter, digit or ASCII mark always begins a new word for a tokenizer whose words hold a
    space only in front, so the text behind it is encoded alike on its own. Other spaces don't cut. Beyond ``most``
    pieces no new ones are remembered; that changes nothing but the time.
    """

    def __init__(self, tokenizer, most: int = 600_000) -> None:
        self.tokenizer, self.most, self.known = tokenizer, most, {}  # by piece, without the space in front of it

    @staticmethod
    def _cuts(piece: str) -> bool:
        return bool(piece) and (piece[-1].isalnum() or "!" <= piece[-1] <= "~")

    def _segments(self, pieces: list[str]) -> list[str]:
        out = [pieces[0]]
        for before, piece in zip(pieces, pieces[1:], strict=False):
            if self._cuts(before):
                out.append(piece)
            else:
                out[-1] += " " + piece
        return out

    def count(self, texts: list[str]) -> list[int]:
        known, counts, firsts, unknown, new = self.known, [], [], [], {}
        for text in texts:
            first, *rest = text.split(" ")
            got = list(map(known.get, rest))
            if None in got or not self._cuts(first):
                missing = [x for x, n in zip(rest, got, strict=True) if n is None]
                if not all(map(self._cuts, [first, *missing])):  # what is known cuts
                    first, *rest = self._segments([first, *rest])
                    got = list(map(known.get, rest))
                    missing = [x for x, n in zip(rest, got, strict=True) if n is None]
                new |= dict.fromkeys(" " + x for x in missing)
                counts.append(sum(n for n in got if n is not None))
            else:
                missing = []
                counts.append(sum(got))
            if first:
                new[first] = None
            firsts.append(first)
            unknown.append(missing)
        pieces = [*new]
        new = dict(zip(pieces, map(len, self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)), strict=True))
        if len(known) < self.most:
            known.update((x[1:], n) for x, n in new.items() if x[0] == " " and self._cuts(x[1:]))
        return [n + (new[first] if first else 0) + sum(new[" " + x] for x in missing)
                for n, first, missing in zip(counts, firsts, unknown, strict=True)]


def count_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", *, limit: int = 512,
                 chunk_chars: int = 32_768, overlap_chars: int = 1_024, batch_chars: int = 262_144) -> DataFrame:
    """``docs`` plus ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    Counts are those of the whole text: no special tokens are added, special strings in texts are read as the
    tokenizer does by default, nothing is cut off or filled up. Null counts as empty: 0 bytes, 0 tokens. Each row is
    counted by itself, so repeated rows are all there; an empty table gives an empty table. Columns of the input with
    these names are replaced. Texts of more than ``chunk_chars + overlap_chars`` go by overlapping chunks;
    never more than ``batch_chars`` characters or one chunk are encoded at a time. ``tokenizer_path`` must exist on every executor.
    """
    longest = chunk_chars + overlap_chars

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer, margin = load(tokenizer_path)
        pieces = PieceCounts(tokenizer)
        for texts in batches:
            counts, some, chars = [0] * len(texts), [], 0
            for i, value in enumerate(texts):
                text = value.as_py() or ""
                if len(text) > longest:
                    counts[i] = spliced_count(text, tokenizer, margin, chunk_chars, overlap_chars)
                elif text:
                    some.append((i, text))
                    chars += len(text)
                if some and (chars >= batch_chars or i + 1 == len(texts)):
                    for (k, _), n in zip(some, pieces.count([t for _, t in some]), strict=True):
                        counts[k] = n
                    some, chars = [], 0
            yield pa.array(counts, pa.int64())

    counted = packed(docs, n_tokens=count(F.col(f"`{text_col}`")))
    n_bytes = F.coalesce(F.octet_length(f"row.`{text_col}`"), F.lit(0)).cast("long")
    return unpacked(counted, docs.columns, n_bytes=n_bytes, n_tokens=F.col("n_tokens"), over_limit=F.col("n_tokens") > limit)

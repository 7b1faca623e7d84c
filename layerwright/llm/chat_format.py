r"""Chat formatting as a prefix tree: turns that conversations have in common at their beginning are emitted once.

A turn's node is told by a hash of all turns up to it. Conversations sorted by their node lists are in depth-first
order: each adds the nodes that no earlier one has, one unbroken segment of the tree's text. A node's offset in that
text is a running total over the cluster; its position id is what stands before it on its own path; it attends to the
intervals of its ancestors and, causally, to itself.

Template of a turn: ``<turn>`` role, newline, text ``</turn>``, newline. In roles and texts ``\`` and ``<`` get a
``\`` in front, and a newline in a role is ``\n``; so ``<`` without ``\`` is always a mark.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from layerwright.llm.common import running_total
from layerwright.session import materialize

OPEN, CLOSE = "<turn>", "</turn>\n"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.DOTALL)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its text begins and ends in it."""
    head = OPEN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def parse_turn(turn: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    if not (turn.startswith(OPEN) and turn.endswith(CLOSE)):
        raise ValueError("not a formatted turn")
    role, _, body = turn[len(OPEN):-len(CLOSE)].partition("\n")
    return unescape(role), unescape(body)


class Packed(NamedTuple):
    """``turns``: ``tree, segment, depth, start, end, position, text, loss_start, loss_end, attends``; a row per distinct node.
    ``start, end`` are the node's characters in its tree's text, ``position`` the position id of the first of them, the others count on;
    ``loss_start, loss_end`` are the characters of ``text`` under the loss mask (both null for none); ``attends`` are the
    ancestors' intervals of the tree's text, neighbouring ones joined.

    ``conversations``: ``conv, tree, n_turns, chars, intervals``; a row per conversation. ``intervals`` (``start, end, segment``)
    are the pieces of the tree's text that make it up, in order.
    """

    turns: DataFrame
    conversations: DataFrame


def _chained(rows: DataFrame, loss_role: str) -> DataFrame:
    """``conv, depth, node, position, text, loss_start, loss_end`` for each turn; rows come sorted within a conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, node, depth, position = object(), b"", 0, 0
        for batch in batches:
            out: list[tuple] = []
            for key, role, text in zip(batch.column("conv").to_pylist(), batch.column("role").to_pylist(),
                                       batch.column("text").to_pylist(), strict=True):
                if key != conv:
                    conv, node, depth, position = key, b"", 0, 0
                turn, begin, end = format_turn(role, text)
                node = hashlib.blake2b(turn.encode("utf-8", "surrogatepass"), key=node, digest_size=16).digest()
                own = (begin, end) if role == loss_role else (None, None)
                out.append((depth, node, position, turn, *own))
                depth, position = depth + 1, position + len(turn)
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                names=["conv", "depth", "node", "position", "text", "loss_start", "loss_end"])

    kind = rows.schema["conv"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv {kind}, depth long, node binary, position long, text string, loss_start long, loss_end long")


def pack(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", *,
         loss_role: str = "assistant") -> Packed:
    """All conversations as packed trees.

    Turns are ordered by ``turn_col``, null first, ties by role and then text. Null roles and texts are empty. Rows with a null id are
    one conversation. A repeated row is one more turn. An empty table gives two empty ones. Other columns are left out.
    A turn of any length is escaped and written as a whole. A conversation streams through one task, turn by turn; only its nodes' hashes, 16 bytes a turn, are put together in a row. A first
    turn that many conversations share costs them one row each, spread over all tasks.
    """
    rows = conversations.select(F.col(f"`{id_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                                F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
                                F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text").select("conv", "role", "text")
    turns = materialize(_chained(rows, loss_role), "chat-turns")

    # Depth-first order: conversations by their lists of nodes. The number is stored, so it is the same in a retried task.
    paths = turns.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("depth", "node"))).alias("path"),
                                      F.sum(F.length("text")).alias("chars"))
    paths = paths.withColumn("path", F.transform("path", lambda x: x["node"]))
    paths = paths.repartitionByRange("path", "conv").sortWithinPartitions("path", "conv")
    paths = materialize(paths.withColumn("segment", F.monotonically_increasing_id()), "chat-paths")
    steps = paths.select("conv", "segment", F.col("path")[0].alias("tree"), F.posexplode("path").alias("depth", "node"))

    # A node belongs to the first conversation that has it.
    owners = steps.groupBy("node", "tree", F.col("depth").cast("long").alias("depth")).agg(F.min(F.struct("segment", "conv")).alias("by"))
    owners = owners.select("node", "tree", "depth", "by.segment", F.col("by.conv").alias("owner"))
    own = turns.withColumnRenamed("node", "own_node").withColumnRenamed("depth", "own_depth")
    nodes = owners.join(own, owners["owner"].eqNullSafe(own["conv"]) & (owners["depth"] == own["own_depth"]))
    nodes = nodes.select("node", "tree", "segment", "depth", "position", "text", "loss_start", "loss_end", F.length("text").alias("chars"))
    nodes = running_total(nodes, ["tree"], ["segment", "depth"], "chars", "end", "chat-nodes")
    nodes = materialize(nodes.withColumn("start", F.col("end") - F.col("chars")), "chat-tree")

    # The pieces of a conversation: its nodes, joined where they belong to the same segment.
    places = nodes.select("node", F.col("segment").alias("piece"), "start", "end")
    pieces = (steps.join(places, "node").groupBy("conv", "segment", "tree", "piece")
              .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.count("*").alias("n")))
    packed = pieces.groupBy("conv", "segment", "tree").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("start", "end", F.col("piece").alias("segment")))).alias("intervals"))
    packed = materialize(packed, "chat-conversations")
    totals = paths.select("segment", "chars")
    conversations = packed.join(totals, "segment").select("conv", "tree", "n_turns", "chars", "intervals")

    above = packed.select("segment", F.filter("intervals", lambda x: x["segment"] != F.col("segment")).alias("above"))
    first = nodes.groupBy("segment").agg(F.min("start").alias("segment_start"))
    attends = F.concat(F.transform("above", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))),
                       F.when(F.col("start") > F.col("segment_start"), F.array(F.struct(F.col("segment_start").alias("start"), F.col("start").alias("end"))))
                       .otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>")))
    out = nodes.join(above, "segment").join(first, "segment").select(
        "tree", "segment", "depth", "start", "end", "position", "text", "loss_start", "loss_end", _joined(attends).alias("attends"))
    return Packed(out, conversations)


def _joined(intervals: Column) -> Column:
    """Sorted intervals, those that touch as one."""
    def add(done: Column, x: Column) -> Column:
        touches = F.when(F.size(done) > 0, F.get(done, F.size(done) - 1)["end"] == x["start"]).otherwise(F.lit(False))
        longer = F.struct(F.get(done, F.size(done) - 1)["start"].alias("start"), x["end"].alias("end"))
        return F.when(touches, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(intervals, F.array().cast("array<struct<start:bigint,end:bigint>>"), add)


def read_back(packed: Packed) -> DataFrame:
    """``conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, from the packed trees alone.

    Each conversation's intervals are looked up in the segments they lie in; the turns are parsed, their loss mask read and unescaped.
    """
    wanted = packed.conversations.select("conv", F.explode("intervals").alias("at"))
    wanted = wanted.select("conv", F.col("at.segment").alias("segment"), F.col("at.end").alias("until"))
    turns = packed.turns.select("segment", "end", "position", "text", "loss_start", "loss_end")
    turns = wanted.join(turns, "segment").filter(F.col("end") <= F.col("until"))
    turns = turns.select("conv", "position", "text", "loss_start", "loss_end").repartition("conv").sortWithinPartitions("conv", "position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None

        def closed() -> tuple:
            n, all_turns, loss_chars, loss, chars = state
            return conv, n, all_turns.hexdigest(), loss_chars, loss.hexdigest(), chars

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if state is None or row["conv"] != conv:
                    if state is not None:
                        out.append(closed())
                    conv, state = row["conv"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse_turn(row["text"])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if row["loss_start"] is not None:
                    masked = unescape(row["text"][row["loss_start"]:row["loss_end"]])
                    state[2] += len(masked)
                    state[3].update(masked.encode())
                state[4] += len(row["text"])
            yield _digests(out, kind)
        if state is not None:
            yield _digests([closed()], kind)

    kind = to_arrow_type(turns.schema["conv"].dataType)
    name = turns.schema["conv"].dataType.simpleString()
    return turns.mapInArrow(run, f"conv {name}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _digests(rows: list[tuple], conv_kind: pa.DataType) -> pa.RecordBatch:
    kinds = [conv_kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                      names=["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

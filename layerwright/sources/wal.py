"""Logical-replication messages: bytes to columns.

Messages are landed as ``(poll_id, seq, send_time, data_start, wal_end, payload)``. Kinds of fixed
layout (begin, commit) are decoded by built-in functions; only relation and row bodies, whose fields
depend on one another, go through an Arrow function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.functions.dates import pg_timestamp
from layerwright.operators.joins import spread_join
from layerwright.session import materialize

LANDING_DDL = "poll_id bigint, seq bigint, send_time timestamp, data_start bigint, wal_end bigint, payload binary"

# Fixed value: text that stands for an unchanged large value in parity mode.
UNCHANGED_TEXT = "TOASTED COLUMN"

ROW_KINDS = ("I", "U", "D")
KINDS = ("B", "R", "I", "U", "D", "T", "C")

_COLUMN = T.StructType([
    T.StructField("column_name", T.StringType()),
    T.StructField("key", T.IntegerType()),
    T.StructField("data_type", T.IntegerType()),
    T.StructField("data_type_modifier", T.IntegerType()),
])
BODY = T.StructType([
    T.StructField("namespace", T.StringType()),
    T.StructField("relation_name", T.StringType()),
    T.StructField("identity_setting", T.IntegerType()),
    T.StructField("columns", T.ArrayType(_COLUMN)),
    T.StructField("replica_identity_changed", T.BooleanType()),
    T.StructField("old_values", T.ArrayType(T.StringType())),
    T.StructField("old_unchanged", T.ArrayType(T.IntegerType())),
    T.StructField("new_values", T.ArrayType(T.StringType())),
    T.StructField("new_unchanged", T.ArrayType(T.IntegerType())),
    T.StructField("error", T.StringType()),
])


def big_endian(payload: Column, start: int, size: int) -> Column:
    """Signed big-endian integer of ``size`` bytes from the 1-based position ``start``."""
    digits = F.hex(F.substring(payload, start, size))
    value = F.conv(digits, 16, -10).cast("long")
    if size < 8:
        half = 1 << (8 * size - 1)
        value = F.when(value >= half, value - (half << 1)).otherwise(value)
    return value


def _parsers():
    """Readers of relation and row bodies. They refer to nothing outside, so executors need no package."""

    def number(data, at, size):
        if at + size > len(data):
            raise ValueError("message ends early")
        return int.from_bytes(data[at:at + size], "big", signed=True)

    def text(data, at):
        end = data.index(b"\x00", at)
        return data[at:end].decode("utf-8"), end + 1

    def tuple_values(data, at):
        values, unchanged = [], []
        count, whole = number(data, at, 2), len(data)
        at += 2
        for position in range(count):
            mark = data[at:at + 1]
            at += 1
            if mark == b"t":
                start = at + 4
                at = start + int.from_bytes(data[at:start], "big", signed=True)
                if not start <= at <= whole:
                    raise ValueError("message ends early")
                values.append(data[start:at].decode("utf-8"))
            elif mark == b"n":
                values.append(None)
            elif mark == b"u":
                values.append(None)
                unchanged.append(position)
            else:
                raise ValueError("unexpected tuple mark")
        return values, unchanged, at

    def relation(data):
        namespace, at = text(data, 5)
        name, at = text(data, at)
        identity, count = number(data, at, 1), number(data, at + 1, 2)
        at += 3
        columns = []
        for _ in range(count):
            key = number(data, at, 1)
            column_name, at = text(data, at + 1)
            columns.append({"column_name": column_name, "key": key, "data_type": number(data, at, 4),
                            "data_type_modifier": number(data, at + 4, 4)})
            at += 8
        return {"namespace": namespace, "relation_name": name, "identity_setting": identity, "columns": columns}

    def row(data):
        kind, mark, at, out = data[:1], data[5:6], 5, {}
        if kind != b"I":
            out["replica_identity_changed"] = mark == b"K"
        if kind != b"I" and mark in (b"O", b"K"):
            out["old_values"], out["old_unchanged"], at = tuple_values(data, 6)
            mark = data[at:at + 1]
        elif kind == b"D":
            raise ValueError("delete without an old row")
        if kind != b"D":
            if mark != b"N":
                raise ValueError("no new row")
            out["new_values"], out["new_unchanged"], _ = tuple_values(data, at + 1)
        return out

    def body(data):
        try:
            if data[:1] == b"R":
                return relation(data)
            return row(data) if data[:1] in (b"I", b"U", b"D") else {}
        except (ValueError, UnicodeDecodeError) as problem:
            return {"error": str(problem)}

    return body


def _arrow_reader(fields: T.StructType, read_one):
    """An Arrow function that gives one struct per row of its binary input."""
    from pyspark.sql.pandas.types import to_arrow_type

    import pyarrow as pa

    kinds = [(f.name, to_arrow_type(f.dataType)) for f in fields.fields]

    def read(first):
        out = [read_one(value) for value in first.to_pylist()]
        return pa.StructArray.from_arrays(
            [pa.array([o.get(name) for o in out], kind) for name, kind in kinds], names=[name for name, _ in kinds]
        )

    read.__annotations__ = {"first": pa.Array, "return": pa.Array}
    return F.arrow_udf(read, returnType=fields)


def _body_reader():
    body = _parsers()
    return _arrow_reader(BODY, lambda data: body(data) if data else {})


CHANGE = T.StructType([
    T.StructField("namespace", T.StringType()),
    T.StructField("relation_name", T.StringType()),
    T.StructField("names", T.ArrayType(T.StringType())),
    T.StructField("type_ids", T.ArrayType(T.IntegerType())),
    T.StructField("modifiers", T.ArrayType(T.IntegerType())),
    *[f for f in BODY.fields if f.name.startswith(("replica", "old", "new"))],
    T.StructField("error", T.StringType()),
])


def change_reader():
    """Arrow function of a row message and the relation message in force for it."""
    body = _parsers()
    seen = {}

    def described(data):
        if data not in seen:
            if len(seen) > 10_000:
                seen.clear()
            found = body(data)
            if "columns" in found:
                columns = found.pop("columns")
                for name, field in (("names", "column_name"), ("type_ids", "data_type"), ("modifiers", "data_type_modifier")):
                    found[name] = [c[field] for c in columns]
            seen[data] = found
        return seen[data]

    def read_one(data, head):
        if "error" in head or not data:
            return {"error": head.get("error")}
        out = body(data)
        widest = max(len(out.get("old_values") or ()), len(out.get("new_values") or ()))
        if widest > len(head["names"]):
            out = {"error": "more values than columns"}
        return out

    return _arrow_change_reader(described, read_one)


def _arrow_change_reader(described, read_one):
    """The Arrow function of :func:`change_reader`. Rows share a few relations, whose columns are made once and handed to rows by number."""
    from pyspark.sql.pandas.types import to_arrow_type

    import pyarrow as pa

    kinds = [(f.name, to_arrow_type(f.dataType)) for f in CHANGE.fields]
    shared = ("namespace", "relation_name", "names", "type_ids", "modifiers")

    def read(first, second):
        coded = second.dictionary_encode()
        heads = [described(data) if data else {"error": "unknown relation"} for data in [*coded.dictionary.to_pylist(), None]]
        number = coded.indices.fill_null(len(heads) - 1)
        out = [read_one(data, heads[i]) for data, i in zip(first.to_pylist(), number.to_pylist())]
        columns = [
            pa.array([h.get(name) for h in heads], kind).take(number) if name in shared else pa.array([o.get(name) for o in out], kind)
            for name, kind in kinds
        ]
        return pa.StructArray.from_arrays(columns, names=[name for name, _ in kinds])

    read.__annotations__ = {"first": pa.Array, "second": pa.Array, "return": pa.Array}
    # Marked so that a filter on the outcome is not turned into a second run of the function.
    return F.arrow_udf(read, returnType=CHANGE).asNondeterministic()


def message_type(payload: Column) -> Column:
    return F.decode(F.substring(payload, 1, 1), "ISO-8859-1")


def decode_headers(messages: DataFrame) -> DataFrame:
    """Message type and all fields of fixed layout, without Python."""
    payload, kind = F.col("payload"), F.col("type")

    def of(*kinds: str, value: Column) -> Column:
        return F.when(kind.isin(*kinds), value)

    relations = F.when(
        (kind == "T") & (big_endian(payload, 2, 4) > 0),
        F.transform(
            F.sequence(F.lit(0), (big_endian(payload, 2, 4) - 1).cast("int")),
            lambda i: F.conv(F.hex(F.substr(payload, i * 4 + 7, F.lit(4))), 16, -10).cast("long").cast("int"),
        ),
    )
    return messages.withColumn("type", message_type(payload)).withColumns({
        "data_size": F.length(payload),
        "lsn": of("B", value=big_endian(payload, 2, 8)),
        "transaction_id": of("B", value=big_endian(payload, 18, 4).cast("int")),
        "is_unused": of("C", value=big_endian(payload, 2, 1).cast("int")),
        "commit_lsn": of("C", value=big_endian(payload, 3, 8)),
        "transaction_lsn": of("C", value=big_endian(payload, 11, 8)),
        "commit_timestamp": of("B", value=pg_timestamp(big_endian(payload, 10, 8))).cast("timestamp"),
        "commit_time": of("C", value=pg_timestamp(big_endian(payload, 19, 8))).cast("timestamp"),
        "relation_id": of("R", *ROW_KINDS, value=big_endian(payload, 2, 4).cast("int")),
        "truncate_option": of("T", value=big_endian(payload, 6, 1).cast("int")),
        "truncated_relations": relations,
    })


def decode(messages: DataFrame) -> DataFrame:
    """All fields of the seven message kinds; ``error`` tells why a message could not be read.

    Unknown kinds come back with an error and no fields.
    """
    out = decode_headers(messages).withColumn("_body", _body_reader()(F.col("payload")))
    fields = [f.name for f in BODY.fields if f.name != "error"]
    known = F.col("type").isin(*KINDS)
    return out.select(
        *[c for c in out.columns if c not in ("payload", "_body")],
        *[F.col(f"_body.{name}").alias(name) for name in fields],
        F.when(~known, F.concat(F.lit("unknown message kind "), F.col("type")))
        .otherwise(F.col("_body.error")).alias("error"),
    )


def rejected(decoded: DataFrame) -> DataFrame:
    """Messages that could not be read."""
    return decoded.where(F.col("error").isNotNull())


def cut_polls(messages: DataFrame, read_started_at) -> DataFrame:
    """Messages of each poll up to the first transaction committed at or after the start of the poll."""
    started = F.lit(read_started_at).cast("timestamp")
    payload = F.col("payload")
    late = messages.where(
        (message_type(payload) == "B") & (pg_timestamp(big_endian(payload, 10, 8)).cast("timestamp") >= started)
    )
    # Written first: one row per poll, which Spark takes for as large as the log as long as it is only planned.
    ends = materialize(late.groupBy("poll_id").agg(F.min("seq").alias("_end")), "poll-ends")
    kept = spread_join(messages, ends, ["poll_id"], "left")
    return kept.where(F.col("_end").isNull() | (F.col("seq") < F.col("_end"))).drop("_end")

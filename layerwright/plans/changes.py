"""Change log: decoded messages to typed, transaction-consistent change records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.functions.pgtypes import parse_value
from layerwright.operators.carry import CHUNK, carry, in_chunks, tasks_for
from layerwright.session import materialize
from layerwright.sources.wal import KINDS, ROW_KINDS, UNCHANGED_TEXT, change_reader, decode_headers


def read_log(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Headers of landed messages, distributed by poll and chunk."""
    return decode_headers(in_chunks(messages, ["poll_id"], "seq", chunk))


def with_transactions(log: DataFrame, chunk: int = CHUNK, told_by: DataFrame | None = None) -> DataFrame:
    """Messages with the header of their transaction and the commit that closes it.

    ``problem`` is NULL for messages of a complete transaction. A message after the last commit
    belongs to an open transaction; a commit that names another start does not fit its block.
    ``told_by`` may give the same headers as a plan that was not distributed yet.
    """
    kind = F.col("type")
    begin = {f"_begin_{c}": F.when(kind == "B", F.col(c)) for c in ("lsn", "transaction_id", "commit_timestamp")}
    commit = {f"_end_{c}": F.when(kind == "C", F.col(c)) for c in ("commit_lsn", "transaction_lsn")}
    filled = carry(log, ["poll_id"], "seq", last=begin, following=commit, chunk=chunk, told_by=told_by)
    problem = (
        F.when(~kind.isin(*KINDS), F.concat(F.lit("unknown message kind "), kind))
        .when(F.col("_begin_lsn").isNull(), F.lit("no transaction"))
        .when(F.col("_end_commit_lsn").isNull(), F.lit("open transaction"))
        .when(F.col("_end_commit_lsn") != F.col("_begin_lsn"), F.lit("commit of another transaction"))
    )
    return filled.select(
        *log.columns,
        F.col("_begin_transaction_id").alias("_transaction_id"),
        F.col("_begin_lsn").alias("_transaction_start_lsn"),
        F.col("_end_transaction_lsn").alias("_transaction_end_lsn"),
        F.col("_begin_commit_timestamp").alias("operation_timestamp"),
        problem.alias("problem"),
    )


def data_messages(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Row and truncate messages, and those of unknown kinds, with their transaction."""
    return with_transactions(read_log(messages, chunk), chunk, decode_headers(messages)).where(~F.col("type").isin("B", "C", "R"))


def _per_relation(log: DataFrame) -> DataFrame:
    """One row per relation that a message speaks of; a truncate names several."""
    relations = F.coalesce(F.col("truncated_relations"), F.array(F.col("relation_id")))
    return log.withColumn("relation_id", F.explode(relations))


def with_relation(rows: DataFrame, headers: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Rows with the bytes of the relation message in force: the last one of that relation in the poll."""
    described = F.when(F.col("type") == "R", F.col("payload"))
    teller = _per_relation(headers.where(F.col("type").isin(*ROW_KINDS, "T", "R")))
    return carry(rows, ["poll_id", "relation_id"], "seq", last={"_relation": described}, chunk=chunk, told_by=teller)


def change_records(messages: DataFrame, parity: bool = False, chunk: int = CHUNK) -> DataFrame:
    """All changes of landed messages, good and bad: a bad one has a ``problem``.

    ``row_before_transaction`` and ``row_after_transaction`` map column names to text, ``column_types`` to the type id and
    modifier that the relation in force gives them. Columns whose
    large value did not change are listed and NULL; with ``parity`` they hold the marker text instead.

    The bytes are distributed once and stay packed while transactions and relations are carried along;
    rows are unpacked last, where they are.
    """
    headers = decode_headers(messages)
    placed = with_transactions(read_log(messages, chunk), chunk, headers).where(~F.col("type").isin("B", "C"))
    rows = with_relation(_per_relation(placed), headers, chunk).where(F.col("type") != "R")
    read = rows.withColumn("_body", change_reader()(
        F.when(F.col("type").isin(*ROW_KINDS), F.col("payload")), F.col("_relation")
    ))
    names = F.col("_body.names")

    def named(side: str) -> Column:
        values = F.col(f"_body.{side}_values")
        shown = values
        if parity:
            unchanged = F.col(f"_body.{side}_unchanged")
            shown = F.transform(
                values, lambda v, i: F.when(F.array_contains(unchanged, i), F.lit(UNCHANGED_TEXT)).otherwise(v)
            )
        return F.map_from_arrays(F.slice(names, 1, F.size(values)), shown)

    return read.select(
        "poll_id", "seq", "relation_id",
        F.concat_ws(".", "_body.namespace", "_body.relation_name").alias("table"),
        F.col("type").alias("operation_type"), "operation_timestamp",
        named("old").alias("row_before_transaction"), named("new").alias("row_after_transaction"),
        F.map_from_arrays(names, F.arrays_zip(F.col("_body.type_ids").alias("type_id"), F.col("_body.modifiers").alias("modifier")))
        .alias("column_types"),
        F.transform(F.col("_body.new_unchanged"), lambda i: F.get(names, i)).alias("unchanged_columns"),
        F.col("_body.replica_identity_changed").alias("replica_identity_changed"),
        "_transaction_id", "_transaction_start_lsn", "_transaction_end_lsn",
        F.coalesce("problem", "_body.error").alias("problem"),
    )


def changes(messages: DataFrame, parity: bool = False, chunk: int = CHUNK) -> DataFrame:
    """Change records of complete transactions."""
    return change_records(messages, parity, chunk).where(F.col("problem").isNull()).drop("problem")


def change_rejects(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Messages that gave no change record, with the reason."""
    return change_records(messages, False, chunk).where(F.col("problem").isNotNull())


def open_tail(messages: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Messages after the last commit of their poll, to be read again with the next one."""
    return data_messages(messages, chunk).where(F.col("problem") == "open transaction")


def column_types(records: DataFrame, table: str) -> dict[str, tuple[int, int]]:
    """Type id and modifier of each column of a table, as its newest relation message in the records has them."""
    types = records.where((F.col("table") == table) & F.col("column_types").isNotNull())
    newest = types.select("poll_id", "seq", F.explode("column_types").alias("name", "of")).groupBy("name").agg(
        F.max_by("of", F.struct("poll_id", "seq")).alias("of"))
    return {r["name"]: (r["of"]["type_id"], r["of"]["modifier"]) for r in newest.collect()}


def typed(records: DataFrame, side: str, columns: Mapping[str, int | tuple[int, int]], parity: bool = False) -> DataFrame:
    """One side of the records of a table as typed columns.

    ``columns`` maps names to type ids, or to type id and modifier as :func:`column_types` finds them; a ``numeric`` is an exact
    decimal with its modifier and a double without one.
    """
    shown = []
    for name, kind in columns.items():
        type_id, modifier = kind if isinstance(kind, tuple) else (kind, -1)
        shown.append(parse_value(F.col(side)[name], type_id, modifier, parity).alias(name))
    return records.select(*records.columns, *shown)


def by_table(records: DataFrame, out: str) -> None:
    """Change records written in commit order, a folder for each table.

    Rows are dealt by ranges of table and place in the log, so that a table with most of the changes takes many files; within
    a file, and from one file of a table to the next, records are in the order of commit. The records are written first: finding
    the ranges reads them once more, and how many there are says how many ranges.
    """
    order = ["table", "poll_id", "_transaction_end_lsn", "seq"]
    records = materialize(records, "change-records")
    dealt = records.repartitionByRange(tasks_for(records), *order).sortWithinPartitions(*order)
    dealt.write.partitionBy("table").mode("overwrite").parquet(out)

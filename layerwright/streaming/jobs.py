"""Streaming jobs. Each batch is written under its own id, so a repeated batch changes nothing."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from layerwright.operators.dedup import latest_per_key
from layerwright.operators.joins import spread_join
from layerwright.operators.tables import newer_than
from layerwright.plans.changes import change_records
from layerwright.session import materialize
from layerwright.sources.wal import LANDING_DDL, decode_headers, message_type
from layerwright.sources.writers import Batch, replace_days, upsert

LATE_DAYS = 3


def landed_files(spark: SparkSession, path: str, schema: T.StructType | str, glob: str | None = None,
                 files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a landing folder as a stream."""
    reader = spark.readStream.format("parquet").schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def daily_counts(events: DataFrame, time: str, keys: Sequence[str], late: str = f"{LATE_DAYS} days") -> DataFrame:
    """Rows by day and key, with late rows taken in for the re-read window."""
    timed = events.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", late)
    counted = timed.groupBy(F.window("_time", "1 day"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.to_date("window.start").alias("day"), *keys, "n")


def without_repeats(events: DataFrame, time: str, key: Sequence[str], late: str = f"{LATE_DAYS} days") -> DataFrame:
    """The first arrival of each key inside the re-read window."""
    timed = events.withColumn("_time", F.col(time).cast("timestamp")).withWatermark("_time", late)
    return timed.dropDuplicatesWithinWatermark(list(key)).drop("_time")


def run_available(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Process what has landed, batch by batch, and stop. The checkpoint remembers what was read."""
    query = (
        stream.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a started stream has kept in its checkpoint; one with a new checkpoint has another."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def upsert_stream(stream: DataFrame, table: str, key: str, checkpoint: str) -> StreamingQuery:
    """Late and changed rows merged into a table by key.

    The table notes the batch with the change itself, so one that comes again, because the run died before the checkpoint moved,
    changes nothing, not even for rows without a key.
    """
    def take(batch: DataFrame, number: int) -> None:
        upsert(batch, table, key, once=Batch(stream_id(stream.sparkSession, checkpoint), number))
        stream.sparkSession.catalog.refreshTable(table)  # a batch has a session of its own

    return run_available(stream, checkpoint, take)


def replace_days_stream(stream: DataFrame, table: str, day: str, checkpoint: str) -> StreamingQuery:
    """Days that arrive again replace what the table holds of them; a batch that comes again changes nothing."""
    def take(batch: DataFrame, number: int) -> None:
        replace_days(batch, table, day, once=Batch(stream_id(stream.sparkSession, checkpoint), number))
        stream.sparkSession.catalog.refreshTable(table)

    return run_available(stream, checkpoint, take)


def feed_stream(nodes: DataFrame, to_messages: Callable[[DataFrame], DataFrame], out: str,
                checkpoint: str, marks: Sequence[str] = (), since: Column | None = None) -> StreamingQuery:
    """Messages of newly landed nodes, one output folder per batch.

    The checkpoint takes the place of the stored mark: it moves on only after the messages are
    written, and a batch that failed half-way is written again to the same folder.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = newer_than(batch, marks, since) if marks and since is not None else batch
        to_messages(rows).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return run_available(nodes, checkpoint, write)


#: How long, by the time of sending, a poll may be silent before it counts as over.
QUIET = "1 day"


def change_stream(messages: DataFrame, out: str, checkpoint: str, quiet: str = QUIET) -> StreamingQuery:
    """Change records of newly landed messages, one output folder per batch, whatever batches a poll is cut into.

    Two things are kept of every poll, written beside the output per batch, so that a repeated batch starts from the same: what
    follows its last commit, until the rest of the transaction has come, and the newest message of each relation. A poll that
    sent nothing for ``quiet`` while others did is over: its open transaction goes out as rejected, as the batch does it, and
    nothing of it is kept. :func:`held_messages` has what waits. Records with a problem are written beside the good ones.
    """
    spark = messages.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("last_seen", F.col("send_time"))
        if batch_id > 0:
            rows = rows.unionByName(_state(spark, out, batch_id - 1))
        rows = materialize(rows, "change-stream")
        headers = decode_headers(rows.select("poll_id", "seq", "payload"))
        ends = headers.groupBy("poll_id").agg(F.max(F.when(F.col("type") == "B", F.col("seq"))).alias("begun"),
                                              F.max(F.when(F.col("type") == "C", F.col("seq"))).alias("ended"))
        seen = rows.groupBy("poll_id").agg(F.max("last_seen").alias("_seen"))
        newest = seen.agg(F.max("_seen").alias("at")).first()["at"]
        open_from = F.when(F.expr("begun IS NOT NULL AND (ended IS NULL OR begun > ended)"), F.coalesce("ended", F.lit(-1)))
        polls = materialize(ends.select("poll_id", open_from.alias("_end")).join(seen, "poll_id").withColumn(
            "_over", F.coalesce(F.col("_seen") < F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {quiet}"), F.lit(False))), "polls")
        placed = spread_join(rows, polls, ["poll_id"])
        waits = F.coalesce(F.col("seq") > F.col("_end"), F.lit(False)) & ~F.col("_over")
        columns = batch.columns
        change_records(placed.where(~waits).select(*columns)).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
        # Written once per live poll and relation, to be there when the poll's next messages come.
        told = placed.where(~waits & ~F.col("_over") & (message_type(F.col("payload")) == "R"))
        told = latest_per_key(told.withColumn("_relation", F.substring("payload", 2, 4)), ["poll_id", "_relation"], "seq", ties=[])
        kept = placed.where(waits).unionByName(told.drop("_relation")).withColumn("last_seen", F.col("_seen"))
        kept.select(*columns, "last_seen").write.mode("overwrite").parquet(f"{out}/_held/{batch_id}")

    return run_available(messages, checkpoint, write)


def _state(spark: SparkSession, out: str, batch_id: int) -> DataFrame:
    return spark.read.schema(f"{LANDING_DDL}, last_seen timestamp").parquet(f"{out}/_held/{batch_id}")


def held_messages(spark: SparkSession, out: str, batch_id: int) -> DataFrame:
    """Messages that wait for the end of their transaction after a batch, with relation messages kept for later ones."""
    return _state(spark, out, batch_id).drop("last_seen")


def landed_messages(spark: SparkSession, path: str) -> DataFrame:
    return landed_files(spark, path, LANDING_DDL)


def read_mark(spark: SparkSession, table: str, default: str) -> Column:
    """A stored high-water mark as literal, or the default when none is stored."""
    if spark.catalog.tableExists(table):
        row = spark.table(table).agg(F.max("mark").alias("mark")).first()
        if row["mark"] is not None:
            return F.lit(row["mark"])
    return F.lit(default).cast("timestamp")


def save_mark(messages: DataFrame, col: str, table: str) -> None:
    """Add the newest time of the sent messages to the marks; nothing new leaves the mark as it is."""
    newest = messages.agg(F.max(col).cast("timestamp").alias("mark")).where(F.col("mark").isNotNull())
    newest.write.mode("append").saveAsTable(table)


#: States of a message in an outbox, in their order; one that is being sent when a run dies may or may not have been received.
QUEUED, SENDING, SENT, FAILED = "queued", "sending", "sent", "failed"
_OUTBOX_DDL = "id string, at timestamp, state string, noted timestamp, message string"


class InDoubt(Exception):
    """Messages that an earlier run was sending when it died: whether they were received is not known."""


def outbox_states(spark: SparkSession, outbox: str, since: datetime | None = None) -> DataFrame:
    """``id, at, state, message``: each message of an outbox, from a time on or of none, with its last state."""
    if not spark.catalog.tableExists(outbox):
        return spark.createDataFrame([], _OUTBOX_DDL).drop("noted")
    notes = spark.table(outbox)
    if since is not None:
        notes = notes.where((F.col("at") >= F.lit(since)) | F.col("at").isNull())
    last = F.max_by(F.struct("state"), F.struct("noted", F.array_position(F.array(*map(F.lit, (QUEUED, SENDING, FAILED, SENT))), F.col("state"))))
    return notes.groupBy("id", "at").agg(last.alias("last"), F.max("message").alias("message")).select("id", "at", "last.state", "message")


def _note(messages: DataFrame, outbox: str, state: str, with_text: bool = False) -> None:
    text = F.col("message") if with_text else F.lit(None).cast("string")
    messages.select(F.col("id"), F.col("at"), F.lit(state).alias("state"), F.current_timestamp().alias("noted"), text.alias("message")).write.mode(
        "append").saveAsTable(outbox)


def feed_run(nodes: DataFrame, to_messages: Callable[[DataFrame, Column], DataFrame], deliver: Callable[[DataFrame], None],
             marks: str, default: str, order: str = "date", outbox: str | None = None, in_doubt: str = "raise") -> int:
    """One run of a feed: from the stored mark to the next. Returns the number of messages that were delivered.

    Messages of nodes after the mark go into an outbox first, by id and time, unless they are there. What has not been sent is noted as being
    sent, delivered in order of ``order``, noted as sent, and then the mark moves to the newest. A run that fails to deliver is
    repeated with the same messages; one that dies between the delivery and the mark sends nothing twice, as the outbox knows. Only a
    run that dies while delivering leaves messages in doubt: the next one raises :class:`InDoubt`, or with ``in_doubt`` as
    ``"resend"`` or ``"skip"`` sends them again or takes them as sent. A run without messages delivers nothing.

    ``to_messages`` gives ``id``, ``message`` and the column ``order``; the outbox is by default named after the marks' table.
    """
    spark, outbox = nodes.sparkSession, outbox or f"{marks}_outbox"
    found = materialize(to_messages(nodes, read_mark(spark, marks, default)), "feed")
    keyed = found.withColumns({"_id": F.col("id").cast("string"), "_at": F.col(order).cast("timestamp")})
    first = keyed.agg(F.min("_at").alias("at")).first()["at"]

    def known() -> DataFrame:  # of the messages' time only, so that a run's cost doesn't grow with the outbox
        states = outbox_states(spark, outbox, first).withColumnsRenamed({"id": "_known", "at": "_known_at"})
        return materialize(states, "outbox")

    def same(left: DataFrame, right: DataFrame) -> Column:
        return left["_id"].eqNullSafe(right["_known"]) & left["_at"].eqNullSafe(right["_known_at"])

    states = known()
    doubtful = states.where(F.col("state") == SENDING)
    if not doubtful.isEmpty():
        shown = doubtful.select(F.col("_known").alias("id"), F.col("_known_at").alias("at"))
        if in_doubt == "raise":
            raise InDoubt(", ".join(r["id"] or "" for r in shown.orderBy("at").limit(5).collect()))
        _note(shown, outbox, FAILED if in_doubt == "resend" else SENT)
        states = known()
    new = keyed.join(states, same(keyed, states), "left_anti")
    _note(new.select(F.col("_id").alias("id"), F.col("_at").alias("at"), "message"), outbox, QUEUED, with_text=True)
    done = states.where(F.col("state") == SENT)
    waiting = materialize(keyed.join(done, same(keyed, done), "left_anti"), "to-send")
    n = waiting.count()
    if n:
        keys = waiting.select(F.col("_id").alias("id"), F.col("_at").alias("at"))
        _note(keys, outbox, SENDING)
        try:
            deliver(waiting.drop("_id", "_at").orderBy(order, "id"))
        except Exception:
            _note(keys, outbox, FAILED)
            raise
        _note(keys, outbox, SENT)
    save_mark(found, order, marks)
    return n

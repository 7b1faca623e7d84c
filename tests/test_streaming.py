"""Streams give what the batch gives, and a second run or a restart adds nothing."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerwright.plans import changes, feeds
from layerwright.sources import wal
from layerwright.streaming import jobs
from test_log import MESSAGES, landed
from test_models import node


@pytest.fixture
def landing(spark, sf_dir, tmp_path):
    """Events landed in two files; the second one repeats some rows of the first."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.where("event_id < 600").coalesce(1).write.parquet(str(tmp_path / "in"))
    events.where("event_id >= 500").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return events, str(tmp_path / "in"), tmp_path


def stream_to(df, path, checkpoint, mode="append"):
    query = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
             .option("path", path).trigger(availableNow=True).start())
    query.awaitTermination()


def test_daily_counts_equal_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = jobs.landed_files(spark, sf_dir, events.schema, "events.parquet")
    stream_to(jobs.daily_counts(stream, "ts", ["event_type"]), str(tmp_path / "o"), str(tmp_path / "c"))
    got = {(r.day, r.event_type): r.n for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    batch = events.groupBy(F.to_date("ts").alias("day"), "event_type").count().collect()
    expected = {(r.day, r.event_type): r["count"] for r in batch}
    assert got and all(expected[k] == n for k, n in got.items())
    # Days inside the late window stay open in append mode.
    newest = max(d for d, _ in expected)
    assert {k for k in expected if k not in got} <= {k for k in expected if k[0] >= newest - dt.timedelta(days=4)}


def test_repeats_are_dropped(spark, landing):
    events, path, tmp = landing
    stream = jobs.without_repeats(jobs.landed_files(spark, path, events.schema, files_per_batch=1), "ts", ["event_id"], "60 days")
    stream_to(stream, str(tmp / "o"), str(tmp / "c"))
    assert spark.read.parquet(str(tmp / "o")).count() == events.count()


def test_upsert_and_replace_streams(spark, landing):
    events, path, tmp = landing
    for _ in range(2):
        jobs.upsert_stream(jobs.landed_files(spark, path, events.schema, files_per_batch=1), "st1.events", "event_id", str(tmp / "u"))
        assert spark.table("st1.events").count() == events.count()
    days = jobs.landed_files(spark, path, events.schema).withColumn("day", F.to_date("ts"))
    for _ in range(2):
        jobs.replace_days_stream(days, "st1.days", "day", str(tmp / "d"))
    assert spark.table("st1.days").count() == spark.read.parquet(path).count()


def test_change_stream_equals_batch(spark, tmp_path):
    log = landed(spark, {1: MESSAGES, 2: MESSAGES[:11]})
    log.repartition(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        jobs.change_stream(jobs.landed_messages(spark, str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"))
    got = spark.read.parquet(str(tmp_path / "o")).drop("batch_id")
    waiting = {(r.poll_id, r.seq) for r in changes.open_tail(log).collect()}
    want = changes.change_records(log).where("problem IS NULL OR problem <> 'open transaction'")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))
    held = jobs.held_messages(spark, str(tmp_path / "o"), 0)
    assert waiting and waiting <= {(r.poll_id, r.seq) for r in held.collect()}


@pytest.mark.parametrize("cut", [2, 5, 8, 11])
def test_a_poll_cut_by_batches_equals_the_batch(spark, tmp_path, cut):
    whole = landed(spark, {1: MESSAGES})
    for part in (whole.where(F.col("seq") < cut), whole.where(F.col("seq") >= cut)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        jobs.change_stream(jobs.landed_messages(spark, str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"))
    got = spark.read.parquet(str(tmp_path / "o")).drop("batch_id").where("problem IS NULL")
    want = changes.change_records(whole).where("problem IS NULL")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def run_changes(spark, tmp_path, part, **options):
    part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    jobs.change_stream(jobs.landed_messages(spark, str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"), **options)


def streamed(spark, tmp_path):
    return spark.read.parquet(str(tmp_path / "o")).drop("batch_id")


def assert_same_records(got, want):
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


def test_a_poll_that_misses_batches_keeps_its_relations(spark, tmp_path):
    whole = landed(spark, {1: MESSAGES[:12], 2: MESSAGES[:4], 3: MESSAGES[:15]})
    pieces = ["poll_id = 1 AND seq < 4", "poll_id = 2 AND seq < 2", "poll_id = 3 AND seq < 7", "poll_id = 2 AND seq >= 2",
              "poll_id = 1 AND seq >= 4", "poll_id = 3 AND seq >= 7"]
    for piece in pieces:
        run_changes(spark, tmp_path, whole.where(piece))
    got = streamed(spark, tmp_path)
    assert_same_records(got, changes.change_records(whole).where("problem IS NULL OR problem <> 'open transaction'"))
    # Of each relation of a poll the newest message is kept, however many came.
    kept = jobs.held_messages(spark, str(tmp_path / "o"), len(pieces) - 1).collect()
    assert sorted((r.poll_id, r.seq) for r in kept) == [(1, 8), (1, 11), (2, 1), (3, 8), (3, 12)]


def test_a_silent_poll_is_over(spark, tmp_path):
    first = landed(spark, {1: MESSAGES[:6]})
    late = landed(spark, {2: MESSAGES[:4]}).withColumn("send_time", F.expr("send_time + INTERVAL 3 DAYS"))
    for part in (first, late.where("seq < 2"), late.where("seq >= 2")):
        run_changes(spark, tmp_path, part, quiet="2 days")
    got = streamed(spark, tmp_path)
    assert_same_records(got, changes.change_records(first.unionByName(late)))
    assert got.where("problem = 'open transaction'").count() == 1
    assert {r.poll_id for r in jobs.held_messages(spark, str(tmp_path / "o"), 2).collect()} == {2}


class Died(Exception):
    pass


def test_a_repeated_batch_of_changes_equals_the_batch(spark, tmp_path, monkeypatch):
    whole = landed(spark, {1: MESSAGES[:12], 2: MESSAGES[:4]})
    real, died = jobs.latest_per_key, []

    def dies_once(*args, **named):
        if len(died) % 2 == 0:
            died.append(1)
            raise Died  # the records are written, what is kept is not
        died.append(1)
        return real(*args, **named)

    for piece in ("seq < 3", "seq >= 3 AND seq < 9", "seq >= 9"):
        with monkeypatch.context() as patched:
            patched.setattr(jobs, "latest_per_key", dies_once)
            with pytest.raises(Exception, match="Died"):
                run_changes(spark, tmp_path, whole.where(piece))
            jobs.change_stream(jobs.landed_messages(spark, str(tmp_path / "in")), str(tmp_path / "o"), str(tmp_path / "c"))
    assert len(died) == 6
    assert_same_records(streamed(spark, tmp_path), changes.change_records(whole).where("problem IS NULL OR problem <> 'open transaction'"))


@pytest.mark.parametrize("mode", ["static", "dynamic"])
@pytest.mark.parametrize("sink", ["upsert", "replace_days"])
def test_a_repeated_batch_changes_nothing(spark, tmp_path, monkeypatch, sink, mode):
    """The run dies when the table is written and the checkpoint has not moved; rows without key or day show it."""
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (None, None)], "id bigint, day string")
    name, real = f"st2_{mode}.{sink}", getattr(jobs, sink)
    calls = []

    def dies_afterwards(*args, **named):
        calls.append(real(*args, **named))
        if len(calls) % 2:
            raise Died

    def run():
        stream = jobs.landed_files(spark, str(tmp_path / "in"), rows.schema)
        make = jobs.upsert_stream if sink == "upsert" else jobs.replace_days_stream
        make(stream, name, "id" if sink == "upsert" else "day", str(tmp_path / "c"))

    try:
        for part in (rows, rows.where("id = 2 OR id IS NULL")):
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            with monkeypatch.context() as patched:
                patched.setattr(jobs, sink, dies_afterwards)
                with pytest.raises(Exception, match="Died"):
                    run()
                run()
        assert [bool(c) for c in calls] == [True, False, True, False]
        assert sorted(spark.table(name).select("id").collect(), key=str) == sorted([(1,), (2,), (None,), (None,)], key=str)
        # Another stream into the same table counts its batches on its own.
        make = jobs.upsert_stream if sink == "upsert" else jobs.replace_days_stream
        make(jobs.landed_files(spark, str(tmp_path / "in"), rows.schema), name, "id" if sink == "upsert" else "day", str(tmp_path / "other"))
        assert spark.table(name).where("id IS NULL").count() == 4
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")


#: Where a run of a feed fails or dies, what was received by then, and what the next run sends.
STEPS = [("to_messages", [], [1, 2]), ("queued", [], [1, 2]), ("before", [], [1, 2]), ("delivery", [], [1, 2]), ("mark", [1, 2], [])]


@pytest.mark.parametrize("step,received,then", STEPS)
def test_a_feed_that_fails_sends_nothing_twice(spark, monkeypatch, step, received, then):
    nodes = node(spark, state="accepted").unionByName(node(spark, id=2, publishedAt=dt.datetime(2024, 2, 1), updatedAt=None))
    marks, sent = f"fr_{step}", []

    def messages(rows, mark):
        if step == "to_messages" and not broken:
            broken.append(1)
            raise Died
        return feeds.proposal_feed(rows, "https://h", mark)

    def deliver(rows):
        if step == "delivery" and not broken:
            broken.append(1)
            raise Died
        sent.extend(r.id for r in rows.collect())

    def note(rows, outbox, state, with_text=False):
        if (step, state) in (("queued", jobs.QUEUED), ("before", jobs.SENDING)) and not broken:
            broken.append(1)
            raise Died
        return real_note(rows, outbox, state, with_text)

    def save(*args):
        if step == "mark" and not broken:
            broken.append(1)
            raise Died
        return real_save(*args)

    broken, real_note, real_save = [], jobs._note, jobs.save_mark
    monkeypatch.setattr(jobs, "_note", note)
    monkeypatch.setattr(jobs, "save_mark", save)
    with pytest.raises(Died):
        jobs.feed_run(nodes, messages, deliver, marks, "2023-01-01 00:00:00")
    assert sent == received
    assert jobs.feed_run(nodes, messages, deliver, marks, "2023-01-01 00:00:00") == len(then)
    assert sent == received + then
    assert jobs.feed_run(nodes, messages, deliver, marks, "2023-01-01 00:00:00") == 0
    states = jobs.outbox_states(spark, f"{marks}_outbox").collect()
    assert {(r.id, r.state) for r in states} == {("1", jobs.SENT), ("2", jobs.SENT)} and all("Proposta" in r.message for r in states)


@pytest.mark.parametrize("choice,more", [("resend", [1, 2]), ("skip", [])])
def test_a_feed_that_dies_while_sending_leaves_a_doubt(spark, monkeypatch, choice, more):
    nodes = node(spark, state="accepted").unionByName(node(spark, id=2, publishedAt=dt.datetime(2024, 2, 1), updatedAt=None))
    sent, marks = [], f"fd_{choice}"

    def messages(rows, mark):
        return feeds.proposal_feed(rows, "https://h", mark)

    def dies(rows):
        raise KeyboardInterrupt  # no error that the run could still note

    with pytest.raises(KeyboardInterrupt):
        jobs.feed_run(nodes, messages, dies, marks, "2023-01-01 00:00:00")

    def deliver(rows):
        sent.extend(r.id for r in rows.collect())

    with pytest.raises(jobs.InDoubt, match="1, 2"):
        jobs.feed_run(nodes, messages, deliver, marks, "2023-01-01 00:00:00")
    assert jobs.feed_run(nodes, messages, deliver, marks, "2023-01-01 00:00:00", in_doubt=choice) == len(more)
    assert sent == more and jobs.feed_run(nodes, messages, deliver, marks, "2023-01-01 00:00:00") == 0


def test_feed_run_moves_the_mark_only_after_delivery(spark, tmp_path):
    nodes = node(spark, state="accepted").unionByName(node(spark, id=2, publishedAt=dt.datetime(2024, 2, 1), updatedAt=None))
    sent = []

    def messages(rows, mark):
        return feeds.proposal_feed(rows, "https://h", mark)

    def fails(rows):
        raise OSError("no connection")

    def run(deliver):
        return jobs.feed_run(nodes, messages, deliver, "run_marks", "2023-01-01 00:00:00")

    with pytest.raises(OSError):
        run(fails)
    assert run(lambda rows: sent.extend(r.id for r in rows.collect())) == 2 and sent == [1, 2]
    assert run(fails) == 0


def test_feed_stream_and_marks(spark, tmp_path):
    first = node(spark, state="accepted")
    first.write.parquet(str(tmp_path / "in"))
    stream = jobs.landed_files(spark, str(tmp_path / "in"), first.schema)

    def messages(rows):
        return feeds.proposal_message(feeds.proposal_rows(rows, "https://h"))

    for _ in range(2):
        jobs.feed_stream(stream, messages, str(tmp_path / "o"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 1
    node(spark, id=2, publishedAt=dt.datetime(2024, 2, 1)).write.mode("append").parquet(str(tmp_path / "in"))
    jobs.feed_stream(stream, messages, str(tmp_path / "o"), str(tmp_path / "c"))
    out = spark.read.parquet(str(tmp_path / "o"))
    assert sorted(r.id for r in out.collect()) == [1, 2]

    default = "2023-01-01 00:00:00"
    shown = spark.range(1).select(jobs.read_mark(spark, "feed_marks", default).cast("string")).first()[0]
    assert shown == default
    jobs.save_mark(out, "date", "feed_marks")
    jobs.save_mark(out.where("false"), "date", "feed_marks")
    assert spark.table("feed_marks").count() == 1
    shown = spark.range(1).select(jobs.read_mark(spark, "feed_marks", default).cast("string")).first()[0]
    assert shown == "2024-02-01 00:00:00"


def test_landing_schema(spark):
    assert landed(spark, {1: MESSAGES[:1]}).schema.simpleString().startswith("struct<poll_id:bigint,seq:bigint")
    assert wal.LANDING_DDL.count(",") == 5

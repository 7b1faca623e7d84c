"""Change log: golden messages, chunks against a single pass, threads against a walk."""

from __future__ import annotations

import datetime as dt
import random
import struct

import pytest
from pyspark.sql import functions as F

from layerwright.operators import carry as carry_module
from layerwright.operators.carry import carry
from layerwright.operators.threads import expand_threads, with_ancestors
from layerwright.plans import changes as C
from layerwright.plans import feeds
from layerwright.sources import wal

MICROS = 757_382_400_000_000  # 2024-01-01 since 2000-01-01


def begin(lsn, xid, micros=MICROS):
    return b"B" + struct.pack(">qqi", lsn, micros, xid)


def commit(lsn, end):
    return b"C" + struct.pack(">bqqq", 0, lsn, end, MICROS)


def relation(rid, *names, kind=25):
    out = b"R" + struct.pack(">i", rid) + b"public\0t%d\0d" % rid + struct.pack(">h", len(names))
    return out + b"".join(b"\x01" + n.encode() + b"\0" + struct.pack(">ii", kind, -1) for n in names)


def values(*items):
    out = struct.pack(">h", len(items))
    for item in items:
        if item is None or item is ...:
            out += b"n" if item is None else b"u"
        else:
            out += b"t" + struct.pack(">i", len(item.encode())) + item.encode()
    return out


def row(kind, rid, *parts):
    return kind.encode() + struct.pack(">i", rid) + b"".join(parts)


MESSAGES = [
    begin(10, 1), relation(5, "a", "b"), row("I", 5, b"N", values("1", "é")), commit(10, 11),
    begin(20, 2), row("U", 5, b"O", values("1", "é"), b"N", values("2", ...)),
    row("U", 5, b"N", values("3", None)), row("U", 5, b"K", values("3", None), b"N", values("4", "x")),
    relation(5, "a"), row("D", 5, b"K", values("4")), commit(20, 21),
    begin(30, 3), relation(6, "x"), b"T" + struct.pack(">ib", 2, 1) + struct.pack(">ii", 5, 6), commit(30, 31),
    b"Ytype", begin(40, 4), row("I", 5, b"N", values("1", "2")), row("I", 9, b"N", values("1")),
    row("I", 5, b"X"), commit(41, 42), begin(50, 5), row("I", 5, b"N", values("9")),
]


def landed(spark, polls):
    sent = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(poll, seq, sent, seq, seq, bytearray(m)) for poll, messages in polls.items() for seq, m in enumerate(messages)],
        wal.LANDING_DDL,
    )


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_golden_messages(spark, collected, chunk):
    records = collected(C.change_records(landed(spark, {1: MESSAGES}), chunk=chunk), "seq", "relation_id")
    short = [(r["seq"], r["table"], r["operation_type"], r["row_before_transaction"], r["row_after_transaction"],
              r["_transaction_id"], r["_transaction_end_lsn"], r["problem"]) for r in records]
    t = "public.t5"
    assert short == [
        (2, t, "I", None, {"a": "1", "b": "é"}, 1, 11, None),
        (5, t, "U", {"a": "1", "b": "é"}, {"a": "2", "b": None}, 2, 21, None),
        (6, t, "U", None, {"a": "3", "b": None}, 2, 21, None),
        (7, t, "U", {"a": "3", "b": None}, {"a": "4", "b": "x"}, 2, 21, None),
        (9, t, "D", {"a": "4"}, None, 2, 21, None),
        (13, t, "T", None, None, 3, 31, None),
        (13, "public.t6", "T", None, None, 3, 31, None),
        (15, "", "Y", None, None, 3, 42, "unknown message kind Y"),
        (17, t, "I", None, None, 4, 42, "commit of another transaction"),
        (18, "", "I", None, None, 4, 42, "commit of another transaction"),
        (19, t, "I", None, None, 4, 42, "commit of another transaction"),
        (22, t, "I", None, {"a": "9"}, 5, None, "open transaction"),
    ]
    assert [r["replica_identity_changed"] for r in records][1:5] == [False, False, True, True]
    assert records[1]["unchanged_columns"] == ["b"]
    assert records[0]["operation_timestamp"] == dt.datetime(2024, 1, 1)


def test_problems_of_rows(spark, collected):
    bad = [begin(1, 1), relation(5, "a"), row("I", 5, b"N", values("1", "2")), row("I", 9, b"N", values("1")),
           row("I", 5, b"X"), row("D", 5, b"N", values("1")), row("I", 5, b"N", values("1"))[:-1], commit(1, 2)]
    got = collected(C.change_rejects(landed(spark, {1: bad})), "seq")
    assert [r["problem"] for r in got] == [
        "more values than columns", "unknown relation", "no new row", "delete without an old row", "message ends early"]


def test_unchanged_marker_in_parity(spark):
    after = C.changes(landed(spark, {1: MESSAGES}), parity=True).where("seq = 5").first().row_after_transaction
    assert after == {"a": "2", "b": wal.UNCHANGED_TEXT}


def test_polls_do_not_share_state(spark):
    polls = {1: MESSAGES[:4], 2: [begin(60, 6), row("I", 5, b"N", values("1")), commit(60, 61)]}
    assert C.changes(landed(spark, polls)).count() == 1
    assert [r.problem for r in C.change_rejects(landed(spark, polls)).collect()] == ["unknown relation"]


def test_open_tail_and_cut(spark):
    log = landed(spark, {1: MESSAGES})
    assert [r.seq for r in C.open_tail(log).collect()] == [22]
    late = [begin(1, 1), commit(1, 2), begin(3, 2, MICROS + 10**6), commit(3, 4), begin(5, 3), commit(5, 6)]
    assert wal.cut_polls(landed(spark, {1: late, 2: late[:2]}), "2024-01-01 00:00:01").count() == 4


def test_typed_columns(spark):
    typed = C.typed(C.changes(landed(spark, {1: MESSAGES})), "row_after_transaction", {"a": 23, "b": 25})
    assert typed.where("seq = 2").select("a", "b").first() == (1, "é")


def test_decode_all_fields(spark):
    decoded = wal.decode(landed(spark, {1: MESSAGES}))
    rel = decoded.where("seq = 1").first()
    assert (rel.namespace, rel.relation_name, rel.identity_setting) == ("public", "t5", ord("d"))
    assert [c.asDict() for c in rel["columns"]][1] == {
        "column_name": "b", "key": 1, "data_type": 25, "data_type_modifier": -1}
    end = decoded.where("seq = 3").first()
    assert (end.commit_lsn, end.transaction_lsn, end.is_unused) == (10, 11, 0)
    assert wal.rejected(decoded).count() == 2


@pytest.mark.parametrize("chunk", [1, 7, 50, 10_000])
def test_carry_against_a_single_pass(spark, chunk):
    rnd = random.Random(chunk)
    data = [(g, p, rnd.choice([None, None, None, p])) for g in (1, 2) for p in sorted(rnd.sample(range(900), 200))]
    df = spark.createDataFrame(data, "g int, p long, v long")
    got = {(r.g, r.p): (r.a, r.b) for r in carry(
        df, ["g"], "p", last={"a": F.col("v")}, following={"b": F.col("v")}, chunk=chunk).collect()}
    for g, p, _ in data:
        said = [(q, v) for h, q, v in data if h == g and v is not None]
        a = max(((q, v) for q, v in said if q <= p), default=(None, None))[1]
        b = min(((q, v) for q, v in said if q >= p), default=(None, None))[1]
        assert got[(g, p)] == (a, b)


def test_tasks_of_a_log_grow_with_its_messages(spark, monkeypatch, tmp_path):
    """However well the log packs, a task has about as many messages; the records stay the same, and tables in order."""
    messages = landed(spark, {p: MESSAGES for p in range(40)})
    want = sorted(map(str, C.change_records(messages, chunk=5).collect()))
    assert C.read_log(messages, chunk=5).select(F.spark_partition_id().alias("p")).distinct().count() == 1
    monkeypatch.setattr(carry_module, "ROWS_PER_TASK", 100)
    assert carry_module.tasks_for(messages) == -(-40 * len(MESSAGES) // 100) == 10
    log = C.read_log(messages, chunk=5).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(log) >= 8 and max(r["count"] for r in log) <= 250
    assert sorted(map(str, C.change_records(messages, chunk=5).collect())) == want
    out = str(tmp_path / "tables")
    C.by_table(C.changes(messages, chunk=5), out)
    files = spark.read.parquet(out).groupBy(F.input_file_name().alias("file")).agg(F.min("poll_id").alias("a"), F.max("poll_id").alias("z"), F.count("*").alias("n"))
    assert files.count() > 3 and files.agg(F.sum("n")).first()[0] == C.changes(messages, chunk=5).count()


def test_threads_against_a_walk(spark):
    rnd = random.Random(3)
    parents = {i: None if i < 4 else rnd.choice([i - 1, i - 1, rnd.randint(0, i - 1)]) for i in range(120)}
    parents.update({500: 501, 501: 500, 600: 999})  # a cycle and an orphan
    data = [(i, p, f"r{i}" if p is None else None) for i, p in parents.items()]
    df = spark.createDataFrame(data, "id long, parent long, root string")
    got = {r.id: (r.thread_id, r.depth, r.root, r.parent_comment_id)
           for r in expand_threads(df, "id", "parent", "root").collect()}
    expected = {}
    for i in range(120):
        depth, top = 1, i
        while parents[top] is not None:
            depth, top = depth + 1, parents[top]
        expected[i] = (top, depth, f"r{top}", i if parents[i] is None else parents[i])
    assert got == expected


def test_threads_of_a_window_read_only_what_they_hang_on(spark, tmp_path):
    """A long history and a few late replies: the closure has their ancestors alone, and scans only the ids near them."""
    parents = {i: None if i % 10 == 0 else i - 1 for i in range(5000)}
    parents.update({5000: 4999, 5001: 5000, 5002: None, 5003: 4203, 5004: 9999})
    data = [(i, p, f"r{i}" if p is None else None) for i, p in parents.items()]
    spark.createDataFrame(data, "id long, parent long, root string").repartitionByRange(20, "id").sortWithinPartitions("id").write.parquet(str(tmp_path / "c"))
    comments = spark.read.parquet(str(tmp_path / "c"))
    read = []
    between = type(F.col("id")).between

    def noting(self, low, high):
        bounds = spark.range(1).select(low, high).first()
        read.append(spark.read.parquet(str(tmp_path / "c")).where(f"id BETWEEN {bounds[0]} AND {bounds[1]}").count())
        return between(self, low, high)

    with pytest.MonkeyPatch.context() as patched:
        patched.setattr(type(F.col("id")), "between", noting)
        near = with_ancestors(comments.where("id IN (5001, 5002, 5004, 4999)"), comments, "id", "parent")
    assert sorted(r.id for r in near.collect()) == [*range(4990, 5003), 5004]
    assert read and sum(read) < 60  # of more than 5,000 comments
    closure = with_ancestors(comments.where("id >= 5000"), comments, "id", "parent")
    whole = {r.id: r for r in expand_threads(comments, "id", "parent", "root").collect()}
    got = {r.id: r for r in expand_threads(closure, "id", "parent", "root").collect()}
    assert got == {i: whole[i] for i in got} and {5000, 5001, 5002, 5003} <= set(got) and 5004 not in got
    assert with_ancestors(comments.limit(0), comments, "id", "parent").count() == 0


def test_a_window_of_comments_equals_the_window_of_all(spark):
    rows = [(i, None if i % 7 == 0 else i - 1 - i % 2 * (i % 7 > 1), "c" if i % 7 == 0 else None, "b", 1, "n", f"2024-01-{i % 28 + 1:02d}T00:00:00Z", None, "s")
            for i in range(140)]
    comments = spark.createDataFrame(rows, "id long, parent_id long, root_component_id string, body string, author_id long, author_name string, "
                                           "createdAt string, updatedAt string, status string")
    low, high = F.lit("2024-01-09").cast("timestamp"), F.lit("2024-01-13").cast("timestamp")
    everything = {r.comment_id: r for r in feeds.comment_rows(comments, "https://h").collect()}
    got = {r.comment_id: r for r in feeds.comment_rows(comments, "https://h", low, high).collect()}
    assert got == {i: r for i, r in everything.items() if dt.datetime(2024, 1, 9) < r.date_filter < dt.datetime(2024, 1, 13)} and len(got) > 10


def test_a_relation_is_described_once_for_all_rows_of_a_batch(monkeypatch):
    import pyarrow as pa

    from layerwright.sources import wal

    made, asked = {}, []

    class Marked:
        def asNondeterministic(self):
            return self

    def keep(function, returnType):
        made["read"] = function
        return Marked()

    monkeypatch.setattr(wal.F, "arrow_udf", keep)

    def described(data):
        asked.append(data)
        return {"namespace": "n", "relation_name": data.decode(), "names": ["a"], "type_ids": [20], "modifiers": [-1]}

    wal._arrow_change_reader(described, lambda data, head: {"error": head.get("error"), "new_values": [data.decode()]})
    got = made["read"](pa.array([b"1", b"2", b"3", b"4"]), pa.array([b"x", b"y", None, b"x"])).to_pylist()
    assert asked == [b"x", b"y"]
    assert [(r["relation_name"], r["names"], r["new_values"], r["error"]) for r in got] == [
        ("x", ["a"], ["1"], None), ("y", ["a"], ["2"], None), (None, None, ["3"], "unknown relation"), ("x", ["a"], ["4"], None)]


def test_a_value_that_ends_early_is_told():
    from layerwright.sources.wal import _parsers

    body, head = _parsers(), b"I\x00\x00\x40\x10N\x00\x01t"
    assert body(head + b"\x00\x00\x00\x02ab")["new_values"] == ["ab"]
    for tail in (b"", b"\x00\x00\x00", b"\x00\x00\x00\x03ab", b"\xff\xff\xff\xff", b"\x80\x00\x00\x00"):
        assert body(head + tail) == {"error": "message ends early"}, tail

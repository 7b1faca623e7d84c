"""Change-log queries. Orders are written as replication messages and read back.

Every year is one poll and every order one transaction: begin, now and then a relation message, the
insert, an update of finished orders (old row, new row with an unchanged column), a delete of
pending ones, a truncate of two relations for one priority, commit. Some commits name another
transaction, and the last order of each poll stays open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.acceptance.tables import Registry, table
from layerwright.operators.dedup import latest_per_key
from layerwright.plans import changes
from layerwright.session import materialize
from layerwright.sources import wal

registry = Registry()

ORDERS, AUDIT = 16400, 16500


def _number(value: Column | int, size: int) -> Column:
    """Hex digits of a big-endian integer."""
    value = F.lit(value).cast("long") if isinstance(value, int) else value.cast("long")
    return F.substr(F.lpad(F.hex(value), 16, "0"), F.lit(17 - 2 * size))


def _text(value: Column | str) -> Column:
    value = F.lit(value) if isinstance(value, str) else value
    return F.hex(F.encode(value, "UTF-8"))


def _zero_ended(value: str) -> Column:
    return F.concat(_text(value), F.lit("00"))


def _value(value: Column) -> Column:
    text = value.cast("string")
    return F.concat(F.lit("74"), _number(F.octet_length(text), 4), _text(text))


_NULL, _UNCHANGED = "6E", "75"


def _tuple(*values: Column) -> Column:
    return F.concat(_number(len(values), 2), *values)


def _relation(relation_id: int, name: str, columns: dict[str, int]) -> Column:
    described = [F.concat(F.lit("01"), _zero_ended(c), _number(kind, 4), _number(-1, 4)) for c, kind in columns.items()]
    return F.concat(F.lit("52"), _number(relation_id, 4), _zero_ended("public"), _zero_ended(name), F.lit("64"),
                    _number(len(columns), 2), *described)


def landed(spark, sf) -> DataFrame:
    """All messages, written in the landing layout as a poll would leave them."""
    orders = table(spark, sf, "orders").withColumn("poll_id", F.year("o_orderdate").cast("long"))
    last = orders.groupBy("poll_id").agg(F.max("o_orderkey").alias("last_key"))
    # One row per year on the right. A log lands in many files, so its orders are spread first.
    rows = orders.join(F.broadcast(last), "poll_id").repartition("o_orderkey")
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    micros = F.unix_micros(F.col("o_orderdate").cast("timestamp")) - F.lit(946684800000000)
    lsn = key * 100 + 1
    full = [_value(key), _value(F.col("o_custkey")), _value(status)]

    def when(condition: Column, payload: Column) -> Column:
        return F.when(condition, payload)

    def row(kind: str, *parts: Column) -> Column:
        return F.concat(F.lit(kind), _number(ORDERS, 4), *parts)

    always = F.lit(True)
    wrong = (priority == "4-NOT SPECIFIED") & (status == "P")
    payloads = [
        F.concat(F.lit("42"), _number(lsn, 8), _number(micros, 8), _number(key, 4)),
        F.when(priority == "1-URGENT", _relation(
            ORDERS, "orders", {"o_orderkey": 20, "o_custkey": 20, "o_orderstatus": 25}
        )).when(priority == "5-LOW", _relation(
            ORDERS, "orders", {"o_orderkey": 20, "o_custkey": 20, "o_state": 25}
        )).when(priority == "2-HIGH", _relation(AUDIT, "audit", {"entry": 25})),
        when(always, row("49", F.lit("4E"), _tuple(*full))),
        when(status == "F", row("55", F.lit("4F"), _tuple(_value(key), _value(F.col("o_custkey")), _value(F.lit("É"))),
                                F.lit("4E"), _tuple(_value(key), F.lit(_UNCHANGED), _value(status)))),
        when(status == "P", row("44", F.lit("4B"), _tuple(_value(key), F.lit(_NULL), F.lit(_NULL)))),
        when(priority == "3-MEDIUM", F.concat(
            F.lit("54"), _number(2, 4), _number(1, 1), _number(ORDERS, 4), _number(AUDIT, 4))),
        when(key != F.col("last_key"), F.concat(
            F.lit("4300"), _number(F.when(wrong, lsn + 1).otherwise(lsn), 8), _number(lsn + 49, 8), _number(micros, 8))),
    ]
    log = rows.select("poll_id", "o_orderkey", F.posexplode(F.array(*payloads)).alias("k", "digits")).where(
        F.col("digits").isNotNull()
    ).select(
        "poll_id", (key * 8 + F.col("k")).alias("seq"),
        F.lit("2024-01-01").cast("timestamp").alias("send_time"),
        (key * 100).alias("data_start"), (key * 100 + 99).alias("wal_end"), F.unhex("digits").alias("payload"),
    )
    return materialize(log, "messages")


# The same log in SQL: orders with their poll, schema in force and problem.
LOG_SQL = f"""
    WITH o AS (
        SELECT *, CAST(year(o_orderdate) AS BIGINT) AS poll_id, o_orderkey * 8 AS base,
               o_orderkey = max(o_orderkey) OVER (PARTITION BY year(o_orderdate)) AS is_last,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 'o_orderstatus'
                    WHEN o_orderpriority = '5-LOW' THEN 'o_state' END AS third,
               CASE WHEN o_orderpriority = '2-HIGH' THEN 1 END AS audit
        FROM orders),
    a AS (
        SELECT *, last_value(third IGNORE NULLS) OVER w AS named, last_value(audit IGNORE NULLS) OVER w AS audited,
               CASE WHEN is_last THEN 'open transaction'
                    WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P'
                         THEN 'commit of another transaction' END AS broken
        FROM o WINDOW w AS (PARTITION BY poll_id ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)),
    d AS (
        SELECT *, 'I' AS op, base + 2 AS seq, {ORDERS} AS relation_id FROM a
        UNION ALL SELECT *, 'U', base + 3, {ORDERS} FROM a WHERE o_orderstatus = 'F'
        UNION ALL SELECT *, 'D', base + 4, {ORDERS} FROM a WHERE o_orderstatus = 'P'
        UNION ALL SELECT *, 'T', base + 5, unnest([{ORDERS}, {AUDIT}]) FROM a WHERE o_orderpriority = '3-MEDIUM'),
    r AS (
        SELECT *, coalesce(broken, CASE WHEN relation_id = {ORDERS} AND named IS NULL THEN 'unknown relation'
                                        WHEN relation_id = {AUDIT} AND audited IS NULL THEN 'unknown relation' END)
               AS problem
        FROM d)"""


@registry.add("q_cdc_decode", """
    WITH o AS (SELECT *, CAST(year(o_orderdate) AS BIGINT) AS poll_id, CAST(o_orderdate AS TIMESTAMP) AS made,
                      o_orderkey = max(o_orderkey) OVER (PARTITION BY year(o_orderdate)) AS is_last,
                      o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' AS wrong,
                      o_orderkey * 100 + 1 AS own FROM orders),
    m AS (SELECT *, substr('BRIUDTC', k + 1, 1) AS type FROM o, (SELECT unnest([0, 1, 2, 3, 4, 5, 6]) AS k)
          WHERE k IN (0, 2) OR (k = 1 AND left(o_orderpriority, 1) IN ('1', '2', '5')) OR (k = 3 AND o_orderstatus = 'F')
                OR (k = 4 AND o_orderstatus = 'P') OR (k = 5 AND o_orderpriority = '3-MEDIUM') OR (k = 6 AND NOT is_last))
    SELECT poll_id, o_orderkey * 8 + k AS seq, type,
           CASE WHEN type = 'B' THEN own END AS lsn, CASE WHEN type = 'B' THEN CAST(o_orderkey AS INT) END AS transaction_id,
           CASE WHEN type = 'B' THEN made END AS commit_timestamp,
           CASE WHEN type = 'C' THEN own + CAST(wrong AS INT) END AS commit_lsn,
           CASE WHEN type = 'C' THEN own + 49 END AS transaction_lsn, CASE WHEN type = 'C' THEN made END AS commit_time,
           CASE WHEN type = 'R' AND o_orderpriority = '2-HIGH' THEN 16500 WHEN type IN ('R', 'I', 'U', 'D') THEN 16400 END AS relation_id,
           CASE WHEN type = 'R' THEN CASE WHEN o_orderpriority = '2-HIGH' THEN 'public.audit' ELSE 'public.orders' END END AS relation,
           CASE WHEN type = 'R' THEN 100 END AS identity_setting,
           CASE WHEN type = 'R' THEN CASE o_orderpriority
                WHEN '2-HIGH' THEN 'entry 1 25 -1'
                WHEN '1-URGENT' THEN 'o_orderkey 1 20 -1,o_custkey 1 20 -1,o_orderstatus 1 25 -1'
                ELSE 'o_orderkey 1 20 -1,o_custkey 1 20 -1,o_state 1 25 -1' END END AS columns,
           CASE type WHEN 'I' THEN o_orderkey || ',' || o_custkey || ',' || o_orderstatus
                     WHEN 'U' THEN o_orderkey || ',?,' || o_orderstatus END AS new_row,
           CASE type WHEN 'U' THEN o_orderkey || ',' || o_custkey || ',É' WHEN 'D' THEN o_orderkey || ',?,?' END AS old_row,
           CASE type WHEN 'U' THEN '1' WHEN 'I' THEN '' END AS unchanged,
           CASE type WHEN 'U' THEN FALSE WHEN 'D' THEN TRUE END AS key_only,
           CASE WHEN type = 'T' THEN '16400,16500' END AS truncated, CASE WHEN type = 'T' THEN 1 END AS truncate_option
    FROM m""")
def q_cdc_decode(spark, sf):
    def joined(name):
        return F.array_join(F.col(name).cast("array<string>"), ",", "?")

    columns = F.transform("columns", lambda c: F.concat_ws(" ", c["column_name"], c["key"], c["data_type"], c["data_type_modifier"]))
    relation = F.when(F.col("type") == "R", F.concat_ws(".", "namespace", "relation_name"))
    return wal.decode(landed(spark, sf)).select(
        "poll_id", "seq", "type", "lsn", "transaction_id",
        F.col("commit_timestamp").cast("timestamp_ntz").alias("commit_timestamp"), "commit_lsn", "transaction_lsn",
        F.col("commit_time").cast("timestamp_ntz").alias("commit_time"), "relation_id", relation.alias("relation"),
        "identity_setting", F.array_join(columns, ",").alias("columns"), joined("new_values").alias("new_row"),
        joined("old_values").alias("old_row"), joined("new_unchanged").alias("unchanged"),
        F.col("replica_identity_changed").alias("key_only"), joined("truncated_relations").alias("truncated"), "truncate_option",
    )


@registry.add("q_cdc_transactions", LOG_SQL + """
    SELECT DISTINCT poll_id, seq, CAST(o_orderkey AS INT) AS transaction_id, o_orderkey * 100 + 1 AS start_lsn,
           CASE WHEN NOT is_last THEN o_orderkey * 100 + 50 END AS end_lsn, broken AS problem FROM r""")
def q_cdc_transactions(spark, sf):
    rows = changes.data_messages(landed(spark, sf))
    return rows.select(
        "poll_id", "seq", F.col("_transaction_id").alias("transaction_id"),
        F.col("_transaction_start_lsn").alias("start_lsn"), F.col("_transaction_end_lsn").alias("end_lsn"), "problem",
    )


@registry.add("q_cdc_schema_asof", LOG_SQL + """
    SELECT poll_id, seq, op AS operation_type, 'o_orderkey,o_custkey,' || named AS columns
    FROM r WHERE relation_id = 16400 AND problem IS NULL""")
def q_cdc_schema_asof(spark, sf):
    records = changes.changes(landed(spark, sf)).where(F.col("table") == "public.orders")
    return records.select("poll_id", "seq", "operation_type", F.array_join(F.map_keys("column_types"), ",").alias("columns"))


@registry.add("q_cdc_changes", LOG_SQL + """
    SELECT poll_id, seq, CASE WHEN relation_id = 16400 THEN 'public.orders' ELSE 'public.audit' END AS table_name,
           op AS operation_type, CAST(o_orderdate AS TIMESTAMP) AS operation_timestamp,
           CASE WHEN op IN ('U', 'D') THEN o_orderkey END AS key_before,
           CASE WHEN op IN ('I', 'U') THEN o_orderkey END AS key_after,
           CASE WHEN op = 'U' THEN o_custkey END AS customer_before,
           CASE WHEN op = 'I' THEN o_custkey END AS customer_after,
           CASE WHEN op IN ('I', 'U') AND named = 'o_orderstatus' THEN o_orderstatus END AS status_after,
           CASE WHEN op IN ('I', 'U') AND named = 'o_state' THEN o_orderstatus END AS state_after,
           CASE WHEN op = 'U' THEN 'o_custkey' WHEN op = 'I' THEN '' END AS unchanged,
           CAST(o_orderkey AS INT) AS transaction_id, o_orderkey * 100 + 50 AS end_lsn
    FROM r WHERE problem IS NULL""")
def q_cdc_changes(spark, sf):
    records = changes.changes(landed(spark, sf))
    records = changes.typed(records, "row_after_transaction", {"o_orderkey": 20, "o_custkey": 20})
    before, after = F.col("row_before_transaction"), F.col("row_after_transaction")
    return records.select(
        "poll_id", "seq", F.col("table").alias("table_name"), "operation_type",
        F.col("operation_timestamp").cast("timestamp_ntz").alias("operation_timestamp"),
        before["o_orderkey"].try_cast("long").alias("key_before"), F.col("o_orderkey").alias("key_after"),
        before["o_custkey"].try_cast("long").alias("customer_before"), F.col("o_custkey").alias("customer_after"),
        after["o_orderstatus"].alias("status_after"), after["o_state"].alias("state_after"),
        F.array_join("unchanged_columns", ",").alias("unchanged"),
        F.col("_transaction_id").alias("transaction_id"), F.col("_transaction_end_lsn").alias("end_lsn"),
    )


@registry.add("q_cdc_rejects", LOG_SQL + """
    SELECT problem, op AS operation_type, count(*) AS n FROM r WHERE problem IS NOT NULL GROUP BY ALL""")
def q_cdc_rejects(spark, sf):
    rejects = changes.change_rejects(landed(spark, sf))
    return rejects.groupBy("problem", "operation_type").agg(F.count(F.lit(1)).alias("n"))


@registry.add("q_cdc_truncate", LOG_SQL + """
    SELECT poll_id, seq, CASE WHEN relation_id = 16400 THEN 'public.orders' ELSE 'public.audit' END AS table_name,
           CAST(o_orderkey AS INT) AS transaction_id
    FROM r WHERE op = 'T' AND problem IS NULL""")
def q_cdc_truncate(spark, sf):
    records = changes.changes(landed(spark, sf)).where(F.col("operation_type") == "T")
    return records.select("poll_id", "seq", F.col("table").alias("table_name"),
                          F.col("_transaction_id").alias("transaction_id"))


@registry.add("q_cdc_poll_cut", """
    WITH o AS (SELECT *, CAST(year(o_orderdate) AS BIGINT) AS poll_id FROM orders),
    late AS (SELECT poll_id, min(o_orderkey) AS first_late FROM o WHERE o_orderdate >= TIMESTAMP '1997-12-31' GROUP BY 1)
    SELECT poll_id, o_orderkey AS transaction_id FROM o LEFT JOIN late USING (poll_id)
    WHERE first_late IS NULL OR o_orderkey < first_late""")
def q_cdc_poll_cut(spark, sf):
    kept = wal.cut_polls(landed(spark, sf), "1997-12-31 00:00:00")
    return wal.decode_headers(kept).where(F.col("type") == "B").select(
        "poll_id", F.col("transaction_id").cast("long").alias("transaction_id")
    )


@registry.add("q_cdc_latest_rows", LOG_SQL + """
    SELECT o_orderkey AS id, operation_type, customer
    FROM (SELECT o_orderkey, op AS operation_type, CASE WHEN op = 'I' THEN o_custkey END AS customer, seq
          FROM r WHERE problem IS NULL AND op <> 'T')
    QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1""")
def q_cdc_latest_rows(spark, sf):
    """The state of each row after all its changes, which is what an upsert of the log would write."""
    records = changes.changes(landed(spark, sf)).where(F.col("operation_type") != "T")
    rows = records.select(
        F.coalesce(F.col("row_after_transaction")["o_orderkey"], F.col("row_before_transaction")["o_orderkey"])
        .cast("long").alias("id"), "operation_type",
        F.col("row_after_transaction")["o_custkey"].try_cast("long").alias("customer"), "seq",
    )
    return latest_per_key(rows, ["id"], "seq").drop("seq")


_MONEY = ((15 << 16) | 2) + 4  # the modifier of numeric(15, 2)


@registry.add("q_cdc_typed", """
    SELECT o_orderkey AS id, o_orderstatus = 'F' AS finished, CAST(o_totalprice AS DECIMAL(15, 2)) AS price,
           CAST(o_orderdate AS DATE) AS day, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 90 MINUTE AS at,
           hex(encode(o_orderpriority)) AS raw, CAST(NULL AS SMALLINT) AS absent
    FROM orders""")
def q_cdc_typed(spark, sf):
    """Rows as the log carries them, as text by column name, in the types of their relation."""
    at = F.date_format(F.col("o_orderdate").cast("timestamp_ntz"), "yyyy-MM-dd")
    row = F.map_from_arrays(
        F.array(*[F.lit(n) for n in ("id", "finished", "price", "day", "at", "raw")]),
        F.array(F.col("o_orderkey").cast("string"), F.when(F.col("o_orderstatus") == "F", "t").otherwise("f"),
                F.format_string("%.2f", "o_totalprice"), at, F.concat(at, F.lit(" 01:30:00")),
                F.concat(F.lit("\\x"), F.lower(F.hex(F.encode("o_orderpriority", "UTF-8"))))))
    records = table(spark, sf, "orders").select(row.alias("after"))
    types = {"id": 20, "finished": 16, "price": (1700, _MONEY), "day": 1082, "at": 1114, "raw": 17, "absent": 21}
    return changes.typed(records, "after", types).drop("after").withColumn("raw", F.hex("raw"))

"""Whole runs on the given tables: ingestion, feeds, streams, published tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.acceptance.feeds import MARK, PROPOSALS_SQL, SITE, nodes, spaces
from layerwright.acceptance.messages import LOG_SQL, landed
from layerwright.acceptance.tables import Registry, scratch_database, table
from layerwright.plans import changes, configs, feeds, gold
from layerwright.schemas import layer_database
from layerwright.session import new_work_path
from layerwright.sources.ingest import ingest_spec, ingest_visits
from layerwright.sources.readers import counted_keys, cuts_query, range_predicates
from layerwright.sources.specs import parse_spec
from layerwright.sources.writers import PART_COLUMN, publish_table
from layerwright.streaming import jobs

registry = Registry()


# Ingestion.

_RUNS = (("1997-03-01", "1997-02-28", "1997-03-03"), ("1997-03-02", "1997-03-01", "1997-03-04"))


@registry.add("q_ingest_spec", " UNION ALL ".join([
    "SELECT 'nation' AS source_table, count(*) AS n_rows, sum(n_nationkey) AS keys FROM nation",
    "SELECT 'supplier', count(*), sum(s_suppkey) FROM supplier",
    f"SELECT 'orders', count(*), CAST(coalesce(sum(o_orderkey), 0) AS BIGINT) FROM orders "
    f"WHERE o_orderdate >= DATE '{_RUNS[0][1]}' AND o_orderdate < DATE '{_RUNS[1][2]}'",
]))
def q_ingest_spec(spark, sf):
    """Two daily runs over a spec: tables refreshed whole, one read by a window that overlaps the day before's."""
    database = scratch_database()
    spec = parse_spec({"name": "given", "extractions": {
        "nation": {"ingestion_type": "full_refresh", "destination_schema": database},
        "supplier": {"ingestion_type": "full_refresh", "destination_schema": database, "exclude_columns": ["S_ACCTBAL"]},
        "orders": {"ingestion_type": "incremental", "destination_schema": database, "exclude_columns": ["o_totalprice"],
                   "incremental_filter": "o_orderdate >= '{{ macros.ds_add(ds, -1) }}' and o_orderdate < '{{ macros.ds_add(ds, 2) }}'"},
    }})
    for day, _, _ in _RUNS:
        for name, keys in (("nation", "n_nationkey"), ("supplier", "s_suppkey"), ("orders", "o_orderkey")):
            one = parse_spec({"name": name, "extractions": {name: _extraction(spec.by_table[name])}})
            ingest_spec(one, lambda e: table(spark, sf, e.table), date.fromisoformat(day), keys)
    kept = None
    for name, key in (("nation", "n_nationkey"), ("supplier", "s_suppkey"), ("orders", "o_orderkey")):
        rows = spark.table(f"{database}.{name}")
        one = rows.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(key), F.lit(0)).alias("keys")).select(F.lit(name).alias("source_table"), "n_rows", "keys")
        kept = one if kept is None else kept.unionAll(one)
    return kept


def _extraction(e) -> dict:
    return {"ingestion_type": e.ingestion_type, "destination_schema": e.destination_schema, "exclude_columns": list(e.exclude_columns),
            **({"incremental_filter": e.incremental_filter} if e.incremental_filter else {})}


@registry.add("q_ingest_visits", """
    SELECT event_id AS visit, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN event_type = 'click' THEN 2 ELSE 1 END AS actions,
           '[{"type":"' || event_type || '"}]' AS details, '{"siteName":"s' || (event_id % 3) || '"}' AS others
    FROM events""")
def q_ingest_visits(spark, sf):
    """Landed pages of the visits feed, each a file with an array; the second landing brings days that are there again."""
    visits = table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 5_000).alias("page"), F.col("event_id").alias("idVisit"), F.date_format("ts", "yyyy-MM-dd").alias("serverDate"),
        F.when(F.col("event_type") == "click", 2).otherwise(1).alias("actions"),
        F.array(F.struct(F.col("event_type").alias("type"))).alias("actionDetails"),
        F.concat(F.lit("s"), (F.col("event_id") % 3).cast("string")).alias("siteName"))
    name = f"{scratch_database()}.visits"
    wrong = visits.where("serverDate >= '2024-01-10'").withColumn("actions", F.lit(99))
    for landing in (wrong, visits):
        path = new_work_path(spark, "landed-pages")
        one = F.struct(*[c for c in landing.columns if c != "page"])
        landing.groupBy("page").agg(F.to_json(F.collect_list(one)).alias("value")).write.partitionBy("page").text(path)
        ingest_visits(spark, path, name)
    return spark.table(name).select(
        F.col("idVisit").cast("long").alias("visit"), F.col("serverDate").cast("string").alias("day"), F.col("actions").cast("int").alias("actions"),
        F.col("actionDetails").alias("details"), F.col("other_fields").alias("others"))


@registry.add("q_key_ranges", """
    WITH p AS (SELECT l_orderkey AS k, ntile(7) OVER (ORDER BY l_orderkey) AS part FROM lineitem),
    c AS (SELECT max(k) AS cut FROM p GROUP BY part),
    e AS (SELECT cut, lag(cut) OVER (ORDER BY cut) AS low FROM (SELECT DISTINCT cut FROM c))
    SELECT CAST(row_number() OVER (ORDER BY cut) - 1 AS INTEGER) AS part, count(*) AS n_rows, min(l_orderkey) AS first, max(l_orderkey) AS last
    FROM e JOIN lineitem ON l_orderkey <= cut AND (low IS NULL OR l_orderkey > low) GROUP BY cut""")
def q_key_ranges(spark, sf):
    """Ranges of a key for a parallel read, with the rows that each reads."""
    lines = table(spark, sf, "lineitem").select("l_orderkey")
    view = scratch_database()
    counted_keys(lines, "l_orderkey").createOrReplaceTempView(view)
    cuts = [r["cut"] for r in spark.sql(cuts_query(view, "l_orderkey", 7, counted=True)).collect()]
    spark.catalog.dropTempView(view)
    part = F.coalesce(*[F.when(F.expr(p), F.lit(i)) for i, p in enumerate(range_predicates("l_orderkey", cuts))])
    return lines.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n_rows"), F.min("l_orderkey").alias("first"), F.max("l_orderkey").alias("last"))


# Published tables.


@registry.add("q_layer_tables", " UNION ALL ".join(
    f"SELECT '{shown}' AS layer_name, r_regionkey, r_name FROM region" for shown in ("silver", "gold", "test_silver", "test_gold", "test")))
def q_layer_tables(spark, sf):
    """One model published for production and for another target, read back by the names of its layers."""
    name, rows = scratch_database(), None
    for target, layer in (("prod", "silver"), ("prod", "gold"), ("test", "silver"), ("test", "gold"), ("test", None)):
        publish_table(table(spark, sf, "region"), name, target, layer)
        database = layer_database(target, layer)
        one = spark.table(f"{database}.{name}").select(F.lit(database).alias("layer_name"), "r_regionkey", "r_name")
        rows = one if rows is None else rows.unionAll(one)
    return rows


@registry.add("q_indexed_lookup", "SELECT * FROM orders WHERE o_custkey IN (1, 7, 100)")
def q_indexed_lookup(spark, sf):
    """A published table that is looked up by a column it is indexed by."""
    name = publish_table(table(spark, sf, "orders"), scratch_database(), "test", "gold", ["o_orderkey"], index_by=["o_custkey"])
    return spark.table(name).where(F.col("o_custkey").isin(1, 7, 100))


@registry.add("q_visit_sketches", """
    SELECT user_id AS proposal_id, TRUE AS near FROM events
    WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1""")
def q_visit_sketches(spark, sf):
    """Different visits of two weeks from daily sketches, within four standard errors of the exact number."""
    visits = table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("session_date"), F.col("user_id").cast("string").alias("proposal_id"), F.col("event_id").alias("session_id"))
    about = gold.visits_between(gold.visit_sketches(visits), "2024-01-05", "2024-01-19")
    exact = visits.where("session_date BETWEEN '2024-01-05' AND '2024-01-19'").groupBy(F.col("proposal_id").cast("bigint").alias("proposal_id")).agg(
        F.count_distinct("session_id").alias("exact"))
    return about.join(exact, "proposal_id").select("proposal_id", (F.abs(F.col("visits") - F.col("exact")) <= F.greatest(F.lit(1), 0.065 * F.col("exact"))).alias("near"))


# Feeds.


@registry.add("q_feed_run", PROPOSALS_SQL + f"""
    SELECT CAST(id AS VARCHAR) AS id, date AS at, 'sent' AS state, TRUE AS in_order
    FROM s WHERE published > TIMESTAMP '{MARK}' OR updated > TIMESTAMP '{MARK}'""")
def q_feed_run(spark, sf):
    """A feed that fails to deliver, then delivers, then has nothing new: what the outbox says, and whether it was sent in order."""
    database = scratch_database()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def to_messages(rows: DataFrame, mark) -> DataFrame:
        return feeds.proposal_feed(rows, SITE, mark)

    def fails(rows: DataFrame) -> None:
        raise ConnectionError("nobody there")

    def deliver(rows: DataFrame) -> None:  # rows come in order; the number is of this order, the task's above 33 bits
        rows.select("id", "date").withColumn("n", F.monotonically_increasing_id()).write.mode("append").saveAsTable(f"{database}.delivered")

    def run(to) -> int:
        return jobs.feed_run(nodes(spark, sf), to_messages, to, f"{database}.marks", MARK)

    try:
        run(fails)
    except ConnectionError:
        pass
    run(deliver)
    run(fails)  # there is nothing left to deliver
    sent = spark.table(f"{database}.delivered").withColumn("task", F.shiftright("n", 33))
    earlier = F.expr("lag(struct(date, id)) OVER (PARTITION BY task ORDER BY n)")
    sent = sent.select(F.col("id").cast("string").alias("id"), F.coalesce(earlier < F.struct("date", "id"), F.lit(True)).alias("in_order"))
    states = jobs.outbox_states(spark, f"{database}.marks_outbox")
    return states.join(sent, "id").select("id", F.col("at").cast("timestamp_ntz").alias("at"), "state", "in_order")


@registry.add("q_component_rows", PROPOSALS_SQL + " SELECT id, state, date FROM s")
def q_component_rows(spark, sf):
    """Rows of a component by its type."""
    rows = feeds.rows_of_component("Proposals", nodes(spark, sf), SITE)
    return rows.select("id", "state", F.col("date").cast("timestamp_ntz").alias("date"))


@registry.add("q_with_chat", """
    SELECT CAST(s_suppkey AS INT) AS component_id, CASE WHEN s_suppkey % 4 = 0 THEN 0 ELSE CAST('-100' || s_suppkey AS BIGINT) END AS chat
    FROM supplier WHERE s_acctbal BETWEEN 0 AND 5000 AND s_suppkey % 4 <> 0""")
def q_with_chat(spark, sf):
    """Configs that have a chat; a chat of number 0 is none."""
    rows = configs.config_rows(spaces(spark, sf), "2024-01-31")
    rows = rows.withColumn("telegram_group_id", F.when(F.col("component_id") % 4 == 0, F.col("telegram_group_id") * 0).otherwise(F.col("telegram_group_id")))
    return feeds.with_chat(rows).select("component_id", F.col("telegram_group_id").alias("chat"))


@registry.add("q_known_fields", """
    SELECT o_orderkey AS id, '-' AS title, '-' AS author_name, CASE WHEN o_orderstatus = 'O' THEN 'accepted' ELSE 'new' END AS state FROM orders""")
def q_known_fields(spark, sf):
    """Nodes that lack most fields of a proposal: those that both have are read, the others are blank."""
    at = F.col("o_orderdate")
    some = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "O", F.lit("accepted")).alias("state"),
        at.alias("publishedAt"), F.lit(None).cast(T.TimestampNTZType()).alias("updatedAt"), F.lit("x").alias("unheardOf"))
    return feeds.proposal_rows(some, SITE).select("id", "title", "author_name", "state")


# Streams. Whatever has landed is read in batches of bounded size, and the run stops.


def _stream(spark, sf) -> DataFrame:
    return jobs.landed_files(spark, sf, table(spark, sf, "events").schema, "events.parquet", files_per_batch=1)


@registry.add("q_upsert_stream", "SELECT event_id, event_type, value FROM events")
def q_upsert_stream(spark, sf):
    """Events merged into a table by a stream that is started twice, after a table with older values of some of them."""
    name, checkpoint = f"{scratch_database()}.events", new_work_path(spark, "checkpoint")
    old = table(spark, sf, "events").where("event_id % 3 = 0").withColumn("value", F.lit(-1.0)).select("event_id", "event_type", "value")
    jobs.upsert(old, name, "event_id", range_size=20_000)
    for _ in range(2):
        jobs.upsert_stream(_stream(spark, sf).select("event_id", "event_type", "value"), name, "event_id", checkpoint)
    return spark.table(name).drop(PART_COLUMN)


@registry.add("q_replace_days_stream", """
    SELECT event_id, CAST(ts AS DATE) AS day FROM events
    UNION ALL SELECT -event_id, DATE '2023-12-31' FROM events WHERE event_id % 100 = 0""")
def q_replace_days_stream(spark, sf):
    """Days that land again take the place of what the table has of them; other days stay."""
    name, checkpoint = f"{scratch_database()}.days", new_work_path(spark, "checkpoint")
    some = table(spark, sf, "events").where("event_id % 100 = 0")
    before = some.selectExpr("-event_id as event_id", "DATE'2023-12-31' as day").unionAll(some.selectExpr("event_id", "cast(ts as date)"))
    jobs.replace_days(before, name, "day")
    for _ in range(2):
        jobs.replace_days_stream(_stream(spark, sf).selectExpr("event_id", "cast(ts as date) as day"), name, "day", checkpoint)
    return spark.table(name)


@registry.add("q_daily_counts_stream", "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def q_daily_counts_stream(spark, sf):
    """Counts by day with late rows taken in, as the stream has them in the end."""
    name = f"{scratch_database()}.counts"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    counts = jobs.daily_counts(_stream(spark, sf), "ts", ["event_type"])

    def keep(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").saveAsTable(name)

    jobs.run_available(counts, new_work_path(spark, "checkpoint"), keep, mode="complete")
    spark.catalog.refreshTable(name)
    return spark.table(name)


# The change log.


@registry.add("q_change_tables", LOG_SQL + """
    SELECT CASE WHEN relation_id = 16400 THEN 'public.orders' ELSE 'public.audit' END AS table_name, count(*) AS n_rows, 0 AS out_of_order
    FROM r WHERE problem IS NULL GROUP BY 1""")
def q_change_tables(spark, sf):
    """Change records written by table in the order of commit, and how many rows of a file come before one that was committed earlier."""
    out = new_work_path(spark, "change-tables")
    changes.by_table(changes.changes(landed(spark, sf)), out)
    rows = spark.read.parquet(out).select("table", "poll_id", "_transaction_end_lsn", "seq", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"))
    place = F.struct("poll_id", "_transaction_end_lsn", "seq")
    late = rows.select("table", (place < F.expr("lag(struct(poll_id, _transaction_end_lsn, seq)) OVER (PARTITION BY file ORDER BY at)")).alias("late"))
    return late.groupBy(F.col("table").alias("table_name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.col("late").cast("int")), F.lit(0)).cast("int").alias("out_of_order"))


@registry.add("q_cdc_typed_by_log", LOG_SQL + """
    SELECT poll_id, seq, CASE WHEN op IN ('I', 'U') THEN o_orderkey END AS o_orderkey, CASE WHEN op = 'I' THEN o_custkey END AS o_custkey,
           CASE WHEN op IN ('I', 'U') AND named = 'o_orderstatus' THEN o_orderstatus END AS o_orderstatus,
           CASE WHEN op IN ('I', 'U') AND named = 'o_state' THEN o_orderstatus END AS o_state
    FROM r WHERE problem IS NULL AND relation_id = 16400""")
def q_cdc_typed_by_log(spark, sf):
    """Rows of a table in the types that its relation messages in the log give."""
    records = changes.changes(landed(spark, sf)).where(F.col("table") == "public.orders")
    types = changes.column_types(records, "public.orders")
    typed = changes.typed(records, "row_after_transaction", types)
    return typed.select("poll_id", "seq", "o_orderkey", "o_custkey", "o_orderstatus", "o_state")


@registry.add("q_change_stream", LOG_SQL + """
    SELECT poll_id, seq, relation_id, op AS operation_type, CAST(o_orderkey AS INT) AS transaction_id, problem
    FROM r WHERE problem IS NULL OR problem <> 'open transaction'""")
def q_change_stream(spark, sf):
    """The log as it lands, piece by piece, read by a stream: polls and transactions are cut wherever a piece ends."""
    path, out = new_work_path(spark, "landed-log"), new_work_path(spark, "change-stream-out")
    log = landed(spark, sf)
    last, pieces = log.agg(F.max("seq").alias("seq")).first()["seq"] or 0, 4
    for i in range(pieces):
        log.where(F.col("seq").between(last * i // pieces + (i > 0), last * (i + 1) // pieces)).write.mode("append").parquet(path)
        jobs.change_stream(jobs.landed_messages(spark, path), out, f"{out}-checkpoint", quiet="100 years")
    return spark.read.parquet(f"{out}/batch_id=*").select(
        "poll_id", "seq", "relation_id", "operation_type", F.col("_transaction_id").alias("transaction_id"), "problem")

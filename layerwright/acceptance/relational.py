"""Extraction, table changes, de-duplication, joins and data tests on the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from layerwright.acceptance.tables import NAMES, Registry, scratch_database, table
from layerwright.functions.text import url_part
from layerwright.operators import quality as dq
from layerwright.operators.dedup import any_per_key, latest_per_key
from layerwright.operators.joins import existing, lookup_dimension, spread_join
from layerwright.operators.tables import drop_columns, page, page_after, tagged
from layerwright.sources.readers import extract, extract_all
from layerwright.sources.specs import Extraction, parse_spec
from layerwright.sources.writers import PART_COLUMN, full_refresh, replace_days, upsert

registry = Registry()

_LINE = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag, l_shipdate"
_LINE_COLUMNS = [c.strip() for c in _LINE.split(",")]
_LATEST = ("l_shipdate DESC NULLS FIRST, l_partkey DESC NULLS FIRST, l_suppkey DESC NULLS FIRST, "
           "l_quantity DESC NULLS FIRST, l_returnflag DESC NULLS FIRST")


@registry.add("q_full_scan", "SELECT * FROM customer")
def q_full_scan(spark, sf):
    return extract(table(spark, sf, "customer"), Extraction("customer", "full_refresh"), date(1997, 3, 1))


_WINDOW = "o_orderdate >= '{{ macros.ds_add(ds, -1) }}' and o_orderdate < '{{ macros.ds_add(ds, 2) }}'"


@registry.add("q_incremental_window", """
    SELECT * FROM orders WHERE o_orderdate >= DATE '1997-02-28' AND o_orderdate < DATE '1997-03-03'""")
def q_incremental_window(spark, sf):
    return extract(table(spark, sf, "orders"), Extraction("orders", "incremental", incremental_filter=_WINDOW),
                   date(1997, 3, 1))


@registry.add("q_exclude_columns", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def q_exclude_columns(spark, sf):
    return drop_columns(table(spark, sf, "customer"), ["C_NAME", "c_acctbal", "not_there"])


@registry.add("q_multi_table_ingest", " UNION ALL ".join(
    f"SELECT '{n}' AS source_table, count(*) AS n_rows FROM {n}" for n in NAMES))
def q_multi_table_ingest(spark, sf):
    spec = parse_spec({"name": "given", "extractions": {n: {"ingestion_type": "full_refresh"} for n in NAMES}})
    tables = extract_all({n: table(spark, sf, n) for n in NAMES}, spec, date(1997, 3, 1))
    rows = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("source_table"), "n_rows")
        rows = one if rows is None else rows.unionAll(one)
    return rows


@registry.add("q_page", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 200")
def q_page(spark, sf):
    return page(table(spark, sf, "orders"), ["o_orderkey"], 200, 100)


@registry.add("q_page_after", "SELECT * FROM orders WHERE o_orderkey > 1000 ORDER BY o_orderkey LIMIT 100")
def q_page_after(spark, sf):
    return page_after(table(spark, sf, "orders"), "o_orderkey", 1000, 100)


@registry.add("q_full_refresh", "SELECT * FROM orders")
def q_full_refresh(spark, sf):
    """The table is refreshed twice, the second time with other columns, and once with nothing, which changes nothing."""
    name = f"{scratch_database()}.refreshed"
    full_refresh(table(spark, sf, "customer"), name)
    full_refresh(table(spark, sf, "orders"), name)
    full_refresh(table(spark, sf, "orders").where("false"), name)
    return spark.table(name)


_CHANGES = """
    WITH rows AS (
        SELECT CASE WHEN o_orderkey % 97 <> 0 THEN o_orderkey END AS o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               o_orderdate, o_orderpriority, CAST(NULL AS BOOLEAN) AS o_changed
        FROM orders),
    target AS (SELECT * FROM rows WHERE o_orderdate < DATE '1999-01-01'),
    batch AS (SELECT * REPLACE (o_totalprice * 2 AS o_totalprice, TRUE AS o_changed) FROM rows WHERE o_orderdate >= DATE '1998-06-01')"""


def _upserted(spark, sf):
    """A table with rows without a key, and a batch that has some too, put in: the table's name and what has changed."""
    rows = table(spark, sf, "orders").withColumns({
        "o_orderkey": F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderkey")), "o_changed": F.lit(None).cast("boolean")})
    batch = rows.where(F.col("o_orderdate") >= "1998-06-01").withColumns(
        {"o_totalprice": F.col("o_totalprice") * 2, "o_changed": F.lit(True)})
    name = f"{scratch_database()}.upserted"
    upsert(rows.where(F.col("o_orderdate") < "1999-01-01"), name, "o_orderkey", range_size=5_000)
    changed = upsert(batch, name, "o_orderkey")
    upsert(batch.where("false"), name, "o_orderkey")
    return name, changed


@registry.add("q_upsert_by_key", _CHANGES + """
    SELECT * FROM target WHERE o_orderkey IS NULL OR o_orderkey NOT IN (SELECT o_orderkey FROM batch WHERE o_orderkey IS NOT NULL)
    UNION ALL SELECT * FROM batch""")
def q_upsert_by_key(spark, sf):
    return spark.table(_upserted(spark, sf)[0]).drop(PART_COLUMN)


@registry.add("q_upsert_one_part", """
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey BETWEEN 100 AND 250 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice,
           CASE WHEN o_orderkey BETWEEN 100 AND 250 THEN 'x' ELSE o_orderstatus END AS o_orderstatus
    FROM orders""")
def q_upsert_one_part(spark, sf):
    """A batch that is in one of many key ranges; then the same by text keys, for the other column, with parts that split."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    few = rows.where("o_orderkey BETWEEN 100 AND 250")
    name = f"{scratch_database()}.u"
    upsert(rows, name, "o_orderkey", range_size=1_000)
    upsert(few.withColumn("o_totalprice", -F.col("o_totalprice")), name, "o_orderkey")
    texts = spark.table(name).drop(PART_COLUMN).withColumn("o_orderkey", F.col("o_orderkey").cast("string"))
    changed = texts.where("CAST(o_orderkey AS BIGINT) BETWEEN 100 AND 250").withColumn("o_orderstatus", F.lit("x"))
    by_text = f"{name}_by_text"
    upsert(texts.where("CAST(o_orderkey AS BIGINT) <= 2000"), by_text, "o_orderkey", range_size=400)
    for batch in (changed, texts.where("CAST(o_orderkey AS BIGINT) > 2000")):
        upsert(batch, by_text, "o_orderkey")
    return spark.table(by_text).drop(PART_COLUMN).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@registry.add("q_upsert_metrics", _CHANGES + """
    SELECT (SELECT count(*) FROM target WHERE o_orderkey IN (SELECT o_orderkey FROM batch)) AS rows_deleted,
           (SELECT count(*) FROM batch) AS rows_written""")
def q_upsert_metrics(spark, sf):
    changed = _upserted(spark, sf)[1]
    return spark.createDataFrame([(changed.rows_deleted, changed.rows_written)], "rows_deleted long, rows_written long")


@registry.add("q_replace_by_day", """
    WITH rows AS (SELECT event_id, CASE WHEN event_id % 50 <> 0 THEN CAST(ts AS DATE) END AS day, value, ts FROM events),
    target AS (SELECT event_id, day, value FROM rows WHERE ts < TIMESTAMP '2024-01-20'),
    batch AS (SELECT event_id, day, -value AS value FROM rows WHERE ts >= TIMESTAMP '2024-01-18 06:00:00')
    SELECT * FROM target WHERE day IS NULL OR day NOT IN (SELECT day FROM batch WHERE day IS NOT NULL)
    UNION ALL SELECT * FROM batch""")
def q_replace_by_day(spark, sf):
    """Days of the batch take the place of the table's; rows without a day, in both, stay and are added."""
    rows = table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 50 != 0, F.to_date("ts")).alias("day"), "value", "ts")
    name = f"{scratch_database()}.days"
    replace_days(rows.where("ts < TIMESTAMP_NTZ'2024-01-20 00:00:00'").drop("ts"), name, "day")
    late = rows.where("ts >= TIMESTAMP_NTZ'2024-01-18 06:00:00'").withColumn("value", -F.col("value")).drop("ts")
    replace_days(late, name, "day")
    return spark.table(name)


@registry.add("q_dedup_latest", f"""
    SELECT {_LINE} FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LATEST}) = 1""")
def q_dedup_latest(spark, sf):
    rows = table(spark, sf, "lineitem").select(*_LINE_COLUMNS)
    return latest_per_key(rows, ["l_orderkey", "l_linenumber"], "l_shipdate")


@registry.add("q_dedup_filtered", f"""
    SELECT {_LINE} FROM lineitem WHERE l_returnflag = 'R'
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LATEST}) = 1""")
def q_dedup_filtered(spark, sf):
    rows = table(spark, sf, "lineitem").select(*_LINE_COLUMNS).where(F.col("l_returnflag") == "R")
    return latest_per_key(rows, ["l_orderkey", "l_linenumber"], "l_shipdate")


@registry.add("q_dedup_any", """
    SELECT l_partkey, l_suppkey, l_quantity, l_shipdate FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey DESC NULLS FIRST,
                               l_quantity DESC NULLS FIRST, l_shipdate DESC NULLS FIRST) = 1""")
def q_dedup_any(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    return any_per_key(rows, ["l_partkey"])


@registry.add("q_union_tagged", """
    SELECT 'customer_' || c_custkey AS row_id, c_custkey AS original_id, 'customer' AS kind,
           c_nationkey AS nationkey FROM customer
    UNION ALL SELECT 'supplier_' || s_suppkey, s_suppkey, 'supplier', s_nationkey FROM supplier""")
def q_union_tagged(spark, sf):
    def shaped(name, key, nation):
        rows = tagged(table(spark, sf, name), name, key, "kind", "row_id")
        return rows.select("row_id", F.col(key).alias("original_id"), "kind", F.col(nation).alias("nationkey"))

    return shaped("customer", "c_custkey", "c_nationkey").unionByName(shaped("supplier", "s_suppkey", "s_nationkey"))


@registry.add("q_semi_join", """
    SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def q_semi_join(spark, sf):
    dear = table(spark, sf, "orders").where(F.col("o_totalprice") > 400000)
    return existing(table(spark, sf, "customer"), dear.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"])


@registry.add("q_composite_left_join", """
    SELECT s_suppkey, s_name, n_name, r_name
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
         LEFT JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'""")
def q_composite_left_join(spark, sf):
    rows = lookup_dimension(table(spark, sf, "supplier"), table(spark, sf, "nation"), {"s_nationkey": "n_nationkey"},
                            {"n_name": "n_name", "n_regionkey": "n_regionkey"})
    rows = lookup_dimension(rows, table(spark, sf, "region"), {"n_regionkey": "r_regionkey"}, {"r_name": "r_name"})
    return rows.where(F.col("r_name") == "ASIA").select("s_suppkey", "s_name", "n_name", "r_name")


@registry.add("q_spread_join", """
    SELECT l_orderkey, l_linenumber, l_suppkey, l_shipdate, p_name
    FROM lineitem LEFT JOIN part ON l_linenumber * 100 = p_partkey""")
def q_spread_join(spark, sf):
    """Few keys, each with a large share of the rows, cut into eight pieces."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate",
        (F.col("l_linenumber") * 100).cast("long").alias("p_partkey"),
    )
    parts = table(spark, sf, "part").select("p_partkey", "p_name")
    return spread_join(lines, parts, ["p_partkey"], salt=8).drop("p_partkey")


@registry.add("q_slug_join", """
    WITH d AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
    SELECT page_id, regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1) AS slug, n AS lang_documents
    FROM pages LEFT JOIN d ON lang = regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1)""")
def q_slug_join(spark, sf):
    pages = table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("url", "^https?://[^/]+/([^/?#]+)", 1).alias("slug")
    )
    languages = table(spark, sf, "documents").groupBy(F.col("lang").alias("slug")).agg(
        F.count(F.lit(1)).alias("lang_documents")
    )
    return spread_join(pages, languages, ["slug"])


@registry.add("q_url_slug", r"""
    SELECT page_id,
           CASE WHEN regexp_matches(url, '(?i)/en/([^/]+)/?')
                THEN regexp_replace(url, '(?s)^.*/en/([^/]+)/?.*$', '\1') END AS slug_parity,
           nullif(regexp_extract(url, '(?is)^.*/en/([^/?#]+)', 1), '') AS slug
    FROM pages""")
def q_url_slug(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", url_part(url, "en").alias("slug_parity"), url_part(url, "en", parity=False).alias("slug")
    )


# Data tests. Tests that find nothing in clean data run on a reference that does have gaps.


@registry.add("q_dq_not_null", """
    SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality IS NULL""")
def q_dq_not_null(spark, sf):
    labelled = table(spark, sf, "documents").select("doc_id", "lang").join(
        table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left"
    )
    return dq.not_null(labelled, "quality")


@registry.add("q_dq_unique", """
    SELECT l_orderkey, count(*) AS n_records FROM lineitem WHERE l_orderkey IS NOT NULL
    GROUP BY 1 HAVING count(*) > 1""")
def q_dq_unique(spark, sf):
    return dq.unique(table(spark, sf, "lineitem"), "l_orderkey")


@registry.add("q_dq_unique_pair", """
    SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def q_dq_unique_pair(spark, sf):
    return dq.unique(table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@registry.add("q_dq_completeness", """
    SELECT doc_id FROM documents WHERE lang <> 'de'
    AND doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def q_dq_completeness(spark, sf):
    return dq.completeness(
        table(spark, sf, "labels"), "doc_id", table(spark, sf, "documents"), "doc_id",
        model_filter=F.col("quality") == 1, origin_filter=F.col("lang") != "de",
    )


@registry.add("q_dq_completeness_parity", """
    SELECT 'corrected' AS mode, count(*) AS failures FROM documents
    WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)
    UNION ALL
    SELECT 'parity', count(*) FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE l.quality = 1 AND l.doc_id IS NULL""")
def q_dq_completeness_parity(spark, sf):
    """The model filter in both readings; in the one of today it can never find anything."""
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = None
    for mode in ("corrected", "parity"):
        found = dq.completeness(labels, "doc_id", documents, "doc_id", F.col("quality") == 1, parity=mode == "parity")
        one = found.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(mode).alias("mode"), "failures")
        rows = one if rows is None else rows.unionAll(one)
    return rows


@registry.add("q_dq_referential", """
    SELECT * FROM orders WHERE o_orderstatus = 'F'
    AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')""")
def q_dq_referential(spark, sf):
    return dq.referential(
        table(spark, sf, "orders"), "o_custkey", table(spark, sf, "customer"), "c_custkey",
        child_filter=F.col("o_orderstatus") == "F", parent_filter=F.col("c_mktsegment") != "MACHINERY",
    )


@registry.add("q_dq_self_reference", """
    SELECT conv_id, turn, conv_id * 1000 + turn AS id, conv_id * 1000 + turn - 1 AS parent_id
    FROM conversations c
    WHERE turn > 0 AND NOT EXISTS (SELECT 1 FROM conversations p WHERE p.role <> 'assistant'
                                   AND p.conv_id = c.conv_id AND p.turn = c.turn - 1)""")
def q_dq_self_reference(spark, sf):
    turns = table(spark, sf, "conversations").select(
        "conv_id", "turn", (F.col("conv_id") * 1000 + F.col("turn")).alias("id"),
        (F.col("conv_id") * 1000 + F.col("turn") - 1).alias("parent_id"), "role",
    )
    found = dq.referential(turns, "parent_id", turns, "id", F.col("turn") > 0, F.col("role") != "assistant")
    return found.select("conv_id", "turn", "id", "parent_id")



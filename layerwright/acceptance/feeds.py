"""Notification feeds, reply threads and process configs on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwright.acceptance.tables import Registry, table
from layerwright.functions.dates import inside_open_interval, latest, message_time
from layerwright.operators.joins import split_known
from layerwright.operators.tables import high_water_mark, newer_than
from layerwright.plans import configs, feeds

registry = Registry()

MARK = "1999-06-30 00:00:00"
SITE = "https://site.example/processes/p/f/1/proposals"

_STATES = ", ".join(f"('{k}', '{label}', '{sign}')" for k, (label, sign) in feeds.STATES.items())

# An order is a proposal: open ones are accepted, finished ones rejected, the rest have no known state.
PROPOSALS_SQL = f"""
    WITH labels_of(state, label, sign) AS (VALUES {_STATES}),
    p AS (
        SELECT o_orderkey AS id, o_orderdate AS published,
               CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderdate + INTERVAL 2 DAY
                    ELSE o_orderdate END AS updated, o_orderstatus, o_orderpriority, o_custkey, o_totalprice
        FROM orders),
    s AS (
        SELECT *, CASE WHEN o_orderstatus = 'O' THEN 'accepted' WHEN o_orderstatus = 'F' THEN 'rejected'
                       WHEN updated > published THEN 'others' ELSE 'new' END AS state,
               greatest(updated, published) AS date
        FROM p)"""


def nodes(spark, sf):
    priority = F.col("o_orderpriority")
    updated = F.when(priority.isin("1-URGENT", "2-HIGH"), F.expr("o_orderdate + INTERVAL 2 DAY")).otherwise(
        F.col("o_orderdate"))
    state = F.when(F.col("o_orderstatus") == "O", F.lit("accepted")).when(
        F.col("o_orderstatus") == "F", F.lit("rejected")).otherwise(F.lit("pending"))
    key = F.col("o_orderkey").cast("string")
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.struct(F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.concat(F.lit("Pedido "), key)).alias(
            "translation")).alias("title"),
        F.struct(F.concat(
            F.lit("<p>Custa &lt;b&gt; <b>"), F.col("o_totalprice").cast("int").cast("string"),
            F.lit("</b> &amp; mais</p>\n")).alias("translation")).alias("body"),
        F.struct(F.when(priority == "5-LOW", F.lit(None)).otherwise(
            F.struct(priority.alias("translation"))).alias("name")).alias("category"),
        F.struct(F.concat(F.lit("Autor "), F.col("o_custkey").cast("string")).alias("name"),
                 F.when(priority == "1-URGENT", F.lit("Own Office")).alias("organizationName")).alias("author"),
        state.alias("state"), F.col("o_orderdate").alias("publishedAt"), updated.alias("updatedAt"),
    )


@registry.add("q_state_label", PROPOSALS_SQL + """
    SELECT id, s.state, label, sign, date FROM s JOIN labels_of l ON s.state = l.state""")
def q_state_label(spark, sf):
    rows = feeds.proposal_rows(nodes(spark, sf), SITE)
    return rows.select(
        "id", "state", F.col("state_label").alias("label"), F.col("state_sign").alias("sign"),
        F.col("date").cast("timestamp_ntz").alias("date"),
    )


@registry.add("q_notify_feed", PROPOSALS_SQL + f"""
    SELECT id, date, sign || ' Proposta <b>' || label || '</b>em ' || strftime(date, '%d/%m/%Y %H:%M')
           || chr(10) || chr(10) || '<b>Proposta</b>' || chr(10)
           || CASE WHEN o_orderstatus = 'P' THEN '-' ELSE 'Pedido ' || id END
           || chr(10) || chr(10) || '<b>Autor</b>' || chr(10) || 'Autor ' || o_custkey || ' '
           || chr(10) || chr(10) || '<b>Categoria</b>' || chr(10)
           || CASE WHEN o_orderpriority = '5-LOW' THEN '-' ELSE o_orderpriority END
           || chr(10) || chr(10) || '<b>Descrição</b>' || chr(10)
           || 'Custa <b> ' || CAST(trunc(o_totalprice) AS INT) || ' & mais'
           || chr(10) || chr(10) || '<a href="{SITE}/' || id || '">Acesse aqui</a>' AS message
    FROM s JOIN labels_of l ON s.state = l.state
    WHERE published > TIMESTAMP '{MARK}' OR updated > TIMESTAMP '{MARK}'""")
def q_notify_feed(spark, sf):
    mark = F.lit(MARK).cast("timestamp")
    rows = feeds.proposal_feed(nodes(spark, sf), SITE, mark, own_organizations=["Own Office"])
    return rows.select("id", F.col("date").cast("timestamp_ntz").alias("date"), "message")


@registry.add("q_high_water_mark", PROPOSALS_SQL + f"""
    SELECT max(date) AS max_datetime FROM s
    WHERE published > TIMESTAMP '{MARK}' OR updated > TIMESTAMP '{MARK}'""")
def q_high_water_mark(spark, sf):
    rows = feeds.proposal_rows(nodes(spark, sf), SITE)
    fresh = newer_than(rows, ["publishedAt", "updatedAt"], F.lit(MARK).cast("timestamp"))
    return high_water_mark(fresh, "date").select(F.col("max_datetime").cast("timestamp_ntz").alias("max_datetime"))


@registry.add("q_comment_window", """
    SELECT event_id, updated AS date_filter, CASE WHEN updated > ts THEN 'update' ELSE 'new' END AS state,
           CASE WHEN updated > ts THEN 'Comentario atualizado' ELSE 'Novo comentario' END AS label,
           strftime(updated, '%d/%m/%Y %H:%M') AS shown
    FROM (SELECT *, CASE WHEN event_type = 'click' THEN ts + INTERVAL 3 HOUR ELSE ts END AS updated FROM events)
    WHERE updated > TIMESTAMP '2024-01-10' AND updated < TIMESTAMP '2024-01-12 12:00:00'""")
def q_comment_window(spark, sf):
    rows = table(spark, sf, "events").withColumn(
        "updated", F.when(F.col("event_type") == "click", F.expr("ts + INTERVAL 3 HOUR"))
    ).withColumn("date_filter", latest(F.col("ts"), F.col("updated")))
    kept = rows.where(inside_open_interval(
        F.col("date_filter"), F.expr("TIMESTAMP_NTZ'2024-01-10 00:00:00'"), F.expr("TIMESTAMP_NTZ'2024-01-12 12:00:00'")
    ))
    state = feeds.comment_state(F.col("ts"), F.col("date_filter"))
    return kept.select(
        "event_id", "date_filter", state.alias("state"), feeds.label_and_sign(state, feeds.COMMENT_STATES)[0].alias("label"),
        message_time(F.col("date_filter")).alias("shown"),
    )


def _turns(spark, sf):
    turn, conv = F.col("turn"), F.col("conv_id")
    created = F.expr("cast(date_add(DATE'2024-01-01', cast(turn as int)) as timestamp)")
    return table(spark, sf, "conversations").select(
        (conv * 1000 + turn).alias("id"),
        F.when(turn > 0, conv * 1000 + turn - 1).alias("parent_id"),
        F.when(turn == 0, conv).alias("root_component_id"),
        F.col("text").alias("body"), conv.alias("author_id"), F.col("role").alias("author_name"),
        F.date_format(created, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdAt"),
        F.date_format(F.when(F.col("role") == "user", created + F.expr("INTERVAL 1 HOUR")).otherwise(created),
                      "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updatedAt"),
        F.lit("ok").alias("status"),
    )


_THREADS_SQL = """
    WITH RECURSIVE c AS (
        SELECT conv_id * 1000 + turn AS id, CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS parent_id,
               conv_id, turn, role, text,
               CAST(DATE '2024-01-01' + CAST(turn AS INT) AS TIMESTAMP) AS created
        FROM conversations),
    t AS (
        SELECT id, id AS parent_comment_id, conv_id AS root, id AS thread_id, 1 AS depth, role, text, created
        FROM c WHERE parent_id IS NULL
        UNION ALL
        SELECT c.id, c.parent_id, t.root, t.thread_id, t.depth + 1, c.role, c.text, c.created
        FROM c JOIN t ON c.parent_id = t.id)"""


@registry.add("q_comment_threads", _THREADS_SQL + f"""
    SELECT root AS root_component_id, parent_comment_id, id AS comment_id, text AS body, role AS author_name,
           thread_id, CAST(depth AS BIGINT) AS depth, '{SITE}/' || root AS link
    FROM t""")
def q_comment_threads(spark, sf):
    rows = feeds.comment_rows(_turns(spark, sf), SITE + "/")
    return rows.select("root_component_id", "parent_comment_id", "comment_id", "body", "author_name", "thread_id",
                       "depth", "link")


@registry.add("q_comment_feed", _THREADS_SQL + f"""
    SELECT id AS comment_id, CASE WHEN role = 'user' THEN '🔄 🔄 🔄 Comentario atualizado: '
                                  ELSE '💬 Novo comentario: ' END
           || strftime(CASE WHEN role = 'user' THEN created + INTERVAL 1 HOUR ELSE created END, '%d/%m/%Y %H:%M')
           || chr(10) || chr(10) || '<b>Autor</b>' || chr(10) || CASE WHEN length(text) % 7 = 3 THEN '-' ELSE role END
           || chr(10) || chr(10) || '<b>Comentario</b>' || chr(10) || CASE WHEN length(text) % 5 = 1 THEN '-' ELSE text END
           || chr(10) || chr(10) || '<a href="{SITE}/' || root || '">Acesse aqui</a>' AS message
    FROM t WHERE CASE WHEN role = 'user' THEN created + INTERVAL 1 HOUR ELSE created END > TIMESTAMP '2024-01-02'""")
def q_comment_feed(spark, sf):
    size = F.length("body")
    turns = _turns(spark, sf).withColumns({  # comments without an author or a body
        "author_name": F.when(size % 7 != 3, F.col("author_name")), "body": F.when(size % 5 != 1, F.col("body")),
    })
    rows = feeds.comment_rows(turns, SITE, lower=F.lit("2024-01-02").cast("timestamp"))
    return feeds.comment_message(rows).select("comment_id", "message")


# Configs: a supplier is a space, with one accepted component and one of another type.


def spaces(spark, sf):
    key = F.col("s_suppkey").cast("string")
    balance = F.col("s_acctbal")

    def component(kind, offset):
        return F.struct(
            (F.col("s_suppkey") + offset).cast("string").alias("id"), F.lit(kind).alias("__typename"),
            F.struct(F.concat(F.lit("Participação "), key).alias("translation")).alias("name"),
        )

    return table(spark, sf, "supplier").select(
        F.concat(F.lit("plano nº "), key).alias("slug"),
        F.when(balance < 0, F.lit("not a number")).when(balance > 5000, F.lit("")).otherwise(
            F.concat(F.lit("-100"), key)).alias("groupChatId"),
        F.when(balance > 2000, F.lit("2023-05-01")).alias("creationDate"),
        F.when(balance > 8000, F.lit("2025-05-01")).alias("closingDate"),
        F.array(component("Proposals", 0), component("Meetings", 1_000_000_000)).alias("components"),
    )


_CONFIGS = """
    SELECT CAST(s_suppkey AS INT) AS component_id, 'Proposals' AS __typename,
           'PLANO_No_' || s_suppkey || '_PARTICIPACAO_' || s_suppkey AS process_id,
           CASE WHEN s_acctbal > 2000 THEN DATE '2023-05-01' ELSE DATE '2024-01-31' END AS start_date,
           CASE WHEN s_acctbal > 8000 THEN DATE '2025-05-01' END AS end_date,
           CASE WHEN s_acctbal BETWEEN 0 AND 5000 THEN CAST('-100' || s_suppkey AS BIGINT) END AS telegram_group_id
    FROM supplier"""


@registry.add("q_config_rows", _CONFIGS)
def q_config_rows(spark, sf):
    return configs.config_rows(spaces(spark, sf), "2024-01-31")


def _stored(spark, sf):
    """Stored configs: suppliers that shipped returned goods; some with another chat than today's."""
    shipped = table(spark, sf, "lineitem").where(F.col("l_returnflag") == "R").groupBy("l_suppkey").agg(
        F.max("l_quantity").alias("most"), F.count_distinct("l_orderkey").alias("orders"))
    topics = F.create_map(F.lit("telegram_moderation_proposals_topic_id"), F.col("orders"))
    return shipped.select(
        F.col("l_suppkey").cast("int").alias("component_id"),
        F.concat(F.lit("STORED_"), F.col("l_suppkey").cast("string")).alias("process_id"),
        F.when(F.col("orders") > 180, F.lit(7).cast("long")).otherwise(
            F.concat(F.lit("-100"), F.col("l_suppkey").cast("string")).cast("long")).alias("telegram_group_id"),
        topics.alias("topics"),
    )


_STORED = """
    SELECT CAST(l_suppkey AS INT) AS sid, count(DISTINCT l_orderkey) AS orders,
           CASE WHEN count(DISTINCT l_orderkey) > 180 THEN 7 ELSE CAST('-100' || l_suppkey AS BIGINT) END AS chat
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_suppkey"""


@registry.add("q_config_merge", f"""
    WITH n AS ({_CONFIGS}), o AS ({_STORED})
    SELECT component_id, CASE WHEN sid IS NOT NULL THEN 'STORED_' || sid ELSE process_id END AS process_id,
           start_date, end_date, coalesce(telegram_group_id, chat) AS telegram_group_id,
           CASE WHEN sid IS NOT NULL AND (telegram_group_id IS NULL OR telegram_group_id = chat) THEN orders END
               AS kept_topic,
           CASE WHEN telegram_group_id IS NULL THEN 0 WHEN telegram_group_id = chat THEN 1 ELSE 2 END AS n_missing,
           sid IS NOT NULL AS was_stored
    FROM n LEFT JOIN o ON component_id = sid""")
def q_config_merge(spark, sf):
    merged = configs.merge_configs(configs.config_rows(spaces(spark, sf), "2024-01-31"), _stored(spark, sf))
    return merged.select(
        "component_id", "process_id", "start_date", "end_date", "telegram_group_id",
        F.col("topics")["telegram_moderation_proposals_topic_id"].alias("kept_topic"),
        F.size("topics_to_create").alias("n_missing"), "was_stored",
    )


@registry.add("q_split_known", """
    SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS known FROM documents""")
def q_split_known(spark, sf):
    update, configure = split_known(
        table(spark, sf, "documents").select("doc_id"), table(spark, sf, "labels"), "doc_id"
    )
    return update.withColumn("known", F.lit(True)).unionByName(configure.withColumn("known", F.lit(False)))


@registry.add("q_missing_topics", """
    SELECT doc_id, CASE WHEN lang = 'en' THEN 'telegram_moderation_comments_topic_id'
                        WHEN lang = 'fr' THEN ''
                        ELSE 'telegram_moderation_proposals_topic_id,telegram_moderation_comments_topic_id' END AS missing
    FROM documents""")
def q_missing_topics(spark, sf):
    have = F.when(F.col("lang") == "en", F.array(F.lit("telegram_moderation_proposals_topic_id"))).when(
        F.col("lang") == "fr", F.array(*[F.lit(t) for t in configs.TOPIC_SUFFIXES]))
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(configs.missing_topics(have), ",").alias("missing")
    )


@registry.add("q_topic_names", """
    SELECT s_suppkey, 'Plano N ' || s_suppkey || '/Propostas' AS proposals_topic,
           'Plano N ' || s_suppkey || '/Comentarios Em Propostas' AS comments_topic FROM supplier""")
def q_topic_names(spark, sf):
    names = configs.topic_names(F.concat(F.lit("PLANO_N_"), F.col("s_suppkey").cast("string")))
    return table(spark, sf, "supplier").select(
        "s_suppkey", names["telegram_moderation_proposals_topic_id"].alias("proposals_topic"),
        names["telegram_moderation_comments_topic_id"].alias("comments_topic"),
    )

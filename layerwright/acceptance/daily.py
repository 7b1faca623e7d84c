"""Daily activity on the event log: the flagship series and the counts it is made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwright.acceptance.tables import Registry, scratch_database, table
from layerwright.operators.series import daily_fill, expand_days
from layerwright.plans import gold
from layerwright.sources.writers import publish_version, switch_view

registry = Registry()

AS_OF = "2024-01-31"
MEASURES = ["qtd_visitas", "qtd_rejeicao", "qtd_votos", "qtd_comentarios"]

# Entities are customers with events; the nation is their process and the first event their creation.
_FLAGSHIP_SQL = f"""
    WITH first AS (SELECT user_id, min(CAST(ts AS DATE)) AS created FROM events GROUP BY 1),
    entities AS (
        SELECT c_custkey AS id, c_name AS title, left(concat(c_mktsegment, c_custkey), length(c_mktsegment)) AS status,
               c_nationkey, left(concat(n_name, c_custkey), length(n_name)) AS n_name, created
        FROM customer JOIN first ON c_custkey = user_id JOIN nation ON c_nationkey = n_nationkey),
    spine AS MATERIALIZED (SELECT *, CAST(unnest(generate_series(created, DATE '{AS_OF}', INTERVAL 1 DAY)) AS DATE) AS day
              FROM entities),
    visited AS (SELECT user_id, CAST(ts AS DATE) AS day, count(DISTINCT event_id) AS v,
                       CAST(sum(CASE WHEN value < 10 THEN 1 ELSE 0 END) AS BIGINT) AS r
                FROM events WHERE event_type = 'view' GROUP BY 1, 2),
    voted AS (SELECT user_id, CAST(ts AS DATE) AS day, count(event_id) AS n FROM events
              WHERE event_type = 'purchase' GROUP BY 1, 2),
    commented AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events
                  WHERE event_type = 'click' GROUP BY 1, 2)
    SELECT spine.day AS data_operacao, c_nationkey AS id_processo, id AS id_proposta, title AS titulo_proposta,
           n_name AS titulo_processo, status AS eixo_tematico, coalesce(v, 0) AS qtd_visitas,
           coalesce(r, 0) AS qtd_rejeicao, coalesce(voted.n, 0) AS qtd_votos,
           coalesce(commented.n, 0) AS qtd_comentarios
    FROM spine LEFT JOIN visited ON id = visited.user_id AND spine.day = visited.day
         LEFT JOIN voted ON id = voted.user_id AND spine.day = voted.day
         LEFT JOIN commented ON id = commented.user_id AND spine.day = commented.day"""


def _activity(events):
    """All four measures in one pass over the log."""

    def of(kind: str):
        return F.col("event_type") == kind

    return events.groupBy(F.col("user_id").alias("id"), F.to_date("ts").alias("day")).agg(
        F.count_distinct(F.when(of("view"), F.col("event_id"))).alias("qtd_visitas"),
        F.sum(F.when(of("view") & (F.col("value") < 10), 1).otherwise(0)).alias("qtd_rejeicao"),
        F.count(F.when(of("purchase"), F.col("event_id"))).alias("qtd_votos"),
        F.count(F.when(of("click"), 1)).alias("qtd_comentarios"),
    )


def _entities(spark, sf, activity):
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    first = activity.groupBy("id").agg(F.min("day").alias("created"))
    return (
        customer.withColumnRenamed("c_custkey", "id").join(first, "id")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("id", "c_name", "c_mktsegment", "c_nationkey", "n_name", "created")
    )


@registry.add("q_daily_metrics", _FLAGSHIP_SQL)
def q_daily_metrics(spark, sf):
    activity = _activity(table(spark, sf, "events"))
    series = daily_fill(_entities(spark, sf, activity), activity, "id", "created", "day", MEASURES, AS_OF)
    return series.select(
        F.col("day").alias("data_operacao"), F.col("c_nationkey").alias("id_processo"),
        F.col("id").alias("id_proposta"), F.col("c_name").alias("titulo_proposta"),
        F.col("n_name").alias("titulo_processo"), F.col("c_mktsegment").alias("eixo_tematico"), *MEASURES,
    )


@registry.add("q_gold_roundtrip", _FLAGSHIP_SQL)
def q_gold_roundtrip(spark, sf):
    """The gold table written as a version, published under its name and read by it."""
    model = q_daily_metrics(spark, sf).withColumn("mes_operacao", F.date_format("data_operacao", "yyyy-MM"))
    database = scratch_database()
    written = publish_version(model, "metrics", "v1", database, None, ["id_proposta", "data_operacao"], ["mes_operacao"])
    return spark.table(switch_view(spark, database, "metrics", written, hide=["mes_operacao"]))


@registry.add("q_daily_spine", f"""
    SELECT o_orderkey AS id, CAST(unnest(generate_series(CAST(o_orderdate AS DATE), DATE '1995-12-31',
           INTERVAL 1 DAY)) AS DATE) AS day
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def q_daily_spine(spark, sf):
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    entities = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"), "o_orderdate"
    )
    return expand_days(entities, "o_orderdate", "1995-12-31").select("id", "day")


# The log as each kind of model row, whole, for the aggregates of the gold model.


@registry.add("q_daily_visits", """
    SELECT CAST(ts AS DATE) AS day, user_id, count(DISTINCT event_id) AS qtd_visitas,
           CAST(sum(CASE WHEN value < 10 THEN 1 ELSE 0 END) AS BIGINT) AS qtd_rejeicao
    FROM events GROUP BY 1, 2""")
def q_daily_visits(spark, sf):
    visits = table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("session_date"), F.col("user_id").cast("string").alias("proposal_id"),
        F.col("event_id").alias("session_id"), F.when(F.col("value") < 10, 1).otherwise(2).alias("num_actions"))
    daily = gold.daily_visits(visits)
    return daily.select("day", F.col("proposal_id").alias("user_id"), "qtd_visitas", "qtd_rejeicao")


@registry.add("q_daily_votes", """
    SELECT CAST(ts AS DATE) AS day, user_id, count(event_id) AS qtd_votos FROM events GROUP BY 1, 2""")
def q_daily_votes(spark, sf):
    votes = table(spark, sf, "events").select(F.col("ts").alias("created_at"), F.col("user_id").alias("voted_component_id"))
    return gold.daily_votes(votes).withColumnRenamed("proposal_id", "user_id")


@registry.add("q_daily_comments", """
    SELECT CAST(ts AS DATE) AS day, user_id, count(*) AS qtd_comentarios FROM events GROUP BY 1, 2""")
def q_daily_comments(spark, sf):
    comments = table(spark, sf, "events").select(F.col("ts").alias("created_at"), F.col("user_id").alias("commented_root_component_id"))
    return gold.daily_comments(comments).withColumnRenamed("proposal_id", "user_id")

"""Model queries: silver models, the gold model, its tests, on bronze tables made of the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwright.acceptance.civic import AS_OF, MODEL_SQL, bronze, with_models
from layerwright.acceptance.tables import Registry
from layerwright.plans import gold, pipeline, silver
from layerwright.session import materialize

registry = Registry()


def _null(kind: str, *names: str) -> str:
    return ", ".join(f"CAST(NULL AS {kind}) AS {n}" for n in names)


MODEL_SQL["visits"] = f"""
    SELECT process_id, CASE WHEN k = 1 THEN 'nation_' || (user_id % 25) END AS participatory_process_slug,
           CASE WHEN k = 1 THEN regexp_extract(a_url, '/proposals/(.*)$', 1) END AS proposal_id,
           event_id AS session_id, {_null('VARCHAR', 'visit_ip', 'visitor_id')}, {_null('INT', 'goal_conversions')},
           strftime(DATE '1995-01-01' + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))::INT, '%Y-%m-%d')
               AS session_date,
           {_null('VARCHAR', 'visit_server_hour')}, {_null('BIGINT', 'last_action_timestamp')},
           {_null('VARCHAR', 'last_action_date_time')},
           {_null('BIGINT', 'server_timestamp', 'first_action_timestamp')},
           CAST(user_id AS VARCHAR) AS user_id, event_type AS visitor_type,
           {_null('VARCHAR', 'visit_converted', 'visit_count', 'days_since_first_visit',
                  'seconds_since_first_visit', 'visit_duration_seconds', 'searches', 'events', 'continent',
                  'continent_code', 'country', 'country_code', 'region', 'region_code', 'city', 'location',
                  'visit_local_hour', 'days_since_last_visit', 'seconds_since_last_visit', 'resolution')},
           CASE WHEN value < 10 THEN 1 ELSE 2 END AS num_actions, a_type AS type, a_url AS url,
           {_null('VARCHAR', 'page_title')}, {_null('INT', 'visit_id')},
           {_null('VARCHAR', 'id_page_view', 'server_time_pretty')},
           CASE WHEN k IS NOT NULL THEN event_id END AS page_id, {_null('VARCHAR', 'bandwidth')},
           CASE WHEN k = 1 THEN 12 END AS time_spent, {_null('VARCHAR', 'time_spent_pretty')},
           {_null('INT', 'page_view_position')}, {_null('VARCHAR', 'title', 'subtitle')},
           {_null('BIGINT', 'visit_timestamp')}, {_null('VARCHAR', 'bandwidth_pretty')}
    FROM actions LEFT JOIN participatory_processes
         ON CASE WHEN k = 1 THEN 'nation_' || (user_id % 25) END = process_slug"""

METRICS_SQL = f"""
    WITH visited AS MATERIALIZED (
        SELECT CAST(session_date AS DATE) AS day, CAST(proposal_id AS BIGINT) AS pid,
               count(DISTINCT session_id) AS qtd_visitas,
               sum(CASE WHEN num_actions = 1 THEN 1 ELSE 0 END) AS qtd_rejeicao
        FROM visits WHERE regexp_full_match(proposal_id, '[0-9]+') GROUP BY session_date, proposal_id),
    voted AS MATERIALIZED (SELECT CAST(created_at AS DATE) AS day, voted_component_id AS pid, count(*) AS qtd_votos
              FROM votes GROUP BY ALL),
    commented AS MATERIALIZED (SELECT CAST(created_at AS DATE) AS day, commented_root_component_id AS pid,
                         count(*) AS qtd_comentarios FROM comments GROUP BY ALL),
    spine AS MATERIALIZED (
        SELECT p.proposal_id, p.process_id, p.proposal_title, p.proposal_status, p.proposal_category,
               left(concat(process_title, p.proposal_id), length(process_title)) AS process_title,
               CAST(unnest(generate_series(CAST(p.created_at AS DATE), DATE '{AS_OF}', INTERVAL 1 DAY)) AS DATE) AS day
        FROM proposals p JOIN participatory_processes pp ON p.process_id = pp.process_id)
    SELECT spine.day AS data_operacao, process_id AS id_processo, proposal_id AS id_proposta,
           proposal_title AS titulo_proposta, proposal_status AS status_proposta, process_title AS titulo_processo,
           proposal_category AS eixo_tematico, coalesce(qtd_visitas, 0) AS qtd_visitas,
           CAST(coalesce(qtd_rejeicao, 0) AS BIGINT) AS qtd_rejeicao, coalesce(qtd_votos, 0) AS qtd_votos,
           coalesce(qtd_comentarios, 0) AS qtd_comentarios
    FROM spine LEFT JOIN visited v ON proposal_id = v.pid AND spine.day = v.day
         LEFT JOIN voted w ON proposal_id = w.pid AND spine.day = w.day
         LEFT JOIN commented c ON proposal_id = c.pid AND spine.day = c.day"""


@registry.add("q_users", with_models("SELECT * FROM users", "users"))
def q_users(spark, sf):
    return silver.users(bronze(spark, sf))


@registry.add("q_dim_left_join", with_models("SELECT * FROM participatory_processes", "participatory_processes"))
def q_dim_left_join(spark, sf):
    return silver.participatory_processes(bronze(spark, sf))


@registry.add("q_proposals", with_models("SELECT * FROM proposals", "proposals"))
def q_proposals(spark, sf):
    return silver.proposals(bronze(spark, sf))


@registry.add("q_proposals_single", """
    WITH a AS (SELECT l_orderkey AS ak, l_suppkey AS user_id FROM lineitem WHERE l_returnflag = 'R'
               QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_suppkey DESC) = 1),
    c AS (SELECT l_orderkey AS ck, l_linenumber FROM lineitem WHERE l_returnflag = 'A'
          QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC) = 1)
    SELECT o_orderkey AS proposal_id, user_id, p_name AS proposal_category
    FROM orders LEFT JOIN a ON o_orderkey = ak LEFT JOIN c ON o_orderkey = ck
         LEFT JOIN part ON l_linenumber = p_partkey""")
def q_proposals_single(spark, sf):
    return silver.proposals(bronze(spark, sf), parity=False).select("proposal_id", "user_id", "proposal_category")


@registry.add("q_comments", with_models("SELECT * FROM comments", "comments"))
def q_comments(spark, sf):
    return silver.comments(bronze(spark, sf))


@registry.add("q_votes", with_models("SELECT * FROM votes", "votes"))
def q_votes(spark, sf):
    return silver.votes(bronze(spark, sf))


@registry.add("q_visits", with_models("SELECT * FROM visits", "visits"))
def q_visits(spark, sf):
    tables = bronze(spark, sf)
    return silver.visits(tables, silver.participatory_processes(tables))


def _models(spark, sf):
    tables = bronze(spark, sf)
    processes = silver.participatory_processes(tables)
    return tables, {
        "users": silver.users(tables),
        "participatory_processes": processes,
        "proposals": silver.proposals(tables),
        "comments": silver.comments(tables),
        "votes": silver.votes(tables),
        "visits": silver.visits(tables, processes),
    }


@registry.add("q_proposal_metrics", with_models(
    METRICS_SQL.strip().replace("WITH visited", ", visited", 1),
    "proposals", "participatory_processes", "visits", "votes", "comments"))
def q_proposal_metrics(spark, sf):
    _, m = _models(spark, sf)
    return gold.proposal_metrics(
        m["proposals"], m["participatory_processes"], m["visits"], m["votes"], m["comments"], AS_OF
    )


# Failures per declared test, on the models above.
_TESTS = {
    "users.unique_user_id": "SELECT user_id FROM users GROUP BY 1 HAVING count(*) > 1",
    "users.not_null_user_id": "SELECT 1 FROM users WHERE user_id IS NULL",
    "users.complete_user_id": "SELECT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM users)",
    "participatory_processes.unique_process_id":
        "SELECT process_id FROM participatory_processes GROUP BY 1 HAVING count(*) > 1",
    "participatory_processes.not_null_process_id": "SELECT 1 FROM participatory_processes WHERE process_id IS NULL",
    "participatory_processes.complete_process_id":
        "SELECT s_nationkey FROM supplier JOIN nation ON s_nationkey = n_nationkey "
        "WHERE s_nationkey NOT IN (SELECT process_id FROM participatory_processes)",
    "proposals.unique_proposal_id":
        "SELECT proposal_id FROM proposals WHERE proposal_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "proposals.not_null_proposal_id": "SELECT 1 FROM proposals WHERE proposal_id IS NULL",
    "proposals.complete_proposal_id":
        "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT proposal_id FROM proposals)",
    "proposals.not_null_process_id": "SELECT 1 FROM proposals WHERE process_id IS NULL",
    "proposals.not_null_user_id": "SELECT 1 FROM proposals WHERE user_id IS NULL",
    "proposals.process_id_in_participatory_processes":
        "SELECT 1 FROM proposals p WHERE NOT EXISTS (SELECT 1 FROM participatory_processes x "
        "WHERE x.process_id = p.process_id)",
    "proposals.user_id_in_users":
        "SELECT 1 FROM proposals p WHERE NOT EXISTS (SELECT 1 FROM users x WHERE x.user_id = p.user_id)",
    "comments.unique_comment_id": "SELECT comment_id FROM comments GROUP BY 1 HAVING count(*) > 1",
    "comments.not_null_comment_id": "SELECT 1 FROM comments WHERE comment_id IS NULL",
    "comments.complete_comment_id":
        "SELECT 1 FROM conversations c WHERE role <> 'system' AND NOT EXISTS (SELECT 1 FROM comments x "
        "WHERE x.comment_id = c.conv_id * 1000 + c.turn)",
    "comments.not_null_commented_component_id": "SELECT 1 FROM comments WHERE commented_component_id IS NULL",
    "comments.not_null_user_id": "SELECT 1 FROM comments WHERE user_id IS NULL",
    "comments.commented_component_id_in_proposals":
        "SELECT 1 FROM comments c WHERE component_type = 'proposal' AND NOT EXISTS (SELECT 1 FROM proposals x "
        "WHERE x.proposal_id = c.commented_component_id)",
    "comments.commented_component_id_in_comments":
        "SELECT 1 FROM comments c WHERE component_type = 'comment' AND NOT EXISTS (SELECT 1 FROM comments x "
        "WHERE x.comment_id = c.commented_component_id)",
    "comments.user_id_in_users":
        "SELECT 1 FROM comments c WHERE NOT EXISTS (SELECT 1 FROM users x WHERE x.user_id = c.user_id)",
    "votes.complete_original_vote_id_of_proposals":
        "SELECT 1 FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM votes x WHERE x.component_type = 'proposal' "
        "AND x.original_vote_id = l.l_orderkey * 10 + l.l_linenumber)",
    "votes.complete_original_vote_id_of_comments":
        "SELECT 1 FROM events e WHERE event_type = 'click' AND NOT EXISTS (SELECT 1 FROM votes x "
        "WHERE x.component_type = 'comment' AND x.original_vote_id = e.event_id)",
    "votes.unique_vote_id": "SELECT vote_id FROM votes GROUP BY 1 HAVING count(*) > 1",
    "votes.not_null_vote_id": "SELECT 1 FROM votes WHERE vote_id IS NULL",
    "votes.not_null_voted_component_id": "SELECT 1 FROM votes WHERE voted_component_id IS NULL",
    "votes.not_null_user_id": "SELECT 1 FROM votes WHERE user_id IS NULL",
    "votes.voted_component_id_in_proposals":
        "SELECT 1 FROM votes v WHERE component_type = 'proposal' AND NOT EXISTS (SELECT 1 FROM proposals x "
        "WHERE x.proposal_id = v.voted_component_id)",
    "votes.voted_component_id_in_comments":
        "SELECT 1 FROM votes v WHERE component_type = 'comment' AND NOT EXISTS (SELECT 1 FROM comments x "
        "WHERE x.comment_id = v.voted_component_id)",
    "votes.user_id_in_users":
        "SELECT 1 FROM votes v WHERE NOT EXISTS (SELECT 1 FROM users x WHERE x.user_id = v.user_id)",
}


_TESTS |= {f"proposal_metrics.not_null_{c}": f"SELECT 1 FROM proposal_metrics WHERE {c} IS NULL" for c in (
    "data_operacao", "id_processo", "id_proposta", "titulo_proposta", "titulo_processo", "qtd_rejeicao", "qtd_visitas", "qtd_votos",
    "qtd_comentarios")}
_TESTS["proposal_metrics.unique_proposal_per_day"] = (
    "SELECT 1 FROM proposal_metrics WHERE id_proposta IS NOT NULL AND data_operacao IS NOT NULL "
    "GROUP BY id_proposta, data_operacao HAVING count(*) > 1")


@registry.add("q_dq_report", with_models(
    f", proposal_metrics AS MATERIALIZED ({METRICS_SQL}) "
    + " UNION ALL ".join(f"SELECT '{n}' AS test, count(*) AS failures FROM ({q})" for n, q in _TESTS.items()),
    "users", "participatory_processes", "proposals", "comments", "votes", "visits")
    # A user may be bronze more than once, and every bronze row without a model row counts.
)
def q_dq_report(spark, sf):
    tables, models = _models(spark, sf)
    written = {name: materialize(model, name) for name, model in models.items() if name != "visits"}
    # From the written processes, which Spark knows to be few: visits then need not be dealt by process.
    written["visits"] = materialize(silver.visits(tables, written["participatory_processes"]), "visits")
    metrics = gold.proposal_metrics(written["proposals"], written["participatory_processes"], written["visits"],
                                    written["votes"], written["comments"], AS_OF)
    written["proposal_metrics"] = materialize(metrics, "proposal_metrics")
    return pipeline.test_report(written, tables)


@registry.add("q_bounce_rate", with_models("""
    SELECT CAST(session_date AS DATE) AS day, CAST(proposal_id AS BIGINT) AS proposal_id,
           count(DISTINCT session_id) AS qtd_visitas,
           CAST(sum(CASE WHEN num_actions = 1 THEN 1 ELSE 0 END) AS BIGINT) AS qtd_rejeicao,
           CAST(sum(CASE WHEN num_actions = 1 THEN 1 ELSE 0 END) // count(DISTINCT session_id) AS BIGINT)
               AS bounce_rate
    FROM visits WHERE regexp_full_match(proposal_id, '[0-9]+') GROUP BY session_date, visits.proposal_id""",
    "visits"))
def q_bounce_rate(spark, sf):
    tables = bronze(spark, sf)
    return gold.daily_visits(silver.visits(tables, silver.participatory_processes(tables)))


@registry.add("q_bounce_share", with_models("""
    SELECT CAST(DATE '1995-01-01' + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))::INT AS DATE) AS day,
           user_id AS proposal_id,
           round(sum(CASE WHEN value < 10 THEN 1 ELSE 0 END) / count(DISTINCT event_id), 6) AS bounce_rate
    FROM actions WHERE k = 1 GROUP BY 1, 2""", "actions"))
def q_bounce_share(spark, sf):
    tables = bronze(spark, sf)
    daily = gold.daily_visits(silver.visits(tables, silver.participatory_processes(tables), False), False)
    return daily.where(F.col("proposal_id").isNotNull()).select(
        "day", "proposal_id", F.round("bounce_rate", 6).alias("bounce_rate")
    )

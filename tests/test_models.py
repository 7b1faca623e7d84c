"""Models, feeds and configs: each quirk in both modes, and the whole run with its gate."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerwright.acceptance.civic import AS_OF, bronze
from layerwright.operators.quality import TestsFailed
from layerwright.plans import configs, feeds, gold, pipeline, silver
from layerwright.schemas import bronze_schema

T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def tables(spark, **data):
    """Bronze tables from rows of dictionaries; columns not given are NULL."""
    names = {
        "proposals": "decidim_proposals_proposals", "scopes": "decidim_scopes", "components": "decidim_components",
        "authors": "decidim_coauthorships", "categorized": "decidim_categorizations",
        "categories": "decidim_categories", "comments": "decidim_comments_comments",
        "proposal_votes": "decidim_proposals_proposal_votes", "comment_votes": "decidim_comments_comment_votes",
        "visits": "matomo_detailed_visits", "users": "decidim_users",
    }
    out = {}
    for short, table in names.items():
        schema = bronze_schema(table)
        rows = [tuple(r.get(c) for c in schema.fieldNames()) for r in data.get(short, [])]
        out[table] = spark.createDataFrame(rows, schema)
    return out


def civic(spark):
    kind, other = silver.PROPOSAL_TYPE, "Other"
    return tables(
        spark,
        proposals=[
            dict(id=1, decidim_component_id=10, decidim_scope_id=5, state="old", title='{"pt-BR":"A"}', created_at=T1, updated_at=T1),
            dict(id=1, decidim_component_id=10, decidim_scope_id=5, state="new", title='{"pt-BR":"A"}', created_at=T1, updated_at=T2),
            dict(id=2, decidim_component_id=11, state="x", title='{"en":"B"}', created_at=T2, updated_at=T1),
        ],
        scopes=[dict(id=5, decidim_organization_id=1, name='{"pt-BR":"S"}', updated_at=T1),
                dict(id=5, decidim_organization_id=2, name='{"pt-BR":"Z"}', updated_at=T2)],
        components=[dict(id=10, participatory_space_id=7, participatory_space_type=silver.PROCESS_SPACE, updated_at=T1),
                    dict(id=11, participatory_space_id=7, participatory_space_type="Decidim::Assembly", updated_at=T1)],
        authors=[dict(coauthorable_id=1, coauthorable_type=kind, decidim_author_id=a, updated_at=t) for a, t in ((100, T1), (101, T2), (100, T2))]
        + [dict(coauthorable_id=2, coauthorable_type=other, decidim_author_id=102, updated_at=T1)],
        categorized=[dict(categorizable_id=1, categorizable_type=kind, decidim_category_id=c, updated_at=t) for c, t in ((1, T1), (2, T2))],
        categories=[dict(id=1, name='{"pt-BR":"c1"}'), dict(id=2, name='{"pt-BR":"c2"}')],
        comments=[
            dict(id=1, decidim_author_id=100, decidim_commentable_type=kind, decidim_commentable_id=1,
                 decidim_root_commentable_type="Decidim::Debates::Debate", decidim_root_commentable_id=1,
                 decidim_participatory_space_type=silver.PROCESS_SPACE, created_at=T2, updated_at=T2),
            dict(id=2, decidim_participatory_space_type="Decidim::Assembly", created_at=T2, updated_at=T2),
        ],
        proposal_votes=[dict(id=1, decidim_proposal_id=1, decidim_author_id=100, created_at=T1, updated_at=t) for t in (T1, T2)],
        comment_votes=[dict(id=1, decidim_comment_id=1, decidim_author_id=100, created_at=T1, updated_at=T1),
                       dict(id=2, decidim_comment_id=2, decidim_author_id=100, created_at=T1, updated_at=T1)],
        visits=[dict(idVisit=1, serverDate="2024-01-02", actions=1, actionDetails='[{"url":"https://h/processes/p/f/1/proposals/1"},'
                     '{"url":"https://h/proposals/01"},{"url":"https://h/PROPOSALS/1"},{"url":"https://h/proposals/1?x=2"}]')],
    )


PROCESSES = "process_id bigint, process_slug string, process_title string"


def test_proposals_fan_out(spark):
    both = silver.proposals(civic(spark)).orderBy("proposal_id", "user_id", "proposal_category").collect()
    assert [(r.proposal_id, r.user_id, r.proposal_category, r.proposal_status, r.proposal_scope) for r in both] == [
        (1, 100, "c1", "new", "S"), (1, 100, "c2", "new", "S"), (1, 101, "c1", "new", "S"), (1, 101, "c2", "new", "S"),
        (2, None, None, "x", None)]
    one = silver.proposals(civic(spark), parity=False).orderBy("proposal_id").collect()
    assert [(r.proposal_id, r.user_id, r.proposal_category) for r in one] == [(1, 101, "c2"), (2, None, None)]
    assert one[1].proposal_title is None


def test_votes_only_on_comments_of_processes(spark):
    got = silver.votes(civic(spark)).orderBy("vote_id").collect()
    assert [(r.vote_id, r.component_type, r.voted_component_id) for r in got] == [
        ("comment_1", "comment", 1), ("proposal_1", "proposal", 1)]


@pytest.mark.parametrize(("parity", "expected"), [
    # The id as written twice (1 and 01), the assembly with the same id, the vote on comment 1, the debate's comment.
    (True, {(1, 1): [(0, 0, 2, 0)], (1, 2): [(1, 1, 0, 1), (1, 1, 0, 1)], (2, 2): [(0, 0, 0, 0)]}),
    (False, {(1, 1): [(0, 0, 1, 0)], (1, 2): [(1, 4, 0, 0)]}),
])
def test_metrics_in_both_modes(spark, parity, expected):
    b = civic(spark)
    processes = spark.createDataFrame([(7, "p", "P")], PROCESSES)
    visits = silver.visits(b, processes, parity)
    metrics = gold.proposal_metrics(
        silver.proposals(b, parity=parity).dropDuplicates(["proposal_id"]), processes, visits, silver.votes(b),
        silver.comments(b), "2024-01-02", parity,
    )
    got = {}
    for r in metrics.collect():
        got.setdefault((r.id_proposta, r.data_operacao.day), []).append(
            (r.qtd_visitas, r.qtd_rejeicao, r.qtd_votos, r.qtd_comentarios))
    assert got == expected
    assert metrics.columns == [
        "data_operacao", "id_processo", "id_proposta", "titulo_proposta", "status_proposta", "titulo_processo",
        "eixo_tematico", "qtd_visitas", "qtd_rejeicao", "qtd_votos", "qtd_comentarios"]


def test_visits_columns(spark):
    processes = spark.createDataFrame([(7, "p", "P")], PROCESSES)
    got = silver.visits(civic(spark), processes)
    assert len(got.columns) == 50 and got.columns[:3] == ["process_id", "participatory_process_slug", "proposal_id"]
    assert got.where("process_id = 7").count() == 1


def test_whole_run_and_gate(spark, sf_dir):
    tables_ = bronze(spark, sf_dir.replace("sf0.001", "sf0.01"))  # the smallest size with processes of the tenant
    with pytest.raises(TestsFailed, match="users|proposals|processes"):
        pipeline.run(spark, tables_, AS_OF, target="gated")
    names = []
    models = {m: spark.range(1) for m in ("users", "participatory_processes", "proposals", "comments", "votes", "proposal_metrics")}
    for tests in pipeline.model_tests(models, tables_).values():
        names.extend(tests)
    assert len(names) == 40
    made = pipeline.run(spark, tables_, AS_OF, target="open", allow_failures=tuple(names))
    assert made["proposal_metrics"] == "open_gold.proposal_metrics"
    assert spark.table("open_gold.proposal_metrics").count() > 0
    before = spark.table("open_gold.proposal_metrics").count()
    again = pipeline.run(spark, tables_, AS_OF, target="open", allow_failures=tuple(names))
    assert again == made and spark.table("open_gold.proposal_metrics").count() == before
    assert spark.sql("SHOW TABLES IN open_gold").count() == 3  # the view, the table behind it and the one before
    assert len(spark.table("open_gold.proposal_metrics").columns) == 11
    with pytest.raises(KeyError, match="decidim_users"):
        pipeline.model_tests(models, {n: t for n, t in tables_.items() if n != "decidim_users"})
    assert not spark.catalog.tableExists("gated_gold.proposal_metrics")


def node(spark, **changes):
    base = dict(id=1, state="accepted", publishedAt=T1, updatedAt=T1, title="t", body="<b>x</b>\n", category=None,
                author="a", organization=None)
    base.update(changes)
    return spark.createDataFrame([base], "id int, state string, publishedAt timestamp, updatedAt timestamp, title string, "
                                 "body string, category string, author string, organization string").select(
        "id", "state", "publishedAt", "updatedAt", F.struct(F.col("title").alias("translation")).alias("title"),
        F.struct(F.col("body").alias("translation")).alias("body"),
        F.struct(F.struct(F.col("category").alias("translation")).alias("name")).alias("category"),
        F.struct(F.col("author").alias("name"), F.col("organization").alias("organizationName")).alias("author"))


@pytest.mark.parametrize(("changes", "state"), [
    ({}, "accepted"), ({"state": "other"}, "new"), ({"state": None}, "new"),
    ({"state": None, "updatedAt": T2}, "others"), ({"state": "rejected", "updatedAt": T2}, "rejected"),
])
def test_proposal_states(spark, changes, state):
    row = feeds.proposal_rows(node(spark, **changes), "https://h/p").first()
    assert (row.state, row.state_label, row.state_sign) == (state, *feeds.STATES[state])
    assert row.date == max(T1, changes.get("updatedAt", T1))


def test_proposal_message(spark):
    rows = feeds.proposal_feed(node(spark, organization="Us"), "https://h/p", F.lit(dt.datetime(2023, 1, 1)), ["Us"])
    assert rows.first().message == (
        "✅ ✅ ✅ Proposta <b>aceita </b>em 01/01/2024 00:00\n\n<b>Proposta</b>\nt\n\n<b>Autor</b>\na \n\n"
        '<b>Categoria</b>\n-\n\n<b>Descrição</b>\nx\n\n<a href="https://h/p/1">Acesse aqui</a>')
    assert feeds.proposal_feed(node(spark), "https://h/p", F.lit(T1)).count() == 0


def test_feed_dispatch_and_chats(spark):
    with pytest.raises(NotImplementedError):
        feeds.rows_of_component("Meetings", node(spark), "https://h")
    assert feeds.rows_of_component("Proposals", node(spark), "https://h").count() == 1
    chats = spark.createDataFrame([(1, 5), (2, 0), (3, None)], "id int, telegram_group_id long")
    assert [r.id for r in feeds.with_chat(chats).collect()] == [1]
    ordered = feeds.to_send(spark.createDataFrame([(2, T2), (1, T1)], "id int, updatedAt timestamp"))
    assert [r.id for r in ordered.collect()] == [1, 2]


def space(spark, start="startDate", end="endDate", chat="-5", begins=None):
    kind = "array<struct<id:string,__typename:string,name:struct<translation:string>>>"
    return spark.createDataFrame(
        [("meu plano", chat, begins, None, [("1", "Proposals", ("Ação",)), ("2", "Meetings", ("x",)), ("3", "Proposals", (None,))])],
        f"slug string, groupChatId string, {start} string, {end} string, components {kind}")


@pytest.mark.parametrize(("start", "end"), [("startDate", "endDate"), ("creationDate", "closingDate"),
                                            ("startVotingDate", "endVotingDate"), ("signatureStartDate", "signatureEndDate")])
def test_config_rows(spark, start, end):
    rows = configs.config_rows(space(spark, start, end), "2024-01-31").orderBy("component_id").collect()
    assert [(r.component_id, r.process_id, str(r.start_date), r.end_date, r.telegram_group_id) for r in rows] == [
        (1, "MEU_PLANO_ACAO", "2024-01-31", None, -5), (3, "MEU_PLANO", "2024-01-31", None, -5)]


@pytest.mark.parametrize(("new_chat", "old_chat", "chat", "topics", "to_create"), [
    ("-5", -5, -5, {"telegram_moderation_proposals_topic_id": 9}, ["telegram_moderation_comments_topic_id"]),
    ("-6", -5, -6, {}, list(configs.TOPIC_SUFFIXES)),
    ("", -5, -5, {"telegram_moderation_proposals_topic_id": 9}, []),
    ("word", None, None, {"telegram_moderation_proposals_topic_id": 9}, []),
])
def test_config_merge(spark, new_chat, old_chat, chat, topics, to_create):
    stored = spark.createDataFrame([(1, "OLD", old_chat, {"telegram_moderation_proposals_topic_id": 9})],
                                   "component_id int, process_id string, telegram_group_id long, topics map<string,long>")
    new = configs.config_rows(space(spark, chat=new_chat, begins="2024-02-02"), "2024-01-31")
    merged = {r.component_id: r for r in configs.merge_configs(new, stored).collect()}
    assert (merged[1].process_id, merged[1].telegram_group_id, merged[1].topics, merged[1].topics_to_create) == (
        "OLD", chat, topics, to_create)
    assert str(merged[1].start_date) == "2024-02-02" and merged[1].was_stored and not merged[3].was_stored
    update, configure = configs.split_configs(new, stored)
    assert [r.component_id for r in update.collect()] == [1] and [r.component_id for r in configure.collect()] == [3]


def test_visits_are_spread_over_tasks_and_joined_to_written_processes_where_they_are(spark, sf_dir):
    """Their file is cut into few tasks; and once processes are written, the rows of visits are not moved again to find theirs."""
    from layerwright.acceptance.civic import bronze
    from layerwright.plans import silver
    from layerwright.session import materialize

    tables = bronze(spark, sf_dir)
    processes = materialize(silver.participatory_processes(tables), "processes")
    plan = silver.visits(tables, processes)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(event_id" in plan and plan.count("hashpartitioning(") == 1 and "SortMergeJoin" not in plan

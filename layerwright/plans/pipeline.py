"""Bronze to gold in order, each model published only when its tests pass."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.operators import quality as dq
from layerwright.plans import gold, silver
from layerwright.schemas import layer_database
from layerwright.sources.writers import publish_version, switch_view


def model_tests(models: Mapping[str, DataFrame], bronze: Mapping[str, DataFrame],
                parity: bool = False) -> dict[str, dict[str, dq.Test]]:
    """The declared data tests of the given models. One that needs a table or model which is not at hand is an error:
    a model must not be published because its test could not run."""
    raw = dict(bronze)
    tests: dict[str, dict[str, dq.Test]] = {}

    def add(model: str, name: str, needs: tuple[str, ...], run: Callable[[], DataFrame]) -> None:
        if model not in models:
            return
        absent = [n for n in needs if n not in models and n not in raw]
        if absent:
            raise KeyError(f"the test {model}.{name} needs {', '.join(absent)}")
        tests.setdefault(model, {})[f"{model}.{name}"] = run

    def key_tests(model: str, column: str) -> None:
        add(model, f"unique_{column}", (), lambda: dq.unique(models[model], column))
        filled(model, column)

    def filled(model: str, *columns: str) -> None:
        for column in columns:
            if model in models:
                add(model, f"not_null_{column}", (), dq.NotNull(models[model], column))

    def complete(model: str, column: str, table: str, tag: str = "", **filters) -> None:
        add(model, f"complete_{column}{tag}", (table,), lambda: dq.completeness(
            models[model], column, raw[table], "id", parity=parity, **filters))

    def refers(model: str, column: str, parent: str, parent_column: str, only: str | None = None) -> None:
        keep = None if only is None else F.col("component_type") == only
        add(model, f"{column}_in_{parent}", (parent,), lambda: dq.referential(
            models[model], column, models[parent], parent_column, keep))

    key_tests("users", "user_id")
    complete("users", "user_id", "decidim_users")
    key_tests("participatory_processes", "process_id")
    complete("participatory_processes", "process_id", "decidim_participatory_processes")
    key_tests("proposals", "proposal_id")
    complete("proposals", "proposal_id", "decidim_proposals_proposals")
    filled("proposals", "process_id", "user_id")
    refers("proposals", "process_id", "participatory_processes", "process_id")
    refers("proposals", "user_id", "users", "user_id")
    key_tests("comments", "comment_id")
    complete("comments", "comment_id", "decidim_comments_comments",
             origin_filter=F.col("decidim_participatory_space_type") == silver.PROCESS_SPACE)
    filled("comments", "commented_component_id", "user_id")
    refers("comments", "commented_component_id", "proposals", "proposal_id", "proposal")
    refers("comments", "commented_component_id", "comments", "comment_id", "comment")
    refers("comments", "user_id", "users", "user_id")
    complete("votes", "original_vote_id", "decidim_proposals_proposal_votes", "_of_proposals",
             model_filter=F.col("component_type") == "proposal")
    complete("votes", "original_vote_id", "decidim_comments_comment_votes", "_of_comments",
             model_filter=F.col("component_type") == "comment")
    key_tests("votes", "vote_id")
    filled("votes", "voted_component_id", "user_id")
    refers("votes", "voted_component_id", "proposals", "proposal_id", "proposal")
    refers("votes", "voted_component_id", "comments", "comment_id", "comment")
    refers("votes", "user_id", "users", "user_id")
    filled("proposal_metrics", "data_operacao", "id_processo", "id_proposta", "titulo_proposta", "titulo_processo",
           "qtd_rejeicao", "qtd_visitas", "qtd_votos", "qtd_comentarios")
    add("proposal_metrics", "unique_proposal_per_day", (),
        lambda: dq.unique(models["proposal_metrics"], "id_proposta", "data_operacao"))
    return tests


def test_report(models: Mapping[str, DataFrame], bronze: Mapping[str, DataFrame], parity: bool = False) -> DataFrame:
    """Failures of all declared tests as one table."""
    every: dict[str, dq.Test] = {}
    for tests in model_tests(models, bronze, parity).values():
        every.update(tests)
    return dq.report(every)


test_report.__test__ = False  # a library function, not a test


def run(spark: SparkSession, bronze: Mapping[str, DataFrame], as_of: date | str, target: str = "prod",
        parity: bool = False, allow_failures: tuple[str, ...] = ()) -> dict[str, str]:
    """Build, write and test every model; returns the published name of each.

    Each run writes a model to a table of its own, its tests read that table, and only then does the
    published name, a view, point to it. Readers never see a half-written or missing model. Later
    models read the written ones, so no work is done twice.
    """
    names: dict[str, str] = {}
    models: dict[str, DataFrame] = {}
    version = uuid.uuid4().hex[:12]

    def build(name: str, model: DataFrame, layer: str, sort_by=(), partition_by=()) -> None:
        written = publish_version(model, name, version, target, layer, sort_by, partition_by)
        models[name] = spark.table(written)
        tests = model_tests(models, bronze, parity).get(name)
        if tests:
            dq.require_passed(dq.report(tests), allow_failures)
        names[name] = switch_view(spark, layer_database(target, layer), name, written, hide=partition_by)

    build("users", silver.users(bronze), "silver")
    build("participatory_processes", silver.participatory_processes(bronze), "silver")
    build("proposals", silver.proposals(bronze, parity=parity), "silver")
    build("comments", silver.comments(bronze), "silver")
    build("votes", silver.votes(bronze), "silver")
    build("visits", silver.visits(bronze, models["participatory_processes"], parity), "silver")
    metrics = gold.proposal_metrics(
        models["proposals"], models["participatory_processes"], models["visits"], models["votes"],
        models["comments"], as_of, parity,
    ).withColumn("mes_operacao", F.date_format("data_operacao", "yyyy-MM"))
    build("proposal_metrics", metrics, "gold", ("id_proposta", "data_operacao"), ("mes_operacao",))
    return names

"""Gold model: activity per proposal and day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.functions.text import is_digits
from layerwright.operators.joins import lookup_dimension
from layerwright.operators.series import daily_fill, sum_daily

MEASURES = ["qtd_visitas", "qtd_rejeicao", "qtd_votos", "qtd_comentarios"]


def daily_visits(visits: DataFrame, parity: bool = True) -> DataFrame:
    """Distinct visits, single-action rows and their ratio by day and proposal.

    Proposal ids come from URLs. With ``parity`` rows are grouped by the id as written, so ``07`` and
    ``7`` make two rows, and the ratio is an integer division.
    """
    rows = visits.where(F.col("proposal_id").isNotNull() & is_digits(F.col("proposal_id"))).select(
        F.col("session_date"), F.col("proposal_id").alias("_written"),
        F.col("proposal_id").try_cast("bigint").alias("_number"), "session_id",
        F.when(F.col("num_actions") == 1, 1).otherwise(0).alias("_single"),
    )
    keys = ["session_date", "_written"] if parity else ["session_date", "_number"]
    grouped = rows.groupBy(*keys).agg(
        F.count_distinct("session_id").alias("qtd_visitas"), F.sum("_single").alias("qtd_rejeicao")
    )
    proposal = F.col("_written").try_cast("bigint") if parity else F.col("_number")
    ratio = F.expr("qtd_rejeicao DIV qtd_visitas") if parity else F.col("qtd_rejeicao") / F.col("qtd_visitas")
    return grouped.select(
        F.col("session_date").try_cast("date").alias("day"), proposal.alias("proposal_id"), "qtd_visitas", "qtd_rejeicao",
        F.when(F.col("qtd_visitas") > 0, ratio).alias("bounce_rate"),
    )


def visit_sketches(visits: DataFrame, lg_k: int = 12) -> DataFrame:
    """A sketch of the distinct visits of each proposal and day, of some kilobytes, whatever their number.

    Days can be added up later without the visits (:func:`visits_between`), which exact counts can't. The standard error of an estimate
    is about 1.04 / sqrt(2 ** lg_k), 1.6 per cent by default.
    """
    rows = visits.where(F.col("proposal_id").isNotNull() & is_digits(F.col("proposal_id")))
    return rows.groupBy(F.col("session_date").try_cast("date").alias("day"), F.col("proposal_id").try_cast("bigint").alias("proposal_id")).agg(
        F.hll_sketch_agg("session_id", F.lit(lg_k)).alias("sketch"))


def visits_between(sketches: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """About how many different visits each proposal had from one day to another, both included."""
    rows = sketches.where(F.col("day").between(F.lit(str(first)).cast("date"), F.lit(str(last)).cast("date")))
    return rows.groupBy("proposal_id").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("visits"))


def daily_votes(votes: DataFrame, only: str | None = None) -> DataFrame:
    """Votes by day and component; ``only`` limits them to one component type."""
    rows = votes if only is None else votes.where(F.col("component_type") == only)
    return rows.groupBy(
        F.to_date("created_at").alias("day"), F.col("voted_component_id").alias("proposal_id")
    ).agg(F.count("voted_component_id").alias("qtd_votos"))


def daily_comments(comments: DataFrame, only: str | None = None) -> DataFrame:
    """Comments by day and root component; ``only`` limits them to one root type."""
    rows = comments if only is None else comments.where(F.col("root_component_type") == only)
    return rows.groupBy(
        F.to_date("created_at").alias("day"), F.col("commented_root_component_id").alias("proposal_id")
    ).agg(F.count(F.lit(1)).alias("qtd_comentarios"))


def proposal_metrics(proposals: DataFrame, processes: DataFrame, visits: DataFrame, votes: DataFrame,
                     comments: DataFrame, as_of: date | str | Column, parity: bool = True) -> DataFrame:
    """Visits, rejections, votes and comments of each proposal on each day since its creation.

    With ``parity`` votes and comments count whatever their component type, as ids are compared
    alone. Otherwise only those on proposals count, and only process spaces are matched.
    """
    only = None if parity else "proposal"
    rows = proposals
    if not parity:
        rows = rows.where(F.col("participatory_space_type").endswith("::ParticipatoryProcess"))
    entities = lookup_dimension(
        rows.select("proposal_id", "process_id", "created_at", "proposal_title", "proposal_status",
                    "proposal_category"),
        processes, {"process_id": "process_id"}, {"process_title": "process_title"}, "inner",
    )
    by_vote, by_comment = daily_votes(votes, only), daily_comments(comments, only)
    by_visit = daily_visits(visits, parity).drop("bounce_rate")
    activity = sum_daily([by_vote, by_comment], "proposal_id", "day", MEASURES[2:])
    return _renamed(daily_fill(
        entities, activity, "proposal_id", "created_at", "day", MEASURES[2:], as_of, variants=by_visit
    ))


def _renamed(series: DataFrame) -> DataFrame:
    return series.select(
        F.col("day").alias("data_operacao"),
        F.col("process_id").alias("id_processo"),
        F.col("proposal_id").alias("id_proposta"),
        F.col("proposal_title").alias("titulo_proposta"),
        F.col("proposal_status").alias("status_proposta"),
        F.col("process_title").alias("titulo_processo"),
        F.col("proposal_category").alias("eixo_tematico"),
        *MEASURES,
    )

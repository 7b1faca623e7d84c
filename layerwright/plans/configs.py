"""Process configs: components found in spaces, compared with the stored configs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.functions.dates import day_or_default
from layerwright.functions.text import first_matching_column, identifier, title_from_identifier
from layerwright.operators.joins import split_known, spread_join

# Accepted component types, patterns of date keys, topics of a component.
ACCEPTED_TYPES = ("Proposals",)
START_KEY = r"(start|creation).*Date"
END_KEY = r"(end|closing).*Date"
TOPIC_SUFFIXES = {
    "telegram_moderation_proposals_topic_id": "/Propostas",
    "telegram_moderation_comments_topic_id": "/Comentarios Em Propostas",
}


def config_rows(spaces: DataFrame, as_of: date | str, accepted: Sequence[str] = ACCEPTED_TYPES) -> DataFrame:
    """One config per accepted component of a space.

    Date columns are found by name, as each kind of space names them in its own way. A missing start
    becomes ``as_of``; a chat id that is no number becomes NULL.
    """
    start_key = first_matching_column(spaces.columns, START_KEY)
    end_key = first_matching_column(spaces.columns, END_KEY)

    def day_text(name: str | None) -> Column:
        return F.lit(None).cast("string") if name is None else F.col(name).cast("string")

    rows = spaces.select(
        "slug", "groupChatId", day_text(start_key).alias("_start"), day_text(end_key).alias("_end"),
        F.explode("components").alias("component"),
    ).where(F.col("component.__typename").isin(*accepted))
    name = F.coalesce(F.col("component.name.translation"), F.lit(""))
    return rows.select(
        F.col("component.__typename").alias("__typename"),
        identifier(F.col("slug"), name).alias("process_id"),
        F.col("component.id").try_cast("int").alias("component_id"),
        day_or_default(F.col("_start"), as_of).alias("start_date"),
        F.try_to_date(F.nullif(F.col("_end"), F.lit("")), "yyyy-MM-dd").alias("end_date"),
        F.col("groupChatId").try_cast("bigint").alias("telegram_group_id"),
    )


def split_configs(configs: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Configs of stored components and of new ones: (to update, to configure)."""
    return split_known(configs, stored, "component_id")


def missing_topics(configured: Column, wanted: Sequence[str] = tuple(TOPIC_SUFFIXES)) -> Column:
    """Topic names that a config still lacks."""
    have = F.coalesce(configured, F.array().cast("array<string>"))
    return F.array_except(F.array(*[F.lit(w) for w in wanted]), have)


def topic_names(process_id: Column) -> dict[str, Column]:
    """Title of each topic of a component."""
    title = title_from_identifier(process_id)
    return {topic: F.concat(title, F.lit(suffix)) for topic, suffix in TOPIC_SUFFIXES.items()}


def merge_configs(new: DataFrame, stored: DataFrame) -> DataFrame:
    """Stored configs brought up to date, and new ones.

    Dates come from the new row. Without a new chat id the stored chat and topics stay. A changed chat
    discards the stored topics; ``topics_to_create`` names those that must be made.
    ``stored`` has ``component_id, process_id, telegram_group_id, topics`` (map of topic to id).
    """
    old = stored.select(
        "component_id", F.col("process_id").alias("_old_id"), F.col("telegram_group_id").alias("_old_chat"),
        F.col("topics").alias("_old_topics"), F.lit(True).alias("_stored"),
    )
    both = spread_join(new, old, ["component_id"], "left")
    has_chat = F.coalesce(F.col("telegram_group_id") != 0, F.lit(False))
    same_chat = has_chat & F.col("telegram_group_id").eqNullSafe(F.col("_old_chat"))
    no_topics = F.create_map().cast("map<string,bigint>")
    kept = F.when(~has_chat | same_chat, F.coalesce("_old_topics", no_topics)).otherwise(no_topics)
    to_create = F.when(has_chat, missing_topics(F.map_keys(kept))).otherwise(F.array().cast("array<string>"))
    return both.select(
        "component_id",
        F.coalesce("_old_id", "process_id").alias("process_id"),
        "start_date", "end_date",
        F.when(has_chat, F.col("telegram_group_id")).otherwise(F.col("_old_chat")).alias("telegram_group_id"),
        kept.alias("topics"),
        to_create.alias("topics_to_create"),
        F.coalesce("_stored", F.lit(False)).alias("was_stored"),
    )

"""Notification feeds: nested proposals and comments to message rows newer than a stored mark."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.functions.dates import inside_open_interval, latest, lenient_timestamp, message_time
from layerwright.functions.text import (
    blank_to_dash, blank_where, drop_hashtags, first_filled, html_to_text, link_to, lookup,
)
from layerwright.operators.nested import flatten_structs
from layerwright.operators.tables import newer_than
from layerwright.operators.threads import expand_threads, with_ancestors

# Label and sign in messages by proposal state and by comment state.
STATES = {
    "accepted": ("aceita ", "✅ ✅ ✅"),
    "evaluating": ("em avaliação ", "📥 📥 📥"),
    "withdrawn": ("retirada ", "🚫 🚫 🚫"),
    "rejected": ("rejeitada ", "⛔ ⛔ ⛔"),
    "others": ("atualizada ", "🔄 🔄 🔄"),
    "new": ("", "📣 📣 📣 <b>[NOVA]</b>"),
}
COMMENT_STATES = {"update": ("Comentario atualizado", "🔄 🔄 🔄"), "new": ("Novo comentario", "💬")}


def label_and_sign(state: Column, states: dict[str, tuple[str, str]]) -> tuple[Column, Column]:
    label, sign = ({name: pair[i] for name, pair in states.items()} for i in (0, 1))
    return lookup(state, label, ""), lookup(state, sign, "")


def proposal_state(state: Column, published: Column, updated: Column) -> Column:
    """The state if it has a label; else ``others`` for an updated proposal and ``new`` for a fresh one."""
    known = state.isin(*STATES)
    return F.when(known, state).when(updated > published, F.lit("others")).otherwise(F.lit("new"))


def proposal_rows(nodes: DataFrame, link_base: Column | str, own_organizations: Iterable[str] = ()) -> DataFrame:
    """Proposal nodes as flat rows with cleaned texts, state, date, category and link.

    ``own_organizations`` are author organisations that messages leave out.
    """
    flat = flatten_structs(nodes)
    have = set(flat.columns)

    def text(name: str) -> Column:
        return F.col(f"`{name}`").cast("string") if name in have else F.lit(None).cast("string")

    published, updated = (F.col(c).cast("timestamp") for c in ("publishedAt", "updatedAt"))
    is_update = F.coalesce(updated > published, F.lit(False))
    state = proposal_state(text("state"), published, updated)
    label, sign = label_and_sign(state, STATES)
    organization = blank_where(F.coalesce(text("author.organizationName"), F.lit("")), ["-", *own_organizations])
    base = link_base if isinstance(link_base, Column) else F.lit(link_base)
    return flat.select(
        F.col("id"),
        blank_to_dash(text("title.translation")).alias("title"),
        blank_to_dash(drop_hashtags(html_to_text(F.coalesce(text("body.translation"), F.lit(""))))).alias("body"),
        first_filled(text("category.name.translation"), text("category")).alias("category"),
        blank_to_dash(text("author.name")).alias("author_name"),
        organization.alias("organization_name"),
        state.alias("state"),
        label.alias("state_label"),
        sign.alias("state_sign"),
        published.alias("publishedAt"),
        updated.alias("updatedAt"),
        F.when(is_update, updated).otherwise(published).alias("date"),
        link_to(base, F.col("id")).alias("link"),
    )


def _message(*parts: Column | str) -> Column:
    """Parts one behind the other. A missing one is left blank: it must not take the whole message with it."""
    return F.concat(*[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts])


def proposal_message(rows: DataFrame) -> DataFrame:
    """Rows with the message text of each proposal."""
    return rows.withColumn("message", _message(
        "state_sign", F.lit(" Proposta <b>"), "state_label", F.lit("</b>em "), message_time(F.col("date")),
        F.lit("\n\n<b>Proposta</b>\n"), "title",
        F.lit("\n\n<b>Autor</b>\n"), "author_name", F.lit(" "), "organization_name",
        F.lit("\n\n<b>Categoria</b>\n"), "category",
        F.lit("\n\n<b>Descrição</b>\n"), "body",
        F.lit('\n\n<a href="'), "link", F.lit('">Acesse aqui</a>'),
    ))


def proposal_feed(nodes: DataFrame, link_base: Column | str, high_water: Column,
                  own_organizations: Iterable[str] = ()) -> DataFrame:
    """Messages for proposals published or updated after the mark. Sort by ``updatedAt`` to send."""
    fresh = newer_than(proposal_rows(nodes, link_base, own_organizations), ["publishedAt", "updatedAt"], high_water)
    return proposal_message(fresh)


def comment_rows(comments: DataFrame, link_base: Column | str, lower: Column | None = None,
                 upper: Column | None = None) -> DataFrame:
    """Comment threads as rows with dates, state and link, strictly inside an optional time window.

    ``comments`` has ``id, parent_id, root_component_id, body, author_id, author_name, createdAt,
    updatedAt, status``; only root comments need the root component.
    """
    base = link_base if isinstance(link_base, Column) else F.lit(link_base)
    created, updated = (lenient_timestamp(F.col(c)) for c in ("createdAt", "updatedAt"))
    inside = inside_open_interval(latest(created, updated), lower, upper)
    if lower is not None or upper is not None:  # threads only of what is told; the rest of history is not walked
        comments = with_ancestors(comments.where(inside), comments, "id", "parent_id")
    threads = expand_threads(comments, "id", "parent_id", "root_component_id")
    return threads.where(inside).select(
        "root_component_id", "parent_comment_id", "body", "author_id", "author_name",
        F.col("id").alias("comment_id"), created.alias("creation_date"), updated.alias("update_date"), "status",
        latest(created, updated).alias("date_filter"), link_to(base, F.col("root_component_id")).alias("link"),
        "thread_id", "depth",
    )


def comment_state(created: Column, updated: Column) -> Column:
    return F.when(updated > created, F.lit("update")).otherwise(F.lit("new"))


def comment_message(rows: DataFrame) -> DataFrame:
    """Rows with the message text of each comment."""
    label, sign = label_and_sign(comment_state(F.col("creation_date"), F.col("update_date")), COMMENT_STATES)
    return rows.withColumn("message", _message(
        sign, F.lit(" "), label, F.lit(": "),
        message_time(F.col("date_filter")),
        F.lit("\n\n<b>Autor</b>\n"), blank_to_dash(F.col("author_name")),
        F.lit("\n\n<b>Comentario</b>\n"), blank_to_dash(F.col("body")),
        F.lit('\n\n<a href="'), "link", F.lit('">Acesse aqui</a>'),
    ))


def with_chat(configs: DataFrame, chat_id: str = "telegram_group_id") -> DataFrame:
    """Configs that have a chat to send to."""
    return configs.where(F.col(chat_id).isNotNull() & (F.col(chat_id) != 0))


FEED_ROWS = {"Proposals": proposal_rows}


def rows_of_component(kind: str, nodes: DataFrame, link_base: Column | str, **options) -> DataFrame:
    """Rows of a component by its type; a type without a transform is an error."""
    if kind not in FEED_ROWS:
        raise NotImplementedError(f"no feed for component type {kind}")
    return FEED_ROWS[kind](nodes, link_base, **options)


def to_send(messages: DataFrame, key: Sequence[str] = ("updatedAt",)) -> DataFrame:
    """Messages in the order of delivery."""
    return messages.orderBy(*key)

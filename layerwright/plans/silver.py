"""Silver models. Each takes bronze tables (raw, with old versions) and returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.functions.text import last_segment, localized, url_part
from layerwright.operators.dedup import any_per_key, latest_per_key
from layerwright.operators.joins import existing, lookup_dimension, lookup_many, spread_join
from layerwright.operators.nested import unnest_json_array
from layerwright.operators.tables import tagged
from layerwright.schemas import ACTION_FIELDS, add_missing_columns, bronze_schema

# Type names that the source stores in its polymorphic columns.
PROCESS_SPACE = "Decidim::ParticipatoryProcess"
PROPOSAL_TYPE = "Decidim::Proposals::Proposal"

Bronze = Mapping[str, DataFrame]


def source(bronze: Bronze, table: str) -> DataFrame:
    """A bronze table cut to the model's columns, with typed NULLs for those left out at ingestion."""
    schema = bronze_schema(table)
    return add_missing_columns(bronze[table], schema).select(*schema.fieldNames())


def users(bronze: Bronze) -> DataFrame:
    newest = latest_per_key(source(bronze, "decidim_users"), ["id"])
    return newest.select(
        F.col("id").alias("user_id"),
        F.col("nickname").alias("username"),
        F.col("email").alias("user_email"),
        "created_at",
        "updated_at",
        F.col("last_sign_in_at").alias("last_activity_at"),
        F.col("roles").alias("user_roles"),
    )


def participatory_processes(bronze: Bronze, organization: int = 1) -> DataFrame:
    """Processes of one organisation with their type, area and area type."""
    key = ["id", "decidim_organization_id"]

    def of_organization(table: str) -> DataFrame:
        return source(bronze, table).where(F.col("decidim_organization_id") == organization)

    processes = latest_per_key(of_organization("decidim_participatory_processes"), key)
    types = latest_per_key(of_organization("decidim_participatory_process_types"), key)
    areas = latest_per_key(of_organization("decidim_areas"), key)
    area_types = any_per_key(of_organization("decidim_area_types"), key)
    org = {"decidim_organization_id": "decidim_organization_id"}
    out = lookup_dimension(
        processes, types, {"decidim_participatory_process_type_id": "id", **org}, {"title": "type_title"}
    )
    out = lookup_dimension(
        out, areas, {"decidim_area_id": "id", **org}, {"name": "area_name", "area_type_id": "area_type_id"},
    )
    out = lookup_dimension(out, area_types, {"area_type_id": "id", **org}, {"name": "area_type_name"})
    return out.select(
        F.col("id").alias("process_id"),
        localized(F.col("type_title")).alias("process_type"),
        F.col("slug").alias("process_slug"),
        localized(F.col("title")).alias("process_title"),
        localized(F.col("subtitle")).alias("process_subtitle"),
        localized(F.col("description")).alias("description"),
        localized(F.col("short_description")).alias("short_description"),
        localized(F.col("area_name")).alias("responsible_area"),
        localized(F.col("area_type_name")).alias("responsible_type"),
        "created_at", "updated_at", "published_at", "start_date", "end_date", "reference", "follows_count",
    )


def proposals(bronze: Bronze, organization: int = 1, parity: bool = True) -> DataFrame:
    """Proposals with space, author, scope and category.

    With ``parity`` there is one row per proposal, author and category. Otherwise the latest author
    and the latest category are taken, which gives one row per proposal.
    """
    base = latest_per_key(source(bronze, "decidim_proposals_proposals"), ["id"])
    scopes = latest_per_key(
        source(bronze, "decidim_scopes").where(F.col("decidim_organization_id") == organization),
        ["id", "decidim_organization_id"],
    )
    components = latest_per_key(source(bronze, "decidim_components"), ["id"])
    authors = source(bronze, "decidim_coauthorships").where(F.col("coauthorable_type") == PROPOSAL_TYPE)
    categorized = source(bronze, "decidim_categorizations").where(F.col("categorizable_type") == PROPOSAL_TYPE)
    # The raw rows name the same proposals and cost less to look in.
    author_keys = authors.select(F.col("coauthorable_id").alias("id"))
    if parity:
        authors = latest_per_key(authors, ["decidim_author_id", "coauthorable_id"])
        categorized = latest_per_key(categorized, ["categorizable_id", "decidim_category_id"])
    else:
        authors = latest_per_key(authors, ["coauthorable_id"])
        categorized = latest_per_key(categorized, ["categorizable_id"])

    named = lookup_dimension(
        categorized, source(bronze, "decidim_categories"), {"decidim_category_id": "id"}, {"name": "category_name"}
    )
    narrow = base.select(
        "id", "decidim_component_id", "decidim_scope_id", F.col("state").alias("proposal_status"), "created_at",
        localized(F.col("title")).alias("proposal_title"), localized(F.col("body")).alias("proposal_text"),
    )
    out = lookup_dimension(narrow, scopes, {"decidim_scope_id": "id"}, {"name": "scope_name"})
    out = lookup_dimension(
        out, components, {"decidim_component_id": "id"},
        {"participatory_space_id": "process_id", "participatory_space_type": "participatory_space_type"},
    )
    authors = authors.select(
        F.col("coauthorable_id").alias("id"), F.col("decidim_author_id").alias("user_id"),
        F.col("decidim_author_type").alias("author_type"),
    )
    categories = named.select(
        F.col("categorizable_id").alias("id"), localized(F.col("category_name")).alias("proposal_category")
    )
    out = lookup_many(out, authors, ["id"], author_keys)
    out = spread_join(out, categories, ["id"])
    return out.select(
        F.col("id").alias("proposal_id"), "process_id", "participatory_space_type", "user_id", "author_type",
        "proposal_status", "created_at", "proposal_title", "proposal_text",
        localized(F.col("scope_name")).alias("proposal_scope"), "proposal_category",
    )


def _process_comments(bronze: Bronze) -> DataFrame:
    return source(bronze, "decidim_comments_comments").where(
        F.col("decidim_participatory_space_type") == PROCESS_SPACE
    )


def comments(bronze: Bronze) -> DataFrame:
    newest = latest_per_key(_process_comments(bronze), ["id"])
    return newest.select(
        F.col("id").alias("comment_id"),
        F.col("decidim_author_id").alias("user_id"),
        last_segment(F.col("decidim_commentable_type")).alias("component_type"),
        F.col("decidim_commentable_id").alias("commented_component_id"),
        last_segment(F.col("decidim_root_commentable_type")).alias("root_component_type"),
        F.col("decidim_root_commentable_id").alias("commented_root_component_id"),
        localized(F.col("body")).alias("comment_text"),
        "created_at", "updated_at", "deleted_at",
    )


def votes(bronze: Bronze) -> DataFrame:
    """Votes on proposals and votes on comments of processes, as one table."""
    on_proposals = latest_per_key(source(bronze, "decidim_proposals_proposal_votes"), ["id"])
    comment_votes = source(bronze, "decidim_comments_comment_votes")
    comment_ids = _process_comments(bronze).select(F.col("id").alias("decidim_comment_id"))
    on_comments = existing(latest_per_key(comment_votes, ["id"]), comment_ids, ["decidim_comment_id"])

    def shaped(rows: DataFrame, tag: str, target: str) -> DataFrame:
        return tagged(rows, tag, "id", "component_type", "vote_id").select(
            "vote_id", F.col("id").alias("original_vote_id"), "component_type",
            F.col(target).alias("voted_component_id"), F.col("decidim_author_id").alias("user_id"), "created_at",
        )

    return shaped(on_proposals, "proposal", "decidim_proposal_id").unionByName(
        shaped(on_comments, "comment", "decidim_comment_id")
    )


# Output names of the visit columns and of the action fields.
VISIT_COLUMNS = {
    "idVisit": "session_id",
    "visitIp": "visit_ip",
    "visitorId": "visitor_id",
    "goalConversions": "goal_conversions",
    "serverDate": "session_date",
    "visitServerHour": "visit_server_hour",
    "lastActionTimestamp": "last_action_timestamp",
    "lastActionDateTime": "last_action_date_time",
    "serverTimestamp": "server_timestamp",
    "firstActionTimestamp": "first_action_timestamp",
    "userId": "user_id",
    "visitorType": "visitor_type",
    "visitConverted": "visit_converted",
    "visitCount": "visit_count",
    "daysSinceFirstVisit": "days_since_first_visit",
    "secondsSinceFirstVisit": "seconds_since_first_visit",
    "visitDuration": "visit_duration_seconds",
    "searches": "searches",
    "events": "events",
    "continent": "continent",
    "continentCode": "continent_code",
    "country": "country",
    "countryCode": "country_code",
    "region": "region",
    "regionCode": "region_code",
    "city": "city",
    "location": "location",
    "visitLocalHour": "visit_local_hour",
    "daysSinceLastVisit": "days_since_last_visit",
    "secondsSinceLastVisit": "seconds_since_last_visit",
    "resolution": "resolution",
    "actions": "num_actions",
}
ACTION_COLUMNS = {
    "type": "type",
    "url": "url",
    "pageTitle": "page_title",
    "pageIdAction": "visit_id",
    "idpageview": "id_page_view",
    "serverTimePretty": "server_time_pretty",
    "pageId": "page_id",
    "bandwidth": "bandwidth",
    "timeSpent": "time_spent",
    "timeSpentPretty": "time_spent_pretty",
    "pageviewPosition": "page_view_position",
    "title": "title",
    "subtitle": "subtitle",
    "timestamp": "visit_timestamp",
    "bandwidth_pretty": "bandwidth_pretty",
}


def visits(bronze: Bronze, processes: DataFrame, parity: bool = True) -> DataFrame:
    """One row per visit and action (one per visit without actions), with process and proposal ids."""
    actions = unnest_json_array(
        source(bronze, "matomo_detailed_visits"), "actionDetails", ACTION_FIELDS, alias="action"
    )
    url = F.col("action.url")
    rows = actions.select(
        url_part(url, "processes", parity).alias("participatory_process_slug"),
        url_part(url, "proposals", parity).alias("proposal_id"),
        *[F.col(name).alias(out) for name, out in VISIT_COLUMNS.items()],
        *[F.col(f"action.{name}").alias(out) for name, out in ACTION_COLUMNS.items()],
    )
    slugs = processes.select(F.col("process_slug").alias("participatory_process_slug"), "process_id")
    joined = spread_join(rows, slugs, ["participatory_process_slug"])
    return joined.select("process_id", *rows.columns)

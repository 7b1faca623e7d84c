"""Bronze tables: names, column types and layer naming.

The table and column names are fixed values: they are those of the source database, whose rows the
models read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


# Columns that the models use, by source table.
BRONZE_DDL = {
    "decidim_users": (
        "id bigint, nickname string, email string, created_at timestamp_ntz, updated_at timestamp_ntz, "
        "last_sign_in_at timestamp_ntz, roles string"
    ),
    "decidim_participatory_processes": (
        "id bigint, decidim_organization_id bigint, slug string, title string, subtitle string, description string, "
        "short_description string, decidim_participatory_process_type_id bigint, decidim_area_id bigint, "
        "created_at timestamp_ntz, updated_at timestamp_ntz, published_at timestamp_ntz, start_date date, "
        "end_date date, reference string, follows_count int"
    ),
    "decidim_participatory_process_types": (
        "id bigint, decidim_organization_id bigint, title string, updated_at timestamp_ntz"
    ),
    "decidim_areas": (
        "id bigint, decidim_organization_id bigint, area_type_id bigint, name string, updated_at timestamp_ntz"
    ),
    "decidim_area_types": "id bigint, decidim_organization_id bigint, name string",
    "decidim_proposals_proposals": (
        "id bigint, decidim_component_id bigint, decidim_scope_id bigint, state string, title string, body string, "
        "created_at timestamp_ntz, updated_at timestamp_ntz"
    ),
    "decidim_scopes": "id bigint, decidim_organization_id bigint, name string, updated_at timestamp_ntz",
    "decidim_scope_types": "id bigint, decidim_organization_id bigint, name string",
    "decidim_components": (
        "id bigint, participatory_space_id bigint, participatory_space_type string, updated_at timestamp_ntz"
    ),
    "decidim_coauthorships": (
        "coauthorable_id bigint, coauthorable_type string, decidim_author_id bigint, decidim_author_type string, "
        "updated_at timestamp_ntz"
    ),
    "decidim_categorizations": (
        "categorizable_id bigint, categorizable_type string, decidim_category_id bigint, updated_at timestamp_ntz"
    ),
    "decidim_categories": "id bigint, name string",
    "decidim_comments_comments": (
        "id bigint, decidim_author_id bigint, decidim_commentable_type string, decidim_commentable_id bigint, "
        "decidim_root_commentable_type string, decidim_root_commentable_id bigint, "
        "decidim_participatory_space_type string, body string, created_at timestamp_ntz, updated_at timestamp_ntz, "
        "deleted_at timestamp_ntz"
    ),
    "decidim_proposals_proposal_votes": (
        "id bigint, decidim_proposal_id bigint, decidim_author_id bigint, created_at timestamp_ntz, "
        "updated_at timestamp_ntz"
    ),
    "decidim_comments_comment_votes": (
        "id bigint, decidim_comment_id bigint, decidim_author_id bigint, created_at timestamp_ntz, "
        "updated_at timestamp_ntz"
    ),
    "matomo_detailed_visits": (
        "idVisit bigint, visitIp string, visitorId string, goalConversions int, serverDate string, "
        "visitServerHour string, lastActionTimestamp bigint, lastActionDateTime string, serverTimestamp bigint, "
        "firstActionTimestamp bigint, userId string, visitorType string, visitConverted string, visitCount string, "
        "daysSinceFirstVisit string, secondsSinceFirstVisit string, visitDuration string, searches string, "
        "events string, continent string, continentCode string, country string, countryCode string, region string, "
        "regionCode string, city string, location string, visitLocalHour string, daysSinceLastVisit string, "
        "secondsSinceLastVisit string, resolution string, actions int, actionDetails string"
    ),
}

# The fields of one action inside ``actionDetails`` and their types.
ACTION_FIELDS = {
    "type": "string",
    "url": "string",
    "pageTitle": "string",
    "pageIdAction": "int",
    "idpageview": "string",
    "serverTimePretty": "string",
    "pageId": "bigint",
    "bandwidth": "string",
    "timeSpent": "int",
    "timeSpentPretty": "string",
    "pageviewPosition": "int",
    "title": "string",
    "subtitle": "string",
    "timestamp": "bigint",
    "bandwidth_pretty": "string",
}

# Targets that use a layer's plain name.
PRODUCTION_TARGETS = ("prod", "main", "master", "production", "auto")


def bronze_schema(table: str) -> T.StructType:
    return _schema(BRONZE_DDL[table])


def add_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns that an extraction left out, as typed NULLs; columns at hand stay as they are."""
    have = {c.lower() for c in df.columns}
    return df.withColumns({
        f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name.lower() not in have
    })


def layer_database(target: str, layer: str | None) -> str:
    """Database of a layer: its own name in production, else prefixed with the target."""
    if layer is None:
        return target
    return layer.strip() if target in PRODUCTION_TARGETS else f"{target}_{layer.strip()}"

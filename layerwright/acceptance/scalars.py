"""Text, JSON and nested operators on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerwright.acceptance.tables import Registry, table
from layerwright.functions.dates import day_or_default, fixed_days, latest, lenient_timestamp
from layerwright.functions.text import (
    blank_to_dash, blank_where, component_link, drop_hashtags, first_filled, first_matching_key, html_to_text,
    identifier, invalid_json, is_digits, last_segment, last_segment_lower_first, last_word_of_camel, link_to,
    localized, plural, smallest_match, snake_case, title_from_identifier,
)
from layerwright.operators.nested import (
    flatten_structs, json_rejects, nested_to_json, unnest_json_array, value_of_key,
)
from layerwright.sources.readers import components_of_type, next_cursor, pages_of_arrays, pages_of_nodes

registry = Registry()


@registry.add("q_json_text", """
    SELECT event_id, props ->> '$.k' AS k, CAST(props ->> '$.k' AS INT) AS k_number,
           CAST(NULL AS VARCHAR) AS absent, FALSE AS invalid
    FROM events""")
def q_json_text(spark, sf):
    props = F.col("props")
    return table(spark, sf, "events").select(
        "event_id", localized(props, "k").alias("k"), localized(props, "k").try_cast("int").alias("k_number"),
        localized(props).alias("absent"), invalid_json(props).alias("invalid"),
    )


@registry.add("q_last_segment", """
    SELECT p_partkey, lower(p_type) AS kind, lower(p_type[1]) || p_type[2:] AS kind_lower_first FROM part""")
def q_last_segment(spark, sf):
    typed = F.concat(F.lit("Shop::"), F.col("p_brand"), F.lit("::"), F.col("p_type"))
    return table(spark, sf, "part").select(
        "p_partkey", last_segment(typed).alias("kind"), last_segment_lower_first(typed).alias("kind_lower_first")
    )


@registry.add("q_snake_last", """
    SELECT p_partkey,
           'shop_' || lower(split_part(p_name, ' ', 1)) || '_' || lower(split_part(p_name, ' ', 2)) AS snake,
           lower(split_part(p_name, ' ', 2)) AS last_word,
           CASE WHEN regexp_matches(lower(split_part(p_name, ' ', 2)), '(s|x|z|ch|sh)$')
                     THEN lower(split_part(p_name, ' ', 2)) || 'es'
                WHEN regexp_matches(lower(split_part(p_name, ' ', 2)), '[^aeiou]y$')
                     THEN regexp_replace(lower(split_part(p_name, ' ', 2)), 'y$', 'ies')
                ELSE lower(split_part(p_name, ' ', 2)) || 's' END AS last_plural
    FROM part""")
def q_snake_last(spark, sf):
    camel = F.concat(F.lit("Shop"), F.translate(F.initcap("p_name"), " ", ""))
    return table(spark, sf, "part").select(
        "p_partkey", snake_case(camel).alias("snake"), last_word_of_camel(camel).alias("last_word"),
        plural(last_word_of_camel(camel)).alias("last_plural"),
    )


@registry.add("q_title_case", """
    SELECT p_partkey, upper(p_name[1]) || lower(split_part(p_name, ' ', 1))[2:] || ' '
           || upper(split_part(p_name, ' ', 2)[1]) || lower(split_part(p_name, ' ', 2))[2:]
           || ' ' || p_size || 'Cm' AS title
    FROM part""")
def q_title_case(spark, sf):
    code = F.concat(F.upper(F.translate("p_name", " ", "_")), F.lit("_"), F.col("p_size").cast("string"), F.lit("CM_"))
    return table(spark, sf, "part").select("p_partkey", title_from_identifier(code).alias("title"))


def _case(number, cases):
    """The input of one of the cases for each row, in turn."""
    return F.element_at(F.array(*[F.lit(given) for given, _ in cases]), (number % len(cases) + 1).cast("int"))


#: Names and their identifiers, worked out by hand.
ID_CASES = [
    ("Конференция", "KONFERENTsIIa"), ("½ price 5€", "1_2_PRICE_5EUR"), ("北京 plan", "U5317U4EAC_PLAN"),
    ("São João nº 3", "SAO_JOAO_No_3"), ("a/b - c!", "A_B___C"),
]


@registry.add("q_normalise_id", r"""
    SELECT doc_id, trim(regexp_replace(replace(replace(replace(strip_accents(upper(replace(replace(source || '_' || text, 'ß', 'SS'), ' ', '_'))),
           'Æ', 'AE'), 'Œ', 'OE'), 'Ø', 'O'), '[^A-Za-z0-9_]', '_', 'g'), '_') AS process_id,
           CASE doc_id % 5 """ + " ".join(f"WHEN {i} THEN '{answer}'" for i, (_, answer) in enumerate(ID_CASES)) + """ END AS case_id
    FROM documents""")
def q_normalise_id(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", identifier(F.col("source"), F.col("text")).alias("process_id"),
        identifier(_case(F.col("doc_id"), ID_CASES)).alias("case_id"))


#: Fragments and the text that a parser of HTML finds in them, worked out by hand.
HTML_CASES = [
    ('<a title="x>y">z</a>', "z"), ("a<script>if (1 < 2) b", "a"), ("&#00000000065;x", "Ax"), ("a<!-- never closed b", "a"),
    ("1 &lt; 2 &amp;amp; 3", "1 < 2 &amp; 3"), ("&#x1F600;&#xD800;&#99999999999;", "\U0001F600\ufffd\ufffd"),
    ("<p class='a>b' id=c>d</p>", "d"), ("x < y &Aacute;", "x < y Á"), ("<style>p{}</style><STYLE a='>'>q", ""),
]


@registry.add("q_html_to_text", r"""
    WITH bare AS (
        SELECT page_id, regexp_replace(regexp_replace(regexp_replace(
            regexp_replace(html, '(&[A-Za-z][A-Za-z0-9]*)<', '\1;<', 'g'),
            '(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'g'),
            '(?s)<!--.*?-->', '', 'g'), '(?s)</?[A-Za-z][^>]*>|<![A-Za-z][^>]*>', '', 'g') AS t
        FROM pages)
    SELECT page_id, regexp_replace(replace(replace(replace(t, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'),
           '&amp;|&amp$', '&', 'g') AS content,
           CASE page_id % 9 """ + " ".join(f"WHEN {i} THEN '{answer}'" for i, (_, answer) in enumerate(HTML_CASES)) + r""" END AS case_text
    FROM (SELECT page_id, regexp_replace(t, '&(am);', '&\1', 'g') AS t FROM bare)""")
def q_html_to_text(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", html_to_text(F.col("html")).alias("content"),
        html_to_text(_case(F.col("page_id"), HTML_CASES)).alias("case_text"))


@registry.add("q_hashtag_clean", r"""
    SELECT doc_id, CASE WHEN length(CAST(doc_id AS VARCHAR)) = 1 THEN text || ' tagged '
           ELSE text || ' tagged gid://decide/Decidim::Hashtag/' || doc_id || '/tag_' || lang END AS body
    FROM documents""")
def q_hashtag_clean(spark, sf):
    tag = F.concat(F.lit(" tagged gid://decide/Decidim::Hashtag/"), F.col("doc_id").cast("string"), F.lit("/tag_"),
                   F.col("lang"), F.lit("\n"))
    return table(spark, sf, "documents").select("doc_id", drop_hashtags(F.concat("text", tag)).alias("body"))


@registry.add("q_numeric_id_filter", r"""
    SELECT page_id, TRY_CAST(part AS INT) AS number
    FROM (SELECT page_id, regexp_extract(url, '^https?://[^/]+/[^/]+/([^/?#]+)', 1) AS part FROM pages)
    WHERE part IS NOT NULL AND regexp_full_match(part, '[0-9]+')""")
def q_numeric_id_filter(spark, sf):
    part = F.regexp_extract("url", "^https?://[^/]+/[^/]+/([^/?#]+)", 1)
    rows = table(spark, sf, "pages").select("page_id", part.alias("part"))
    kept = rows.where(F.col("part").isNotNull() & is_digits(F.col("part")))
    return kept.select("page_id", F.col("part").try_cast("int").alias("number"))


@registry.add("q_blank_default", """
    SELECT d.doc_id, CASE WHEN l.quality IS NULL THEN '-' ELSE 'label ' || l.quality END AS label,
           coalesce('label ' || l.quality, lang) AS category,
           CASE WHEN lang IN ('de', 'es') THEN '' ELSE lang END AS shown
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def q_blank_default(spark, sf):
    label = F.when(F.col("quality").isNull(), F.lit("")).otherwise(F.concat(F.lit("label "), F.col("quality").cast("string")))
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select(
        "doc_id", blank_to_dash(label).alias("label"), first_filled(label, F.col("lang")).alias("category"),
        blank_where(F.col("lang"), ["de", "es"]).alias("shown"),
    )


@registry.add("q_min_match", r"""
    SELECT c_nationkey, min(c_name) FILTER (regexp_matches(c_name, '#0*[0-9]*7[0-9]*$')) AS first_name
    FROM customer GROUP BY 1""")
def q_min_match(spark, sf):
    name = smallest_match(F.col("c_name"), "#0*[0-9]*7[0-9]*$")
    return table(spark, sf, "customer").groupBy("c_nationkey").agg(name.alias("first_name"))


@registry.add("q_first_matching_key", """
    SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'startDate' ELSE 'creationDate' END AS date_key
    FROM events""")
def q_first_matching_key(spark, sf):
    keys = F.when(F.col("event_type").isin("view", "click"), F.array(F.lit("id"), F.lit("startDate"))).otherwise(
        F.array(F.lit("endDate"), F.lit("creationDate"), F.lit("startDate"))
    )
    return table(spark, sf, "events").select(
        "event_id", first_matching_key(keys, "(start|creation).*Date").alias("date_key")
    )


@registry.add("q_link_column", """
    SELECT s_suppkey, 'https://site.example/' || 'processes' || '/nation_' || s_nationkey || '/f/' || s_suppkey
           || '/proposals' AS base,
           'https://site.example/processes/nation_' || s_nationkey || '/f/' || s_suppkey || '/proposals/' || s_suppkey
           AS link
    FROM supplier""")
def q_link_column(spark, sf):
    slug = F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string"))
    base = component_link("https://site.example/api", F.lit("Decidim::ParticipatoryProcess"), slug,
                          F.col("s_suppkey"), F.lit("Proposals"))
    return table(spark, sf, "supplier").select(
        "s_suppkey", base.alias("base"), link_to(base, F.col("s_suppkey")).alias("link")
    )


@registry.add("q_lenient_dates", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(o_orderdate AS TIMESTAMP) END AS parsed,
           CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) ELSE DATE '2024-01-31' END AS day,
           CAST(o_orderdate AS TIMESTAMP) AS newest,
           CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y-%m-%d') END AS day_text
    FROM orders""")
def q_lenient_dates(spark, sf):
    text = F.when(F.col("o_orderstatus") == "F", F.lit("no date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    day = F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.lit(""))
    parsed = lenient_timestamp(text)
    first, _ = fixed_days(text, text)
    return table(spark, sf, "orders").select(
        "o_orderkey", parsed.cast("timestamp_ntz").alias("parsed"), day_or_default(day, "2024-01-31").alias("day"),
        latest(parsed.cast("timestamp_ntz"), F.col("o_orderdate")).alias("newest"), first.alias("day_text"),
    )


# Nested data.

_ACTION = {"event_id": "bigint", "kind": "string", "amount": "int", "absent": "string"}


@registry.add("q_lateral_outer_unnest", """
    SELECT event_id AS visit_id, CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE event_id END AS event_id,
           CASE WHEN event_type IN ('signup', 'error') THEN NULL ELSE event_type END AS kind,
           CASE WHEN event_type IN ('signup', 'error') OR k = 2 THEN NULL ELSE CAST(floor(value) AS INT) END AS amount,
           CAST(NULL AS VARCHAR) AS absent
    FROM events, (SELECT unnest([1, 2]) AS k)
    WHERE k = 1 OR (event_type NOT IN ('signup', 'error') AND event_id % 11 <> 3)""")
def q_lateral_outer_unnest(spark, sf):
    """Some arrays are cut off inside their second element, which costs them no more than that."""
    rows = unnest_json_array(_visits_with_actions(spark, sf), "actions", _ACTION, "action")
    return rows.select("visit_id", "action.event_id", "action.kind", "action.amount", "action.absent")


@registry.add("q_unnest_rejects", """
    SELECT event_id AS visit_id, 2 AS place, '{"event_id":' || event_id || ',"kind":"' || event_type || '","am' AS element
    FROM events WHERE event_type NOT IN ('signup', 'error') AND event_id % 11 = 3""")
def q_unnest_rejects(spark, sf):
    return json_rejects(_visits_with_actions(spark, sf), "actions")


def _visits_with_actions(spark, sf):
    whole = (
        "case event_type when 'signup' then null when 'error' then '[]' else to_json(array("
        "named_struct('event_id', event_id, 'kind', event_type, 'amount', cast(cast(floor(value) as int) as string)),"
        "named_struct('event_id', event_id, 'kind', event_type, 'amount', 'unknown'))) end"
    )
    cut = "substr(actions, 1, length(actions) - length('ount\":\"unknown\"}]'))"
    visits = table(spark, sf, "events").selectExpr("event_id as visit_id", f"{whole} as actions")
    return visits.selectExpr("visit_id", f"case when visit_id % 11 = 3 and length(actions) > 2 then {cut} else actions end as actions")


@registry.add("q_complex_to_json", """
    SELECT vec_id, label, '{"vec_id":' || vec_id || ',"tags":[' || label || ',null],"note":"ação"}' AS meta,
           CAST(len(embedding) AS INT) AS dimensions, CAST(round(embedding[1], 4) AS DOUBLE) AS first_value
    FROM embeddings""")
def q_complex_to_json(spark, sf):
    rows = table(spark, sf, "embeddings").select(
        "vec_id", "label",
        F.struct("vec_id", F.array("label", F.lit(None).cast("int")).alias("tags"), F.lit("ação").alias("note")).alias("meta"),
        "embedding",
    )
    values = F.from_json("embedding", "array<float>")
    return nested_to_json(rows).select(
        "vec_id", "label", "meta", F.size(values).alias("dimensions"),
        F.round(values[0], 4).cast("double").alias("first_value"),
    )


@registry.add("q_flatten_struct", """
    SELECT event_id AS "event.id", event_type AS "event.kind.name", user_id AS "user.id", value FROM events""")
def q_flatten_struct(spark, sf):
    rows = table(spark, sf, "events").select(
        F.struct(F.col("event_id").alias("id"), F.struct(F.col("event_type").alias("name")).alias("kind")).alias("event"),
        F.struct(F.col("user_id").alias("id")).alias("user"), "value",
    )
    return flatten_structs(rows)


@registry.add("q_key_lookup", """
    SELECT event_id, TRUE AS "hasNextPage", CAST(event_id AS VARCHAR) AS "endCursor", CAST(NULL AS VARCHAR) AS nothing
    FROM events""")
def q_key_lookup(spark, sf):
    info = F.struct(F.lit(True).alias("hasNextPage"), F.col("event_id").cast("string").alias("endCursor"))
    rows = table(spark, sf, "events").select(
        "event_id",
        F.struct(F.array(info).alias("ignored"), F.struct(info.alias("pageInfo")).alias("proposals")).alias("data"),
    )
    page_info = value_of_key(rows, "pageInfo")
    return rows.select(
        "event_id", page_info["hasNextPage"].alias("hasNextPage"), page_info["endCursor"].alias("endCursor"),
        value_of_key(rows, "absent").alias("nothing"),
    )


def _page():
    """Page of an event; a page holds at most 100 rows, the page size of the feed."""
    return F.floor(F.col("event_id") / 100).alias("page")


@registry.add("q_paged_json_union", "SELECT event_id, event_type, user_id, value FROM events")
def q_paged_json_union(spark, sf):
    pages = table(spark, sf, "events").groupBy(_page()).agg(
        F.to_json(F.collect_list(F.struct("event_id", "event_type", "user_id", "value"))).alias("body")
    )
    return pages_of_arrays(pages, "body", "event_id bigint, event_type string, user_id bigint, value double")


@registry.add("q_paged_nodes", "SELECT event_id AS id, event_type AS state, ts AS \"updatedAt\" FROM events")
def q_paged_nodes(spark, sf):
    node = F.struct(F.col("event_id").alias("id"), F.col("event_type").alias("state"), F.col("ts").alias("updatedAt"))
    pages = table(spark, sf, "events").groupBy(_page()).agg(F.collect_list(node).alias("nodes"))
    body = F.to_json(F.struct(F.struct(F.struct(F.struct("nodes").alias("proposals")).alias("component")).alias("data")),
                     {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return pages_of_nodes(pages.select(body.alias("body")), "body", "data.component.proposals",
                          "id bigint, state string, updatedAt timestamp_ntz")


@registry.add("q_page_cursors", """
    SELECT event_id, CASE WHEN value >= 10 THEN 'c' || event_id END AS next FROM events""")
def q_page_cursors(spark, sf):
    info = F.struct((F.col("value") >= 10).alias("hasNextPage"),
                    F.concat(F.lit("c"), F.col("event_id").cast("string")).alias("endCursor"))
    body = F.to_json(F.struct(F.struct(F.struct(info.alias("pageInfo")).alias("proposals")).alias("data")))
    return table(spark, sf, "events").select("event_id", next_cursor(body, "data.proposals").alias("next"))


@registry.add("q_components_by_type", """
    SELECT c_custkey AS id, CASE WHEN c_acctbal < 0 THEN 'Proposals' ELSE 'Meetings' END AS __typename FROM customer
    WHERE c_acctbal < 0
    UNION ALL SELECT c_custkey + 1000000, 'Surveys' FROM customer
    UNION ALL SELECT s_suppkey, 'Proposals' FROM supplier""")
def q_components_by_type(spark, sf):
    def component(key, kind):
        return F.struct(F.col(key).cast("long").alias("id"), kind.alias("__typename"))

    customers = table(spark, sf, "customer").select(F.array(
        component("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit("Proposals")).otherwise(F.lit("Meetings"))),
        F.struct((F.col("c_custkey") + 1000000).alias("id"), F.lit("Surveys").alias("__typename")),
    ).alias("components"))
    suppliers = table(spark, sf, "supplier").select(F.array(component("s_suppkey", F.lit("Proposals"))).alias("components"))
    return components_of_type([customers, suppliers], ["Proposals", "Surveys"])

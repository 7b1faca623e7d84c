"""The given tables in the shape of bronze tables, so that the models run on them as they are.

Each derivation reads its whole table: orders become proposals (with older versions), customers
users and components, line items authors, categories and votes, conversations comment threads,
events site visits, and regions, nations and suppliers the process dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.acceptance.tables import NAMES, table

AS_OF = "1995-01-31"


def _text(value: str) -> str:
    return f"to_json(named_struct('pt-BR', {value}))"


def _squeezed(column: str) -> str:
    """A timestamp of the years of the orders moved into the first months of 1995."""
    return (
        f"cast(date_add(DATE'1995-01-01', cast(floor(datediff({column}, DATE'1995-01-01') / 32) as int)) "
        "as timestamp_ntz)"
    )


class LazyTables(Mapping):
    """Tables that are built when they are first asked for."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]) -> None:
        self._makers = makers
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


def bronze(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    given = LazyTables({name: (lambda n=name: table(spark, sf_dir, n)) for name in NAMES})
    t = given.__getitem__
    fixed = "TIMESTAMP_NTZ'2020-01-01 00:00:00' as updated_at"
    shifted = "date_add(DATE'1995-01-01', datediff(ts, DATE'2024-01-01'))"

    def users() -> DataFrame:
        return t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).selectExpr(
            "o_custkey as id", "c_name as nickname", "lower(concat(c_name, '@example.org')) as email",
            "TIMESTAMP_NTZ'1995-01-01 00:00:00' as created_at",
            "case when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then null else o_orderdate end as updated_at",
            "o_orderdate as last_sign_in_at", "concat('[\"', o_orderpriority, '\"]') as roles",
        )

    def processes() -> DataFrame:
        return t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
            "cast(n_nationkey as bigint) as id", "cast(n_regionkey as bigint) as decidim_organization_id",
            "lower(n_name) as slug", _text("concat('Processo ', n_name)") + " as title",
            "to_json(named_struct('en', n_name)) as subtitle",
            f"case when s_acctbal < 0 then null else {_text('s_name')} end as description",
            "'{\"pt-BR\":null}' as short_description",
            "cast(n_regionkey as bigint) as decidim_participatory_process_type_id",
            "cast(n_nationkey as bigint) as decidim_area_id", "TIMESTAMP_NTZ'2020-01-01 00:00:00' as created_at",
            "cast(date_add(DATE'2020-01-01', cast(s_suppkey as int)) as timestamp_ntz) as updated_at",
            "cast(null as timestamp_ntz) as published_at", "DATE'2020-02-01' as start_date",
            "cast(null as date) as end_date", "s_name as reference", "cast(floor(s_acctbal) as int) as follows_count",
        )

    def proposals() -> DataFrame:
        proposal = [
            "o_orderkey as id", "o_custkey as decidim_component_id",
            "cast(month(o_orderdate) as bigint) as decidim_scope_id",
        ]
        texts = [
            _text("concat('Proposta ', cast(o_orderkey as string))") + " as title",
            _text("o_orderpriority") + " as body", _squeezed("o_orderdate") + " as created_at",
        ]
        return t("orders").selectExpr(*proposal, "o_orderstatus as state", *texts, "o_orderdate as updated_at").unionByName(
            t("orders").where("o_orderstatus = 'F'").selectExpr(
                *proposal, "'draft' as state", *texts, "o_orderdate - INTERVAL 1 DAY as updated_at"
            )
        )

    def comments() -> DataFrame:
        comment = [
            "conv_id * 1000 + turn as id", "conv_id as decidim_author_id",
            "case when turn = 0 then 'Decidim::Proposals::Proposal' else 'Decidim::Comments::Comment' end "
            "as decidim_commentable_type",
            "case when turn = 0 then conv_id else conv_id * 1000 + turn - 1 end as decidim_commentable_id",
            "'Decidim::Proposals::Proposal' as decidim_root_commentable_type", "conv_id as decidim_root_commentable_id",
            "case when role = 'system' then 'Decidim::Assembly' else 'Decidim::ParticipatoryProcess' end "
            "as decidim_participatory_space_type",
        ]
        created = "cast(date_add(DATE'1995-01-01', cast(turn * 3 as int)) as timestamp_ntz)"
        return t("conversations").selectExpr(
            *comment, _text("text") + " as body", f"{created} as created_at",
            f"{created} + INTERVAL 1 HOUR as updated_at", "cast(null as timestamp_ntz) as deleted_at",
        ).unionByName(t("conversations").where("role = 'user'").selectExpr(
            *comment, _text("'draft'") + " as body", f"{created} as created_at", f"{created} as updated_at",
            "cast(null as timestamp_ntz) as deleted_at",
        ))

    def visits() -> DataFrame:
        address = "concat('https://example.org/processes/nation_', cast(user_id % 25 as string), '/f/1/proposals/'"
        # A visit's text costs far more to write and to read than its few bytes say, by which a file is cut into tasks: so rows are spread first.
        return t("events").repartition("event_id").selectExpr(
            "event_id as idVisit", f"date_format({shifted}, 'yyyy-MM-dd') as serverDate",
            "cast(user_id as string) as userId", "event_type as visitorType",
            "case when value < 10 then 1 else 2 end as actions",
            "case event_type when 'signup' then null when 'error' then '[]' else to_json(array("
            "named_struct('type', 'action', 'url', "
            f"{address}, case event_type when 'click' then '0' else '' end, cast(user_id as string), "
            "case event_type when 'purchase' then '?ref=1' else '' end), 'timeSpent', '12', 'pageId', event_id),"
            "named_struct('type', 'search', 'url', cast(null as string), 'timeSpent', 'x', 'pageId', event_id)"
            ")) end as actionDetails",
        )

    return LazyTables({
        "decidim_users": users,
        "decidim_participatory_processes": processes,
        "decidim_participatory_process_types": lambda: t("region").selectExpr(
            "cast(r_regionkey as bigint) as id", "cast(r_regionkey as bigint) as decidim_organization_id",
            _text("r_name") + " as title", fixed),
        "decidim_areas": lambda: t("nation").selectExpr(
            "cast(n_nationkey as bigint) as id", "cast(n_regionkey as bigint) as decidim_organization_id",
            "cast(n_regionkey as bigint) as area_type_id", _text("n_name") + " as name", fixed),
        "decidim_area_types": lambda: t("region").selectExpr(
            "cast(r_regionkey as bigint) as id", "cast(r_regionkey as bigint) as decidim_organization_id",
            _text("lower(r_name)") + " as name"),
        "decidim_proposals_proposals": proposals,
        "decidim_scopes": lambda: t("region").selectExpr(
            "cast(r_regionkey as bigint) as id",
            "cast(case when r_regionkey < 4 then 1 else 2 end as bigint) as decidim_organization_id",
            _text("r_name") + " as name", fixed),
        "decidim_components": lambda: t("customer").selectExpr(
            "c_custkey as id", "cast(c_nationkey as bigint) as participatory_space_id",
            "case when c_mktsegment = 'BUILDING' then 'Decidim::Assembly' "
            "else 'Decidim::ParticipatoryProcess' end as participatory_space_type", fixed),
        "decidim_coauthorships": lambda: t("lineitem").selectExpr(
            "l_orderkey as coauthorable_id", "case when l_returnflag = 'R' then 'Decidim::Proposals::Proposal' "
            "else 'Decidim::Meetings::Meeting' end as coauthorable_type", "l_suppkey as decidim_author_id",
            "'Decidim::UserBaseEntity' as decidim_author_type", "l_shipdate as updated_at"),
        "decidim_categorizations": lambda: t("lineitem").selectExpr(
            "l_orderkey as categorizable_id", "case when l_returnflag = 'A' then 'Decidim::Proposals::Proposal' "
            "else 'Decidim::Meetings::Meeting' end as categorizable_type",
            "cast(l_linenumber as bigint) as decidim_category_id", "l_shipdate as updated_at"),
        "decidim_categories": lambda: t("part").selectExpr("p_partkey as id", _text("p_name") + " as name"),
        "decidim_comments_comments": comments,
        "decidim_proposals_proposal_votes": lambda: t("lineitem").selectExpr(
            "l_orderkey * 10 + l_linenumber as id", "l_orderkey as decidim_proposal_id",
            "l_suppkey as decidim_author_id", _squeezed("l_shipdate") + " as created_at", "l_shipdate as updated_at"),
        "decidim_comments_comment_votes": lambda: t("events").where("event_type = 'click'").selectExpr(
            "event_id as id", "user_id * 1000 as decidim_comment_id", "user_id as decidim_author_id",
            f"cast({shifted} as timestamp_ntz) as created_at", "ts as updated_at"),
        "matomo_detailed_visits": visits,
    })


# The models in SQL, written against the given tables. Later entries use earlier ones. Texts are joined with
# a key and cut again where DuckDB would keep them as dictionaries, on which it fails at times.
_SQUEEZE = "CAST(DATE '1995-01-01' + CAST(floor(date_diff('day', DATE '1995-01-01', CAST({c} AS DATE)) / 32) AS INT) AS TIMESTAMP)"

MODEL_SQL = {
    "users": """
        SELECT o_custkey AS user_id, c_name AS username, lower(c_name || '@example.org') AS user_email,
               TIMESTAMP '1995-01-01' AS created_at, updated_at, o_orderdate AS last_activity_at,
               '["' || o_orderpriority || '"]' AS user_roles
        FROM (SELECT *, CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN NULL
                        ELSE o_orderdate END AS updated_at
              FROM orders JOIN customer ON o_custkey = c_custkey)
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY updated_at DESC NULLS FIRST,
                o_orderdate DESC NULLS FIRST, o_orderpriority DESC NULLS FIRST) = 1""",
    "participatory_processes": """
        SELECT CAST(n_nationkey AS BIGINT) AS process_id, r_name AS process_type, lower(n_name) AS process_slug,
               'Processo ' || n_name AS process_title, CAST(NULL AS VARCHAR) AS process_subtitle,
               CASE WHEN s_acctbal < 0 THEN NULL ELSE s_name END AS description,
               CAST(NULL AS VARCHAR) AS short_description, n_name AS responsible_area,
               lower(r_name) AS responsible_type, TIMESTAMP '2020-01-01' AS created_at,
               CAST(DATE '2020-01-01' + CAST(s_suppkey AS INT) AS TIMESTAMP) AS updated_at,
               CAST(NULL AS TIMESTAMP) AS published_at, DATE '2020-02-01' AS start_date,
               CAST(NULL AS DATE) AS end_date, s_name AS reference, CAST(floor(s_acctbal) AS INT) AS follows_count
        FROM supplier JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
        WHERE n_regionkey = 1
        QUALIFY row_number() OVER (PARTITION BY n_nationkey, n_regionkey ORDER BY s_suppkey DESC) = 1""",
    "proposals": f"""
        SELECT o_orderkey AS proposal_id, CAST(c_nationkey AS BIGINT) AS process_id,
               CASE WHEN c_custkey IS NULL THEN NULL WHEN c_mktsegment = 'BUILDING' THEN 'Decidim::Assembly'
                    ELSE 'Decidim::ParticipatoryProcess' END AS participatory_space_type,
               user_id, author_type, left(concat(o_orderstatus, o_orderkey), 1) AS proposal_status,
               {_SQUEEZE.format(c='o_orderdate')} AS created_at,
               'Proposta ' || o_orderkey AS proposal_title, o_orderpriority AS proposal_text,
               left(concat(r_name, o_orderkey), length(r_name)) AS proposal_scope,
               left(concat(p_name, o_orderkey), length(p_name)) AS proposal_category
        FROM orders
        LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN region ON month(o_orderdate) = r_regionkey AND r_regionkey < 4
        LEFT JOIN (SELECT DISTINCT l_orderkey AS ak, l_suppkey AS user_id, 'Decidim::UserBaseEntity' AS author_type
                   FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = ak
        LEFT JOIN (SELECT DISTINCT l_orderkey AS ck, l_linenumber FROM lineitem WHERE l_returnflag = 'A')
               ON o_orderkey = ck
        LEFT JOIN part ON l_linenumber = p_partkey""",
    "comments": """
        SELECT conv_id * 1000 + turn AS comment_id, conv_id AS user_id,
               CASE WHEN turn = 0 THEN 'proposal' ELSE 'comment' END AS component_type,
               CASE WHEN turn = 0 THEN conv_id ELSE conv_id * 1000 + turn - 1 END AS commented_component_id,
               'proposal' AS root_component_type, conv_id AS commented_root_component_id, text AS comment_text,
               CAST(DATE '1995-01-01' + CAST(turn * 3 AS INT) AS TIMESTAMP) AS created_at,
               CAST(DATE '1995-01-01' + CAST(turn * 3 AS INT) AS TIMESTAMP) + INTERVAL 1 HOUR AS updated_at,
               CAST(NULL AS TIMESTAMP) AS deleted_at
        FROM conversations WHERE role IS DISTINCT FROM 'system'""",
    "votes": f"""
        SELECT 'proposal_' || id AS vote_id, id AS original_vote_id, 'proposal' AS component_type,
               l_orderkey AS voted_component_id, l_suppkey AS user_id, created_at
        FROM (SELECT *, l_orderkey * 10 + l_linenumber AS id, {_SQUEEZE.format(c='l_shipdate')} AS created_at
              FROM lineitem)
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY l_shipdate DESC NULLS FIRST,
                l_orderkey DESC, l_suppkey DESC, created_at DESC) = 1
        UNION ALL
        SELECT 'comment_' || event_id, event_id, 'comment', user_id * 1000, user_id,
               CAST(DATE '1995-01-01' + date_diff('day', DATE '2024-01-01', CAST(ts AS DATE))::INT AS TIMESTAMP)
        FROM events WHERE event_type = 'click' AND user_id * 1000 IN (SELECT comment_id FROM comments)""",
    "actions": """
        SELECT e.*, k,
               CASE WHEN k = 1 THEN 'action' WHEN k = 2 THEN 'search' END AS a_type,
               CASE WHEN k = 1 THEN 'https://example.org/processes/nation_' || (user_id % 25) || '/f/1/proposals/'
                    || CASE event_type WHEN 'click' THEN '0' ELSE '' END || user_id
                    || CASE event_type WHEN 'purchase' THEN '?ref=1' ELSE '' END END AS a_url
        FROM events e LEFT JOIN (SELECT unnest([1, 2]) AS k) ON event_type NOT IN ('signup', 'error')""",
}


def with_models(body: str, *names: str) -> str:
    """A statement with the named models, and those they use, in front."""
    needs = {"votes": ("comments",), "visits": ("participatory_processes", "actions")}
    order: list[str] = []

    def visit(name: str) -> None:
        for other in needs.get(name, ()):
            visit(other)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS MATERIALIZED ({MODEL_SQL[n]})" for n in order]
    return f"WITH {', '.join(parts)} {body}"

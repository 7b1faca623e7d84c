"""Batch sources: database tables, files, landed pages of feeds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.operators.tables import drop_columns
from layerwright.schemas import BRONZE_DDL, bronze_schema
from layerwright.session import materialize
from layerwright.sources.specs import Extraction, ExtractionSpec


def jdbc_table(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
               lower=None, upper=None, partitions: int = 1, **options: str) -> DataFrame:
    """A database table, read in parallel ranges of ``partition_column`` from ``lower`` to ``upper`` (the ends take what lies beyond).

    Without a partition column one task reads it all, which is for small tables; asking for ``partitions`` without one is an error.
    """
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition_column is None and partitions > 1:
        raise ValueError("a parallel read needs a partition column")
    if partition_column is not None:
        if lower is None or upper is None or partitions < 2:
            raise ValueError("a partition column needs its bounds and the number of ranges")
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper),
            numPartitions=str(partitions),
        )
    return reader.load()


def counted_keys(rows: DataFrame, column: str) -> DataFrame:
    """``column, n_rows, stretch``: each key with its rows, and the number of the stretch of keys it is in, in order; written, as stretches
    are dealt by a sample. Rows without a key are left out."""
    counted = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return materialize(counted.repartitionByRange(column).withColumn("stretch", F.spark_partition_id()), "counted-keys")


def cuts_query(table: str, column: str, partitions: int, counted: bool = False) -> str:
    """Standard SQL for the ends of ranges of a key that hold about as many rows each, which equal steps of the key do not.

    A database has the key in order; on a table of Spark the window over all rows would be one task. There ``counted`` gives the same ends from
    a table of :func:`counted_keys`, with windows over a stretch of keys at most, or over one row per stretch.
    """
    if counted:
        return _counted_cuts_query(table, column, int(partitions))
    inner = f"SELECT {column} AS k, ntile({int(partitions)}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL"
    return f"SELECT DISTINCT max(k) AS cut FROM ({inner}) x GROUP BY part ORDER BY cut"


def _counted_cuts_query(table: str, column: str, parts: int) -> str:
    """Ranges of ``total`` rows differ by one row at most, and the longer ones come first; a key is an end if a range ends in its rows."""
    def ended(rows: str) -> str:
        """How many ranges have ended after so many rows."""
        return (f"CASE WHEN {rows} >= total THEN {parts} WHEN {rows} < longer * (size + 1) THEN FLOOR({rows} / (size + 1)) "
                f"ELSE longer + FLOOR(({rows} - longer * (size + 1)) / size) END")

    stretches = f"SELECT stretch, SUM(n_rows) AS n FROM {table} GROUP BY stretch"
    before = f"SELECT stretch, SUM(n) OVER (ORDER BY stretch) - n AS earlier, SUM(n) OVER () AS total FROM ({stretches}) s"
    sized = f"SELECT stretch, earlier, total, FLOOR(total / {parts}) AS size, MOD(total, {parts}) AS longer FROM ({before}) b"
    upto = (f"SELECT k.{column} AS k, k.n_rows AS n, z.total, z.size, z.longer, "
            f"z.earlier + SUM(k.n_rows) OVER (PARTITION BY k.stretch ORDER BY k.{column}) AS upto FROM {table} k JOIN ({sized}) z ON k.stretch = z.stretch")
    return f"SELECT k AS cut FROM ({upto}) u WHERE {ended('upto')} > {ended('(upto - n)')} ORDER BY cut"


def range_predicates(column: str, cuts: Sequence) -> list[str]:
    """Conditions that share all rows out by the ends of ranges; the first takes rows without a key, the last what lies beyond."""
    def literal(value) -> str:
        return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"

    ends = [literal(c) for c in list(dict.fromkeys(cuts))[:-1]]
    if not ends:
        return ["1 = 1"]
    between = [f"{column} > {low} AND {column} <= {high}" for low, high in zip(ends, ends[1:])]
    return [f"{column} <= {ends[0]} OR {column} IS NULL", *between, f"{column} > {ends[-1]}"]


def jdbc_table_evenly(spark: SparkSession, url: str, table: str, column: str, partitions: int, **options: str) -> DataFrame:
    """A database table read in parallel ranges of about as many rows each, found by one query beforehand."""
    cuts = spark.read.format("jdbc").option("url", url).option("query", cuts_query(table, column, partitions)).options(**options).load()
    predicates = range_predicates(column, [r["cut"] for r in cuts.orderBy("cut").collect()])
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def extract(table: DataFrame, spec: Extraction, run_date: date) -> DataFrame:
    """Rows and columns that a spec asks for. Filter and column list are pushed into the scan."""
    predicate = spec.predicate(run_date)
    rows = table if predicate is None else table.where(F.expr(predicate))
    return drop_columns(rows, spec.exclude_columns)


def extract_all(tables: Mapping[str, DataFrame], spec: ExtractionSpec, run_date: date) -> dict[str, DataFrame]:
    """One lazy extraction per table of a spec; tables do not depend on each other."""
    return {e.table: extract(tables[e.table], e, run_date) for e in spec.extractions}


def bronze_tables(spark: SparkSession, database: str = "raw") -> dict[str, DataFrame]:
    """The declared bronze tables that exist in a database."""
    return {n: spark.table(f"{database}.{n}") for n in BRONZE_DDL if spark.catalog.tableExists(f"{database}.{n}")}


#: The column that keeps the fields of a feed which its schema does not declare.
OTHER_FIELDS = "other_fields"


class BrokenPage(Exception):
    """Pages that are no array of objects; nothing of the feed is written until they are landed again."""


def visit_pages(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Landed pages of the visits feed, each file a JSON array. Nested cells stay JSON text.

    Declared fields are columns; all others are kept, as JSON text by name, in ``other_fields``. A page that can't be read is
    an error, found before any row is written.
    """
    declared = bronze_schema("matomo_detailed_visits") if schema is None else schema
    pages = spark.read.text(path, wholetext=True).select("value", F.input_file_name().alias("file"))
    items = F.from_json("value", "array<string>")  # each object as its JSON text
    bad = items.isNull() | F.exists(items, lambda x: F.coalesce(~F.startswith(x, F.lit("{")), F.lit(True)))
    broken = [r["file"] for r in pages.where(F.trim("value") != "").where(bad).select("file").limit(5).collect()]
    if broken:
        raise BrokenPage(", ".join(broken))
    return _declared(pages.select(F.explode(items).alias("item")), declared)


def _declared(rows: DataFrame, declared: T.StructType) -> DataFrame:
    """JSON objects as the declared columns and the rest of their fields."""
    text = F.col("item")
    fields = F.from_json(text, T.MapType(T.StringType(), T.StringType()))
    names = F.array(*[F.lit(n) for n in declared.fieldNames()])
    others = F.map_filter(fields, lambda k, _: ~F.array_contains(names, k))
    return rows.select(F.from_json(text, declared).alias("row"), F.when(F.size(others) > 0, F.to_json(others)).alias(OTHER_FIELDS)).select("row.*", OTHER_FIELDS)


def pages_of_arrays(pages: DataFrame, col: str, element: str | T.DataType) -> DataFrame:
    """Rows of pages that are held as JSON array texts; an empty page adds none."""
    kind = T._parse_datatype_string(element) if isinstance(element, str) else element
    items = F.from_json(F.col(col), T.ArrayType(kind))
    return pages.select(F.explode(items).alias("_item")).select("_item.*")


def pages_of_nodes(pages: DataFrame, col: str, path: str, node: str | T.DataType) -> DataFrame:
    """Nodes of cursor pages, whatever the order in which the pages came.

    ``path`` leads to the object that holds ``nodes``, for example ``data.component.proposals``.
    """
    kind = T._parse_datatype_string(node) if isinstance(node, str) else node
    schema: T.DataType = T.StructType([T.StructField("nodes", T.ArrayType(kind))])
    steps = path.split(".")
    for step in reversed(steps):
        schema = T.StructType([T.StructField(step, schema)])
    nodes = F.from_json(F.col(col), schema)
    for step in [*steps, "nodes"]:
        nodes = nodes[step]
    return pages.select(F.explode(nodes).alias("_node")).select("_node.*")


def next_cursor(page: Column, path: str) -> Column:
    """Cursor of the next page; NULL on the last one."""
    info = f"$.{path}.pageInfo"
    more = F.get_json_object(page, f"{info}.hasNextPage") == "true"
    return F.when(more, F.get_json_object(page, f"{info}.endCursor"))


def components_of_type(spaces: Sequence[DataFrame], kinds: Sequence[str]) -> DataFrame:
    """Components of the accepted types over several kinds of spaces.

    Every input has an array column ``components`` of structs with ``id`` and ``__typename``.
    """
    rows = None
    for space in spaces:
        one = space.select(F.explode("components").alias("component")).select(
            F.col("component.id").alias("id"), F.col("component.__typename").alias("__typename")
        )
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:
        raise ValueError("no spaces given")
    return rows.where(F.col("__typename").isin(*kinds))

"""Writing layer tables.

A table on plain files cannot be changed in place. ``full_refresh`` writes anew and switches a name; ``replace_days`` and
``upsert`` replace the partitions that a batch touches and no others, whatever the session's settings. A batch is read once, into
a table of its own; what the touched partitions are to hold is written next; then the change is noted in the table's properties and carried out, and a
run that dies on the way is finished by the next one (:func:`recover`). Table formats with ``MERGE INTO`` delete and insert. Every sink
tells how many rows it deleted and wrote.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerwright.operators.nested import nested_to_json
from layerwright.operators.tables import upsert as upserted
from layerwright.schemas import layer_database

MERGE_FORMATS = ("delta", "iceberg", "hudi")
PART_COLUMN = "_key_part"
RANGE_SIZE = 1_000_000
NO_KEY = "none"
#: A table has no fewer hash parts, and a batch cuts no table into more parts than this: each is a folder to list, open and replace.
LEAST_PARTS, MOST_PARTS = 4, 1_000
#: Table properties: how a key is cut into parts, and how many rows there are; whose version a table is, in which state, and since when.
SIZE, PARTS, ROWS = "layerwright.range_size", "layerwright.hash_parts", "layerwright.rows"
VERSION_OF, STATE, SINCE = "layerwright.version_of", "layerwright.state", "layerwright.since"
#: A change that is being made, and the last batch of each stream that was taken in.
PENDING, TAKEN = "layerwright.pending", "layerwright.taken."


@dataclass(frozen=True)
class Changed:
    """What a run has done to a table; false when it changed nothing."""

    rows_deleted: int = 0
    rows_written: int = 0

    def __bool__(self) -> bool:
        return self.rows_written > 0 or self.rows_deleted > 0


@dataclass(frozen=True)
class Batch:
    """A numbered batch of a stream. A sink takes each number once, in order."""

    stream: str
    number: int

    @property
    def taken(self) -> dict[str, str]:
        return {TAKEN + self.stream: str(self.number)}


class RowsLost(Exception):
    """A table does not hold what a change should have left; the change stays noted, with the rows it was to write."""


def _described(spark: SparkSession, table: str, what: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == what).collect()
    return rows[-1]["data_type"] if rows else ""


def _provider(spark: SparkSession, table: str) -> str:
    return _described(spark, table, "Provider").lower()


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _set_properties(spark: SparkSession, table: str, **values: str) -> None:
    def quoted(text: str) -> str:
        return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

    text = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in values.items())
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({text})")


def _ensure_database(spark: SparkSession, table: str) -> None:
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")


def _written_beside(rows: DataFrame, table: str) -> str:
    """The rows as a table beside the one that is changed."""
    name = f"{table}__staged_{uuid.uuid4().hex[:12]}"
    _ensure_database(rows.sparkSession, name)
    rows.write.saveAsTable(name)
    return name


@contextmanager
def _staged(rows: DataFrame, table: str) -> Iterator[tuple[DataFrame, str]]:
    """A copy of the rows and its name, dropped in the end unless a change is noted that waits for it.

    Whatever is asked of the copy, the rows themselves are read once.
    """
    spark, name = rows.sparkSession, _written_beside(rows, table)
    try:
        yield spark.table(name), name
    finally:
        if _pending(spark, table).get("content") != name:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def _pending(spark: SparkSession, table: str) -> dict:
    """The change that is noted in a table's properties; empty if there is none."""
    return json.loads((_properties(spark, table).get(PENDING) if spark.catalog.tableExists(table) else None) or "{}")


def new_version(rows: DataFrame, table: str) -> str:
    """The rows written as a table of their own, recorded as a version of the published name that is not yet published."""
    spark, version = rows.sparkSession, f"{table}__{uuid.uuid4().hex[:12]}"
    _ensure_database(spark, table)
    rows.write.saveAsTable(version)
    record_version(spark, version, table)
    return version


def record_version(spark: SparkSession, version: str, table: str) -> None:
    _set_properties(spark, version, **{VERSION_OF: table.lower(), STATE: "written"})


def full_refresh(batch: DataFrame, table: str, keep_on_empty: bool = True) -> Changed:
    """Replace all rows by the batch. An empty batch leaves them by default.

    The batch is read once, into a table of its own; then the name, a view, is switched to it, so that a failed run costs
    nothing. How many rows there were is stored with the version that is replaced.
    """
    spark = batch.sparkSession
    version = new_version(nested_to_json(batch), table)
    n = spark.table(version).count()
    if not n and keep_on_empty:
        spark.sql(f"DROP TABLE {version}")
        return Changed()
    _set_properties(spark, version, **{ROWS: str(n)})
    database, _, name = table.rpartition(".")
    database = database or spark.catalog.currentDatabase()
    old = _rows_of_published(spark, table, database, name)
    switch_view(spark, database, name, version)
    return Changed(old, n)


def _rows_of_published(spark: SparkSession, table: str, database: str, name: str) -> int:
    if not spark.catalog.tableExists(table):
        return 0
    for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__*'").collect():
        kept = _properties(spark, f"{database}.{row['tableName']}")
        if kept.get(VERSION_OF) == f"{database}.{name}".lower() and kept.get(STATE) == "published" and ROWS in kept:
            return int(kept[ROWS])
    return spark.table(table).count()


def replace_days(batch: DataFrame, table: str, day: str = "serverDate", once: Batch | None = None) -> Changed:
    """Replace the days that the batch holds. The table is partitioned by day; others stay untouched.

    Rows without a day belong to no day: those of the batch are added, those of the table stay. Columns that the batch lacks are
    null; ``once`` names the batch of a stream, which is left out if the table has taken it in before.
    """
    spark = batch.sparkSession
    if _taken(spark, table, once):
        return Changed()
    with _staged(nested_to_json(batch), table) as (rows, name):
        n = rows.count()
        if not n:
            return Changed()
        _create(rows, table, day)
        target = spark.table(table)
        dayless = not rows.where(F.col(day).isNull()).isEmpty()
        deleted = target.select(day).join(rows.select(day).distinct(), day, "left_semi").count()
        if dayless or not _same_shape(rows, target):
            name = _written_beside(_shaped(rows, target), table)
        if dayless:  # the partition of rows without a day keeps what it has
            target.where(F.col(day).isNull()).write.mode("append").saveAsTable(name)
        _replace_parts(spark, table, day, name, [], once.taken if once else {})
    return Changed(deleted, n)


def upsert(batch: DataFrame, table: str, key: str = "id", range_size: int = RANGE_SIZE, once: Batch | None = None) -> Changed:
    """Delete target rows whose key is in the batch and add the batch; an empty batch does nothing.

    A table on plain files is partitioned by ranges of a whole-number key, or by hash parts of another. Only parts with a changed key
    are read and rewritten, so with ascending numbers a daily batch of recent rows costs no more than the last ranges. Hash parts
    are split as the table grows, a few at a time and along with those that a batch rewrites anyway. ``range_size`` is the least that a part is made
    for: where it would cut a table into more than ``MOST_PARTS``, parts are longer, so that a load costs as its rows do and not as a
    folder for every few of them. Ranges keep the length of the first load. Rows without a key match nothing: those of the batch are added, those of the table stay. Rows of the batch that repeat a key are all added, in every format. Columns that the
    batch lacks are null; ``once`` names the batch of a stream, which is left out if the table has taken it in before.
    """
    spark = batch.sparkSession
    if _taken(spark, table, once):
        return Changed()
    rows, exists = nested_to_json(batch), spark.catalog.tableExists(table)
    if exists and _provider(spark, table) in MERGE_FORMATS:
        with _staged(rows, table) as (staged, _):
            return _delete_and_insert(staged, table, key, once)
    numbered = _whole_number(rows, key)
    if not exists and numbered:  # where each row goes is known beforehand, so it is written but once before it goes there
        rows = _with_part(rows, key, range_size, 0)
    with _staged(rows, table) as (rows, name):
        n = rows.count()
        if not n:
            return Changed()
        longer = range_size if exists or not numbered else _range_for(rows, key, range_size)
        if longer > range_size:
            name = _written_beside(_with_part(rows, key, longer, 0), table)
        first = {SIZE: str(longer), ROWS: "0", PARTS: str(0 if numbered else _parts_for(n, range_size))}
        _create(rows.withColumn(PART_COLUMN, F.lit("")), table, PART_COLUMN, first)
        stored, target = _properties(spark, table), spark.table(table)
        if PARTS not in stored:
            raise ValueError(f"{table} was not made by upsert")
        size, parts, total = (int(stored[p]) for p in (SIZE, PARTS, ROWS))
        if numbered != (parts == 0):
            raise ValueError(f"{table} is cut by another type of key")
        done = once.taken if once else {}
        if not exists and numbered:
            _replace_parts(spark, table, PART_COLUMN, name, [], {ROWS: str(n), **done})
            return Changed(0, n)
        shaped = _shaped(rows, target)
        own = _with_part(shaped, key, size, parts).select(PART_COLUMN, key).distinct()
        deleted = target.join(own, [PART_COLUMN, key], "left_semi").count() if exists else 0
        total += n - deleted
        more = max(parts, _parts_for(total, size)) if parts else 0
        moved = spark.createDataFrame([(f"p{_parent(j, parts)}",) for j in range(parts, more)], f"{PART_COLUMN} string")
        touched = own.select(PART_COLUMN) if more == parts else own.select(PART_COLUMN).union(moved)
        before = target.join(touched.distinct(), PART_COLUMN, "left_semi")
        name = _written_beside(_with_part(upserted(before, shaped, key), key, size, more).select(*target.columns), table)
        left = moved.join(spark.table(name), PART_COLUMN, "left_anti").distinct().collect() if more > parts else []
        _replace_parts(spark, table, PART_COLUMN, name, [r[0] for r in left], {ROWS: str(total), PARTS: str(more), **done})
    return Changed(deleted, n)


def _taken(spark: SparkSession, table: str, once: Batch | None) -> bool:
    """Whether a table has taken a batch in, after finishing what an earlier run has left."""
    recover(spark, table)
    if once is None or not spark.catalog.tableExists(table):
        return False
    return int(_properties(spark, table).get(TAKEN + once.stream, -1)) >= once.number


def _create(rows: DataFrame, table: str, part: str, properties: dict[str, str] | None = None) -> None:
    """An empty table for such rows, if there is none."""
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        rows.limit(0).write.partitionBy(part).saveAsTable(table)
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{STATE}' = 'made')")
    kept = _properties(spark, table)
    if properties and not any(name in kept for name in properties) and kept.get(STATE) == "made":
        _set_properties(spark, table, **properties)


def _replace_parts(spark: SparkSession, table: str, part: str, content: str, gone: list[str], done: dict[str, str]) -> None:
    """Let the partitions that ``content`` has rows of hold just these, and drop those in ``gone``; then ``done`` are the table's properties."""
    todo = {"content": content, "part": part, "gone": gone, "done": done}
    _set_properties(spark, table, **{PENDING: json.dumps(todo)})
    recover(spark, table)


def recover(spark: SparkSession, table: str) -> bool:
    """Finish a change that was noted but not finished; false if there is none. Every sink calls it first.

    All of it can be done again: the rows to write wait in a table of their own until they are in place and counted.
    """
    todo = _pending(spark, table)
    if not todo:
        return False
    part, content = todo["part"], spark.table(todo["content"])
    before = _partitions(spark, table)
    # By path: there the option counts, while a write by the table's name goes by the session's setting alone.
    dealt = content.hint("rebalance", F.col(part)).write.format(_provider(spark, table)).partitionBy(part)
    dealt.option("partitionOverwriteMode", "dynamic").mode("overwrite").save(_described(spark, table, "Location"))
    for value in todo["gone"]:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{part}` = '{value}')")
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
    spark.catalog.refreshTable(table)
    _check(spark, table, part, content, before - {f"{part}={value}" for value in todo["gone"]})
    _set_properties(spark, table, **todo["done"], **{PENDING: ""})
    spark.sql(f"DROP TABLE IF EXISTS {todo['content']}")
    return True


def _partitions(spark: SparkSession, table: str) -> set[str]:
    return {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def _check(spark: SparkSession, table: str, part: str, content: DataFrame, expected: set[str]) -> None:
    """The partitions of before are there, and those that were replaced have the rows they were to have."""
    lost = expected - _partitions(spark, table)
    if lost:
        raise RowsLost(f"{table} has lost {', '.join(sorted(lost)[:5])}")
    target, parts = spark.table(table).select(part), content.select(part).distinct()
    held = target.join(parts, part, "left_semi").count()
    if part != PART_COLUMN and not parts.where(F.col(part).isNull()).isEmpty():
        held += target.where(F.col(part).isNull()).count()
    if held != (wanted := content.count()):
        raise RowsLost(f"the replaced partitions of {table} have {held} rows instead of {wanted}")


def _parts_for(rows: int, range_size: int) -> int:
    return min(MOST_PARTS, max(LEAST_PARTS, -(-rows // range_size)))


def _range_for(rows: DataFrame, key: str, range_size: int) -> int:
    """The length of ranges, as given or longer, that puts the rows into ``MOST_PARTS`` at most. Ranges without rows don't count."""
    while (parts := rows.select(F.expr(f"`{key}` DIV {int(range_size)}")).where(F.col(f"`{key}`").isNotNull()).distinct().count()) > MOST_PARTS:
        range_size *= -(-parts // MOST_PARTS)
    return range_size


def _parent(part: int, parts: int) -> int:
    """The hash part whose rows a new part takes over some of."""
    while part >= parts:
        part -= 1 << (part.bit_length() - 1)
    return part


def _shaped(batch: DataFrame, target: DataFrame) -> DataFrame:
    """The batch in the columns and types of the target; a column that it lacks is an error, not something to lose silently."""
    have = {c.lower(): c for c in batch.columns}
    new = set(have) - {c.lower() for c in target.columns}
    if new:
        raise ValueError(f"the table has no column {', '.join(sorted(new))}")

    def value(f: T.StructField) -> Column:
        name = have.get(f.name.lower())
        if name is None:
            return F.lit(None).cast(f.dataType)
        col = F.col(f"`{name}`")
        if batch.schema[name].dataType == f.dataType:
            return col
        problem = F.concat(F.lit(f"no {f.dataType.simpleString()} for {f.name}: "), col.cast("string"))
        return F.coalesce(col.try_cast(f.dataType), F.when(col.isNotNull(), F.raise_error(problem)).cast(f.dataType))

    return batch.select(*[value(f).alias(f.name) for f in target.schema.fields])


def _same_shape(batch: DataFrame, target: DataFrame) -> bool:
    """Whether a batch has just the target's columns, in its types, in any order."""
    return sorted((f.name, f.dataType.simpleString()) for f in batch.schema) == sorted((f.name, f.dataType.simpleString()) for f in target.schema)


def _whole_number(rows: DataFrame, key: str) -> bool:
    return isinstance(rows.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _with_part(rows: DataFrame, key: str, range_size: int, parts: int) -> DataFrame:
    """Rows with the part that their key is in; rows without a key are a part of their own.

    ``parts`` is the number of hash parts, 0 for ranges. A hash part beyond it is not split off yet: its rows are in its parent.
    """
    col = F.col(f"`{key}`")
    if parts:
        whole = 1 << (parts - 1).bit_length()
        hashed = F.pmod(F.xxhash64(col), F.lit(whole))
        number = F.when(hashed < parts, hashed).otherwise(hashed - whole // 2)
    else:
        number = F.expr(f"`{key}` DIV {int(range_size)}")
    named = F.when(col.isNotNull(), F.concat(F.lit("p"), number.cast("string")))
    return rows.withColumn(PART_COLUMN, F.coalesce(named, F.lit(NO_KEY)))


def _delete_and_insert(rows: DataFrame, table: str, key: str, once: Batch | None) -> Changed:
    """The same on a format that can delete rows."""
    spark, view = rows.sparkSession, f"upsert_batch_{uuid.uuid4().hex}"
    shaped = _shaped(rows, spark.table(table))
    deleted = spark.table(table).join(rows.select(key).distinct(), key, "left_semi").count()
    rows.createOrReplaceTempView(view)
    try:
        spark.sql(f"DELETE FROM {table} WHERE `{key}` IN (SELECT `{key}` FROM {view} WHERE `{key}` IS NOT NULL)")
        shaped.write.mode("append").insertInto(table)
    finally:
        spark.catalog.dropTempView(view)
    if once:
        _set_properties(spark, table, **once.taken)
    return Changed(deleted, rows.count())


def publish_view(model: DataFrame, name: str) -> str:
    """Make a lazy model available by name in the session."""
    model.createOrReplaceTempView(name)
    return name


def publish_table(model: DataFrame, name: str, target: str = "prod", layer: str | None = "gold",
                  sort_by: Sequence[str] = (), partition_by: Sequence[str] = (),
                  bucket_by: Sequence[str] = (), buckets: int = 0, index_by: Sequence[str] = ()) -> str:
    """Rebuild a model's table in its layer database, ordered inside files for the usual look-ups.

    Tables bucketed alike by an id join on it without moving rows again; take ids without hot values. ``index_by`` does what an index
    is for: rows are dealt by ranges of these columns and sorted by them, so a look-up opens the file or two that its range is in, and Bloom filters
    tell row groups that lack a value inside the range. It costs a shuffle of the table.
    """
    full = f"{layer_database(target, layer)}.{name}"
    _ensure_database(model.sparkSession, full)
    if index_by:
        if buckets or partition_by:
            raise ValueError("an index takes the place of buckets and partitions")
        model, sort_by = model.repartitionByRange(*index_by), [*index_by, *[c for c in sort_by if c not in index_by]]
    if buckets:
        model = model.repartition(buckets, *bucket_by)
    # Otherwise rows stay in the tasks that made them: a table that unfolds inside its last stage, as the daily
    # series does, would otherwise be moved as a whole. Each task writes one file per partition value.
    order = [*partition_by, *sort_by] if not buckets else []
    rows = model.sortWithinPartitions(*order) if order else model
    writer = rows.write.mode("overwrite")
    for column in index_by:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*(sort_by or bucket_by))
    writer.saveAsTable(full)
    return full


def publish_version(model: DataFrame, name: str, version: str, target: str = "prod", layer: str | None = "gold",
                    sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> str:
    """A model written as a version of its published name, for tests to read before :func:`switch_view`."""
    full = publish_table(model, f"{name}__{version}", target, layer, sort_by, partition_by)
    record_version(model.sparkSession, full, f"{layer_database(target, layer)}.{name}")
    return full


def switch_view(spark: SparkSession, database: str, name: str, table: str, hide: Sequence[str] = ()) -> str:
    """Let the published name point to a newly written version; columns that only lay out its files can be hidden.

    Only tables recorded as versions of this name that were replaced before the last switch are dropped: readers of the
    version that is replaced now can finish, and versions that another run has written but not published are left alone.
    """
    view = f"{database}.{name}"
    if spark.catalog.tableExists(view) and spark.catalog.getTable(view).tableType != "VIEW":
        spark.sql(f"DROP TABLE {view}")  # a table of that name from before views were switched
    versions = {}
    for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__*'").collect():
        full = f"{database}.{row['tableName']}"
        kept = _properties(spark, full)
        if kept.get(VERSION_OF) == view.lower() and full.lower() != table.lower():
            versions[full] = kept.get(STATE)
    record_version(spark, table, view)
    shown = ", ".join(f"`{c}`" for c in spark.table(table).columns if c not in hide)
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT {shown} FROM {table}")
    now = datetime.now(timezone.utc).isoformat()
    _set_properties(spark, table, **{STATE: "published", SINCE: now})
    for old, state in versions.items():
        if state == "replaced":
            spark.sql(f"DROP TABLE IF EXISTS {old}")
        elif state == "published":
            _set_properties(spark, old, **{STATE: "replaced", SINCE: now})
    return view

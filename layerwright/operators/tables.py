"""Pure forms of the table changes: upsert, replacement by day, union of shapes, paging."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.operators.joins import existing, missing


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """All columns but the named ones, in order; case is ignored, unknown names too."""
    out = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in out])


def upsert(target: DataFrame, batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the whole batch."""
    on = [key] if isinstance(key, str) else list(key)
    return missing(target, batch, on).unionByName(batch, allowMissingColumns=True)


def replace_days(target: DataFrame, batch: DataFrame, day: str) -> DataFrame:
    """Target rows of days that are not in the batch, plus the whole batch."""
    return upsert(target, batch, day)


def change_counts(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """One row: how many target rows an upsert deletes and how many rows it writes."""
    deleted = existing(target, batch, [key]).select(F.lit(1).alias("deleted"), F.lit(0).alias("written"))
    written = batch.select(F.lit(0).alias("deleted"), F.lit(1).alias("written"))
    return deleted.unionAll(written).agg(
        F.coalesce(F.sum("deleted"), F.lit(0)).alias("rows_deleted"),
        F.coalesce(F.sum("written"), F.lit(0)).alias("rows_written"),
    )


def tagged(df: DataFrame, tag: str, key: str, tag_column: str, id_column: str) -> DataFrame:
    """A constant tag and a surrogate id ``<tag>_<key>``, ready for a union of shapes."""
    return df.withColumn(id_column, F.concat(F.lit(f"{tag}_"), F.col(key).cast("string"))).withColumn(
        tag_column, F.lit(tag)
    )


def page(df: DataFrame, order: Sequence[Column | str], offset: int, limit: int) -> DataFrame:
    """One page of an ordered result. A far page costs a sort of all rows before it; :func:`page_after` does not."""
    return df.orderBy(*order).offset(offset).limit(limit)


def page_after(df: DataFrame, key: str, after, limit: int) -> DataFrame:
    """The page that follows a key value. Its cost does not depend on how far the page is."""
    rows = df if after is None else df.where(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(limit)


def newer_than(df: DataFrame, marks: Sequence[str], high_water: Column) -> DataFrame:
    """Rows with any of the timestamps strictly after the mark."""
    keep = F.lit(False)
    for name in marks:
        keep = keep | F.coalesce(F.col(f"`{name}`") > high_water, F.lit(False))
    return df.where(keep)


def high_water_mark(df: DataFrame, col: str, alias: str = "max_datetime") -> DataFrame:
    """The new mark, or NULL when there is nothing new."""
    return df.agg(F.max(f"`{col}`").alias(alias))

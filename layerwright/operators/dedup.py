"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _orderable(df: DataFrame, leave_out: Sequence[str]) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if f.name not in leave_out and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str = "updated_at",
                   ties: Sequence[str] | None = None, nulls_win: bool = True) -> DataFrame:
    """The newest version of each key.

    A missing version wins by default, as it does under PostgreSQL's descending order. Equal
    versions are settled by ``ties``, by default all other columns, so that the choice is fixed.
    Spark keeps one row per key and map task before the shuffle, so a hot key moves few rows.
    """
    ties = _orderable(df, [*keys, version]) if ties is None else ties
    newest = F.col(version).desc_nulls_first() if nulls_win else F.col(version).desc_nulls_last()
    order = [newest, *[F.col(f"`{t}`").desc_nulls_first() for t in ties]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the same in every run."""
    order = [F.col(f"`{c}`").desc_nulls_first() for c in _orderable(df, keys)] or [F.lit(1)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")

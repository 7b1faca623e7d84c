"""Joins on equal keys. Building one runs nothing: Spark broadcasts a side whose size it knows to be under its
threshold, from the files or from what a stage has written, and adaptive execution splits the tasks of hot keys. Where
that can't, for hot rows on the optional side, the join is put so that it can, or keys are cut on request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def row_piece(df: DataFrame, pieces):
    """A piece number per row that a retried task computes again the same way.

    The partition id is part of it, so that full copies of one row spread as well.
    """
    cols = [F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)]
    return F.pmod(F.xxhash64(*cols, F.spark_partition_id()), pieces)


def spread_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left", salt: int = 1) -> DataFrame:
    """Equi-join of a large left side, for ``inner``, ``left``, ``left_semi`` and ``left_anti``.

    With ``salt`` every key of the left side is cut into so many pieces and each right row copied to all of them: for
    left keys so hot that even their split tasks are too long, and a right side small enough to be copied. Any salt gives the same rows.
    The copies are never broadcast: Spark's estimate of their size leaves out the copying, and the driver would have to hold them all.
    """
    on = list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    if how in ("left_semi", "left_anti"):
        right = right.select(*on)
    if salt <= 1:
        return left.join(right, on, how)
    if how in ("left_semi", "left_anti"):
        right = right.distinct()
    cut = left.withColumn("_piece", row_piece(left, F.lit(salt)))
    copied = right.withColumn("_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))))
    return cut.join(copied.hint("merge"), [*on, "_piece"], how).drop("_piece")


def lookup_many(left: DataFrame, right: DataFrame, on: Sequence[str], keys: DataFrame | None = None) -> DataFrame:
    """Left join of a table with one row per key to a table with many rows per key.

    An outer join can't split the right rows of a hot key, an inner join can. So rows with a match are joined inner, and those
    without are added. ``keys`` may name a cheaper frame with the same keys as ``right``.
    """
    on = list(on)
    found = right.join(left, on, "inner")
    alone = missing(left, right if keys is None else keys, on)
    columns = [*left.columns, *[c for c in right.columns if c not in on]]
    return alone.unionByName(found, allowMissingColumns=True).select(*[c for c in on], *[c for c in columns if c not in on])


def existing(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is found in the other table."""
    return spread_join(df, other, on, "left_semi")


def missing(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key is not found in the other table; rows without a key stay."""
    return spread_join(df, other, on, "left_anti")


def split_known(rows: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a stored key and rows without one: (to update, to configure)."""
    return existing(rows, known, [key]), missing(rows, known, [key])


def lookup_dimension(facts: DataFrame, dimension: DataFrame, keys: dict[str, str], take: dict[str, str],
                     how: str = "left") -> DataFrame:
    """Add columns of a dimension to a fact table.

    ``keys`` maps fact columns to dimension columns, ``take`` dimension columns to output names.
    """
    dim = dimension.select(
        *[F.col(d).alias(f) for f, d in keys.items()], *[F.col(d).alias(name) for d, name in take.items()]
    )
    return spread_join(facts, dim, list(keys), how)

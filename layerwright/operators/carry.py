"""Fill values along an ordered log without putting one long log into one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 100_000
CHUNK_COLUMN = "_chunk"
#: Rows that a task of a log is to have: it sorts them several times, unpacked, at about 1.3 KB a row.
ROWS_PER_TASK = 200_000


def tasks_for(df: DataFrame) -> int:
    """How many tasks share the rows, which are counted for it; of a written table only the files' footers are read."""
    return max(1, -(-df.count() // ROWS_PER_TASK))


def in_chunks(df: DataFrame, group: Sequence[str], position: str, chunk: int = CHUNK) -> DataFrame:
    """Rows distributed by group and chunk, so that work on them and the windows of ``carry`` need no
    further exchange.

    The number of tasks grows with the rows: Spark's own goes by the packed size of what is shuffled, of which a log's is a small part of what
    the windows hold.
    """
    cut = df.withColumn(CHUNK_COLUMN, _chunk_of(position, chunk))
    return cut.repartition(tasks_for(df), *group, CHUNK_COLUMN)


def _chunk_of(position: str, chunk: int) -> Column:
    return F.expr(f"`{position}` DIV {int(chunk)}")


def carry(df: DataFrame, group: Sequence[str], position: str, last: Mapping[str, Column] | None = None,
          following: Mapping[str, Column] | None = None, chunk: int = CHUNK,
          told_by: DataFrame | None = None) -> DataFrame:
    """Add the last known value up to each row and the next known value from each row on.

    ``last`` and ``following`` map new column names to expressions that are NULL where a row says
    nothing. A group is cut into chunks of positions. One row per chunk carries the values across
    chunks, and the windows over the log itself never reach beyond a chunk, however long the group is.
    ``told_by`` may give the same groups, positions and values as a cheaper plan than ``df``.
    """
    last, following = dict(last or {}), dict(following or {})
    group = list(group)
    pos = F.col(position)
    values = {f"_v_{name}": expr for name, expr in {**last, **following}.items()}

    def chunked(rows: DataFrame) -> DataFrame:
        if CHUNK_COLUMN not in rows.columns:
            rows = rows.withColumn(CHUNK_COLUMN, _chunk_of(position, chunk))
        return rows.withColumns(values)

    cut = chunked(df)
    picks = [
        F.max_by(F.col(f"_v_{n}"), F.when(F.col(f"_v_{n}").isNotNull(), pos)).alias(f"_c_{n}") for n in last
    ] + [
        F.min_by(F.col(f"_v_{n}"), F.when(F.col(f"_v_{n}").isNotNull(), pos)).alias(f"_c_{n}") for n in following
    ]
    teller = cut if told_by is None else chunked(told_by)
    summary = teller.groupBy(*group, CHUNK_COLUMN).agg(*picks)
    earlier = Window.partitionBy(*group).orderBy(CHUNK_COLUMN).rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*group).orderBy(F.desc(CHUNK_COLUMN)).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *group, CHUNK_COLUMN,
        *[F.last(f"_c_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in last],
        *[F.last(f"_c_{n}", ignorenulls=True).over(later).alias(f"_c_{n}") for n in following],
    )

    inside = Window.partitionBy(*group, CHUNK_COLUMN)
    upto = inside.orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = inside.orderBy(pos.desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = cut.join(carried, [*group, CHUNK_COLUMN], "left")
    filled = joined.select(
        *df.columns,
        *[F.coalesce(F.last(f"_v_{n}", ignorenulls=True).over(upto), F.col(f"_c_{n}")).alias(n) for n in last],
        *[F.coalesce(F.last(f"_v_{n}", ignorenulls=True).over(onward), F.col(f"_c_{n}")).alias(n) for n in following],
    )
    return filled

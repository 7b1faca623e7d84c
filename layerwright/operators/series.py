"""Daily series per entity with zero fill."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright.functions.dates import as_date, day_series


def expand_days(df: DataFrame, start: str, as_of: date | str | Column, day: str = "day") -> DataFrame:
    """One row per day from the start column to ``as_of``; none for a later or missing start."""
    return df.withColumn(day, F.explode(day_series(F.col(start), as_date(as_of))))


def sum_daily(facts: Sequence[DataFrame], key: str, day: str, measures: Sequence[str]) -> DataFrame:
    """Several daily tables as one, with 0 where a table lacks a measure."""
    zero = F.lit(0).cast("long")
    aligned = [
        f.select(key, day, *[(F.col(m).cast("long") if m in f.columns else zero).alias(m) for m in measures])
        for f in facts
    ]
    rows = aligned[0]
    for more in aligned[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy(key, day).agg(*[F.sum(m).alias(m) for m in measures])


def daily_fill(entities: DataFrame, activity: DataFrame, key: str, start: str, day: str,
               measures: Sequence[str], as_of: date | str | Column, variants: DataFrame | None = None) -> DataFrame:
    """Entities by day with the measures of that day, 0 on days without activity.

    ``activity`` holds one row per key and active day. The series is not built first and joined:
    each active day opens a stretch that lasts until the next one, the time before the first is a
    stretch too, and stretches are unfolded after the only join. So what is shuffled grows with
    activity, not with entities times days. Entity rows may repeat a key; each gets its own series.

    ``variants`` holds further measures with possibly several rows per key and day; on such a day
    the series has one row for each.
    """
    last, zero = as_date(as_of), F.lit(0).cast("long")
    marks = sum_daily([activity.where(F.col(key).isNotNull() & (F.col(day) <= last))], key, day, measures)
    if variants is not None:
        more = [c for c in variants.columns if c not in (key, day)]
        dated = variants.where(F.col(key).isNotNull() & (F.col(day) <= last))
        measures = [*measures, *more]
        marks = marks.join(dated, [key, day], "full").na.fill(0, measures)
    order = Window.partitionBy(key).orderBy(day)
    before_next = F.date_sub(F.lead(day).over(order), 1)
    # Among several rows of one day only the last reaches up to the next day.
    marks = marks.withColumn("_end", F.greatest(F.col(day), F.coalesce(before_next, last)))
    marks = marks.withColumn("_first", F.lag(day).over(order).isNull())
    own = F.struct(F.col(day).alias("_from"), F.col("_end"), *measures)
    before = F.struct(
        F.lit(None).cast("date").alias("_from"), F.date_sub(F.col(day), 1).alias("_end"), *[zero.alias(m) for m in measures]
    )
    stretches = marks.select(
        key, F.inline(F.when(F.col("_first"), F.array(before, own)).otherwise(F.array(own)))
    )
    begun = entities.withColumn("_start", F.to_date(start)).where(F.col("_start") <= last)
    held = begun.join(stretches, key, "left").where(F.col("_end").isNull() | (F.col("_end") >= F.col("_start")))
    unfolded = held.withColumn(day, F.explode(F.sequence(
        F.greatest("_from", "_start"), F.coalesce("_end", last), F.expr("INTERVAL 1 DAY")
    )))
    own_day = F.col(day) == F.col("_from")
    return unfolded.withColumns(
        {m: F.when(own_day, F.col(m)).otherwise(zero) for m in measures}
    ).drop("_start", "_from", "_end")

"""What the operators share: text normalisation, clashing column names, running totals over ranges."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerwright.session import materialize

#: The separators of words, U+0020 and U+0009 to U+000D, as a character class and as plain characters.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: For bytes.translate: A-Z lower-cased, all else kept.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased. ``lower`` does just that, and faster, where all characters are ASCII."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def packed(df: DataFrame, **columns: str | Column) -> DataFrame:
    """The named columns and, as ``row``, the whole row.

    Inside an operator only the names given here exist, so a column of the input can't clash with one of the
    operator's own.
    """
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(name) for name, c in columns.items()],
                     F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"))


def unpacked(df: DataFrame, names: list[str], **columns: Column) -> DataFrame:
    """The packed row's columns again, with ``columns`` added. A column of the input of the same name is replaced."""
    new = {name.lower() for name in columns}
    kept = [F.col(f"row.`{n}`").alias(n) if n.lower() not in new else None for n in names]
    at = {n.lower(): i for i, n in enumerate(names)}
    extra = []
    for name, column in columns.items():
        if name.lower() in at:
            kept[at[name.lower()]] = column.alias(names[at[name.lower()]])
        else:
            extra.append(column.alias(name))
    return df.select(*kept, *extra)


def finished(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of steps whose results are written.

    It does so when the driver collects the objects that stood for them, which on a driver with room to spare may take longer
    than the job, while every step's files wait on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*steps: DataFrame) -> None:
    """Deletes written steps that no later one reads any more; each is a folder of its own in the shared folder."""
    for step in steps:
        spark = step.sparkSession
        for folder in {name.rsplit("/", 1)[0] for name in step.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, total: str, label: str) -> DataFrame:
    """``df`` with the running total of ``value`` within ``keys`` in the given order, the row itself included.

    A window over a key would put all its rows into one task. Here the rows are dealt by ranges of (keys, order), so
    that a hot key takes many tasks; each task adds up its own rows, and one row per task and key carries what
    comes before. Ties of the whole order may stand in any order among themselves.
    """
    columns = [*keys, *order]
    dealt = df.repartitionByRange(*[F.col(c) for c in columns]) if columns else df.coalesce(1)
    dealt = materialize(dealt.sortWithinPartitions(*columns).withColumn("_part", F.spark_partition_id()), label)
    parts = dealt.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = dealt.withColumn(total, F.sum(value).over(inside))
    same = [summed[k].eqNullSafe(parts[k]) for k in [*keys, "_part"]]
    joined = summed.join(parts, same, "left")
    return joined.select(*[summed[c] for c in df.columns], (summed[total] + parts["_before"]).alias(total))

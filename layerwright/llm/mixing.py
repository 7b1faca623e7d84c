"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled and queue up, copy after copy; a copy's virtual finish time is its source's running total
of words divided by the source's target. All copies are sorted by it over the cluster and the sorted list is cut at
the total budget, so that sources advance in proportion to their targets. DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerwright.llm.common import SPACE_CLASS, packed, running_total
from layerwright.session import materialize


def word_count(text: Column) -> Column:
    """Number of words, runs of other characters than white space; 0 for null."""
    words = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), f"^{SPACE_CLASS}+", ""), f"{SPACE_CLASS}+")
    return (F.size(words) - F.when(F.element_at(words, -1) == "", 1).otherwise(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """``source, source_no, source_size, target`` from one row per source with its ``source_size``.

    Weights are dealt out by code point, null last, again and again. A target is its weight times one level, but
    never above ``most`` times the source's size; what such sources leave raises the level of the others. With sources in order of
    the level at which they are full, the level is the highest that any number of full sources gives. The
    windows without keys see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    numbered = sizes.withColumn("source_no", F.row_number().over(by_name))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.col("source_no") - 1, F.lit(len(weights))) + 1).cast("int"))
    full = F.col("source_size") * most
    numbered = numbered.withColumn("weight", weight).withColumn("full", full)
    before = Window.orderBy(F.col("full") / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    budget = F.sum("source_size").over(whole) * F.lit(share)
    rest = budget - F.coalesce(F.sum("full").over(before), F.lit(0))
    level = rest / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    levels = numbered.withColumn("level", level).withColumn("level", F.max("level").over(whole))
    target = F.least(F.col("full").cast("double"), F.col("weight") * F.col("level"))
    return levels.select("source", "source_no", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", *,
             weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix") -> DataFrame:
    """``id, fp, source, size, source_size, target, copies, taken``: one row for each row of ``docs``.

    ``fp`` is a hash of the whole row's id, source and text. Whole documents are taken, so a source's words differ from its
    target by a document or so; none is taken more than ``most`` times. The shuffle is a hash of seed and id, so that reruns
    agree. Null and empty texts have no words and are never taken. The null source is one source, after the others. Rows with
    the same id, source and text stand together: all of them are taken or none. An empty table gives an empty table.
    """
    text, source = F.col(f"`{text_col}`"), F.col(f"`{source_col}`")
    ident = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    base = packed(docs, id=id_col, source=source.cast("string"), size=word_count(text),
                  h=F.substring(F.md5(F.concat(F.lit(seed), ident)), 1, 16), fp=row_hash(id_col, text_col, source_col))
    base = materialize(base.drop("row"), "mix-sizes")
    targets = source_targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    targets = materialize(targets, "mix-targets")  # so that Spark knows its size: one row per source
    queued = base.join(targets.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    queued = running_total(queued, ["source_no"], ["h", "fp"], "size", "cum", "mix-queue")

    def place(copy: Column) -> Column:
        finish = (copy * F.col("source_size") + F.col("cum")) / F.col("target")
        return F.struct(finish.alias("finish"), "source_no", "h", "fp", copy.alias("copy"))

    copies = F.sequence(F.lit(0), F.lit(most - 1))
    items = queued.filter("size > 0").select("*", F.explode(copies).alias("n")).select(place(F.col("n")).alias("at"), "size")
    listed = running_total(items.select("at.*", "size"), [], ["finish", "source_no", "h", "fp", "copy"], "size", "total", "mix-order")
    budget = targets.agg(F.sum("source_size")).first()[0]
    order = F.struct("finish", "source_no", "h", "fp", "copy")
    last = listed.filter(F.col("total") <= F.lit(float(share * (budget or 0)))).agg(F.max(order).alias("at")).first()["at"]
    if last is None:
        taken = F.lit(0)
    else:
        kinds = {"finish": "double", "source_no": "int", "h": "string", "fp": "long", "copy": "int"}
        end = F.struct(*[F.lit(last[name]).cast(kind).alias(name) for name, kind in kinds.items()])
        taken = sum((F.when(place(F.lit(c)) <= end, 1).otherwise(0) for c in range(most)), F.lit(0))
    taken = F.when(F.col("size") > 0, taken).otherwise(0)
    return queued.select("id", "fp", "source", "size", "source_size", "target", taken.alias("copies"), (taken * F.col("size")).alias("taken"))


def row_hash(id_col: str, text_col: str, source_col: str) -> Column:
    return F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0null")) for c in (id_col, source_col, text_col)])


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row for each copy that :func:`mix_plan` takes, and its number as ``copy``
    (from 0). A column of the input of that name is replaced."""
    plan = mix_plan(docs, id_col, text_col, source_col, **options).filter("copies > 0")
    plan = plan.select("id", "fp", "copies").dropDuplicates(["id", "fp"])
    base = packed(docs, id=id_col, fp=row_hash(id_col, text_col, source_col))
    same = base["id"].eqNullSafe(plan["id"]) & (base["fp"] == plan["fp"])
    joined = base.join(plan, same).select("row", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() != "copy"]
    return joined.select(*kept, "copy")

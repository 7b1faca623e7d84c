"""Expansion of reply threads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerwright.operators.joins import spread_join
from layerwright.session import materialize


def with_ancestors(wanted: DataFrame, comments: DataFrame, comment_id: str, parent_id: str) -> DataFrame:
    """Comments asked for and all that they reply to, up to the roots.

    Every round looks up the parents that were not met before, in the stretch of ids that they are in, which the scan takes as a
    filter; so the work goes with the threads of the comments asked for, and not with all that was ever written. It takes a round per
    reply of the deepest thread.
    """
    met = materialize(wanted.select(*comments.columns), "window")
    frontier = met
    while True:
        asked = frontier.select(F.col(parent_id).alias("_asked")).where("_asked IS NOT NULL").distinct()
        asked = materialize(asked.join(met.select(F.col(comment_id).alias("_asked")), "_asked", "left_anti"), "parents")
        ends = asked.agg(F.min("_asked").alias("low"), F.max("_asked").alias("high")).first()
        if ends["low"] is None:
            return met
        near = comments.where(F.col(comment_id).between(F.lit(ends["low"]), F.lit(ends["high"])))
        frontier = materialize(near.join(asked, F.col(comment_id) == F.col("_asked"), "left_semi"), "parents")
        met = met.unionByName(frontier)


def expand_threads(comments: DataFrame, comment_id: str, parent_id: str, root_id: str) -> DataFrame:
    """Every comment reachable from a root comment, with its thread.

    ``comments`` has one row per comment. A root comment has a NULL parent and names its root
    component in ``root_id``. The result adds ``parent_comment_id`` (a root is its own parent),
    ``thread_id``, ``depth`` (1 for roots) and the root component of every comment. Comments that
    hang on no root are left out.

    Each round lets a comment skip to the ancestor of its ancestor, so a thread of depth d takes
    log2(d) rounds instead of d. The ids found so far are materialised between rounds.
    """
    links = comments.select(
        F.col(comment_id).alias("id"),
        F.col(parent_id).alias("ancestor"),
        F.lit(1).cast("long").alias("steps"),
        F.col(root_id).alias("root"),
    )
    done = links.where(F.col("ancestor").isNull()).select(
        "id", F.col("id").alias("thread_id"), F.col("steps").alias("depth"), "root"
    )
    open_links = links.where(F.col("ancestor").isNotNull()).select("id", "ancestor", "steps")
    done, open_links = materialize(done, "threads"), materialize(open_links, "threads")
    resolved = done
    while not open_links.isEmpty():
        reached = spread_join(
            open_links, resolved.select(F.col("id").alias("ancestor"), "thread_id", "depth", "root"), ["ancestor"],
        )
        found = materialize(reached.where(F.col("depth").isNotNull()).select(
            "id", "thread_id", (F.col("depth") + F.col("steps")).alias("depth"), "root"
        ))
        if found.isEmpty():
            break
        waiting = reached.where(F.col("depth").isNull()).select("id", "ancestor", "steps")
        hops = open_links.select(
            F.col("id").alias("ancestor"), F.col("ancestor").alias("further"), F.col("steps").alias("more")
        )
        open_links = materialize(spread_join(waiting, hops, ["ancestor"], "inner").select(
            "id", F.col("further").alias("ancestor"), (F.col("steps") + F.col("more")).alias("steps")
        ))
        resolved = resolved.unionByName(found)
    threads = resolved.withColumnRenamed("id", comment_id)
    rest = comments.drop(root_id)
    return (
        rest.join(threads, comment_id, "inner")
        .withColumn("parent_comment_id", F.coalesce(F.col(parent_id), F.col(comment_id)))
        .withColumnRenamed("root", root_id)
    )

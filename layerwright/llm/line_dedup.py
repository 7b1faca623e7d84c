"""Line dedup: lines that many documents hold stay in one of them only.

Lines are exploded with their position, normalised and hashed; distinct documents are counted per hash; lines
whose hash is in too many documents are dropped everywhere but in the first document; the rest is put together
by position. Only hashes and positions are shuffled, texts once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import SPACE_CHARS, ascii_lower, packed, unpacked
from layerwright.session import materialize


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z lower-cased."""
    return ascii_lower(F.trim(line, F.lit(SPACE_CHARS)))


def repeated_lines(lines: DataFrame, max_docs: int) -> DataFrame:
    """``key, first_doc`` of the keys that more than ``max_docs`` documents hold.

    Counts are made in two steps, by (key, document) and by key, each with map-side combining: a line that
    stands in a third of all documents comes to its task as one row per map task.
    """
    per_doc = lines.groupBy("key", "id").agg(F.lit(1).alias("one"))
    counted = per_doc.groupBy("key").agg(F.count("one").alias("docs"), F.min("id").alias("first_doc"))
    return counted.filter(F.col("docs") > max_docs).select("key", "first_doc")


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = 10,
                        max_docs: int = 1) -> DataFrame:
    r"""``docs`` without repeated lines, plus ``n_lines`` (before dropping) and ``n_dropped``.

    A text is split at ``\n``; null and empty texts are one empty line and come out empty. Keys of fewer than ``min_chars`` code
    points are never dropped. A key in more than ``max_docs`` documents stays, with all its lines, in the document of the smallest id;
    a null id counts as one document, after all others. Rows that repeat an id are one document: a key within it
    is not repeated by that. An empty table gives an empty table. A column of the input named ``n_lines`` or
    ``n_dropped`` is replaced. Keys are compared by MD5.
    A text of any length is split as a whole, by one task; its lines are then dealt by key.
    """
    # Two rows of one id may hold different texts, so a row's positions go by id and text hash.
    base = packed(docs, id=id_col, fp=F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    text = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    lines = (base.select("id", "fp", F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
             .select("id", "fp", "pos", line_key(F.col("line")).alias("line"))
             .filter(F.length("line") >= min_chars)
             .select("id", "fp", "pos", F.unhex(F.md5("line")).alias("key")))
    # Written, so that the join below has two plain exchanges and Spark can split the task of a hot line.
    repeated = materialize(repeated_lines(lines, max_docs), "repeated-lines")
    dropped = (lines.join(repeated, "key").filter(~F.col("id").eqNullSafe(F.col("first_doc")))
               .groupBy("id", "fp").agg(F.collect_set("pos").alias("gone")))
    same = base["id"].eqNullSafe(dropped["id"]) & (base["fp"] == dropped["fp"])
    out = base.join(dropped, same, "left").select("row", "gone").withColumn("lines", F.split(text, "\n", -1))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.when(F.col("gone").isNull(), text).otherwise(
        F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n"))
    return unpacked(out, docs.columns, **{text_col: kept, "n_lines": F.size("lines").cast("long"),
                                          "n_dropped": F.coalesce(F.size("gone"), F.lit(0)).cast("long")})

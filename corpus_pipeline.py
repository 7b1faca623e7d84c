"""The corpus pipeline: every stage is one operator over all documents that the stage before has kept.

All stages but the last return the columns of ``documents``, and ``n_chars`` follows the text where a stage changes it. The
last gives the mix: one row for each copy taken, with the copy's number. SQL can't express the first stage, so there is no SQL for the whole; tests
hold the stages against brute force.

Texts of any length are worked on as a whole. A null text has no language and goes in the first stage; a null id comes after all others; null languages and
sources are values like others. Columns besides those of ``documents`` go along to the mix, also where they have the name of a result of an operator. No
documents give none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.llm import decontamination, language_id, line_dedup, mixing, ngram_join
from layerwright.session import materialize, new_work_path

#: A document whose language is less sure than this is rejected; of four languages the likeliest has a quarter at least.
LEAST_SCORE = 0.4


#: Columns that the operators add. Those that documents have of these names are put aside meanwhile.
RESULTS = {"held_out", "lang_pred", "score", "n_lines", "n_dropped", "n_shingles", "component_id", "n_words", "n_hit", "item_ids", "hit_runs", "contaminated"}


def aside(docs: DataFrame) -> DataFrame:
    return docs.withColumnsRenamed({c: f"_own_{c}" for c in docs.columns if c.lower() in RESULTS})


def own(docs: DataFrame) -> list[Column]:
    """The columns of documents that were put aside."""
    return [F.col(f"`_own_{c}`").alias(c) if c.lower() in RESULTS else F.col(f"`{c}`") for c in docs.columns]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language is told with a score of ``LEAST_SCORE`` at least. Repeated rows are judged alike."""
    found = language_id.identify(aside(docs))
    return found.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*own(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a document with a smaller id has. One that loses all its lines stays, empty.

    Rows that repeat an id are one document here: they keep what they share with each other.
    """
    kept = line_dedup.drop_repeated_lines(aside(docs)).select(*own(docs))
    return kept.select(*[F.length("text").cast(t).alias(c) if c == "n_chars" else F.col(c) for c, t in docs.dtypes])


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of similar ones: five words, 80 per cent.

    Rows that repeat the smallest id of a group stay where they differ; of equal rows one stays. Of rows without an id, those go that are similar
    to one with an id; those of a group without any id stay, equal ones once.
    """
    found = ngram_join.similar_components(aside(docs), words=5, percent=80)
    kept = found.filter(F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id"))).select(*own(docs))
    repeated = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("again"))
    repeated = materialize(repeated, "repeated-ids")
    if repeated.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(repeated["again"])
    return kept.join(repeated, same, "left_anti").unionByName(kept.join(repeated, same, "left_semi").distinct())


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.contaminated_documents(aside(docs), benchmark).filter("NOT contaminated").select(*own(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight: a row for each copy that is taken."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_repeated_lines),
    ("ngram_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("mix", mixed),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

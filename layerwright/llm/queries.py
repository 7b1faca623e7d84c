"""The contract's queries over the operators of this folder, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerwright.llm import (
    chat_format, decontamination, kneser_ney, language_id, lexical_search, line_dedup, mixing, nearest, ngram_join, periodic_runs, suffix_dedup, token_counts, url_filter,
)
from layerwright.llm import sql as oracle

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = line_dedup.drop_repeated_lines(docs, min_chars=10, max_docs=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


#: The contract's extra conversation: its texts hold an escape and the template's own marks.
EXTRA_CONVERSATION = [(-7, i, role, r"\### Assistant: </turn> ok") for i, role in enumerate(("user", "assistant"))]


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_CONVERSATION, "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.pack(rows.unionByName(extra))).withColumnRenamed("conv", "conv_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, TOKENIZER, limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    plan = mixing.mix_plan(docs, weights=(5, 2, 1), share=1.5, most=2)
    return plan.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


#: The contract's rules: verdict, host, path.
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"),
                                                   ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("blocked"))
    judged = url_filter.judge_urls(pages, pages.join(labels, "page_id"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = suffix_dedup.remove_repeats(docs, least=50)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = ngram_join.similar_sets(docs, words=4, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op9_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest.nearest(rows, F.col("vec_id") % 20 == 0, k=20)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.contaminated_documents(docs, table(spark, sf_dir, "benchmark"), window=13, least_share=20)
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op11_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)
    model = kneser_ney.train(docs.filter("NOT held_out"))
    scored = kneser_ney.score(docs, model)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def planted_periods(docs: DataFrame) -> DataFrame:
    """The contract's texts: of every tenth document, by a hash of its id, the words from one on repeat with a period."""
    by_id = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    words = by_id.withColumn("words", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")))
    shaped = words.withColumn("n", F.size("words")).withColumn("g", F.expr("h DIV 10"))
    shaped = shaped.withColumn("a", F.expr("IF(n > 0, g % n, 0)")).withColumn("p", F.expr("1 + (n - a) DIV (3 + g % 8)"))
    repeated = F.array_join(F.transform("words", lambda w, i: F.when(i < F.col("a"), w).otherwise(
        F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))), " ")
    return shaped.select("doc_id", F.when(F.col("n") > 0, repeated).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(planted_periods(docs))
    ranked = F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"].alias("start"), r["period"].alias("period")))
    found = found.withColumn("best", F.array_min(ranked))
    length = -F.col("best.shorter")
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), length.alias("length"),
                        F.col("best.period").alias("period"), F.floor(F.lit(1000) * length / F.col("best.period")).alias("exponent_milli"),
                        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = lexical_search.ranked_search(docs, table(spark, sf_dir, "benchmark"), k=10)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


QUERIES = {q.__name__: q for q in (op1_line_dedup, op2_chat_format, op3_token_counts, op4_source_mix, op5_url_filter, op6_suffix_dedup, op7_ngram_join, op8_language_id,
                                op9_nearest_vectors, op10_decontamination, op11_kneser_ney, op12_periodic_runs, op13_lexical_search)}
SQL = {
    "op1_line_dedup": oracle.OP1,
    "op2_chat_format": oracle.OP2,
    "op4_source_mix": oracle.OP4,
    "op7_ngram_join": oracle.OP7,
    "op9_nearest_vectors": oracle.OP9,
    "op10_decontamination": oracle.OP10,
    "op13_lexical_search": oracle.OP13,
}

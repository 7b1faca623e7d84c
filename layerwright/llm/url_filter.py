"""URL filter: a list of host and path rules, and association rules mined from labelled URLs for all others.

URLs are sets of tokens. FP-growth finds the token combinations that are frequent among labelled URLs; those that go with
the label ``block`` often enough become rules. A rule is found by an inverted index under its rarest token and
applies when the URL has all its tokens. DataFrame operations and Spark's own FP-growth only.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.llm.common import ascii_lower, packed, unpacked
from layerwright.session import materialize

BLOCKED = "label=block"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path as they stand behind the first ``://``; both empty without one or for null."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)


def url_tokens(host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: the parts of the host and the segments of the path."""
    parts = F.filter(F.split(host, r"\."), lambda x: x != "")
    segments = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.array_distinct(F.concat(F.transform(parts, lambda x: F.concat(F.lit("h:"), x)),
                                     F.transform(segments, lambda x: F.concat(F.lit("p:"), x))))


def token_items(baskets: DataFrame, least: int) -> DataFrame:
    """``token, item, freq`` of the tokens in at least ``least`` baskets; tokens that are in the same baskets are one item.

    The subsets of a basket are the itemsets that FP-growth has to list, so a deep path that many URLs share must not count
    segment by segment. Equal baskets are told by their number and the sum of hashes of their numbers.
    """
    places = baskets.select("basket", F.explode("tokens").alias("token"))
    by_token = places.groupBy("token").agg(
        F.count("*").alias("freq"), F.sum(F.xxhash64("basket").cast("decimal(38,0)")).alias("mark"),
        F.sum(F.xxhash64(F.lit("again"), "basket").cast("decimal(38,0)")).alias("mark2")).filter(F.col("freq") >= least)
    same = by_token.groupBy("freq", "mark", "mark2").agg(F.min("token").alias("item"), F.collect_set("token").alias("token"))
    return same.select(F.explode("token").alias("token"), "item", "freq")


def mined_rules(labelled: DataFrame, min_support: float, min_count: int, min_confidence: float) -> DataFrame:
    """``items, confidence, support, index_item`` and the items' tokens, from ``tokens, blocked``.

    Rules say items -> block with at least ``min_confidence``; the items are in at least ``min_support`` of the baskets and in
    ``min_count`` of them. A rule is pruned when a rule of some of its items is as sure. ``index_item`` is its rarest item.
    """
    baskets = materialize(labelled.withColumn("basket", F.monotonically_increasing_id()), "url-baskets")
    n = baskets.count()
    least = max(min_count, int(-(-n * min_support // 1)))
    items = materialize(token_items(baskets, least), "url-items")
    one = items.filter(F.col("token") == F.col("item"))
    dealt = (baskets.select("basket", "blocked", F.explode("tokens").alias("item")).join(one, "item")
             .groupBy("basket", "blocked").agg(F.collect_set("item").alias("items")))
    dealt = dealt.select(F.when(F.col("blocked"), F.concat("items", F.array(F.lit(BLOCKED)))).otherwise(F.col("items")).alias("items"))
    # Baskets without frequent tokens are gone, so the support is put in terms of those that are left.
    left = dealt.count()
    support = min(1.0, (least - 0.5) / left) if left else 1.0
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(dealt)
    rules = model.associationRules.filter(F.col("consequent") == F.array(F.lit(BLOCKED)))
    rules = materialize(rules.select(F.array_sort("antecedent").alias("items"), "confidence", "support"), "url-rules")
    shorter = rules.select(F.col("items").alias("part"), F.col("confidence").alias("part_confidence"), F.explode("items").alias("item"))
    longer = rules.select("items", "confidence", F.explode("items").alias("item"))
    beaten = (longer.join(shorter, "item")
              .filter((F.size("part") < F.size("items")) & (F.col("part_confidence") >= F.col("confidence")))
              .groupBy("items", "part").agg(F.count("*").alias("shared")).filter(F.col("shared") == F.size("part"))
              .select("items").distinct())
    kept = rules.join(beaten, "items", "left_anti")
    rarest = (kept.select("items", F.explode("items").alias("item")).join(one, "item")
              .groupBy("items").agg(F.min_by("item", F.struct("freq", "item")).alias("index_item")))
    return kept.join(rarest, "items")


def judge_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", *,
               min_support: float = 0.002, min_count: int = 20, min_confidence: float = 0.6) -> DataFrame:
    """``pages`` plus ``host, path, rule, verdict, confidence``.

    ``rules`` are (``allow`` or ``block``, host, path): one fits its host and all subdomains of it if the URL's path starts with
    the rule's; the longest of those that fit gives ``rule`` (host and path) and ``verdict``; of equally long ones the last by rule and verdict, so ``block`` beats
    ``allow`` for the same host and path. URLs of any length are taken whole. For other URLs ``rule`` is null
    and the verdict is ``block`` when a mined rule applies, whose ``confidence`` is the highest of them, else ``allow``. A rule's
    items are in at least ``min_support`` of the labelled URLs and in ``min_count`` of them; tokens that were always
    together there stand for one another, and the first of them has to be in the URL.
    ``labelled`` has ``url`` and ``blocked`` (boolean); null in either is left out. Null URLs and
    URLs without ``://`` have an empty host and path and no tokens. Each distinct URL is judged once; repeated
    rows are all there. Without labelled URLs nothing is mined. Columns of the input with these names are replaced.
    """
    host, path = host_and_path(F.col("url"))
    urls = pages.select(F.col(f"`{url_col}`").alias("url")).distinct()
    urls = materialize(urls.withColumns({"host": host, "path": path}).withColumn("tokens", url_tokens(F.col("host"), F.col("path"))), "urls")
    known = labelled.filter("url IS NOT NULL AND blocked IS NOT NULL").select("url", "blocked")
    known = known.withColumns({"host": host, "path": path}).select(url_tokens(F.col("host"), F.col("path")).alias("tokens"), "blocked")
    mined = mined_rules(known, min_support, min_count, min_confidence)
    index = materialize(mined.select(F.col("index_item").alias("token"), F.col("items").alias("needs"), "confidence"), "url-index")
    applied = (urls.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
               .filter(F.size(F.array_except("needs", "tokens")) == 0)
               .groupBy("url").agg(F.max("confidence").alias("confidence")))
    listed = listed_verdicts(urls.select("url", "host", "path"), rules)
    judged = urls.select("url", "host", "path").join(listed, "url", "left").join(applied, "url", "left")
    verdict = F.coalesce("listed", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
    judged = judged.select("url", "host", "path", "rule", verdict.alias("verdict"), "confidence")
    base = packed(pages, url=url_col)
    out = base.join(judged.withColumnRenamed("url", "judged_url"), F.col("url").eqNullSafe(F.col("judged_url")), "left")
    return unpacked(out, pages.columns, **{c: F.col(c) for c in ("host", "path", "rule", "verdict", "confidence")})


def listed_verdicts(urls: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``url, rule, listed`` of the URLs that a listed rule fits. Rules are looked up by each domain that a host ends with."""
    spark = urls.sparkSession
    table = spark.createDataFrame([(h, p, v) for v, h, p in rules], "rule_host string, rule_path string, listed string")
    parts = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    fits = (urls.select("url", "path", F.explode(F.array_distinct(domains)).alias("rule_host")).join(table, "rule_host")
            .filter(F.startswith("path", "rule_path")))
    rule = F.concat("rule_host", "rule_path")
    return fits.groupBy("url").agg(F.max(F.struct(F.length(rule).alias("n"), rule.alias("rule"), "listed")).alias("best")).select(
        "url", "best.rule", "best.listed")

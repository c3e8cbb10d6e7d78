"""URL filter: association rules mined by FP-growth, matched by an inverted index.

Tokens of a URL are its host labels, path words and query keys. Labelled URLs
become transactions with one more item, ``=bad``; Spark's FP-growth mines them,
and the rules {tokens} -> {=bad} that pass the support and confidence limits are
kept, less those that contain a shorter kept rule. Support is a share and at least
``MIN_COUNT`` bad rows, and the lower Wilson bound (``Z``) of a rule's confidence has
to be above the share of bad rows, at any input size. The index lists a rule under
its rarest token only; a URL meets the rules of its tokens in a join, and a rule
holds if none of its tokens is missing. The caller's own allow and block rules
(host suffix and path prefix, the longest wins) are looked up the same way, by
the URL's host suffixes, and go before the mined verdict.

Both lookups work on the distinct (host, path, query) keys, so copies of a URL
cost one row. Nothing runs in Python; FP-growth's memory on the driver is the
list of frequent items, at most (tokens per URL) / min_support.

Defined results: a null URL or one without ``://`` has empty host and path, no
tokens and verdict allow; repeated rows get equal verdicts; without labels
there are no mined rules; other columns are passed through.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ouzel.llm.common import lower_ascii, table

BAD = "=bad"
MIN_COUNT = 10   # bad rows behind a rule
Z = 3.0          # standard errors between a rule's confidence and the base rate
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query) as the rules see them."""
    u = F.coalesce(url, F.lit(""))
    part = lambda rx: F.regexp_extract(u, r"(?s)^.*?://" + rx, 1)
    return (lower_ascii(part(r"([^/?#]*)")), part(r"[^/?#]*([^?#]*)"), part(r"[^?#]*\?([^#]*)"))


def url_tokens(host: Column, path: Column, query: Column) -> Column:
    """Distinct tokens: host labels, path words, names of query fields."""
    def tagged(tag: str, words: Column) -> Column:
        return F.transform(F.filter(words, lambda w: F.length(w) > 0), lambda w: F.concat(F.lit(tag), w))
    names = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    return F.array_distinct(F.concat(
        tagged("h:", F.split(host, r"\.")), tagged("p:", F.split(lower_ascii(path), "[^a-z0-9]+")),
        tagged("q:", lower_ascii_all(names))))


def lower_ascii_all(words: Column) -> Column:
    return F.transform(words, lower_ascii)


def wilson_low(hits: Column, n: Column, z: float) -> Column:
    """Lower Wilson bound of the share hits / n."""
    p, zz = hits / n, z * z
    return (p + zz / (2 * n) - z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n))) / (1 + zz / n)


def mine_rules(labelled: DataFrame, min_support: float, min_confidence: float, partitions: int,
               min_count: int = MIN_COUNT, z: float = Z) -> DataFrame:
    """(rule_id, antecedent, confidence, support) from rows (tokens, bad boolean)."""
    spark = labelled.sparkSession
    items = labelled.select(F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD))))
                            .otherwise(F.col("tokens")).alias("items"))
    empty = spark.createDataFrame([], "rule_id long, antecedent array<string>, confidence double, support double")
    total, bad = labelled.agg(F.count("*"), F.count_if("bad")).first()
    least = max(math.ceil(min_support * total), min_count)
    if bad < least:
        return empty
    # FP-growth rounds minSupport * total up: half a row less gives ``least`` itself
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / total, minConfidence=min_confidence,
                     numPartitions=partitions).fit(items)
    hits = F.round(F.col("support") * total)
    rules = (model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD)))
             .where(wilson_low(hits, F.round(hits / F.col("confidence")), z) > bad / total)
             .select(F.array_sort("antecedent").alias("antecedent"), "confidence", "support")
             .withColumn("rule_id", F.xxhash64("antecedent")))
    # a rule goes if one of its proper, shorter subsets is a rule: looked up by dropping one token at a time
    shorter = (rules.select("rule_id", F.explode("antecedent").alias("out"), "antecedent")
               .select("rule_id", F.xxhash64(F.array_remove("antecedent", F.col("out"))).alias("sub")))
    covered = shorter.join(rules.select(F.col("rule_id").alias("sub")), "sub", "left_semi").select("rule_id")
    return rules.join(covered, "rule_id", "left_anti").select("rule_id", "antecedent", "confidence", "support")


def matched(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct rows of ``keys`` (key, tokens) that some mined rule fits."""
    per_rule = rules.select("rule_id", "antecedent", F.explode("antecedent").alias("token"))
    common = keys.select(F.explode("tokens").alias("token")).groupBy("token").count()
    index = (per_rule.join(common, "token", "left")
             .groupBy("rule_id").agg(F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token")).alias("token"),
                                     F.first("antecedent").alias("antecedent")))
    return (keys.select("key", "tokens", F.explode("tokens").alias("token")).join(index, "token")
            .where(F.size(F.array_except("antecedent", "tokens")) == 0).select("key").distinct())


def fitting_rule(keys: DataFrame, rules: DataFrame, max_labels: int) -> DataFrame:
    """The longest of the caller's rules for each key that has one: (key, rule, action)."""
    labels = F.split("host", r"\.")
    n = F.size(labels)
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(max_labels))),
                           lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    return (keys.select("key", "path", F.explode(suffixes).alias("rule_host"))
            .join(rules, "rule_host").where(F.startswith("path", F.col("rule_path")))
            .select("key", F.concat("rule_host", "rule_path").alias("rule"), "action")
            .groupBy("key").agg(F.max(F.struct(F.length("rule").alias("n"), (F.col("action") == "block").alias("b"),
                                               "rule", "action")).alias("best"))
            .select("key", "best.rule", "best.action"))


def filter_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str, str]], url: str = "url",
                min_support: float = 0.002, min_confidence: float = 0.6, out: str = "url_filter",
                min_count: int = MIN_COUNT, z: float = Z) -> DataFrame:
    """``pages`` with a struct column ``out`` (host, path, rule, verdict, mined), in place of one of that name.

    ``labelled``: rows (url, bad boolean). ``rules``: (action, host, path prefix).
    ``mined`` says whether a mined rule fits, also where the caller's rule decides.
    ``min_count``, ``z``: the least number of bad rows of a mined rule, and its distance from the base rate.
    """
    spark, pages = pages.sparkSession, pages.drop(out)
    host, path, query = url_parts(F.col(url))
    of = lambda df: df.select(F.struct(host.alias("host"), path.alias("path"), query.alias("query")).alias("key"))
    tokens = url_tokens(F.col("key.host"), F.col("key.path"), F.col("key.query"))
    keys = of(pages).distinct().select("key", "key.host", "key.path", tokens.alias("tokens"))

    known = labelled.where(F.col("bad").isNotNull()).select(F.struct(*[
        c.alias(n) for c, n in zip(url_parts(F.col("url")), ("host", "path", "query"))]).alias("key"), "bad")
    mined = mine_rules(known.select(tokens.alias("tokens"), "bad"), min_support, min_confidence,
                       int(spark.conf.get("spark.sql.shuffle.partitions")), min_count, z)
    own = spark.createDataFrame([(h, p, a) for a, h, p in rules],
                                "rule_host string, rule_path string, action string")
    most = max((h.count(".") + 1 for _, h, _ in rules), default=1)
    verdicts = (keys.select("key")
                .join(matched(keys.select("key", "tokens"), mined).withColumn("mined", F.lit(True)), "key", "left")
                .join(fitting_rule(keys, own, most), "key", "left"))
    # tagged with the caller's rows after the lookups, on plain keys: the hot ones can be split by AQE
    tagged = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
                          F.struct(host.alias("host"), path.alias("path"), query.alias("query")).alias("key"))
    judged = tagged.join(verdicts, "key", "left")
    mined_flag = F.coalesce("mined", F.lit(False))
    verdict = F.coalesce("action", F.when(mined_flag, F.lit("block")).otherwise(F.lit("allow")))
    return judged.select(*[F.col(f"row.`{c}`") for c in pages.columns],
                      F.struct(F.col("key.host").alias("host"), F.col("key.path").alias("path"), F.col("rule"),
                               verdict.alias("verdict"), mined_flag.alias("mined")).alias(out))


def labelled_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, bad): a page is labelled by the row of ``labels`` with its id; bad is low quality.

    ``labels`` covers documents and no table ties a document to a page: the ids are all there is.
    """
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).alias("bad"))
    return table(spark, sf_dir, "pages").select("page_id", "url").join(labels, "page_id").select("url", "bad")


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = filter_urls(pages, labelled_urls(spark, sf_dir), RULES)
    return out.select("page_id", "url_filter.host", "url_filter.path", "url_filter.rule", "url_filter.verdict",
                      "url_filter.mined")

"""Judge URLs by given prefix rules, else by association rules mined from labels."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatpulse.llm.common import write_once

#: (verdict, host, path prefix). A rule fits its host and all subdomains; the longest fitting one wins.
PREFIX_RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "\u0001bad"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(_rest(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules=PREFIX_RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest fitting rule, null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for kind, name, prefix in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        rule = F.when(fits, F.lit(name + prefix)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column) -> Column:
    """Distinct tokens: host labels and host suffixes, path and query words, each with its place."""
    host, rest = host_of(url), F.coalesce(_rest(url), F.lit(""))
    labels = F.filter(F.split(host, r"\."), lambda t: t != "")
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    words = F.filter(F.split(F.translate(after, UPPER, LOWER), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    tokens = F.concat(
        F.transform(labels, lambda t: F.concat(F.lit("h:"), t)), F.transform(words, lambda t: F.concat(F.lit("p:"), t))
    )
    return F.array_distinct(F.when(url.isNull(), F.array().cast("array<string>")).otherwise(tokens))


def _telling_tokens(rows: DataFrame, least: int) -> DataFrame:
    """(token) of tokens that at least ``least`` bad rows hold; one of those that the very same rows hold.

    Rows are told apart by sums of their hashes. Tokens that always come together, such as the words of
    a path that many urls share, would give a rule for each of their combinations.
    """
    held = rows.select("bad", F.xxhash64("page_id", "url").cast("decimal(38,0)").alias("row"), F.explode("items").alias("token"))
    counted = held.groupBy("token").agg(F.count("*").alias("n"), F.sum("bad").alias("n_bad"), F.sum("row").alias("rows"))
    return counted.where(F.col("n_bad") >= least).groupBy("n", "rows").agg(F.min("token").alias("token")).select("token")


def beyond_chance(n_rows: Column, share: Column, base: float, tried: int, error: float = 0.05) -> Column:
    """Whether so many bad rows among ``n_rows`` are too many for chance, by Chernoff's bound, which lies above the exact probability.

    The bound is held against ``error`` divided by the number of combinations ``tried``.
    """
    base = min(max(base, 1e-9), 1 - 1e-9)
    other = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
    return (share > base) & (n_rows * (share * F.log(share / base) + other) >= float(math.log(max(tried, 1) / error)))


def mine_rules(
    pages: DataFrame,
    labels: DataFrame,
    min_support: float = 0.002,
    min_rows: int = 10,
    min_confidence: float = 0.5,
    min_lift: float = 1.5,
    train_rows: int = 200_000,
) -> DataFrame:
    """Rules (tokens, confidence, support) whose consequent is a bad label.

    A page labelled low quality or toxic (under the id it shares with ``labels``) is bad. The
    training rows are about ``train_rows`` labelled pages, taken by hash of id and url, with all
    their tokens. A combination counts if at least ``min_support`` of the rows and ``min_rows`` rows hold it
    and are bad; tokens that fewer bad rows hold can be part of none and are dropped first, and of
    tokens in the same rows one stands for all. A rule must have more bad rows than chance allows
    (``beyond_chance``, corrected for the combinations tried), and is left out if a rule on part of its
    tokens is as sure (``prune_rules``). FP-growth and rule generation run on the executors' JVMs.
    """
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")).alias("bad")
    )
    rows = pages.select("page_id", "url").join(marks.where(F.col("bad").isNotNull()), "page_id")
    everything = rows.count()
    if everything > train_rows:
        part = int(train_rows / everything * (1 << 30))
        rows = rows.where(F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < part)
    rows = write_once(rows.withColumn("items", url_tokens(F.col("url"))), "url-training")
    known = rows.agg(F.count("*"), F.sum("bad")).first()
    n, base = known[0], (known[1] or 0) / max(known[0], 1)
    least = max(min_rows, math.ceil(min_support * n))
    spread = rows.select("page_id", "url", "bad", F.explode("items").alias("token"))
    telling = spread.join(_telling_tokens(rows, least), "token", "left_semi")
    held = telling.groupBy("page_id", "url", "bad").agg(F.collect_set("token").alias("items"))
    baskets = held.select(F.when(F.col("bad") == 1, F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items"))
    baskets = write_once(baskets, "url-baskets")
    size = max(baskets.count(), 1)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, least / size), minConfidence=min_confidence).fit(baskets)
    tried = model.freqItemsets.where(~F.array_contains("items", BAD)).count()
    found = model.associationRules.where((F.element_at("consequent", 1) == BAD) & (F.col("confidence") >= min_lift * base))
    holders = F.col("support") * size / F.col("confidence")
    return found.where(beyond_chance(holders, F.col("confidence"), base, tried)).select(
        F.array_sort("antecedent").alias("tokens"), "confidence", (F.col("support") * size / max(n, 1)).alias("support")
    )


def prune_rules(rules: DataFrame) -> DataFrame:
    """Drop a rule if another one on some of its tokens has at least its confidence."""
    posted = rules.select("tokens", "confidence", F.explode("tokens").alias("token"))
    wider = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("sure"), F.element_at("tokens", 1).alias("token"))
    inside = F.size(F.array_except("part", "tokens")) == 0
    beaten = posted.join(wider, "token").where(
        inside & (F.size("part") < F.size("tokens")) & (F.col("sure") >= F.col("confidence"))
    )
    return rules.join(beaten.select("tokens").distinct(), "tokens", "left_anti")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, confidence) of the surest rule all of whose tokens a url has, by an inverted index.

    A rule is posted under its rarest token among the rules' own, so that common tokens
    hold short posting lists; a url looks its tokens up and the rest of a rule is checked
    on the spot.
    """
    use = rules.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("uses"))
    spread = rules.select("tokens", "confidence", F.explode("tokens").alias("token")).join(use, "token")
    index = spread.groupBy("tokens", "confidence").agg(F.min_by("token", F.struct("uses", "token")).alias("token"))
    known = urls.select("url", url_tokens(F.col("url")).alias("has"))
    looked = known.select("url", "has", F.explode("has").alias("token")).join(index, "token")
    fits = looked.where(F.size(F.array_except("tokens", "has")) == 0)
    return fits.groupBy("url").agg(F.max("confidence").alias("confidence"))


def judge_urls(pages: DataFrame, labels: DataFrame, prefix_rules=PREFIX_RULES, **mining) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, confidence.

    A prefix rule decides where one fits. Other urls are blocked if a mined rule fits and
    allowed if none does. Each distinct url is matched once; pages then take its result, so
    a url that a third of all pages share costs no more than another (the last join is left
    to the skew-join split). A null url or one without ``://`` has empty host and path and is
    allowed; null and repeated ids keep their rows; without labels nothing is mined and all
    is allowed; an empty table gives no rows.
    """
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    rule, verdict = longest_rule(F.col("host"), F.col("path"), prefix_rules)
    parts = pages.select("page_id", url.cast("string").alias("url")).select(
        "page_id", "url", host.alias("host"), path.alias("path")
    ).withColumn("rule", rule).withColumn("given", verdict)
    open_urls = parts.where(F.col("given").isNull() & F.col("url").isNotNull()).select("url").distinct()
    matched = match_rules(open_urls, prune_rules(mine_rules(pages, labels, **mining)))
    judged = parts.join(matched, "url", "left")
    by_method = F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("given", by_method).alias("verdict"), "confidence")

"""URL filter: fixed host rules first, then association rules mined by FP-growth.

Tokens of a URL: scheme, host labels, the host's last two labels, path segments (numbers as ``#``), file extension, query keys, fragment.
Labels come from documents; which document a page belongs to is the ``link`` column, by default the first number in the URL's path.
A rule is a set of tokens that at least ``SUPPORT`` of the labelled pages (and ``LEAST`` of them) hold together with the block label, with
``CONFIDENCE`` and ``LIFT``. A URL is blocked if it holds all tokens of some rule, so only rules without a smaller one inside are kept:

* tokens that are a rule alone are found by counting and leave the sets, as do tokens that all labelled pages have or too few blocked ones;
* tokens that are on the same labelled pages (by two 64-bit hash sums over the pages) count as one item: any of them stands for it;
* Spark's FP-growth finds the frequent sets of items of the blocked pages; how many allowed pages hold them is counted by inverted index.

Rules match by inverted index too: each is listed under its rarest item and meets only URLs that have it.

Defined cases: null URL and URL without ``://`` have empty host and path and no token, so no rule and verdict allow; with fewer than ``LEAST``
blocked pages nothing is mined; several labels of a document count as bad if one is; rows that repeat get equal results; empty table: empty result; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from tidewell.llm.common import ascii_lower, saved

# Verdict, host, path prefix.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))
SUPPORT, LEAST, CONFIDENCE, LIFT = 0.002, 10, 0.6, 1.5


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column) -> tuple[Column, Column]:
    """The longest rule that fits, written host then path, and its verdict; nulls where none does."""
    name = verdict = F.lit(None).cast("string")
    for what, h, p in sorted(RULES, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL; none without ``://``."""
    host, path = host_of(url), path_of(url)
    query, fragment = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1), F.regexp_extract(url, r"(?s)#(.*)$", 1)
    filled = lambda c: F.filter(c, lambda x: x != "")
    parts = F.concat(
        F.array(F.concat(F.lit("scheme="), F.regexp_extract(url, r"^([A-Za-z0-9+.-]*)://", 1))),
        F.transform(filled(F.split(host, r"\.")), lambda x: F.concat(F.lit("host="), x)),
        F.array(F.concat(F.lit("site="), F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1))),
        F.transform(filled(F.split(path, "/")), lambda x: F.concat(F.lit("path="), F.regexp_replace(x, "[0-9]+", "#"))),
        F.array(F.concat(F.lit("ext="), F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))),
        F.transform(filled(F.split(query, "&")), lambda x: F.concat(F.lit("key="), F.substring_index(x, "=", 1))),
        F.array(F.concat(F.lit("fragment="), fragment)),
    )
    return F.array_distinct(F.filter(F.when(F.coalesce(url, F.lit("")).contains("://"), parts).otherwise(F.array().cast("array<string>")), lambda x: ~x.endswith("=")))


def linked_document(url: Column) -> Column:
    """The first number in the path."""
    return F.regexp_extract(path_of(url), r"/([0-9]{1,18})(?:[^0-9]|$)", 1).try_cast("long")


def holders(sets: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, rule) where the set ``has`` of ``key`` holds all of the rule's ``wants``; a rule meets the sets with its rarest item only."""
    found = sets.select("key", "has", F.explode("has").alias("t"))
    listed = wanted.select("rule", "wants", F.explode("wants").alias("t"))
    often = found.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    rarest = listed.join(often, "t").groupBy("rule").agg(F.min_by("t", F.struct("n", "t")).alias("t"), F.first("wants").alias("wants"))
    return found.join(rarest, "t").where(F.size(F.array_except("wants", "has")) == 0).select("key", "rule")


def labelled(pages: DataFrame, labels: DataFrame, link: Column | None = None) -> DataFrame:
    """(key, bad, tokens) of the pages whose document has labels; a document is bad if one of its labels is."""
    one_bad = F.coalesce(F.col("toxic") == 1, F.lit(False)) | F.coalesce(F.col("quality") == 0, F.lit(False))
    bad = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(one_bad).alias("bad"))
    link = linked_document(F.col("url")) if link is None else link
    linked = pages.where("url IS NOT NULL").select("url", link.alias("doc_id")).join(bad, "doc_id")
    return saved(linked.select(F.monotonically_increasing_id().alias("key"), "bad", tokens(F.col("url")).alias("tokens")), "baskets")


def mine(baskets: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, lift: float = LIFT) -> tuple[DataFrame, DataFrame]:
    """((rule, wants), (token, item)): the smallest sets of items that imply the block label, and the items of the tokens."""
    spark = baskets.sparkSession
    total, bad = baskets.agg(F.count(F.lit(1)), F.coalesce(F.count_if("bad"), F.lit(0))).first()
    least = max(math.ceil(support * total), LEAST)
    if bad < least:
        return spark.createDataFrame([], "rule long, wants array<string>"), spark.createDataFrame([], "token string, item string")
    sure = F.lit(max(confidence, lift * bad / total) - 1e-12)
    held = baskets.select("key", "bad", F.explode("tokens").alias("token"))
    places = [F.bit_xor(F.xxhash64("key", F.lit(seed))).alias(f"x{seed}") for seed in (0, 1)]
    stats = held.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("bad"), *places)
    # at most (tokens of a page) / SUPPORT rows from here on
    stats = saved(stats.where((F.col("bad") >= least) & (F.col("n") < total)), "tokens")
    alone = stats.where(F.col("bad") / F.col("n") >= sure).select("token", F.col("token").alias("item"))
    rest = stats.where(F.col("bad") / F.col("n") < sure)
    merged = rest.groupBy("n", "x0", "x1").agg(F.min("token").alias("item"), F.collect_list("token").alias("token"))
    merged = saved(merged.select(F.explode("token").alias("token"), "item"), "items")
    sets = saved(held.join(merged, "token").groupBy("key", "bad").agg(F.collect_set("item").alias("has")), "sets")
    model = FPGrowth(itemsCol="has", minSupport=min(1.0, (least - 0.5) / bad)).fit(sets.where("bad").select("has"))
    often = model.freqItemsets.where(F.size("items") > 1).select(F.monotonically_increasing_id().alias("rule"), F.array_sort("items").alias("wants"), "freq")
    often = saved(often, "frequent")
    allowed = holders(sets.where("not bad"), often).groupBy("rule").agg(F.count(F.lit(1)).alias("allowed"))
    rules = often.join(allowed, "rule", "left").where(F.col("freq") / (F.col("freq") + F.coalesce("allowed", F.lit(0))) >= sure)
    rules = saved(rules.select("rule", "wants"), "rules")
    # a smaller rule inside is listed under its first item, which the larger one has
    inside = rules.select(F.col("wants")[0].alias("t"), F.col("wants").alias("part"))
    larger = rules.select("rule", "wants", F.explode("wants").alias("t")).join(inside, "t")
    larger = larger.where((F.size("part") < F.size("wants")) & (F.size(F.array_except("part", "wants")) == 0))
    smallest = rules.join(larger.select("rule").distinct(), "rule", "left_anti")
    single = alone.select((-F.monotonically_increasing_id() - 1).alias("rule"), F.array("item").alias("wants"))
    return saved(smallest.unionByName(single), "url-rules"), alone.unionByName(merged)


def matched(urls: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """The URLs, each once, that hold all items of a rule."""
    used = items.join(rules.select(F.explode("wants").alias("item")).distinct(), "item")
    held = urls.select("url", F.explode(tokens(F.col("url"))).alias("token")).join(used, "token")
    sets = held.groupBy(F.col("url").alias("key")).agg(F.collect_set("item").alias("has"))
    return holders(sets, rules).select(F.col("key").alias("url")).distinct()


def judge(pages: DataFrame, labels: DataFrame, link: Column | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every page. ``link``: the document of a page, as an expression over ``pages``."""
    rules, items = mine(labelled(pages, labels, link))
    thin = pages.select("page_id", "url")
    known = thin.where("url IS NOT NULL")
    blocked = matched(known.select("url").distinct(), rules, items).select(F.col("url").alias("blocked"))
    both = known.join(blocked, F.col("url") == F.col("blocked"), "left").unionByName(thin.where("url IS NULL").withColumn("blocked", F.lit(None).cast("string")))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, verdict = fixed_rule(host, path)
    mined = F.when(F.col("blocked").isNotNull(), "block").otherwise("allow")
    return both.select("page_id", host.alias("host"), path.alias("path"), rule.alias("rule"), F.coalesce(verdict, mined).alias("verdict"))

"""Joins that are operators of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def join_tags(actions: DataFrame, item_tags: DataFrame) -> DataFrame:
    """Actions with item attributes; adaptive execution picks broadcast or a skew-split sort-merge join."""
    return actions.join(item_tags, "item_id")


def semi(df: DataFrame, users: DataFrame) -> DataFrame:
    return df.join(users.select("user_id"), "user_id", "left_semi")


def referrer_clusters(visits: DataFrame, mapping: DataFrame) -> DataFrame:
    """Clusters whose referrer is a prefix of the visit's referrer.

    Turned into an equi-join: only prefix lengths that occur in the mapping are cut from each visit,
    so no visit meets a mapping row it does not match. ``mapping`` holds ``(prefix, cluster_id)``.
    """
    sized = mapping.withColumn("_len", F.length("prefix"))
    lengths = sized.agg(F.collect_set("_len")).scalar()  # at most as many as a URL has characters
    cut = visits.withColumn("_len", F.explode(lengths)).where(F.col("_len") <= F.length("referrer"))
    cut = cut.withColumn("prefix", F.substring(F.col("referrer"), F.lit(1), F.col("_len")))
    return cut.join(sized, ["_len", "prefix"]).drop("_len", "prefix")


def explain(recs: DataFrame, texts: DataFrame, locale: str, default_algo: str = "default") -> DataFrame:
    """Explanation per (algorithm, locale) with the locale's default row as fallback. ``texts``: algo, locale, text."""
    mine = texts.where(F.col("locale") == locale)
    fallback = mine.where(F.col("algo") == default_algo).agg(F.first("text")).scalar()
    own = mine.where(F.col("algo") != default_algo).select("algo", "text")
    return recs.join(own, "algo", "left").withColumn("text", F.coalesce("text", fallback))

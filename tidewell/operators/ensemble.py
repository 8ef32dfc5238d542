"""Combining recommenders, A/B assignment and diversification.

Recommendation frames carry ``user_id, item_id, score, algo, ord`` (``ord`` = position of the algorithm).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewell.functions.hashing import hash_bits, hash_share
from tidewell.operators.topk import topk_by

COMBINERS: dict[str, Callable[..., DataFrame]] = {}


def register_combiner(name: str, fn: Callable[..., DataFrame]) -> None:
    COMBINERS[name] = fn


def tagged(recs: DataFrame, algo: str, position: int) -> DataFrame:
    return recs.select("user_id", "item_id", F.col("score").cast("double").alias("score"), F.lit(algo).alias("algo"), F.lit(position).alias("ord"))


def combine_first(recs: DataFrame, k: int) -> DataFrame:
    """First algorithm giving at least ``k`` results, else the longest list (the earliest wins ties)."""
    sizes = recs.groupBy("user_id", "ord").agg(F.count("*").alias("n"))
    full = F.col("n") >= k
    best = sizes.groupBy("user_id").agg(F.min(F.struct(F.when(full, 0).otherwise(1), F.when(full, 0).otherwise(-F.col("n")), "ord")).alias("b"))
    chosen = best.select("user_id", F.col("b.ord").alias("ord"))
    return topk_by(recs.join(chosen, ["user_id", "ord"]), "user_id", k).select("user_id", "item_id", "score", "algo")


def combine_rank_sum(recs: DataFrame, k: int, strict: bool = False) -> DataFrame:
    """Sum of ``k - rank`` over algorithms for the first ``k`` ranks; strict: only algorithms with at least ``k`` results."""
    if strict:
        full = recs.groupBy("user_id", "ord").agg(F.count("*").alias("n")).where(F.col("n") >= k).select("user_id", "ord")
        recs = recs.join(full, ["user_id", "ord"], "left_semi")
    ranked = topk_by(recs, ["user_id", "ord"], k, rank="_r")
    sums = ranked.groupBy("user_id", "item_id").agg(F.sum(k - (F.col("_r") - 1)).cast("double").alias("score"), _algos())
    return sums.select("user_id", "item_id", "score", "algo")


def combine_score(recs: DataFrame, k: int, first_seen: bool = False) -> DataFrame:
    """Union of items by their best score, or by the score of the first algorithm that listed them."""
    score = F.min_by("score", "ord") if first_seen else F.max("score")
    return topk_by(recs.groupBy("user_id", "item_id").agg(score.alias("score"), _algos()), "user_id", k).select("user_id", "item_id", "score", "algo")


def _algos() -> Column:
    return F.array_join(F.array_sort(F.collect_set("algo")), ":").alias("algo")


register_combiner("first", combine_first)
register_combiner("rank_sum", combine_rank_sum)
register_combiner("score", combine_score)


def ensemble(specs: list[tuple[str, DataFrame]], combiner: str, k: int, **options) -> DataFrame:
    """Run algorithms in order, combine, cut to ``k``; ``algo`` names the contributors."""
    union = reduce(DataFrame.unionByName, [tagged(r, name, i) for i, (name, r) in enumerate(specs)])
    return topk_by(COMBINERS[combiner](union, k, **options), "user_id", k)


def _variation(value: Column, ratios: dict[str, float], decimals: int | None = None) -> Column:
    """First variation whose normalised cumulative ratio reaches ``value``; a handful of ratios becomes one CASE."""
    total = sum(ratios.values())
    upper, out = 0.0, None
    names = list(ratios)
    for i, name in enumerate(names):
        upper += ratios[name] / total
        bound = 1.0 if i == len(names) - 1 else (round(upper, decimals) if decimals else upper)
        out = F.when(value <= bound, F.lit(name)) if out is None else out.when(value <= bound, F.lit(name))
    return out


def ab_assign(users: DataFrame, ratios: dict[str, float], seed: int = 0) -> DataFrame:
    """User to variation by hash bucket 1..100 over cumulative ratios; stable per user."""
    bucket = F.pmod(hash_bits("user_id", seed), F.lit(100)) + 1
    return users.withColumn("variation", _variation(bucket / F.lit(100), ratios, 5))


def random_variation(requests: DataFrame, ratios: dict[str, float], seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """Random variation per request: a hash of its ``key`` columns (all by default), so a retried task draws the same."""
    return requests.withColumn("variation", _variation(hash_share(key or requests.columns, seed), ratios))


def tag_strategy(requests: DataFrame, strategies: DataFrame, default: str) -> DataFrame:
    """Strategy by recommendation tag with a default."""
    return requests.join(strategies.select("tag", "strategy"), "tag", "left").withColumn("strategy", F.coalesce("strategy", F.lit(default)))


def list_hash(recs: DataFrame, k: int) -> DataFrame:
    """Fingerprint of every user's top ``k`` list."""
    top = topk_by(recs, "user_id", k)
    entry = F.format_string("%d=%d", "item_id", F.round(F.col("score") * 1e6).cast("long"))
    return top.groupBy("user_id").agg(F.md5(F.array_join(F.array_sort(F.collect_list(entry)), ",").cast("binary")).alias("shown_hash"))


def diversify(recs: DataFrame, k: int, level: int, shown: DataFrame, seed: int = 42) -> DataFrame:
    """Top ``k`` items, or ``k`` random ones of the top ``k*level`` where the same list was shown before.

    ``shown``: ``user_id, shown_hash``. Score order is kept. The draw is a seeded hash, so a rerun repeats it.
    """
    again = list_hash(recs, k).join(shown.select("user_id", "shown_hash"), ["user_id", "shown_hash"], "left_semi").select("user_id", F.lit(1).alias("_again"))
    pool = topk_by(recs, "user_id", k * level, rank="_r").join(again, "user_id", "left")
    draw = F.when(F.col("_again") == 1, hash_bits(F.concat_ws(":", F.col("user_id").cast("string"), F.col("item_id").cast("string")), seed)).otherwise(F.col("_r").cast("long"))
    picked = pool.withColumn("_p", F.row_number().over(W.partitionBy("user_id").orderBy(draw, "item_id"))).where(F.col("_p") <= k)
    return picked.select("user_id", "item_id", "score")

"""Item similarity from shared users or documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.functions.hashing import hash_share
from tidewell.operators.filters import filter_items
from tidewell.operators.skew import cooccurrence_candidates, shared_counts, with_key_count
from tidewell.operators.topk import topk_by

NO_LIMIT = 2**63 - 1


def _user_items(actions: DataFrame, min_users: int, max_users: int | None, min_items: int) -> DataFrame:
    ui = filter_items(actions, min_users, NO_LIMIT if max_users is None else max_users).where("item_id > 0")
    if min_items > 0:
        ui = with_key_count(ui, ["user_id"], "_n").where(F.col("_n") >= min_items).drop("_n")
    return ui


def item_similarity(
    actions: DataFrame,
    limit: int = 100,
    min_users: int = 0,
    max_users: int | None = None,
    min_items: int = 0,
    threshold: float = 0.0,
    both: bool = False,
    hot_size: int = 2000,
) -> DataFrame:
    """Exact item cosine over 0/1 user vectors: ``n_ab / sqrt(n_a * n_b)``.

    Each pair is listed under its smaller id, the best ``limit`` per first item; ``both`` lists every item's
    best partners. ``threshold`` drops weaker pairs.
    """
    ui = _user_items(actions, min_users, max_users, min_items)
    members = ui.select(F.col("user_id").alias("grp"), F.col("item_id").alias("item"))
    pairs = cooccurrence_candidates(members, limit, hot_size=hot_size, upper=not both)
    scored = pairs.select("item_a", "item_b", (F.col("shared") / F.sqrt((F.col("n_a") * F.col("n_b")).cast("double"))).alias("score"))
    return topk_by(scored.where(F.col("score") >= threshold), "item_a", limit, tie="item_b")


def item_similarity_sampled(actions: DataFrame, limit: int, threshold: float, seed: int = 42, **bounds) -> DataFrame:
    """Sampled cosine for pairs above ``threshold``, in the way of all-pairs dimension-independent sampling.

    A (user, item) cell stays with probability ``min(1, g / |item|)``, ``g = sqrt(10 * ln(items) / threshold)``, and
    counts ``1 / min(g, |item|)``, so popular items shrink while pairs above the threshold keep their expected score.
    The draw is a hash of the cell.
    """
    ui = _user_items(actions, bounds.get("min_users", 0), bounds.get("max_users"), bounds.get("min_items", 0))
    sized = with_key_count(ui, ["item_id"], "n").withColumn("norm", F.sqrt(F.col("n").cast("double")))
    g = F.sqrt(10.0 * F.log(ui.agg(F.countDistinct("item_id")).scalar()) / threshold)
    kept = sized.where(hash_share(["user_id", "item_id"], seed) < g / F.col("norm"))
    pairs = shared_counts(kept.select(F.col("user_id").alias("grp"), F.col("item_id").alias("item")))
    scale = sized.select("item_id", F.least(g, "norm").alias("s")).dropDuplicates(["item_id"])
    scored = pairs.join(scale.toDF("item_a", "sa"), "item_a").join(scale.toDF("item_b", "sb"), "item_b")
    sim = scored.select("item_a", "item_b", (F.col("shared") / (F.col("sa") * F.col("sb"))).alias("score"))
    return topk_by(sim.withColumn("_s", F.round("score", 10)), "item_a", limit, score="_s", tie="item_b").drop("_s")


def cooccurrence(user_items: DataFrame, n: int, hot_size: int = 2000) -> DataFrame:
    """Top ``n`` partners per item by the number of users who have both."""
    members = user_items.select(F.col("user_id").alias("grp"), F.col("item_id").alias("item"))
    pairs = cooccurrence_candidates(members, n, tie="id", hot_size=hot_size)
    return topk_by(pairs.select("item_a", "item_b", F.col("shared").alias("score")), "item_a", n, tie="item_b")


def tag_knn(
    doc_tags: DataFrame,
    k: int,
    metric: str = "jaccard",
    max_share: float = 0.1,
    min_size: int = 25,
    min_score: float = 0.0,
    hot_size: int = 2000,
) -> DataFrame:
    """Nearest tags by the documents they share.

    Jaccard is 0 when the first tag's documents exceed ``max_share`` of the number of tags; the asymmetric
    score ``shared / n_b`` is 0 when the second tag has fewer than ``min_size`` documents; ``both`` adds them.
    All rise with the overlap and fall with ``n_b`` on either side of ``min_size``.
    """
    pairs = doc_tags.select(F.col("doc_id").alias("grp"), F.col("tag").alias("item")).dropDuplicates()
    n_tags = doc_tags.agg(F.countDistinct("tag")).scalar()
    jac = F.when(F.col("n_a") / n_tags <= max_share, F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared"))).otherwise(0.0)
    asym = F.when(F.col("n_b") >= min_size, F.col("shared") / F.col("n_b")).otherwise(0.0)
    score = {"jaccard": jac, "asym": asym, "both": jac + asym}[metric]
    candidates = cooccurrence_candidates(pairs, k, hot_size=hot_size, split_at=None if metric == "jaccard" else min_size)
    scored = candidates.select("item_a", "item_b", score.alias("score")).where((F.col("score") > 0) & (F.col("score") >= min_score))
    return topk_by(scored, "item_a", k, tie="item_b").select(F.col("item_a").alias("tag"), F.col("item_b").alias("other"), "score")

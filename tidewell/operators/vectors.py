"""Term and document search, pair scores and list ordering on vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidewell.functions.scalars import cosine
from tidewell.operators.nearest import all_scores, nearest
from tidewell.operators.topk import rescale_topk, topk_by


def search(queries: DataFrame, target: DataFrame, k: int, exclude: DataFrame | None = None, include: DataFrame | None = None, min_id: int | None = None) -> DataFrame:
    """Nearest vectors of ``target`` per query; ``include`` (``item_id``) and ``min_id`` limit the target first.

    ``exclude`` (``query_id, item_id``): a query asks for as many rows more as it excludes, so its top ``k`` stays whole.
    """
    if include is not None:
        target = target.join(include.select("item_id"), "item_id", "left_semi")
    if min_id is not None:
        target = target.where(F.col("item_id") >= min_id)
    if exclude is None:
        return nearest(queries, target, k)
    return nearest_unseen(queries, target, exclude, k)


def nearest_unseen(queries: DataFrame, vectors: DataFrame, seen: DataFrame, k: int, metric: str = "cosine") -> DataFrame:
    """Top ``k`` per query without its ``seen`` (``query_id, item_id``) rows; exact, no fixed over-fetch."""
    pairs = seen.select("query_id", "item_id").dropDuplicates()
    counts = pairs.groupBy("query_id").agg(F.count("*").cast("int").alias("_n"))
    asked = queries.join(counts, "query_id", "left").withColumn("need", F.lit(k) + F.coalesce("_n", F.lit(0))).drop("_n")
    found = nearest(asked, vectors, k, metric=metric).join(pairs, ["query_id", "item_id"], "left_anti")
    return topk_by(found.withColumn("_s", F.round("score", 10)), "query_id", k, score="_s").drop("_s")


def pair_score(pairs: DataFrame, vectors: DataFrame, other: DataFrame | None = None) -> DataFrame:
    """Cosine of ``id_a`` (in ``vectors``) and ``id_b`` (in ``other``, default the same); 0 without a vector."""
    b = vectors if other is None else other
    out = pairs.join(vectors.select(F.col("item_id").alias("id_a"), F.col("features").alias("_a")), "id_a", "left")
    out = out.join(b.select(F.col("item_id").alias("id_b"), F.col("features").alias("_b")), "id_b", "left")
    return out.withColumn("score", F.coalesce(cosine("_a", "_b"), F.lit(0.0))).drop("_a", "_b")


def vector_sort(lists: DataFrame, recent: DataFrame, vectors: DataFrame) -> DataFrame:
    """Order given lists by summed cosine to the user's recent items.

    ``lists``: ``user_id, item_id, pos``; ``recent``: ``user_id, item_id, rank``. Scored items first, then items
    already seen, then items without a vector (both in given order); users without any comparison vanish.
    """
    v = vectors.select("item_id", "features")
    mine = recent.join(v, "item_id").select("user_id", F.col("item_id").alias("seen_id"), F.col("features").alias("_r"))
    flagged = (
        lists.join(recent.select("user_id", "item_id", F.lit(1).alias("_seen")).dropDuplicates(), ["user_id", "item_id"], "left")
        .join(v.withColumnRenamed("features", "_v"), "item_id", "left")
        .withColumn("grp", F.when(F.col("_seen") == 1, 1).when(F.col("_v").isNull(), 2).otherwise(0))
    )
    scored = flagged.where("grp = 0").join(mine, "user_id").groupBy("user_id", "item_id").agg(F.sum(cosine("_v", "_r")).alias("score"))
    comparable = scored.select("user_id").dropDuplicates()
    out = flagged.join(scored, ["user_id", "item_id"], "left").join(comparable, "user_id", "left_semi")
    return out.select("user_id", "item_id", "pos", "grp", "score")


def ranked_lists(sorted_lists: DataFrame) -> DataFrame:
    """Number the rows of ``vector_sort`` per user; lists are as long as the caller's request."""
    order = [F.asc("grp"), F.desc_nulls_last(F.round("score", 10)), F.asc("pos")]
    return sorted_lists.withColumn("rank", F.row_number().over(W.partitionBy("user_id").orderBy(*order)))


def rec_vectors(recent: DataFrame, vectors: DataFrame, k: int, candidates: DataFrame | None = None, skip_exact: bool = False) -> DataFrame:
    """Sum of cosines of the user's recent items to other items, rescaled to the best.

    Each recent item brings its ``10*k`` nearest items (or its scores to the fixed candidates). Neighbours
    are found once per distinct item, not per user.
    """
    target = vectors if candidates is None else vectors.join(candidates.select("item_id"), "item_id", "left_semi")
    items = recent.select("item_id").dropDuplicates().join(vectors, "item_id").withColumnRenamed("item_id", "query_id")
    if candidates is None:
        near = nearest(items, target, 10 * k)
    else:
        near = all_scores(items, target)
    near = near.select(F.col("query_id").alias("_from"), "item_id", "score")
    if skip_exact:
        near = near.where(F.round("score", 9) < 1.0)
    seen = recent.select("user_id", "item_id").dropDuplicates()
    hits = seen.withColumnRenamed("item_id", "_from").join(near, "_from").groupBy("user_id", "item_id").agg(F.sum("score").alias("score"))
    return rescale_topk(hits.join(seen, ["user_id", "item_id"], "left_anti"), ["user_id"], k)


def suggest_clusters(user_tags: DataFrame, tag_vectors: DataFrame, cluster_vectors: DataFrame, k: int, min_score: float = 0.5, max_weight: float = 1.0) -> DataFrame:
    """Clusters near a user's tags: scores above ``min_score`` summed over tags, the best ``k``, weight ``max_weight * score / best``.

    A tag brings every cluster above ``min_score``, as a cluster that is not among the nearest of any tag may have the largest sum. Tags
    meet clusters in blocks, and only those above ``min_score`` leave a task.
    """
    tags = user_tags.select("tag").dropDuplicates().join(tag_vectors, "tag").select(F.col("tag").alias("query_id"), "features")
    wanted = cluster_vectors.where("cluster_id is not null").select(F.col("cluster_id").alias("item_id"), "features")
    near = all_scores(tags, wanted, min_score)
    hits = user_tags.join(near.withColumnRenamed("query_id", "tag"), "tag").groupBy("user_id", "item_id").agg(F.sum("score").alias("score"))
    out = rescale_topk(hits, ["user_id"], k)
    return out.select("user_id", F.col("item_id").alias("cluster_id"), (F.col("score") * max_weight).alias("weight"))

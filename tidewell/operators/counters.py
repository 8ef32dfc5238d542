"""Exponentially decayed counters and the top lists read from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.operators.filters import has_tag, items_two_dims, items_with_dims
from tidewell.operators.topk import topk, topk_by


def decay(age_s: Column, alpha: float) -> Column:
    """``exp(-age/alpha)``; a negative age counts as 0."""
    return F.exp(-F.greatest(age_s, F.lit(0)) / F.lit(float(alpha)))


def decayed_counts(events: DataFrame, keys: list[str], alpha: float, now: Column, weight: str | None = None) -> DataFrame:
    """Decayed count per key at ``now``.

    The recurrence ``c = w + exp(-dt/alpha) * c`` over time-ordered events equals the plain sum of
    ``w * exp(-(now - t)/alpha)``, so no ordered pass over a key is needed.
    """
    age = F.unix_timestamp(now) - F.unix_timestamp("ts")
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    return events.groupBy(*keys).agg(F.sum(w * decay(age, alpha)).alias("count"))


def merge_counter(old_count: Column, old_ts: Column, incr: Column, ts: Column, alpha: float) -> Column:
    """One recurrence step: late increments see no decay."""
    return incr + decay(F.unix_timestamp(ts) - F.unix_timestamp(old_ts), alpha) * old_count


def restrict(counts: DataFrame, item_dims=None, dims=None, dim2=None, item_tags=None, tag=None) -> DataFrame:
    """Counter rows of items in the dimensions, in a second dimension and with a tag (each optional)."""
    if dims and dim2:
        counts = items_two_dims(counts, item_dims, dims, dim2)
    elif dims:
        counts = items_with_dims(counts, item_dims, dims)
    if tag is not None:
        hit = item_tags.where(has_tag("tags", tag)).select("item_id")
        counts = counts.join(hit, "item_id", "left_semi")
    return counts


def _at(counts: DataFrame, alpha: float, now: Column) -> DataFrame:
    """Stored ``(cluster_id, item_id, count, t)`` brought forward to ``now``."""
    return counts.withColumn("count", F.col("count") * decay(F.unix_timestamp(now) - F.unix_timestamp("t"), alpha))


def cluster_top(counts: DataFrame, k: int, alpha: float, now: Column, **limits) -> DataFrame:
    """Top items of every cluster by decayed count."""
    return topk_by(_at(restrict(counts, **limits), alpha, now), "cluster_id", k, score="count")


def global_top(counts: DataFrame, k: int, alpha: float, now: Column, **limits) -> DataFrame:
    """Top items by decayed count summed over clusters."""
    summed = _at(restrict(counts, **limits), alpha, now).groupBy("item_id").agg(F.sum("count").alias("count"))
    return topk(summed, k, score="count")


def significant(counts: DataFrame, k: int, alpha: float, now: Column, item_totals: DataFrame | None = None, **limits) -> DataFrame:
    """Items over-represented in a cluster: ``v*c`` with ``v = (c/sl - s/sg) / greatest(c/sl, s/sg)``.

    ``c`` decayed cluster count, ``sl`` sum of decay factors in the cluster, ``s`` item total, ``sg`` grand total.
    """
    age = F.unix_timestamp(now) - F.unix_timestamp("t")
    live = counts.withColumn("c", F.col("count") * decay(age, alpha)).withColumn("_d", decay(age, alpha))
    per_cluster = live.groupBy("cluster_id").agg(F.sum("_d").alias("sl"))
    totals = item_totals if item_totals is not None else counts.groupBy("item_id").agg(F.sum("count").alias("s"))
    grand = totals.agg(F.sum("s")).scalar()
    rows = restrict(live, **limits).join(per_cluster, "cluster_id").join(totals, "item_id")
    local, overall = F.col("c") / F.col("sl"), F.col("s") / grand
    scored = rows.withColumn("score", (local - overall) / F.greatest(local, overall) * F.col("c"))
    return topk_by(scored, "cluster_id", k).select("cluster_id", "item_id", "score")


def cluster_counts(actions: DataFrame, user_clusters: DataFrame, alpha: float) -> DataFrame:
    """Counter rows from actions of clustered users, each standing at its last event time.

    Counted per (user, item, second) first, so a hot user shuffles one row per item and second.
    """
    second = F.date_trunc("second", "ts")
    ui = actions.groupBy("user_id", "item_id", second.alias("ts")).agg(F.count("*").alias("n"))
    rows = ui.join(user_clusters, "user_id").withColumn("_us", F.unix_timestamp("ts"))
    last = rows.groupBy("cluster_id", "item_id").agg(F.max("ts").alias("t"))
    aged = rows.join(last, ["cluster_id", "item_id"])
    return aged.groupBy("cluster_id", "item_id", "t").agg(
        F.sum(F.col("n") * F.col("weight") * decay(F.unix_timestamp("t") - F.col("_us"), alpha)).alias("count")
    )

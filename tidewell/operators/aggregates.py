"""Click-through, popularity, shares, affinity and engagement reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewell.operators.filters import allow_users
from tidewell.operators.skew import exact_quantiles, sessionise, with_key_count
from tidewell.operators.topk import topk_by


def ctr(imps: DataFrame, by: list[str], users: DataFrame | None = None) -> DataFrame:
    """Impressions, clicks and click-through percentage in one pass; groups lacking a side vanish."""
    d = allow_users(imps, users)
    if "day" in by and "day" not in d.columns:
        d = d.withColumn("day", F.to_date("ts"))
    return (
        d.groupBy(*by)
        .agg(
            F.count_if(F.col("kind") == "IMP").alias("impressions"),
            F.count_if(F.col("kind") == "CTR").alias("clicks"),
        )
        .where("impressions > 0 and clicks > 0")
        .withColumn("ctr", 100.0 * F.col("clicks") / F.col("impressions"))
    )


def unique_users(actions: DataFrame, min_days: int) -> DataFrame:
    """Users active on at least ``min_days`` distinct days, with their client."""
    days = actions.select("user_id", "client", F.unix_date(F.to_date("ts")).alias("day"))
    per_day = days.groupBy("user_id", "day").agg(F.min("client").alias("client"))
    return (
        per_day.groupBy("user_id")
        .agg(F.count("*").alias("days"), F.min("client").alias("client"))
        .where(F.col("days") >= min_days)
    )


def most_popular(actions: DataFrame) -> DataFrame:
    return actions.where("item_id > 0").groupBy("item_id").agg(F.count("*").alias("n"))


def popular_by_dim(actions: DataFrame, item_dims: DataFrame, k: int, min_count: float = 0.0) -> DataFrame:
    """Per dimension the items with the largest sum of ``value + 1``. Summed per item before the join."""
    per_item = actions.groupBy("item_id").agg(F.sum(F.col("value") + 1.0).alias("score"))
    scored = per_item.join(item_dims, "item_id").groupBy("dim", "item_id").agg(F.sum("score").alias("score"))
    return topk_by(scored.where(F.col("score") >= min_count), "dim", k, rank="rank")


def ratings(actions: DataFrame, weights: dict[int, tuple[float, float]] | None = None) -> DataFrame:
    """Per (user, item) the sum over action types of ``min(weight * count, cap)``; unlisted types count 0."""
    weights = weights or {1: (1.0, 1.0)}
    n = F.count("*")
    per_type = actions.groupBy("user_id", "item_id", "action_type").agg(n.alias("n"))
    part: Column = F.lit(0.0)
    for t, (w, cap) in weights.items():
        part = F.when(F.col("action_type") == t, F.least(F.col("n") * F.lit(float(w)), F.lit(float(cap)))).otherwise(part)
    return per_type.groupBy("user_id", "item_id").agg(F.sum(part).alias("rating"))


def user_dim_counts(actions: DataFrame, item_dims: DataFrame) -> DataFrame:
    """(user, dim, count): actions are counted per (user, item) before they meet the dimensions."""
    ui = actions.groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    return ui.join(item_dims, "item_id").groupBy("user_id", "dim").agg(F.sum("n").alias("n"))


def dim_share(actions: DataFrame, item_dims: DataFrame) -> DataFrame:
    """Share of each dimension among all (action, dimension) rows."""
    per_item = actions.groupBy("item_id").agg(F.count("*").alias("n"))
    per_dim = per_item.join(item_dims, "item_id").groupBy("dim").agg(F.sum("n").alias("n"))
    total = per_dim.agg(F.sum("n")).scalar()
    return per_dim.select("dim", "n", (F.col("n") / total).alias("share"))


def cluster_users(actions: DataFrame, item_dims: DataFrame, delta: float, min_size: int, min_actions: int = 0) -> DataFrame:
    """Users join a dimension's cluster when their share exceeds the global one by ``delta``."""
    if min_actions > 0:
        actions = with_key_count(actions, ["user_id"], "_n").where(F.col("_n") >= min_actions).drop("_n")
    counts = user_dim_counts(actions, item_dims)
    share = dim_share(actions, item_dims).select("dim", F.col("share").alias("global_share"))
    totals = counts.groupBy("user_id").agg(F.sum("n").alias("total"))
    picked = (
        counts.join(totals, "user_id")
        .join(share, "dim")
        .withColumn("weight", F.col("n") / F.col("total"))
        .where(F.col("weight") > F.col("global_share") + delta)
    )
    sizes = picked.groupBy("dim").agg(F.count("*").alias("size")).where(F.col("size") >= min_size)
    return picked.join(sizes, "dim").select("user_id", "dim", "weight")


def tag_share(actions: DataFrame, item_tags: DataFrame) -> DataFrame:
    """Tag count over the number of actions on tagged items."""
    per_item = actions.groupBy("item_id").agg(F.count("*").alias("n"))
    item_tags = item_tags.hint("merge")  # a row per item and tag: much larger than its file lets Spark expect, not to be sent through the driver
    total = per_item.join(item_tags, "item_id", "left_semi").agg(F.sum("n")).scalar()
    counts = per_item.join(item_tags, "item_id").groupBy("tag").agg(F.sum("n").alias("n"))
    return counts.select("tag", "n", (F.col("n") / total).alias("share"))


def user_tag_counts(actions: DataFrame, item_tags: DataFrame, min_actions: int = 0) -> DataFrame:
    """(user, tag, tf, actions) over tagged items; ``actions`` is the user's action count on them."""
    ui = actions.groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    per_item = item_tags.groupBy("item_id").agg(F.collect_set("tag").alias("tags"))
    joined = ui.join(per_item.hint("merge"), "item_id")  # as many rows as items: not through the driver
    totals = joined.groupBy("user_id").agg(F.sum("n").alias("actions")).where(F.col("actions") >= min_actions)
    counts = joined.select("user_id", "n", F.explode("tags").alias("tag")).groupBy("user_id", "tag").agg(F.sum("n").alias("tf"))
    return counts.join(totals.hint("merge"), "user_id")


def _affine(actions, item_tags, min_actions, min_tag_count, min_increase, tags=None) -> DataFrame:
    share = tag_share(actions, item_tags).select("tag", F.col("share").alias("global_share"))
    counts = user_tag_counts(actions, item_tags, min_actions).where(F.col("tf") > min_tag_count)
    if tags is not None:
        counts = counts.join(tags.select("tag").dropDuplicates(), "tag", "left_semi")
    rise = (F.col("tf") / F.col("actions") - F.col("global_share")) / F.col("global_share")
    return counts.join(share, "tag").withColumn("weight", rise).where(F.col("weight") > min_increase)


def tag_affinity(
    actions: DataFrame,
    item_tags: DataFrame,
    min_actions: int = 10,
    min_tag_count: int = 4,
    min_increase: float = 0.5,
    max_tags: int | None = 100,
    tags: DataFrame | None = None,
) -> DataFrame:
    """Tags a user prefers over everybody; a user with more than ``max_tags`` of them is dropped whole, ``None`` keeps everyone."""
    kept = _affine(actions, item_tags, min_actions, min_tag_count, min_increase, tags)
    if max_tags is None:
        return kept.select("user_id", "tag", "weight")
    few = kept.groupBy("user_id").agg(F.count("*").alias("_n")).where(F.col("_n") <= max_tags)
    return kept.join(few.hint("merge"), "user_id").select("user_id", "tag", "weight")


def tag_affinity_report(actions, item_tags, clients, min_actions=10, min_tag_count=4, min_increase=0.5) -> DataFrame:
    """Affinity without the tag-count drop, plus the client's user id and action count."""
    kept = _affine(actions, item_tags, min_actions, min_tag_count, min_increase)
    return kept.join(clients, "user_id").select("user_id", "client_user_id", "tag", "weight", "tf", "actions")


def tag_clusters(actions, item_tags, defs, min_actions=10, min_tag_count=4, min_increase=0.5) -> DataFrame:
    """Per user and cluster of tags the kept tags; group and cluster ids number the names from 0.

    ``defs`` holds ``(tag, tag_group, cluster)`` and is small by nature (a hand-made file).
    """
    groups = defs.select("tag_group").distinct().withColumn("group_id", F.row_number().over(W.orderBy("tag_group")) - 1)
    clusters = defs.select("cluster").distinct().withColumn("cluster_no", F.row_number().over(W.orderBy("cluster")) - 1)
    numbered = defs.join(groups, "tag_group").join(clusters, "cluster")
    kept = _affine(actions, item_tags, min_actions, min_tag_count, min_increase, defs)
    return (
        kept.join(numbered, "tag")
        .groupBy("user_id", "group_id", "cluster_no")
        .agg(F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("tags"))
    )


def rec_age(imps: DataFrame, published: DataFrame) -> DataFrame:
    """Age in seconds of every recommended item at impression time."""
    shown = imps.select("ts", F.explode(F.split("recs", ":")).alias("item")).select("ts", F.col("item").cast("long").alias("item_id"))
    return shown.join(published, "item_id").select(
        "item_id", "ts", (F.unix_timestamp("ts") - F.unix_timestamp("published")).alias("age")
    )


def rec_recency(imps: DataFrame, published: DataFrame, probs=(0.25, 0.5, 0.75, 0.9, 0.99), approx: bool = False) -> DataFrame:
    """Percentiles of recommended-item age per hour, exact or (``approx``) sketched."""
    aged = rec_age(imps, published).withColumn("hour", F.date_trunc("hour", "ts"))
    if approx:
        col = F.percentile_approx("age", [float(p) for p in probs], 10000)
        return aged.groupBy("hour").agg(col.alias("v")).select("hour", F.posexplode("v").alias("i", "value")).select(
            "hour", F.array(*[F.lit(float(p)) for p in probs])[F.col("i")].alias("p"), F.col("value").cast("double").alias("value")
        )
    return exact_quantiles(aged, ["hour"], "age", list(probs))


def percentile_np1(df: DataFrame, col: str, p: float, keys: list[str] | None = None) -> DataFrame:
    """Percentile at rank ``p/100*(n+1)``, interpolated, clamped at the ends."""
    return exact_quantiles(df, keys or [], col, [p / 100.0], rule="np1")


def engagement_sessions(imps: DataFrame, gap_s: int = 600, max_pv: int = 50) -> DataFrame:
    """Sessions per user with length in whole seconds (at least 1) and page views.

    Users who change variation are dropped; so are sessions beyond ``max_pv`` views. The first kept
    session of a user carries ``user_count = 1``.
    """
    d = sessionise(imps, ["client", "user_id"], "ts", ["ts", "event_id"], gap_s)
    gap = F.floor((F.unix_millis("ts") - F.unix_millis("prev_ts")) / 1000)
    per = d.groupBy("client", "user_id", "session").agg(
        F.greatest(F.sum(F.when(F.col("is_break"), 0).otherwise(gap)), F.lit(1)).alias("seconds"),
        F.count("*").alias("page_views"),
        F.min("variation").alias("variation"),
        F.max("variation").alias("_v2"),
    )
    fits = F.col("page_views") <= max_pv
    users = per.groupBy("client", "user_id").agg(
        F.min("variation").alias("_va"), F.max("_v2").alias("_vb"), F.min(F.when(fits, F.col("session"))).alias("_first")
    )
    kept = per.where(fits).join(users.where("_va = _vb"), ["client", "user_id"])
    first = F.col("session") == F.col("_first")
    return kept.select(
        "client",
        "user_id",
        "variation",
        "session",
        "seconds",
        "page_views",
        F.when(first, 1).otherwise(0).alias("user_count"),
        F.when(F.col("page_views") > 1, 1).otherwise(0).alias("multi_page"),
    )


def engagement_ab(imps: DataFrame, gap_s: int = 600, max_pv: int = 50) -> DataFrame:
    """Average session length, views and multi-page share per client: baseline, normal, difference."""
    s = engagement_sessions(imps, gap_s, max_pv)
    group = F.when(F.col("variation") == "baseline", "baseline").otherwise("normal")
    stats = s.groupBy("client", group.alias("grp")).agg(
        (F.sum("seconds") / F.count("*")).alias("avg_seconds"),
        (F.sum("page_views") / F.count("*")).alias("avg_views"),
        (F.sum("multi_page") / F.count("*")).alias("multi_share"),
    )

    def of(g: str, c: str) -> Column:
        return F.max(F.when(F.col("grp") == g, F.col(c)))

    out = stats.groupBy("client").agg(
        *[of("baseline", c).alias(f"base_{c}") for c in ("avg_seconds", "avg_views", "multi_share")],
        *[of("normal", c).alias(f"normal_{c}") for c in ("avg_seconds", "avg_views", "multi_share")],
    )
    for c in ("avg_seconds", "avg_views", "multi_share"):
        out = out.withColumn(f"diff_{c}", F.col(f"normal_{c}") - F.col(f"base_{c}"))
    return out


def vocab(docs: DataFrame, tokens: str, size: int | None = None) -> DataFrame:
    """Token counts of a corpus, most frequent first, ids from 0."""
    counts = docs.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    return counts if size is None else counts.orderBy(F.desc("n"), "term").limit(size)

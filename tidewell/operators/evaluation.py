"""Splits and ranking metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewell.functions.hashing import hash_share
from tidewell.operators.topk import topk_by


def split(df: DataFrame, keys: list[str], p: float = 0.8, seed: int = 123, test_users: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """(train, test): rows by hash, then test rows limited to a share of the test users."""
    train = df.where(hash_share(keys, seed) < p)
    test = df.where((hash_share(keys, seed) >= p) & (hash_share(["user_id"], seed + 1) < test_users))
    return train, test


def rating_error(test: DataFrame, recs: DataFrame) -> DataFrame:
    """MAE and RMSE of predicted scores on common (user, item) rows."""
    both = test.join(recs.select("user_id", "item_id", "score"), ["user_id", "item_id"])
    e = F.col("rating") - F.col("score")
    return both.agg(F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.count("*").alias("n"))


def ranking_metrics(test: DataFrame, recs: DataFrame, ks: list[int] = (5, 10, 20)) -> DataFrame:
    """NDCG, MRR, precision, recall, F1 and MAP at each ``k``, averaged over users with test items.

    Binary relevance: an item counts when it is in the user's test set. Ideal DCG puts all relevant items first.
    """
    relevant = test.select("user_id", "item_id").dropDuplicates()
    sizes = relevant.groupBy("user_id").agg(F.count("*").alias("rel"))
    ranked = topk_by(recs.select("user_id", "item_id", "score"), "user_id", max(ks), rank="rank")
    hits = ranked.join(relevant, ["user_id", "item_id"]).select("user_id", "rank")
    packed = hits.groupBy("user_id").agg(F.array_sort(F.collect_list("rank")).alias("ranks"))
    users = sizes.join(packed, "user_id", "left").withColumn("ranks", F.coalesce("ranks", F.array().cast("array<int>")))
    rows = users.withColumn("k", F.explode(F.array(*[F.lit(k) for k in ks]))).withColumn("h", F.filter("ranks", lambda r: r <= F.col("k")))
    gain = lambda a: F.aggregate(a, F.lit(0.0), lambda s, r: s + 1.0 / F.log2(r + F.lit(1.0)))
    n = F.size("h")
    rows = rows.select(
        "user_id",
        "k",
        (gain(F.col("h")) / gain(F.sequence(F.lit(1), F.least(F.col("rel"), "k").cast("int")))).alias("ndcg"),
        F.coalesce(1.0 / F.get("h", F.lit(0)), F.lit(0.0)).alias("mrr"),
        (n / F.col("k")).alias("precision"),
        (n / F.col("rel")).alias("recall"),
        (
            F.aggregate(F.transform("h", lambda r, i: (i + 1) / r), F.lit(0.0), lambda s, x: s + x) / F.least(F.col("rel"), "k")
        ).alias("map"),
    )
    p, r = F.col("precision"), F.col("recall")
    rows = rows.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0))
    return rows.groupBy("k").agg(*[F.avg(c).alias(c) for c in ("ndcg", "mrr", "precision", "recall", "f1", "map")])


def prefs(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(user to item preference sums, item to user sums with the item's total, distinct times per pair as rows)."""
    sums = df.groupBy("user_id", "item_id").agg(F.sum("value").alias("pref"))
    totals = sums.groupBy("item_id").agg(F.sum("pref").alias("total"), F.count("*").alias("users"))
    times = df.select("user_id", "item_id", F.unix_timestamp("ts").alias("time")).dropDuplicates()
    return sums, totals, times

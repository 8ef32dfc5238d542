"""Top-k, score scaling and list helpers. Ties: score descending, then id ascending."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def topk(df: DataFrame, k: int, score: str = "score", tie: str = "item_id") -> DataFrame:
    """Global top k; Spark keeps k rows per task before merging."""
    return df.orderBy(F.desc(score), tie).limit(k)


def topk_by(df: DataFrame, keys: list[str] | str, k: int, score: str = "score", tie: str = "item_id", rank: str | None = None) -> DataFrame:
    """Top k per key; the rank filter is pushed below the shuffle as a group limit."""
    keys = [keys] if isinstance(keys, str) else keys
    name = rank or "_rank"
    w = W.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie))
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def rescale(df: DataFrame, keys: list[str], score: str = "score") -> DataFrame:
    """Divide by the best score of the list; lists without a positive score vanish."""
    if not keys:
        top = df.agg(F.max(score)).scalar()
        return df.where(top > 0).withColumn(score, F.col(score) / top)
    top = df.groupBy(*keys).agg(F.max(score).alias("_top")).where("_top > 0")
    return df.join(top, keys).withColumn(score, F.col(score) / F.col("_top")).drop("_top")


def rescale_topk(df: DataFrame, keys: list[str], k: int, score: str = "score", tie: str = "item_id") -> DataFrame:
    """Top k per key, then score / max in the same window; all non-positive lists vanish."""
    w = W.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie))
    ranked = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    top = F.max(score).over(W.partitionBy(*keys))
    return ranked.withColumn("_top", top).where("_top > 0").withColumn(score, F.col(score) / F.col("_top")).drop("_rank", "_top")


def normalise_topk(df: DataFrame, keys: list[str], k: int, score: str = "score", tie: str = "item_id") -> DataFrame:
    """Top k per key, then score / sum; lists with a sum of at most 0 vanish."""
    w = W.partitionBy(*keys).orderBy(F.desc(score), F.asc(tie))
    ranked = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    total = F.sum(score).over(W.partitionBy(*keys))
    return ranked.withColumn("_sum", total).where("_sum > 0").withColumn(score, F.col(score) / F.col("_sum")).drop("_rank", "_sum")


def rank_score(df: DataFrame, keys: list[str], order: list[Column], out: str = "score") -> DataFrame:
    """Linear score ``1 - rank/n`` (rank from 0) of an ordered list; apply to bounded (top-k) lists."""
    w = W.partitionBy(*keys)
    rank = F.row_number().over(w.orderBy(*order)) - 1
    return df.withColumn(out, 1.0 - rank / F.count("*").over(w))


def select_topk_linear(df: DataFrame, keys: list[str], k: int, order: list[Column], out: str = "score") -> DataFrame:
    """First k rows per key in ``order``, scored ``1 - rank/n``."""
    w = W.partitionBy(*keys).orderBy(*order)
    first = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)
    return first.withColumn(out, 1.0 - (F.col("_rank") - 1) / F.count("*").over(W.partitionBy(*keys))).drop("_rank")


def global_rank(df: DataFrame, score: str = "score", tie: str = "item_id", buckets: int = 128, out: str = "rank") -> DataFrame:
    """Exact rank from 1 (score descending, id ascending) without one global sort.

    Approximate quantiles cut the scores into buckets, a cut's own score apart from the others; as a score of many rows is a
    cut, its rows are cut again by id. Rows are numbered inside their bucket and shifted by the bucket sizes ahead. Only the
    cut points reach the driver.
    """
    probs = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(score, probs, 10000).alias("s"), F.percentile_approx(tie, probs, 10000).alias("t")).first()
    points = [F.array(*[F.lit(c) for c in sorted(set(x or []))]) if x else F.array().cast("array<double>") for x in (found.s, found.t)]
    is_cut = F.array_contains(points[0], F.col(score)) if found.s else F.lit(False)
    by_id = F.when(is_cut, F.size(F.filter(points[1], lambda c: c < F.col(tie)))).otherwise(0)
    level = 2 * F.size(F.filter(points[0], lambda c: c > F.col(score))) + is_cut.cast("int")
    placed = df.withColumn("_b", level * buckets + by_id)
    sizes = placed.groupBy("_b").agg(F.count("*").alias("_n"))
    sizes = sizes.select("_b", (F.sum("_n").over(W.orderBy("_b")) - F.col("_n")).alias("_off"))  # at most 2 * buckets ** 2 rows
    inner = placed.withColumn("_r", F.row_number().over(W.partitionBy("_b").orderBy(F.desc(score), tie)))
    return inner.join(sizes, "_b").withColumn(out, F.col("_off") + F.col("_r")).drop("_b", "_r", "_off")

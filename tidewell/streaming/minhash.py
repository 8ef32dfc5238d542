"""MinHash item similarity over rolling and fixed windows, streaming and batch.

The signature of an item is the minimum of ``H`` hash functions over its users: ``H`` columns of one
aggregation, combined in the map tasks. Candidate pairs meet on equal (hash number, value) only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.hashing import hash_family, prime_hash
from tidewell.operators.skew import shared_counts
from tidewell.streaming.stats import emit_snapshot, last_snapshot


def signature_columns(user: str, hashes: int, seed: int = 42) -> list[Column]:
    return [F.min(prime_hash(user, a, b)).alias(f"h{i}") for i, (a, b) in enumerate(hash_family(hashes, seed))]


def signatures(df: DataFrame, hashes: int, keys: list[Column | str], seed: int = 42) -> DataFrame:
    """Per key the event count and the signature columns ``h0…``."""
    return df.groupBy(*keys, "item_id").agg(F.count("*").alias("n"), *signature_columns("user_id", hashes, seed))


def window_signatures(stream: DataFrame, window: str, slide: str | None, hashes: int, delay: str = "10 minutes", seed: int = 42) -> DataFrame:
    """Signatures per rolling window; entries leave a window when their time passes out of it."""
    d = stream.withWatermark("ts", delay)
    w = F.window("ts", window, slide or window)
    return signatures(d, hashes, [w.alias("w")], seed).select(F.col("w.end").alias("end"), "item_id", "n", *[f"h{i}" for i in range(hashes)])


def similarity(sigs: DataFrame, hashes: int, min_activity: int = 1, keys: list[str] = ()) -> DataFrame:
    """Pairs ``item_a < item_b`` of active items with the share of equal hashes (above 0), per key."""
    active = sigs.where(F.col("n") >= min_activity)
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"h{i}").alias("h")) for i in range(hashes)])
    rows = active.select(*keys, "item_id", F.explode(cells).alias("c"))
    if keys:
        pairs = shared_counts(rows.select(F.struct(*keys, "c").alias("grp"), F.struct(*keys, "item_id").alias("item")))
        ends = [F.col(f"{e}.item_id").alias(e) for e in ("item_a", "item_b")]
        out = pairs.select(*[F.col(f"item_a.{k}").alias(k) for k in keys], *ends, "shared")
    else:
        out = shared_counts(rows.select(F.col("c").alias("grp"), F.col("item_id").alias("item")))
    return out.select(*keys, "item_a", "item_b", (F.col("shared") / F.lit(hashes)).alias("score"))


def rolling(df: DataFrame, now: Column, window_s: int, hashes: int, min_activity: int = 1, seed: int = 42) -> DataFrame:
    """Similarity at one moment: entries with ``ts <= now - window`` have expired."""
    live = df.where((F.col("ts") > now - F.make_interval(secs=F.lit(window_s))) & (F.col("ts") <= now))
    return similarity(signatures(live, hashes, [], seed), hashes, min_activity)


def minhash_window(df: DataFrame, start: Column, end: Column, hashes: int, min_activity: int = 1, seed: int = 42) -> DataFrame:
    """Similarity over the fixed window ``[start, end)``."""
    return similarity(signatures(df.where((F.col("ts") >= start) & (F.col("ts") < end)), hashes, [], seed), hashes, min_activity)


def latest_signatures(stored: DataFrame) -> DataFrame:
    """Newest signature per (window, item) of the stored micro-batch updates (``batch`` column)."""
    values = [c for c in stored.columns if c not in ("end", "item_id", "batch")]
    newest = stored.groupBy("end", "item_id").agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return newest.select("end", "item_id", "v.*")


def minhash_sim(path: str, hashes: int, min_activity: int = 1, keep: int | None = None):
    """``foreachBatch`` function for ``window_signatures``: store the updated signatures, then write a whole snapshot.

    Every window has a folder of its own, and only those of the windows the batch touched are listed and read; the other
    windows come from the last snapshot. With ``keep``, windows that end ``keep`` seconds or more before the newest one leave the snapshot.
    """
    root = path.rstrip("/")

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        end = F.unix_micros("end")
        touched = [r.w for r in batch.select(end.alias("w")).distinct().collect()]  # the batch's windows
        if not touched:
            return  # a batch that only moves the watermark
        rows = batch.withColumns({"window": end, "batch": F.lit(batch_id)})
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("window", "batch").parquet(f"{root}/signatures")
        folders = [f"{root}/signatures/window={w}" for w in touched]
        stored = spark.read.option("basePath", f"{root}/signatures").parquet(*folders).where(F.col("batch") <= batch_id).drop("window")
        whole = similarity(latest_signatures(stored), hashes, min_activity, ["end"])
        last = last_snapshot(spark, f"{root}/similarity", batch_id)
        if last is not None:
            whole = whole.unionByName(last.where(~F.unix_micros("end").isin(touched)))
        if keep is not None:
            ends = batch.select("end") if last is None else batch.select("end").unionByName(last.select("end"))
            newest = ends.agg(F.max("end")).first()[0]
            whole = whole.where(F.col("end") > F.lit(newest) - F.make_interval(secs=F.lit(keep)))
        emit_snapshot(f"{root}/similarity", lambda _: whole)(batch, batch_id)

    return run

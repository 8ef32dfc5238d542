"""Sinks: JSON, per-client partitions, staged publishing, factors, streaming statistics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException


def write_json(df: DataFrame, path: str, gzip: bool = False) -> None:
    df.write.mode("overwrite").json(path, compression="gzip" if gzip else "none")


def write_frame(df: DataFrame, path: str, fmt: str) -> None:
    """Feature frame back to CSV (with header) or JSON lines."""
    w = df.write.mode("overwrite")
    w.option("header", True).csv(path) if fmt == "csv" else w.json(path)


def write_by_client(df: DataFrame, root: str, rows_per_file: int = 5_000_000) -> None:
    """One folder per client and unix day in a single pass.

    Rows are rebalanced by client and day, which bounds the number of files; adaptive execution splits a hot client's
    rows over as many tasks as they fill.
    """
    df.hint("rebalance", "client", "day").write.mode("append").option("maxRecordsPerFile", rows_per_file).partitionBy("client", "day").json(root)


def write_factors(df: DataFrame, path: str, gzip: bool = False) -> None:
    """``id|f1,f2,…`` lines, written by all tasks."""
    line = F.concat_ws("|", F.col("id").cast("string"), F.array_join(F.transform("features", lambda x: x.cast("string")), ","))
    df.select(line.alias("value")).write.mode("overwrite").text(path, compression="gzip" if gzip else "none")


def publish(df: DataFrame, root: str, pins: DataFrame | None = None, key: str = "item_id") -> str:
    """Write a whole new version, then point the table at it; pinned rows whose key is absent are added.

    Readers see the old version until the pointer row is written. Returns the version's path.
    """
    spark = df.sparkSession
    full = df if pins is None else df.unionByName(pins.join(df, key, "left_anti"))
    target = f"{root.rstrip('/')}/data/{uuid.uuid4().hex}"
    full.write.parquet(target)
    pointer = spark.range(1).select(F.lit(target).alias("target"), F.current_timestamp().alias("at"))
    pointer.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/versions")
    return target


def read_published(spark: SparkSession, root: str) -> DataFrame:
    """The newest published version."""
    versions = spark.read.parquet(f"{root.rstrip('/')}/versions")
    return spark.read.parquet(versions.orderBy(F.desc("at")).first().target)


def stats_batch(path: str, prepare=None):
    """``foreachBatch`` function: each micro-batch overwrites its own ``batch=`` folder, so a retry never doubles rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if prepare is None else prepare(batch)
        rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def write_stats(stream: DataFrame, path: str, checkpoint: str, mode: str = "update", trigger: dict | None = None, prepare=None):
    """Statistics points of a streaming aggregation as a parquet time series (one folder per micro-batch)."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(stats_batch(path, prepare))
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def read_stats(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Latest point per key: a window updated by several micro-batches counts once."""
    try:
        raw = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/batch=*")
    except AnalysisException as ex:
        raise FileNotFoundError(f"no statistics written under {path}") from ex
    values = [c for c in raw.columns if c not in keys and c != "batch"]
    latest = raw.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("v"))
    return latest.select(*keys, "v.*")

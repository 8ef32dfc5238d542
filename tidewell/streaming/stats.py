"""Streaming statistics: impressions, requests, predictions; branching and snapshots.

All are event-time windows with a watermark: rows later than the delay are dropped. Counts are combined in the
map tasks before they reach the state, so a hot client or tag costs one row per task and window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidewell.functions.scalars import best_class, default_tag, default_variation, path_template


def _windowed(stream: DataFrame, window: str, delay: str):
    return stream.withWatermark("ts", delay), F.window("ts", window)


def impression_stats(stream: DataFrame, window: str = "1 second", delay: str = "10 minutes") -> DataFrame:
    """Impressions and clicks per client, tag, variation and window."""
    d, w = _windowed(stream, window, delay)
    return (
        d.groupBy(w.alias("w"), "client", default_tag("tag").alias("tag"), default_variation("variation").alias("variation"))
        .agg(F.count_if(F.col("kind") == "IMP").alias("impressions"), F.count_if(F.col("kind") == "CTR").alias("clicks"))
        .select(F.col("w.start").alias("time"), "client", "tag", "variation", "impressions", "clicks")
    )


def request_stats(stream: DataFrame, window: str = "1 second", delay: str = "10 minutes") -> DataFrame:
    """Requests and mean execution time per client, method and path template."""
    d, w = _windowed(stream, window, delay)
    return (
        d.groupBy(w.alias("w"), "client", "method", path_template("path").alias("path"))
        .agg(F.count("*").alias("n"), F.avg("exectime").alias("mean_time"))
        .select(F.col("w.start").alias("time"), "client", "method", "path", "n", "mean_time")
    )


def prediction_stats(stream: DataFrame, window: str = "1 second", delay: str = "10 minutes") -> DataFrame:
    """Predictions and mean best score per client, variation, model and best class."""
    d, w = _windowed(stream.withColumn("_best", best_class("predictions")), window, delay)
    return (
        d.groupBy(w.alias("w"), "client", "variation", "model", F.col("_best.name").alias("best"))
        .agg(F.count("*").alias("n"), F.avg("_best.score").alias("mean_score"))
        .select(F.col("w.start").alias("time"), "client", "variation", "model", "best", "n", "mean_score")
    )


def branch(tags: dict[str, str], path: str):
    """``foreachBatch`` function that splits one stream by tag: each tag's rows go to their own folder per batch.

    The batch is read once and kept while its branches are written; a retried batch overwrites its folders.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for tag, name in tags.items():
                batch.where(F.col("tag") == tag).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{name}/batch={batch_id}")
        finally:
            batch.unpersist()

    return write


def trigger(window_secs: int | None = None, once: bool = False) -> dict:
    """Emission policy: every ``window_secs`` of processing time, or all available data and stop."""
    if once or window_secs is None:
        return {"availableNow": True}
    return {"processingTime": f"{window_secs} seconds"}


def files_per_trigger(n: int) -> dict[str, str]:
    """Source option that makes a micro-batch of every ``n`` files (emission after a number of events)."""
    return {"maxFilesPerTrigger": str(n)}


EMITTED = "client string, reason string, at timestamp, n long"


def _per_second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Events per (client, second) inside a batch of rows, before anything is shuffled."""
    for pdf in batches:
        if len(pdf):
            yield pdf.groupby(["client", "second"], as_index=False, dropna=False).agg(n=("second", "size"))


def emissions(stream: DataFrame, window_secs: int, every: int) -> DataFrame:
    """Emission by data: (client, reason, at, n so far), a row for each time a result is due.

    ``time``: the first event in a later slot of ``window_secs`` of event time; ``at`` is the start of that slot and ``n`` counts all events
    before. ``count``: the running number reaches a multiple of ``every``; ``at`` is the second in which it does. Micro-batches don't
    matter as long as events come in order; an event behind the newest second counts at that second. The state is two numbers per
    client, and a client reaches it as one row per second and task, however many events it has.
    """
    counted = stream.select("client", F.unix_timestamp("ts").alias("second")).mapInPandas(_per_second, "client string, second long, n long")

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before, newest = state.get if state.exists else (0, None)
        rows = pd.concat(parts)
        seconds = rows["second"].clip(lower=newest) if newest is not None else rows["second"]
        sums = rows["n"].groupby(seconds).sum().sort_index()
        second, total = sums.index.to_numpy(dtype=np.int64), before + sums.to_numpy(dtype=np.int64).cumsum()
        earlier = np.append(before, total[:-1])
        slot = second // window_secs
        last = np.append(slot[0] if newest is None else newest // window_secs, slot[:-1])
        due = slot > last
        crossed = total // every - earlier // every
        multiple = np.concatenate([np.arange(a // every + 1, b // every + 1) for a, b in zip(earlier, total)]) * every
        state.update((int(total[-1]), int(second[-1])))
        found = pd.DataFrame({"reason": "time", "at": slot[due] * window_secs, "n": earlier[due]})
        found = pd.concat([found, pd.DataFrame({"reason": "count", "at": np.repeat(second, crossed), "n": multiple})])
        yield found.assign(client=key[0], at=pd.to_datetime(found["at"].astype("int64"), unit="s"))[["client", "reason", "at", "n"]]

    return counted.groupBy("client").applyInPandasWithState(update, EMITTED, "n long, newest long", "append", GroupStateTimeout.NoTimeout)


def emit_snapshot(path: str, result):
    """``foreachBatch`` function writing ``result(batch)`` as one whole snapshot.

    The snapshot's folder is written first and listed in ``done`` last, so readers see whole snapshots only.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        target = f"{path.rstrip('/')}/snapshot={batch_id}"
        result(batch).write.mode("overwrite").parquet(target)
        batch.sparkSession.range(1).select(F.lit(batch_id).alias("id")).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/done/id={batch_id}")

    return write


def last_snapshot(spark, path: str, before: int) -> DataFrame | None:
    """The newest whole snapshot of a batch before ``before``; none if there is none."""
    try:
        done = spark.read.parquet(f"{path.rstrip('/')}/done/*")
    except AnalysisException:  # nothing written yet
        return None
    newest = done.where(F.col("id") < before).agg(F.max("id")).first()[0]
    return None if newest is None else spark.read.parquet(f"{path.rstrip('/')}/snapshot={newest}")


def read_snapshot(spark, path: str) -> DataFrame:
    """The newest whole snapshot."""
    newest = spark.read.parquet(f"{path.rstrip('/')}/done/*").agg(F.max("id")).first()[0]
    return spark.read.parquet(f"{path.rstrip('/')}/snapshot={newest}")

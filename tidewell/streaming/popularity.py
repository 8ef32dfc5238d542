"""Streaming popularity with exponential decay."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Fixed value: decay scale in seconds.
TAU = 82400.0

OUT = "client string, item_id long, score double, ts timestamp"


def _partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts per (client, item) inside a batch of rows, before anything is shuffled."""
    for pdf in batches:
        if len(pdf):
            yield pdf.groupby(["client", "item_id"], as_index=False).agg(n=("item_id", "size"), us=("us", "max"))


def popular_decay(stream: DataFrame, tau: float = TAU, clients: list[str] | None = None) -> DataFrame:
    """Recent popularity per (client, item): new count + ``exp(-dt/tau)`` * old score, time in seconds.

    ``dt`` runs between the newest events of the item in this and in its last micro-batch; late batches see no
    decay. Rows are counted inside the map tasks first, so a hot item reaches its state as a few rows.
    """
    d = stream if not clients else stream.where(F.col("client").isin(clients))
    counts = d.select("client", "item_id", F.unix_micros("ts").alias("us")).mapInPandas(_partial, "client string, item_id long, n long, us long")

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, us = 0, 0
        for p in parts:
            n, us = n + int(p["n"].sum()), max(us, int(p["us"].max()))
        score = float(n)
        if state.exists:
            old, at = state.get
            score += math.exp(-max(us - at, 0) / 1e6 / tau) * old
            us = max(us, at)
        state.update((score, us))
        yield pd.DataFrame({"client": [key[0]], "item_id": [key[1]], "score": [score], "ts": [pd.Timestamp(us, unit="us")]})

    return counts.groupBy("client", "item_id").applyInPandasWithState(update, OUT, "score double, us long", "update", GroupStateTimeout.NoTimeout)


FORWARD_KEYS = ["start", "client", "item_id"]


def forward_decay(stream: DataFrame, tau: float = TAU, span: str = "7 days", delay: str = "1 day", clients: list[str] | None = None) -> DataFrame:
    """Decayed popularity as sums that any number of tasks and micro-batches can add up: per (start, client, item) ``weight`` and ``n``.

    An event weighs ``exp((ts - start) / tau)`` with the start of its ``span`` of time, so weights never shrink and stay
    below ``exp(span / tau)``; they are decayed to a moment when they are read (``decayed_at``). Sums are made in the map tasks first; a
    span leaves the state once the watermark (``delay`` behind the newest event) has passed it, its last sums stay in the table.
    """
    d = stream if not clients else stream.where(F.col("client").isin(clients))
    d = d.withWatermark("ts", delay).withColumn("w", F.window("ts", span))
    weight = F.exp((F.unix_micros("ts") - F.unix_micros("w.start")) / 1e6 / tau)
    sums = d.groupBy("w", "client", "item_id").agg(F.sum(weight).alias("weight"), F.count("*").alias("n"), F.max("ts").alias("newest"))
    return sums.select(F.col("w.start").alias("start"), "client", "item_id", "weight", "n", "newest")


def decayed_at(sums: DataFrame, now: Column | None = None, tau: float = TAU) -> DataFrame:
    """(client, item_id, score): every event counts ``exp(-(now - ts) / tau)``; without ``now``, the item's newest event."""
    at = F.unix_micros(F.max("newest") if now is None else F.max(now))
    per_item = sums.groupBy("client", "item_id").agg(at.alias("at"), F.collect_list(F.struct(F.unix_micros("start").alias("s"), "weight")).alias("spans"))
    score = F.aggregate("spans", F.lit(0.0), lambda a, x: a + x["weight"] * F.exp((x["s"] - F.col("at")) / 1e6 / tau))
    return per_item.select("client", "item_id", score.alias("score"))

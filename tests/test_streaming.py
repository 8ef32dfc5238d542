"""Streams against their batch results, restart, late rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from tidewell.session import scratch_path
from tidewell.sources import readers, writers
from tidewell.streaming import minhash as mh, popularity, stats


def rows(spark, data):
    return spark.createDataFrame(data, "client string, tag string, variation string, kind string, t long").withColumn("ts", F.timestamp_seconds("t")).drop("t")


SCHEMA = "client string, tag string, variation string, kind string, ts timestamp"


def run(spark, root, out, progress):
    s = stats.impression_stats(readers.read_stream(spark, "parquet", {"path": root, "maxFilesPerTrigger": "1"}, SCHEMA), "60 seconds", "2 minutes")
    writers.write_stats(s, out, progress).awaitTermination()
    return {(r.time.timestamp(), r.tag, r.variation): (r.impressions, r.clicks) for r in writers.read_stats(spark, out, ["time", "client", "tag", "variation"]).collect()}


def test_restart_and_late_rows(spark):
    root, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    first = rows(spark, [("c", None, "-", "IMP", 10), ("c", "null", "-", "CTR", 20), ("c", "x", "v", "IMP", 70)])
    first.coalesce(1).write.mode("append").parquet(root)
    assert run(spark, root, out, progress) == {(0.0, "default", "all"): (1, 1), (60.0, "x", "v"): (1, 0)}
    # a restart keeps the state: the window grows, and a row behind the watermark is dropped
    rows(spark, [("c", "x", "v", "CTR", 80), ("c", "x", "v", "IMP", 1000)]).coalesce(1).write.mode("append").parquet(root)
    assert run(spark, root, out, progress)[(60.0, "x", "v")] == (1, 1)
    rows(spark, [("c", "x", "v", "IMP", 71), ("c", "x", "v", "IMP", 1001)]).coalesce(1).write.mode("append").parquet(root)
    got = run(spark, root, out, progress)
    assert got[(60.0, "x", "v")] == (1, 1) and got[(960.0, "x", "v")] == (2, 0)


def test_popular_decay_recurrence(spark):
    root, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    steps = [[0, 5], [100], [60]]
    for times in steps:
        spark.createDataFrame([("c", 1, t) for t in times], "client string, item_id long, t long").select("client", "item_id", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.mode("append").parquet(root)
    s = popularity.popular_decay(readers.read_stream(spark, "parquet", {"path": root, "maxFilesPerTrigger": "1"}, "client string, item_id long, ts timestamp"), 50.0)
    writers.write_stats(s, out, progress).awaitTermination()
    got = writers.read_stats(spark, out, ["client", "item_id"]).first()
    want = 1 + (1 + 2 * math.exp(-95 / 50))  # the late batch sees no decay
    assert math.isclose(got.score, want, rel_tol=1e-9) and got.ts.timestamp() == 100


def test_minhash_half_overlap(spark):
    data = [(1, u, u) for u in range(1, 100)] + [(2, u, u) for u in range(51, 100)]
    df = spark.createDataFrame(data, "item_id long, user_id long, t long").withColumn("ts", F.timestamp_seconds("t"))
    now = F.timestamp_seconds(F.lit(1000))
    out = mh.rolling(df, now, 10000, 100).collect()
    assert len(out) == 1 and abs(out[0].score - 0.5) <= 0.15
    assert mh.rolling(df, now, 10000, 100, min_activity=200).count() == 0
    # users 1..50 expired: both items now have the same users
    assert mh.rolling(df, now, 950, 100).first().score == 1.0


def test_minhash_is_close_to_jaccard(spark):
    data = [(i, u) for i in range(6) for u in range(i * 10, i * 10 + 60)]
    df = spark.createDataFrame(data, "item_id long, user_id long").withColumn("ts", F.timestamp_seconds(F.lit(5)))
    out = mh.minhash_window(df, F.timestamp_seconds(F.lit(0)), F.timestamp_seconds(F.lit(10)), 200)
    sets = {i: set(range(i * 10, i * 10 + 60)) for i in range(6)}
    for r in out.collect():
        a, b = sets[r.item_a], sets[r.item_b]
        assert abs(r.score - len(a & b) / len(a | b)) < 0.15


def test_minhash_snapshot_is_whole_in_any_number_of_batches(spark):
    """Same events in 1, 2 and 5 micro-batches: the newest snapshot holds every window."""
    events = [(u, i, w * 100 + u) for w in range(4) for u in range(12) for i in range(5) if (u + i + w) % 3]
    df = spark.createDataFrame(events, "user_id long, item_id long, t long").withColumn("ts", F.timestamp_seconds("t"))
    found = []
    for parts, keep in ((1, None), (2, None), (5, None), (5, 150)):
        root, out = scratch_path(spark, "in"), scratch_path(spark, "out")
        for p in range(parts):
            df.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == p).drop("t").coalesce(1).write.mode("append").parquet(root)
        stream = readers.read_stream(spark, "parquet", {"path": root, "maxFilesPerTrigger": "1"}, "user_id long, item_id long, ts timestamp")
        sigs = mh.window_signatures(stream, "100 seconds", None, 16, delay="1 day")
        writer = sigs.writeStream.outputMode("update").option("checkpointLocation", scratch_path(spark, "progress"))
        writer.foreachBatch(mh.minhash_sim(out, 16, keep=keep)).trigger(**stats.trigger(once=True)).start().awaitTermination()
        found.append({tuple(r) for r in stats.read_snapshot(spark, f"{out}/similarity").select(F.unix_timestamp("end"), "item_a", "item_b", F.round("score", 9)).collect()})
    assert found[0] == found[1] == found[2] and {r[0] for r in found[0]} == {100, 200, 300, 400}
    assert found[3] == {r for r in found[0] if r[0] > 250}


def test_sliding_minhash_in_any_number_of_batches(spark):
    """Windows of 100 seconds every 50: the same snapshot from 1, 2 and 5 micro-batches, equal to the rolling form at every window's end."""
    events = [(u, i, w * 50 + u * 4) for w in range(5) for u in range(12) for i in range(5) if (u * i + w) % 3]
    df = spark.createDataFrame(events, "user_id long, item_id long, t long").withColumn("ts", F.timestamp_seconds("t"))
    found = []
    for parts in (1, 2, 5):
        root, out = scratch_path(spark, "in"), scratch_path(spark, "out")
        for p in range(parts):
            df.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == p).drop("t").coalesce(1).write.mode("append").parquet(root)
        stream = readers.read_stream(spark, "parquet", {"path": root, "maxFilesPerTrigger": "1"}, "user_id long, item_id long, ts timestamp")
        sigs = mh.window_signatures(stream, "100 seconds", "50 seconds", 16, delay="1 day")
        writer = sigs.writeStream.outputMode("update").option("checkpointLocation", scratch_path(spark, "progress"))
        writer.foreachBatch(mh.minhash_sim(out, 16)).trigger(**stats.trigger(once=True)).start().awaitTermination()
        found.append({tuple(r) for r in stats.read_snapshot(spark, f"{out}/similarity").select(F.unix_timestamp("end"), "item_a", "item_b", F.round("score", 9)).collect()})
    assert found[0] == found[1] == found[2] and len({r[0] for r in found[0]}) >= 5
    for end in (100, 200):
        at = F.timestamp_seconds(F.lit(end))
        want = mh.minhash_window(df, F.timestamp_seconds(F.lit(end - 100)), at, 16).collect()
        assert {r[1:] for r in found[0] if r[0] == end} == {(r.item_a, r.item_b, round(r.score, 9)) for r in want}


def test_forward_decay_in_any_number_of_batches(spark):
    events = [("c", i, t) for i in range(3) for t in range(0, 4000, 37 * (i + 1))] + [("d", 1, 3999)]
    df = spark.createDataFrame(events, "client string, item_id long, t long").withColumn("ts", F.timestamp_seconds("t"))
    want = {(c, i): sum(math.exp((t - 4000) / 700) for c2, i2, t in events if (c2, i2) == (c, i)) for c, i, _ in events}
    for parts in (1, 3):
        root, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
        for p in range(parts):
            df.where(F.pmod(F.xxhash64("t"), F.lit(parts)) == p).drop("t").coalesce(1).write.mode("append").parquet(root)
        s = readers.read_stream(spark, "parquet", {"path": root, "maxFilesPerTrigger": "1"}, "client string, item_id long, ts timestamp")
        writers.write_stats(popularity.forward_decay(s, 700.0, "1000 seconds", "1 day"), out, progress).awaitTermination()
        got = popularity.decayed_at(writers.read_stats(spark, out, popularity.FORWARD_KEYS), F.timestamp_seconds(F.lit(4000)), 700.0)
        assert {(r.client, r.item_id): round(r.score, 9) for r in got.collect()} == {k: round(v, 9) for k, v in want.items()}


def test_forward_decay_drops_old_state(spark):
    """Once the watermark has passed a stretch of time, its sums leave the state; the table keeps them."""
    root, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
    for t in (0, 10_000, 20_000, 30_000):
        spark.createDataFrame([("c", 1, t)], "client string, item_id long, t long").select("client", "item_id", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.mode("append").parquet(root)
    s = readers.read_stream(spark, "parquet", {"path": root, "maxFilesPerTrigger": "1"}, "client string, item_id long, ts timestamp")
    q = writers.write_stats(popularity.forward_decay(s, 700.0, "1000 seconds", "1 second"), out, progress)
    q.awaitTermination()
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2 and writers.read_stats(spark, out, popularity.FORWARD_KEYS).count() == 4


def test_emissions_by_time_and_count(spark):
    """Emissions of one run and of runs in pieces are those of plain Python over the ordered events."""
    rng = np.random.default_rng(3)
    events = sorted((int(t), str(c)) for t, c in zip(rng.integers(0, 5000, 400), rng.choice(["a", "b"], 400)))
    want, count, slot = set(), {}, {}
    for second in sorted({t for t, _ in events}):
        for client in "ab":
            n = sum(e == (second, client) for e in events)
            if n:
                before = count.get(client, 0)
                if client in slot and second // 600 > slot[client]:
                    want.add((client, "time", second // 600 * 600, before))
                slot[client] = second // 600
                want |= {(client, "count", second, m) for m in range(before + 1, before + n + 1) if m % 50 == 0}
                count[client] = before + n
    for cuts in ([0, 5000], [0, 700, 1800, 1900, 5000]):
        root, out, progress = (scratch_path(spark, n) for n in ("in", "out", "progress"))
        for lo, hi in zip(cuts, cuts[1:]):
            part = spark.createDataFrame([(c, t) for t, c in events if lo <= t < hi], "client string, t long")
            part.select("client", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.mode("append").parquet(root)
        s = readers.read_stream(spark, "parquet", {"path": root, "maxFilesPerTrigger": "1"}, "client string, ts timestamp")
        writers.write_stats(stats.emissions(s, 600, 50), out, progress, "append").awaitTermination()
        got = spark.read.parquet(f"{out}/*").select("client", "reason", F.unix_timestamp("at").alias("at"), "n").collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want

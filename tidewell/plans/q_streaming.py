"""Queries: streaming jobs run to completion over the whole event log as a file stream, plus their batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions.hashing import hash_family
from tidewell.plans import fixtures as fx
from tidewell.plans.q_scalars import SQL_TEMPLATE
from tidewell.plans.registry import query
from tidewell.session import scratch_path
from tidewell.sources import readers, writers
from tidewell.streaming import minhash as mh, popularity, stats


#: Files of one micro-batch: a batch is read and written by as many tasks.
FILES = 4


def event_stream(spark, d, view, parts: int = 1, ordered: bool = False):
    """A canonical view of the events as a file stream; ``parts`` > 1 delivers it in that many micro-batches.

    They hold days by remainder, so later ones also hold earlier times, or with ``ordered`` one stretch of time after the other.
    """
    root = scratch_path(spark, "stream")
    rows = view(spark, d)
    if parts == 1:
        rows.write.parquet(root)
    else:
        first, last = rows.select(F.min(F.unix_date(F.to_date("ts"))), F.max(F.unix_date(F.to_date("ts")))).first() if ordered else (0, 0)
        place = F.floor((F.unix_date(F.to_date("ts")) - first) * parts / (last - first + 1)) if ordered else F.dayofmonth("ts") % parts
        for i in range(parts):
            rows.where(place == i).repartition(FILES).write.mode("append").parquet(root)
    opts = {"path": root} if parts == 1 else {"path": root, **stats.files_per_trigger(FILES)}
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return readers.read_stream(spark, "parquet", opts, schema)


def finished(spark, stream, keys, mode="update"):
    """Run a statistics stream over all available data and read the table it wrote."""
    out = scratch_path(spark, "stats")
    writers.write_stats(stream, out, scratch_path(spark, "progress"), mode).awaitTermination()
    return writers.read_stats(spark, out, keys)


@query(
    "st_impressions",
    """SELECT CAST(epoch(time_bucket(INTERVAL '1 hour', ts)) AS BIGINT) AS time, client, tag, variation, count(*) FILTER (kind = 'IMP') AS impressions,
              count(*) FILTER (kind = 'CTR') AS clicks FROM fx_impressions GROUP BY 1, 2, 3, 4""",
)
def st_impressions(spark, d):
    s = stats.impression_stats(event_stream(spark, d, fx.impressions), "1 hour")
    out = finished(spark, s, ["time", "client", "tag", "variation"])
    return out.withColumn("time", F.unix_timestamp("time"))


@query(
    "st_requests",
    f"""SELECT CAST(epoch(time_bucket(INTERVAL '1 hour', ts)) AS BIGINT) AS time, client, method, {SQL_TEMPLATE} AS path, count(*) AS n, round(avg(exectime), 6) AS mean_time
        FROM fx_requests GROUP BY 1, 2, 3, 4""",
)
def st_requests(spark, d):
    s = stats.request_stats(event_stream(spark, d, fx.request_log), "1 hour")
    out = finished(spark, s, ["time", "client", "method", "path"])
    return out.withColumn("time", F.unix_timestamp("time")).withColumn("mean_time", F.round("mean_time", 6))


def predictions(spark, d):
    """Predictions derived from events: three classes scored by the event's value."""
    v = F.col("value")

    def cls(score, name):
        return F.struct(score.alias("prediction"), F.lit(name).alias("predictedClass"))

    return fx.table(spark, d, "events").select(
        "ts",
        F.concat(F.lit("c"), F.col("user_id") % 3).alias("client"),
        F.when(F.col("user_id") % 2 == 0, "a").otherwise("b").alias("variation"),
        F.col("event_type").alias("model"),
        F.array(cls(v, "high"), cls(60 - v / 2, "mid")).alias("predictions"),
    )


@query(
    "st_predictions",
    """SELECT CAST(epoch(time_bucket(INTERVAL '1 day', ts)) AS BIGINT) AS time, 'c' || (user_id % 3) AS client, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS variation,
              event_type AS model, CASE WHEN value >= 60 - value / 2 THEN CASE WHEN value = 60 - value / 2 THEN 'mid' ELSE 'high' END ELSE 'mid' END AS best, count(*) AS n,
              round(avg(greatest(value, 60 - value / 2)), 6) AS mean_score FROM events GROUP BY 1, 2, 3, 4, 5""",
)
def st_predictions(spark, d):
    s = stats.prediction_stats(event_stream(spark, d, predictions), "1 day")
    out = finished(spark, s, ["time", "client", "variation", "model", "best"])
    return out.withColumn("time", F.unix_timestamp("time")).withColumn("mean_score", F.round("mean_score", 6))


def tagged_events(spark, d):
    return fx.table(spark, d, "events").select("event_id", F.col("event_type").alias("tag"), "user_id", "ts")


@query("st_branch", "SELECT CASE event_type WHEN 'view' THEN 'imps' ELSE 'clicks' END AS branch, event_id, user_id FROM events WHERE event_type IN ('view', 'click')")
def st_branch(spark, d):
    out = scratch_path(spark, "branch")
    s = event_stream(spark, d, tagged_events)
    writer = s.writeStream.option("checkpointLocation", scratch_path(spark, "progress")).trigger(**stats.trigger(once=True))
    writer.foreachBatch(stats.branch({"view": "imps", "click": "clicks"}, out)).start().awaitTermination()
    a, b = (spark.read.parquet(f"{out}/{n}/*").select(F.lit(n).alias("branch"), "event_id", "user_id") for n in ("imps", "clicks"))
    return a.union(b)


def sink_stats_points(spark, d):
    return st_impressions(spark, d)


query(
    "sink_stats",
    """SELECT CAST(epoch(time_bucket(INTERVAL '1 hour', ts)) AS BIGINT) AS time, client, tag, variation, count(*) FILTER (kind = 'IMP') AS impressions,
              count(*) FILTER (kind = 'CTR') AS clicks FROM fx_impressions GROUP BY 1, 2, 3, 4""",
)(sink_stats_points)


@query("src_stream_json", "SELECT event_type AS tag, count(*) AS n, sum(user_id)::BIGINT AS users FROM events GROUP BY 1")
def src_stream_json(spark, d):
    """A folder of JSON lines as a stream, counted by tag."""
    root = scratch_path(spark, "json")
    tagged_events(spark, d).write.json(root)
    s = readers.read_stream(spark, "json", {"path": root}, "event_id long, tag string, user_id long, ts timestamp")
    counts = s.groupBy("tag").agg(F.count("*").alias("n"), F.sum("user_id").alias("users"))
    return finished(spark, counts, ["tag"])


TAU = 82400.0


@query(
    "st_popular_decay",
    f"""WITH b AS (SELECT client, item_id, CAST(day(ts) % 3 AS INT) AS b, count(*) AS n, max(ts) AS t FROM fx_actions GROUP BY 1, 2, 3),
        s AS (SELECT client, item_id, max(CASE WHEN b = 0 THEN n END) AS n0, max(CASE WHEN b = 1 THEN n END) AS n1, max(CASE WHEN b = 2 THEN n END) AS n2,
                     max(CASE WHEN b = 0 THEN epoch_us(t) END) AS t0, max(CASE WHEN b = 1 THEN epoch_us(t) END) AS t1, max(CASE WHEN b = 2 THEN epoch_us(t) END) AS t2 FROM b GROUP BY 1, 2),
        x AS (SELECT client, item_id, coalesce(n1, 0) + CASE WHEN n1 IS NULL THEN coalesce(n0, 0) ELSE coalesce(n0, 0) * exp(-greatest(t1 - coalesce(t0, t1), 0) / 1e6 / {TAU}) END AS s1,
                     greatest(coalesce(t0, 0), coalesce(t1, 0)) AS u1, n2, t2 FROM s)
        SELECT client, item_id, round(CASE WHEN n2 IS NULL THEN s1 ELSE n2 + s1 * exp(-greatest(t2 - CASE WHEN u1 = 0 THEN t2 ELSE u1 END, 0) / 1e6 / {TAU}) END, 6) AS score FROM x""",
)
def st_popular_decay(spark, d):
    """Three micro-batches (days by remainder, so later batches also hold earlier times)."""
    s = popularity.popular_decay(event_stream(spark, d, lambda sp, x: fx.actions(sp, x).select("client", "item_id", "ts"), 3))
    out = finished(spark, s, ["client", "item_id"])
    return out.select("client", "item_id", F.round("score", 6).alias("score"))


@query(
    "st_popular_forward",
    f"""SELECT client, item_id, round(sum(exp((epoch_us(ts) - epoch_us(newest)) / 1e6 / {TAU})), 6) AS score
        FROM (SELECT client, item_id, ts, max(ts) OVER (PARTITION BY client, item_id) AS newest FROM fx_actions) GROUP BY client, item_id""",
)
def st_popular_forward(spark, d):
    """Decay by event, the same in any number and order of micro-batches."""
    s = popularity.forward_decay(event_stream(spark, d, lambda sp, x: fx.actions(sp, x).select("client", "item_id", "ts"), 3), delay="60 days")
    out = popularity.decayed_at(finished(spark, s, popularity.FORWARD_KEYS))
    return out.select("client", "item_id", F.round("score", 6).alias("score"))


H = 24
HASHES = hash_family(H)
SQL_SIGS = ", ".join(f"min(CAST((CAST({a} AS HUGEINT) * user_id + {b}) % 4294967311 AS BIGINT)) AS h{i}" for i, (a, b) in enumerate(HASHES))
SQL_EQUAL = " + ".join(f"(a.h{i} = b.h{i})::INT" for i in range(H))
SQL_PAIRS = f"SELECT a.wend, a.item_id AS item_a, b.item_id AS item_b, ({SQL_EQUAL}) / {H}.0 AS score FROM sg a JOIN sg b ON a.wend = b.wend AND a.item_id < b.item_id"


@query(
    "st_minhash_sim",
    f"""WITH sg AS (SELECT time_bucket(INTERVAL '6 days', ts, TIMESTAMP '1970-01-01') + INTERVAL '6 days' AS wend, item_id, count(*) AS n, {SQL_SIGS} FROM fx_actions GROUP BY 1, 2 HAVING count(*) >= 18),
        p AS ({SQL_PAIRS}) SELECT CAST(epoch(wend) AS BIGINT) AS wend, item_a, item_b, round(score, 6)::DOUBLE AS score FROM p WHERE score > 0""",
)
def st_minhash_sim(spark, d):
    out = scratch_path(spark, "minhash")
    sigs = mh.window_signatures(event_stream(spark, d, fx.actions), "6 days", None, H)
    writer = sigs.writeStream.outputMode("update").option("checkpointLocation", scratch_path(spark, "progress"))
    writer.foreachBatch(mh.minhash_sim(out, H, 18)).trigger(**stats.trigger(once=True)).start().awaitTermination()
    snap = stats.read_snapshot(spark, f"{out}/similarity")
    return snap.select(F.unix_timestamp("end").alias("wend"), "item_a", "item_b", F.round("score", 6).alias("score"))


@query(
    "st_minhash_fixed",
    f"""WITH sg AS (SELECT 1 AS wend, item_id, count(*) AS n, {SQL_SIGS} FROM fx_actions WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-12' GROUP BY item_id),
        p AS ({SQL_PAIRS}) SELECT item_a, item_b, round(score, 6)::DOUBLE AS score FROM p WHERE score > 0""",
)
def st_minhash_fixed(spark, d):
    at = lambda t: F.to_timestamp(F.lit(t))
    out = mh.minhash_window(fx.actions(spark, d), at("2024-01-05 00:00:00"), at("2024-01-12 00:00:00"), H)
    return out.withColumn("score", F.round("score", 6))


@query(
    "st_minhash_rolling",
    f"""WITH sg AS (SELECT 1 AS wend, item_id, count(*) AS n, {SQL_SIGS} FROM fx_actions WHERE ts > TIMESTAMP '2024-01-20' - INTERVAL '10 days' AND ts <= TIMESTAMP '2024-01-20'
              GROUP BY item_id HAVING count(*) >= 30), p AS ({SQL_PAIRS}) SELECT item_a, item_b, round(score, 6)::DOUBLE AS score FROM p WHERE score > 0""",
)
def st_minhash_rolling(spark, d):
    out = mh.rolling(fx.actions(spark, d), F.to_timestamp(F.lit("2024-01-20 00:00:00")), 864000, H, 30)
    return out.withColumn("score", F.round("score", 6))


@query("st_emit_policy", "SELECT client, count(*) AS n FROM fx_actions GROUP BY client")
def st_emit_policy(spark, d):
    """One micro-batch per delivered file; the last update per key is the total."""
    s = event_stream(spark, d, lambda sp, x: fx.actions(sp, x).select("client", "ts"), 4)
    return finished(spark, s.groupBy("client").agg(F.count("*").alias("n")), ["client"])


@query(
    "st_emit_policy_data",
    """WITH s AS (SELECT client, CAST(floor(epoch(ts)) AS BIGINT) AS sec, count(*) AS c FROM fx_actions GROUP BY 1, 2),
            r AS (SELECT client, sec, c, sec // 259200 AS slot, CAST(sum(c) OVER (PARTITION BY client ORDER BY sec) AS BIGINT) AS total FROM s),
            l AS (SELECT *, lag(slot) OVER (PARTITION BY client ORDER BY sec) AS before FROM r)
       SELECT client, 'time' AS reason, slot * 259200 AS at, total - c AS n FROM l WHERE slot > before
       UNION ALL SELECT client, 'count' AS reason, sec AS at, unnest(range((total - c) // 500 + 1, total // 500 + 1)) * 500 AS n FROM r""",
)
def st_emit_policy_data(spark, d):
    """The emissions themselves: every three days of event time, and every 500 events of a client."""
    s = stats.emissions(event_stream(spark, d, lambda sp, x: fx.actions(sp, x).select("client", "ts"), 4, ordered=True), 259_200, 500)
    out = scratch_path(spark, "emissions")
    writers.write_stats(s, out, scratch_path(spark, "progress"), "append").awaitTermination()
    return spark.read.parquet(f"{out}/*").select("client", "reason", F.unix_timestamp("at").alias("at"), "n")


@query("st_snapshot_frame", "SELECT item_id, count(*) AS n FROM fx_actions GROUP BY item_id")
def st_snapshot_frame(spark, d):
    """Every micro-batch writes the whole running result as one snapshot."""
    out = scratch_path(spark, "snapshot")
    s = event_stream(spark, d, lambda sp, x: fx.actions(sp, x).select("item_id", "ts"), 3).groupBy("item_id").agg(F.count("*").alias("n"))
    writer = s.writeStream.outputMode("complete").option("checkpointLocation", scratch_path(spark, "progress")).trigger(**stats.trigger(once=True))
    writer.foreachBatch(stats.emit_snapshot(out, lambda b: b)).start().awaitTermination()
    return stats.read_snapshot(spark, out)

"""Queries: sessions, baskets, histories, recency."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import aggregates as agg, filters as flt, sessions as ses
from tidewell.operators.topk import topk
from tidewell.plans import fixtures as fx
from tidewell.plans.registry import query

GAP = 4 * 3600


def joined(col: str):
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",").alias(col)


SQL_SESSIONS = f"""us AS (SELECT user_id FROM fx_actions GROUP BY 1 HAVING count(*) BETWEEN 2 AND 100000),
    g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM fx_actions WHERE user_id IN (FROM us)),
    s AS (SELECT *, 1 + sum(CASE WHEN epoch_us(ts) - epoch_us(prev) > {GAP}000000 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)"""


@query(
    "session_items",
    f"""WITH {SQL_SESSIONS} SELECT user_id, CAST(session AS BIGINT) AS session, string_agg(item_id::VARCHAR, ',' ORDER BY ts, event_id) AS items
        FROM s GROUP BY user_id, session""",
)
def session_items(spark, d):
    return ses.session_items(fx.actions(spark, d), GAP, 2, 100000).select("user_id", "session", joined("items"))


SQL_TAG_SESSIONS = f"""tw AS (SELECT item_id, list(tag ORDER BY tag) AS words FROM fx_item_tags GROUP BY item_id),
    ta AS (SELECT a.*, words FROM fx_actions a JOIN tw USING (item_id)),
    us AS (SELECT user_id FROM ta GROUP BY 1 HAVING count(*) > 2 AND count(*) < 100000),
    g AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM ta WHERE user_id IN (FROM us)),
    s AS (SELECT *, 1 + sum(CASE WHEN epoch_us(ts) - epoch_us(prev) > {GAP}000000 THEN 1 ELSE 0 END)
                 OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM g)"""


@query(
    "session_tags",
    f"""WITH {SQL_TAG_SESSIONS} SELECT user_id, CAST(session AS BIGINT) AS session,
            string_agg(array_to_string(words, ','), ',' ORDER BY ts, event_id) AS words
        FROM s GROUP BY user_id, session HAVING sum(len(words)) >= 5""",
)
def session_tags(spark, d):
    out = ses.session_tags(fx.actions(spark, d), fx.item_tags(spark, d), GAP, 2, 100000, 5)
    return out.select("user_id", "session", joined("words"))


@query(
    "basket_sessions",
    """WITH us AS (SELECT user_id FROM fx_baskets GROUP BY 1 HAVING count(*) BETWEEN 1 AND 100000),
       g AS (SELECT *, lag(ts) OVER w AS prev FROM fx_baskets WHERE user_id IN (FROM us)
             WINDOW w AS (PARTITION BY user_id ORDER BY ts, basket_id, line, item_id, kind)),
       s AS (SELECT *, 1 + sum(CASE WHEN epoch(ts) - epoch(prev) > 15552000 AND kind = 1 THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id ORDER BY ts, basket_id, line, item_id, kind ROWS UNBOUNDED PRECEDING) AS session FROM g),
       l AS (SELECT user_id, session, item_id, arg_max(kind, (ts, basket_id, line, item_id, kind)) AS kind FROM s GROUP BY 1, 2, 3)
       SELECT user_id, CAST(session AS BIGINT) AS session, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS items
       FROM l WHERE kind = 1 GROUP BY 1, 2""",
)
def basket_sessions(spark, d):
    order = ["ts", "basket_id", "line", "item_id", "kind"]
    return ses.baskets(fx.baskets(spark, d), 1, 15552000, 1, 100000, order).select("user_id", "session", joined("items"))


SQL_ENGAGE = """g AS (SELECT *, lag(ts) OVER (PARTITION BY client, user_id ORDER BY ts, event_id) AS prev FROM fx_impressions),
    s AS (SELECT *, 1 + sum(CASE WHEN epoch_us(ts) - epoch_us(prev) > 36000000000 THEN 1 ELSE 0 END)
               OVER (PARTITION BY client, user_id ORDER BY ts, event_id) AS session,
               CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 36000000000 THEN 0
                    ELSE floor((epoch_ms(ts) - epoch_ms(prev)) / 1000) END AS gap FROM g),
    p AS (SELECT client, user_id, session, min(variation) AS variation, greatest(sum(gap), 1) AS seconds, count(*) AS page_views
          FROM s GROUP BY 1, 2, 3),
    k AS (SELECT *, row_number() OVER (PARTITION BY client, user_id ORDER BY session) AS r FROM p WHERE page_views <= 6)"""


@query(
    "engagement_sessions",
    f"""WITH {SQL_ENGAGE} SELECT client, user_id, variation, CAST(session AS BIGINT) AS session, CAST(seconds AS BIGINT) AS seconds, page_views,
               CASE WHEN r = 1 THEN 1 ELSE 0 END AS user_count, CASE WHEN page_views > 1 THEN 1 ELSE 0 END AS multi_page FROM k""",
)
def engagement_sessions(spark, d):
    return agg.engagement_sessions(fx.impressions(spark, d), 36000, 6)


@query(
    "engagement_ab",
    f"""WITH {SQL_ENGAGE}, st AS (SELECT client, variation, avg(seconds) AS s, avg(page_views) AS v,
               avg(CASE WHEN page_views > 1 THEN 1.0 ELSE 0.0 END) AS m FROM k GROUP BY 1, 2)
        SELECT b.client, round(b.s, 6) AS base_avg_seconds, round(b.v, 6) AS base_avg_views, round(b.m, 6) AS base_multi_share,
               round(n.s, 6) AS normal_avg_seconds, round(n.v, 6) AS normal_avg_views, round(n.m, 6) AS normal_multi_share,
               round(n.s - b.s, 6) AS diff_avg_seconds, round(n.v - b.v, 6) AS diff_avg_views, round(n.m - b.m, 6) AS diff_multi_share
        FROM st b JOIN st n ON b.client = n.client AND b.variation = 'baseline' AND n.variation = 'normal'""",
)
def engagement_ab(spark, d):
    out = agg.engagement_ab(fx.impressions(spark, d), 36000, 6)
    return out.select("client", *[F.round(c, 6).alias(c) for c in out.columns if c != "client"])


SQL_HISTORY = """tw AS (SELECT item_id, list(tag ORDER BY tag) AS tags FROM fx_item_tags GROUP BY item_id),
    h AS (SELECT a.*, tags, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq
          FROM fx_actions a JOIN tw USING (item_id))"""


@query(
    "history_features",
    f"""WITH {SQL_HISTORY}, f AS (SELECT * FROM h WHERE seq <= 12),
        b AS (SELECT *, flatten(list(tags) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS past FROM f)
        SELECT user_id, event_id, CAST(seq AS BIGINT) AS seq,
               array_to_string(list_concat(list_transform(tags, lambda t: 'i_' || t), list_transform(coalesce(past, []), lambda t: 'u_' || t)), ' ') AS features
        FROM b WHERE seq >= 2""",
)
def history_features(spark, d):
    out = ses.history_features(fx.actions(spark, d), fx.item_tags(spark, d), 2, 12)
    return out.select("user_id", "event_id", F.col("seq").cast("long").alias("seq"), F.array_join("features", " ").alias("features"))


@query(
    "next_item_features",
    """WITH tw AS (SELECT item_id, list(tag ORDER BY tag) AS tags FROM fx_item_tags GROUP BY item_id),
       h AS (SELECT user_id, event_id, tags, lag(tags) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS past
             FROM fx_actions JOIN tw USING (item_id) WHERE value > 3)
       SELECT user_id, event_id, array_to_string(list_concat(list_transform(tags, lambda t: 'i_' || t), list_transform(past, lambda t: 'u_' || t)), ' ') AS features
       FROM h WHERE past IS NOT NULL""",
)
def next_item_features(spark, d):
    out = ses.next_item_features(fx.actions(spark, d), fx.item_tags(spark, d), 3.0)
    return out.select("user_id", "event_id", F.array_join("features", " ").alias("features"))


@query(
    "recent_actions",
    """SELECT user_id, item_id, rank FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank
       FROM fx_actions) WHERE rank <= 10""",
    longs=("rank",),
)
def recent_actions(spark, d):
    return ses.recent_actions(fx.actions(spark, d), 10)


@query(
    "recent_items",
    """SELECT * FROM (SELECT 'all' AS kind, p_partkey AS item_id FROM part ORDER BY 2 DESC LIMIT 20)
       UNION ALL SELECT * FROM (SELECT 'dim', p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#2') ORDER BY 2 DESC LIMIT 20)
       UNION ALL SELECT * FROM (SELECT 'two', p_partkey FROM part WHERE p_brand IN ('Brand#1', 'Brand#2') AND p_type = 'LARGE' ORDER BY 2 DESC LIMIT 20)""",
)
def recent_items(spark, d):
    items = fx.table(spark, d, "part").select(F.col("p_partkey").alias("item_id"))
    dims = fx.item_dims(spark, d)
    pick = ["Brand#1", "Brand#2"]
    lists = {"all": items, "dim": flt.items_with_dims(items, dims, pick), "two": flt.items_two_dims(items, dims, pick, "LARGE")}
    out = [flt.items_list(i, "id", 0, 20).select(F.lit(n).alias("kind"), "item_id") for n, i in lists.items()]
    return out[0].union(out[1]).union(out[2])


@query(
    "recent_items_by_tag",
    """SELECT DISTINCT item_id FROM fx_item_tags WHERE tag IN ('ring', 'promo') ORDER BY item_id DESC LIMIT 40""",
)
def recent_items_by_tag(spark, d):
    hit = fx.item_tags(spark, d).where(F.col("tag").isin("ring", "promo")).select("item_id").distinct()
    return topk(hit, 40, score="item_id")

"""Queries: projections, filters, lookups and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import filters as flt, joins, skew
from tidewell.plans import fixtures as fx
from tidewell.plans.registry import query, sql_share


def items(spark, d):
    return fx.table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"), F.col("p_type").alias("item_type"))


def customer(spark, d):
    return fx.table(spark, d, "customer")


@query("include_features", "SELECT c_custkey, c_mktsegment FROM customer")
def include_features(spark, d):
    return flt.include(customer(spark, d), ["c_custkey", "c_mktsegment", "absent"])


@query("exclude_features", "SELECT c_custkey, c_name, c_nationkey FROM customer")
def exclude_features(spark, d):
    return flt.exclude(customer(spark, d), ["c_acctbal", "c_mktsegment", "absent"])


@query(
    "exist_features",
    """SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND toxic IS NOT NULL""",
)
def exist_features(spark, d):
    wide = fx.table(spark, d, "documents").select("doc_id").join(fx.table(spark, d, "labels"), "doc_id", "left")
    return flt.require(wide, ["quality", "toxic"]).select("doc_id", "quality")


@query(
    "json_feature_filter",
    """SELECT event_id, regexp_extract(props, '"k": *([0-9]+)', 1) AS kept, 0::BIGINT AS rest FROM events""",
)
def json_feature_filter(spark, d):
    e = fx.table(spark, d, "events").select("event_id", F.from_json("props", "map<string,string>").alias("m"))
    return e.select(
        "event_id",
        flt.filter_keys("m", ["k"])["k"].alias("kept"),
        F.size(flt.filter_keys("m", ["k"], "exclusive")).cast("long").alias("rest"),
    )


@query("filter_action_type", "SELECT event_id FROM fx_actions WHERE action_type IN (2, 3)")
def filter_action_type(spark, d):
    return flt.filter_types(fx.actions(spark, d), [2, 3]).select("event_id")


@query(
    "filter_user_activity",
    """SELECT event_id, user_id FROM fx_actions WHERE user_id IN (SELECT user_id FROM fx_actions GROUP BY 1 HAVING count(*) BETWEEN 60 AND 70)""",
)
def filter_user_activity(spark, d):
    return flt.filter_users(fx.actions(spark, d), 60, 70).select("event_id", "user_id")


@query(
    "filter_item_users",
    """SELECT DISTINCT item_id, user_id FROM fx_actions WHERE item_id IN
       (SELECT item_id FROM fx_actions GROUP BY 1 HAVING count(DISTINCT user_id) BETWEEN 70 AND 75)""",
)
def filter_item_users(spark, d):
    return flt.filter_items(fx.actions(spark, d), 70, 75)


@query("filter_value", "SELECT event_id FROM fx_actions WHERE value > 3")
def filter_value(spark, d):
    return flt.filter_value(fx.actions(spark, d), 3.0).select("event_id")


@query("user_allowlist", "SELECT event_id FROM fx_actions WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')")
def user_allowlist(spark, d):
    users = customer(spark, d).where("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("user_id"))
    return flt.allow_users(fx.actions(spark, d), users).select("event_id")


@query("sample_actions", f"SELECT event_id, user_id, item_id FROM fx_actions WHERE {sql_share('event_id', 42)} < 0.25")
def sample_actions(spark, d):
    return flt.sample(fx.actions(spark, d), 0.25, key=["event_id"]).select("event_id", "user_id", "item_id")


@query("required_dims", "SELECT p_partkey AS item_id, p_name AS name FROM part WHERE p_brand IN ('Brand#3', 'Brand#5')")
def required_dims(spark, d):
    return flt.items_with_dims(items(spark, d), fx.item_dims(spark, d), ["Brand#3", "Brand#5"]).select("item_id", "name")


@query("join_two_dims", "SELECT p_partkey AS item_id FROM part WHERE p_brand IN ('Brand#3', 'Brand#5') AND p_type = 'PROMO'")
def join_two_dims(spark, d):
    return flt.items_two_dims(items(spark, d), fx.item_dims(spark, d), ["Brand#3", "Brand#5"], "PROMO").select("item_id")


@query("tag_match", "SELECT p_partkey AS item_id FROM part WHERE regexp_matches(replace(p_name, ' ', ','), '(^|,)[ ]*ring[ ]*(,|$)')")
def tag_match(spark, d):
    return fx.item_tag_text(spark, d).where(flt.has_tag("tags", "ring")).select("item_id")


@query(
    "actions_by_key",
    """SELECT * FROM (SELECT 'user' AS kind, event_id FROM fx_actions WHERE user_id = 7 ORDER BY ts DESC, event_id DESC LIMIT 20)
       UNION ALL SELECT * FROM (SELECT 'item', event_id FROM fx_actions WHERE item_id = 42 ORDER BY ts DESC, event_id DESC LIMIT 20)
       UNION ALL SELECT * FROM (SELECT 'type', event_id FROM fx_actions WHERE user_id = 7 AND action_type = 3 ORDER BY ts DESC, event_id DESC LIMIT 20)""",
)
def actions_by_key(spark, d):
    a = fx.actions(spark, d)
    parts = [
        flt.actions_for(a, 20, user=7).select(F.lit("user").alias("kind"), "event_id"),
        flt.actions_for(a, 20, item=42).select(F.lit("item").alias("kind"), "event_id"),
        flt.actions_for(a, 20, user=7, type=3).select(F.lit("type").alias("kind"), "event_id"),
    ]
    return parts[0].union(parts[1]).union(parts[2])


@query(
    "items_by_action",
    "SELECT item_id, CAST(epoch_us(max(ts)) AS BIGINT) AS last_ts FROM fx_actions WHERE user_id = 3 AND action_type = 3 GROUP BY item_id",
)
def items_by_action(spark, d):
    a = fx.actions(spark, d)
    names = fx.table(spark, d, "events").select(F.col("event_type").alias("name")).distinct()
    code = F.create_map(*[F.lit(x) for pair in fx.ACTION_TYPES.items() for x in pair])
    out = flt.items_by_action(a, names.withColumn("action_type", code[F.col("name")]), "purchase", 3)
    return out.select("item_id", F.unix_micros("last_ts").alias("last_ts"))


@query(
    "items_list",
    """SELECT * FROM (SELECT 'id' AS kind, p_partkey AS item_id FROM part ORDER BY p_partkey DESC LIMIT 30)
       UNION ALL SELECT * FROM (SELECT 'name', p_partkey FROM part WHERE p_type = 'PROMO' ORDER BY p_name, p_partkey LIMIT 10 OFFSET 5)""",
)
def items_list(spark, d):
    i = items(spark, d)
    a = flt.items_list(i, "id", 0, 30).select(F.lit("id").alias("kind"), "item_id")
    b = flt.items_list(i, "name", 5, 10, "PROMO").select(F.lit("name").alias("kind"), "item_id")
    return a.union(b)


@query("users_by_attr", "SELECT c_custkey AS user_id FROM customer WHERE c_mktsegment = 'BUILDING'")
def users_by_attr(spark, d):
    c = customer(spark, d)
    users = c.select(F.col("c_custkey").alias("user_id"))
    eav = c.select(F.col("c_custkey").alias("user_id"), F.lit("segment").alias("attr"), F.col("c_mktsegment").alias("value"))
    return flt.users_with(users, eav, "segment", "BUILDING")


@query(
    "active_users",
    "SELECT user_id, CAST(epoch_us(max(ts)) AS BIGINT) AS last_op FROM fx_actions GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25",
)
def active_users(spark, d):
    u = fx.actions(spark, d).groupBy("user_id").agg(F.max("ts").alias("last_op"))
    return flt.active_users(u, n=25).select("user_id", F.unix_micros("last_op").alias("last_op"))


@query(
    "ignore_values",
    """SELECT c_custkey, nullif(nullif(c_mktsegment, 'MACHINERY'), 'BUILDING') AS c_mktsegment, nullif(c_nationkey, 7) AS c_nationkey FROM customer""",
)
def ignore_values(spark, d):
    c = customer(spark, d).select("c_custkey", "c_mktsegment", "c_nationkey")
    return flt.ignore(c, ["MACHINERY", "BUILDING", 7], ["c_mktsegment", "c_nationkey"])


# joins


@query("join_actions_tags", "SELECT event_id, tag FROM fx_actions JOIN fx_item_tags USING (item_id)")
def join_actions_tags(spark, d):
    return joins.join_tags(fx.actions(spark, d), fx.item_tags(spark, d)).select("event_id", "tag")


@query(
    "self_join_pairs",
    """SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS shared FROM fx_day_baskets a JOIN fx_day_baskets b
       ON a.basket_id = b.basket_id AND a.item_id < b.item_id GROUP BY 1, 2""",
)
def self_join_pairs(spark, d):
    members = fx.day_baskets(spark, d).select(F.col("basket_id").alias("grp"), F.col("item_id").alias("item"))
    return skew.shared_counts(members)


@query("semi_test_users", "SELECT event_id FROM fx_actions WHERE user_id IN (SELECT user_id FROM fx_actions WHERE action_type = 3 AND value > 100)")
def semi_test_users(spark, d):
    a = fx.actions(spark, d)
    return joins.semi(a, a.where("action_type = 3 and value > 100").select("user_id").distinct()).select("event_id")


@query(
    "prefix_referrer",
    """SELECT page_id, cluster_id FROM pages JOIN (SELECT DISTINCT regexp_extract(url, '^https?://[^/]+/[^/]*', 0) AS prefix,
            'c' || length(regexp_extract(url, '^https?://[^/]+/[^/]*', 0)) AS cluster_id FROM pages
            UNION SELECT DISTINCT regexp_extract(url, '^https?://[^/]+', 0), 'host' FROM pages) m ON starts_with(url, prefix)""",
)
def prefix_referrer(spark, d):
    pages = fx.table(spark, d, "pages").select("page_id", F.col("url").alias("referrer"))
    folder = F.regexp_extract("referrer", "^https?://[^/]+/[^/]*", 0)
    mapping = (
        pages.select(folder.alias("prefix"), F.concat(F.lit("c"), F.length(folder)).alias("cluster_id"))
        .union(pages.select(F.regexp_extract("referrer", "^https?://[^/]+", 0), F.lit("host")))
        .distinct()
    )
    return joins.referrer_clusters(pages, mapping).select("page_id", "cluster_id")


@query(
    "left_outer_default",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'text view' WHEN 'click' THEN 'text click' ELSE 'text default' END AS text FROM events""",
)
def left_outer_default(spark, d):
    e = fx.table(spark, d, "events")
    recs = e.select("event_id", F.col("event_type").alias("algo"))
    names = e.select(F.col("event_type").alias("algo")).distinct().where("algo in ('view', 'click', 'signup')")
    texts = names.select(
        F.when(F.col("algo") == "signup", "default").otherwise(F.col("algo")).alias("algo"), F.lit("en").alias("locale")
    ).withColumn("text", F.concat(F.lit("text "), "algo"))
    return joins.explain(recs, texts, "en").select("event_id", "text")

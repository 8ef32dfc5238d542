"""Views that present the provided tables in the shape of the canonical data model.

Each view exists twice: as a DataFrame (used by the queries) and as SQL (used by the oracles).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

# Event type names and their action type numbers.
ACTION_TYPES = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A provided table; wall-clock timestamps are read as UTC instants."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    local = {f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"}
    return df.select(*[F.col(c).cast("timestamp").alias(c) if c in local else c for c in df.columns]) if local else df


def _item() -> F.Column:
    return F.get_json_object("props", "$.k").cast("long")


def actions(spark, d) -> DataFrame:
    kind = F.col("event_type")
    code = F.lit(None).cast("int")
    for name, number in ACTION_TYPES.items():
        code = F.when(kind == name, F.lit(number)).otherwise(code)
    return table(spark, d, "events").select(
        "event_id",
        F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")).alias("client"),
        "user_id",
        _item().alias("item_id"),
        code.alias("action_type"),
        "value",
        "ts",
    )


def impressions(spark, d) -> DataFrame:
    k = _item()
    return (
        table(spark, d, "events")
        .where(F.col("event_type").isin("view", "click"))
        .select(
            "event_id",
            F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")).alias("client"),
            F.when(F.col("user_id") % 2 == 0, "baseline").otherwise("normal").alias("variation"),
            F.concat(F.lit("t"), (k % 4).cast("string")).alias("tag"),
            "user_id",
            F.when(F.col("event_type") == "view", "IMP").otherwise("CTR").alias("kind"),
            "ts",
            F.concat_ws(":", k, (k + 1) % 100, (k + 7) % 100).alias("recs"),
        )
    )


def baskets(spark, d) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (
        table(spark, d, "lineitem")
        .select("l_orderkey", "l_partkey", "l_linenumber", "l_returnflag")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.col("l_orderkey").alias("basket_id"),
            F.col("l_partkey").alias("item_id"),
            F.col("l_linenumber").alias("line"),
            F.when(F.col("l_returnflag") == "R", 2).otherwise(1).alias("kind"),
            F.col("o_orderdate").alias("ts"),
        )
    )


def item_dims(spark, d) -> DataFrame:
    part = table(spark, d, "part")
    return part.select(
        F.col("p_partkey").alias("item_id"),
        F.explode(
            F.array(
                F.struct(F.col("p_brand").alias("dim"), F.lit("brand").alias("dim_group")),
                F.struct(F.col("p_type").alias("dim"), F.lit("type").alias("dim_group")),
            )
        ).alias("x"),
    ).select("item_id", "x.dim", "x.dim_group")


def item_tags(spark, d) -> DataFrame:
    words = F.array_union(F.split(F.col("p_name"), " "), F.array(F.lower("p_type")))
    return table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.explode(words).alias("tag"))


def item_tag_text(spark, d) -> DataFrame:
    """Items with the comma-separated tag attribute as stored in the catalogue."""
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.concat_ws(" , ", F.regexp_replace("p_name", " ", ","), F.col("p_type")).alias("tags"),
    )


def user_clusters(spark, d) -> DataFrame:
    customer = table(spark, d, "customer")
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        F.explode(
            F.array(
                F.struct(F.col("c_mktsegment").alias("cluster_id"), F.lit(1.0).alias("weight")),
                F.struct(
                    F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("cluster_id"),
                    F.lit(0.5).alias("weight"),
                ),
            )
        ).alias("x"),
    ).select("user_id", "x.cluster_id", "x.weight")


def publish(spark, d) -> DataFrame:
    return actions(spark, d).groupBy("item_id").agg(F.min("ts").alias("published"))


def doc_tags(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.explode(F.array("lang", "source")).alias("tag"))


def sequences(spark, d) -> DataFrame:
    words = F.filter(F.split(F.lower("text"), "[ \n]+"), lambda t: t != "")
    return table(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("seq_id"), words.alias("tokens"))


def edges(spark, d) -> DataFrame:
    """Parts that follow each other inside an order, as a weighted edge list."""
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    return (
        table(spark, d, "lineitem")
        .select("l_partkey", "l_orderkey", "l_linenumber", F.lag("l_partkey").over(w).alias("before"))
        .where("before is not null")
        .groupBy(F.col("before").alias("src"), F.col("l_partkey").alias("dst"))
        .agg(F.count("*").cast("double").alias("weight"))
    )


def day_baskets(spark, d) -> DataFrame:
    """Items a user touched on one day: small baskets over the shared item space."""
    return (
        actions(spark, d)
        .select(F.concat_ws("-", "user_id", F.unix_date(F.to_date("ts"))).alias("basket_id"), "user_id", "item_id")
        .dropDuplicates()
    )


def request_log(spark, d) -> DataFrame:
    """API requests derived from events: one path per event."""
    e = table(spark, d, "events")
    k = _item().cast("string")
    u = F.col("user_id").cast("string")
    path = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("/users/"), u, F.lit("/recommendations")))
        .when(F.col("event_type") == "click", F.concat(F.lit("/users/"), u, F.lit("/actions/"), k))
        .when(F.col("event_type") == "purchase", F.concat(F.lit("/items/"), k, F.lit("/actions")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("/items/"), k))
        .otherwise(F.lit("/js/action/new"))
    )
    return e.select(
        "event_id",
        F.concat(F.lit("c"), (F.col("user_id") % 3).cast("string")).alias("client"),
        F.when(F.col("event_type").isin("view", "signup"), "GET").otherwise("POST").alias("method"),
        path.alias("path"),
        F.floor(F.col("value") * 10).cast("long").alias("exectime"),
        "ts",
    )


# DuckDB text of the same views.
SQL_VIEWS: dict[str, str] = {
    "fx_actions": """
        SELECT event_id, 'c' || (user_id % 3) AS client, user_id,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS item_id,
               CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
                    WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS action_type, value, ts
        FROM events""",
    "fx_impressions": """
        SELECT event_id, 'c' || (user_id % 3) AS client,
               CASE WHEN user_id % 2 = 0 THEN 'baseline' ELSE 'normal' END AS variation,
               't' || (CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) % 4) AS tag, user_id,
               CASE WHEN event_type = 'view' THEN 'IMP' ELSE 'CTR' END AS kind, ts,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k
        FROM events WHERE event_type IN ('view', 'click')""",
    "fx_baskets": """
        SELECT o_custkey AS user_id, l_orderkey AS basket_id, l_partkey AS item_id, l_linenumber AS line,
               CASE WHEN l_returnflag = 'R' THEN 2 ELSE 1 END AS kind, o_orderdate AS ts
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "fx_item_dims": """
        SELECT p_partkey AS item_id, p_brand AS dim, 'brand' AS dim_group FROM part
        UNION ALL SELECT p_partkey, p_type, 'type' FROM part""",
    "fx_item_tags": """
        SELECT DISTINCT p_partkey AS item_id, unnest(string_split(p_name, ' ')) AS tag FROM part
        UNION SELECT p_partkey, lower(p_type) FROM part""",
    "fx_user_clusters": """
        SELECT c_custkey AS user_id, c_mktsegment AS cluster_id, 1.0::DOUBLE AS weight FROM customer
        UNION ALL SELECT c_custkey, 'n' || c_nationkey, 0.5::DOUBLE FROM customer""",
    "fx_publish": "SELECT item_id, min(ts) AS published FROM fx_actions GROUP BY item_id",
    "fx_doc_tags": "SELECT doc_id, lang AS tag FROM documents UNION ALL SELECT doc_id, source FROM documents",
    "fx_sequences": r"""
        SELECT conv_id * 1000 + turn AS seq_id,
               list_filter(regexp_split_to_array(lower(text), '[ \n]+'), lambda t: t <> '') AS tokens
        FROM conversations""",
    "fx_edges": """
        SELECT src, dst, CAST(count(*) AS DOUBLE) AS weight FROM (
            SELECT lag(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS src,
                   l_partkey AS dst FROM lineitem) WHERE src IS NOT NULL GROUP BY src, dst""",
    "fx_day_baskets": """
        SELECT DISTINCT user_id || '-' || date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS basket_id,
               user_id, item_id FROM fx_actions""",
    "fx_requests": """
        SELECT event_id, 'c' || (user_id % 3) AS client,
               CASE WHEN event_type IN ('view', 'signup') THEN 'GET' ELSE 'POST' END AS method, event_type,
               CAST(floor(value * 10) AS BIGINT) AS exectime, ts FROM events""",
}

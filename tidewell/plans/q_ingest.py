"""Queries: ingest, cleaning, catalogue, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import ingest as ing
from tidewell.plans import fixtures as fx
from tidewell.plans.registry import query
from tidewell.session import scratch_path
from tidewell.sources import readers, writers


def raw_actions(spark, d):
    """Logged actions with text ids; every event number divisible by 4 lacks the internal user id."""
    return fx.actions(spark, d).select(
        "client",
        F.concat(F.lit("u"), F.when(F.col("event_id") % 40 == 0, F.lit(-1)).otherwise(F.col("user_id"))).alias("client_user_id"),
        F.when((F.col("event_id") % 4 == 0) | (F.col("user_id") % 50 == 7), 0).otherwise(F.col("user_id")).alias("user_id"),
        "item_id",
        F.concat(F.lit("i"), "item_id").alias("client_item_id"),
        "action_type",
        "value",
        "ts",
        "event_id",
    )


SQL_RAW = """raw AS (SELECT client, 'u' || CASE WHEN event_id % 40 = 0 THEN -1 ELSE user_id END AS client_user_id,
    CASE WHEN event_id % 4 = 0 OR user_id % 50 = 7 THEN 0 ELSE user_id END AS user_id, item_id, 'i' || item_id AS client_item_id,
    action_type, value, ts, event_id FROM fx_actions)"""


@query(
    "resolve_users",
    f"""WITH {SQL_RAW}, ids AS (SELECT client, client_user_id, max(user_id) AS uid FROM raw WHERE user_id <> 0 GROUP BY 1, 2)
        SELECT event_id, CASE WHEN user_id <> 0 THEN user_id ELSE uid END AS user_id FROM raw LEFT JOIN ids USING (client, client_user_id)
        WHERE user_id <> 0 OR uid IS NOT NULL""",
)
def resolve_users(spark, d):
    return ing.resolve_users(raw_actions(spark, d)).select("event_id", "user_id")


@query(
    "resolve_report",
    f"""WITH {SQL_RAW}, ids AS (SELECT client, client_user_id, max(user_id) AS uid FROM raw WHERE user_id <> 0 GROUP BY 1, 2)
        SELECT client, count(uid) AS resolved, count(*) - count(uid) AS dropped FROM raw LEFT JOIN ids USING (client, client_user_id)
        WHERE user_id = 0 GROUP BY client""",
)
def resolve_report(spark, d):
    return ing.resolve_report(raw_actions(spark, d))


@query(
    "split_events",
    "SELECT client, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day, count(*) AS n FROM fx_actions WHERE client = 'c1' GROUP BY ALL",
)
def split_events(spark, d):
    out = ing.split_events(fx.actions(spark, d), "c1")
    return out.groupBy("client", F.col("day").cast("long").alias("day")).agg(F.count("*").alias("n"))


def item_schema(spark, d):
    """Catalogue derived from ``part``: brand and type are enums with their values in order."""
    part = fx.table(spark, d, "part")
    enums = part.agg(F.array_sort(F.collect_set("p_brand")).alias("brand"), F.array_sort(F.collect_set("p_type")).alias("type"))
    none = F.array().cast("array<string>")
    rows = F.array(
        F.struct(F.lit(1).alias("item_type"), F.lit("brand").alias("attr"), F.lit("enum").alias("value_type"), F.col("brand").alias("enum_values")),
        F.struct(F.lit(1).alias("item_type"), F.lit("kind").alias("attr"), F.lit("enum").alias("value_type"), F.col("type").alias("enum_values")),
        F.struct(F.lit(1).alias("item_type"), F.lit("price").alias("attr"), F.lit("double").alias("value_type"), none.alias("enum_values")),
        F.struct(F.lit(1).alias("item_type"), F.lit("size").alias("attr"), F.lit("int").alias("value_type"), none.alias("enum_values")),
        F.struct(F.lit(1).alias("item_type"), F.lit("title").alias("attr"), F.lit("varchar").alias("value_type"), none.alias("enum_values")),
    )
    return enums.select(F.explode(rows).alias("x")).select("x.*")


def wide_items(spark, d):
    return fx.table(spark, d, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.when(F.col("p_size") == 13, "Brand#unknown").otherwise(F.col("p_brand")).alias("brand"),
        F.col("p_type").alias("kind"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.when(F.col("p_size") == 7, "seven").otherwise(F.col("p_size").cast("string")).alias("size"),
        F.col("p_name").alias("title"),
    )


SQL_CATALOGUE = """vals AS (SELECT 1 AS attr_id, 'brand' AS attr, p_brand AS value_name FROM part UNION SELECT 2, 'kind', p_type FROM part),
    en AS (SELECT attr_id, attr, value_name, row_number() OVER (PARTITION BY attr_id ORDER BY value_name) AS value_id,
                  row_number() OVER (ORDER BY attr_id, value_name) AS dim_id FROM vals)"""


@query("define_attrs", f"WITH {SQL_CATALOGUE} SELECT dim_id, attr_id, value_id, value_name FROM en", longs=("dim_id", "value_id"))
def define_attrs(spark, d):
    _, enums, dims = ing.define_attrs(item_schema(spark, d))
    return dims.join(enums, ["item_type", "attr_id", "value_id"]).select("dim_id", "attr_id", "value_id", "value_name")


@query(
    "validate_items",
    """SELECT 'ok' AS kind, p_partkey AS item_id, NULL AS attr, NULL AS value FROM part WHERE p_size <> 13
       UNION ALL SELECT 'bad', p_partkey, 'brand', 'Brand#unknown' FROM part WHERE p_size = 13
       UNION ALL SELECT 'bad', p_partkey, 'colour', NULL FROM part""",
)
def validate_items(spark, d):
    attrs, enums, _ = ing.define_attrs(item_schema(spark, d))
    good, bad = ing.validate_items(wide_items(spark, d).withColumn("colour", F.lit("red")), attrs, enums)
    ok = good.select(F.lit("ok").alias("kind"), "item_id", F.lit(None).cast("string").alias("attr"), F.lit(None).cast("string").alias("value"))
    return ok.unionByName(bad.select(F.lit("bad").alias("kind"), "item_id", "attr", "value"))


ATTRS = {"brand": "enum", "kind": "enum", "price": "double", "size": "int", "title": "varchar"}


@query(
    "load_attrs",
    f"""WITH {SQL_CATALOGUE} SELECT 'int' AS kind, p_partkey AS item_id, 'size' AS attr, p_size::VARCHAR AS value FROM part WHERE p_size <> 7
        UNION ALL SELECT 'double', p_partkey, 'price', round(p_retailprice * 100)::BIGINT::VARCHAR FROM part
        UNION ALL SELECT 'varchar', p_partkey, 'title', p_name FROM part
        UNION ALL SELECT 'enum', p_partkey, 'brand', value_id::VARCHAR FROM part JOIN en ON attr = 'brand' AND value_name = p_brand WHERE p_size <> 13
        UNION ALL SELECT 'enum', p_partkey, 'kind', value_id::VARCHAR FROM part JOIN en ON attr = 'kind' AND value_name = p_type""",
)
def load_attrs(spark, d):
    _, enums, _ = ing.define_attrs(item_schema(spark, d))
    out = None
    for kind, frame in ing.items_to_eav(wide_items(spark, d), ATTRS, enums).items():
        text = F.round(F.col("value") * 100).cast("long").cast("string") if kind == "double" else F.col("value").cast("string")
        part = frame.select(F.lit(kind).alias("kind"), "item_id", "attr", text.alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "map_action_ids",
    """SELECT event_id, user_id, item_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%SZ') AS timestamp_utc FROM fx_actions
       WHERE item_id < 80 AND user_id % 7 <> 0""",
)
def map_action_ids(spark, d):
    a = fx.actions(spark, d)
    raw = a.select(
        F.concat(F.lit("u"), "user_id").alias("client_user_id"),
        F.concat(F.lit("i"), "item_id").alias("client_item_id"),
        F.col("event_id").alias("action_type"),
        "value",
        F.unix_timestamp("ts").alias("epoch"),
    )
    users = a.where("user_id % 7 <> 0").select(F.concat(F.lit("u"), "user_id").alias("client_user_id"), "user_id").distinct()
    items = a.where("item_id < 80").select(F.concat(F.lit("i"), "item_id").alias("client_item_id"), "item_id").distinct()
    return ing.map_action_ids(raw, users, items).select(F.col("action_type").alias("event_id"), "user_id", "item_id", "timestamp_utc")


@query(
    "attr_value",
    """SELECT p_partkey AS item_id, 'size' AS attr, CASE WHEN p_size <> 7 THEN p_size::VARCHAR ELSE p_name END AS value FROM part
       UNION ALL SELECT p_partkey, 'brand', p_brand FROM part WHERE p_size <> 13""",
)
def attr_value(spark, d):
    _, enums, _ = ing.define_attrs(item_schema(spark, d))
    w = wide_items(spark, d)
    eav = {
        "int": ing.items_to_eav(w, {"size": "int"})["int"],
        "varchar": w.select("item_id", F.lit("size").alias("attr"), F.col("title").alias("value")),
        "enum": ing.items_to_eav(w, {"brand": "enum"}, enums)["enum"],
    }
    return ing.attr_value(eav, enums)


@query(
    "item_dimensions",
    f"""WITH {SQL_CATALOGUE} SELECT p_partkey AS item_id, dim_id FROM part JOIN en ON (attr = 'brand' AND value_name = p_brand) OR (attr = 'kind' AND value_name = p_type)
        WHERE value_name NOT IN ('PROMO', 'SMALL')""",
    longs=("dim_id",),
)
def item_dimensions(spark, d):
    _, enums, dims = ing.define_attrs(item_schema(spark, d))
    part = fx.table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_brand").alias("brand"), F.col("p_type").alias("kind"))
    linked = ing.items_to_eav(part, {"brand": "enum", "kind": "enum"}, enums)["enum"]
    map_enum = linked.join(enums.select("attr", "attr_id").distinct(), "attr").select("item_id", "attr_id", F.col("value").alias("value_id"))
    hidden = dims.join(enums.where("value_name in ('PROMO', 'SMALL')"), ["attr_id", "value_id"]).select("dim_id")
    return ing.item_dims(map_enum, dims, hidden)


@query(
    "tags_explode",
    """SELECT DISTINCT p_partkey AS item_id, unnest(string_split(p_name, ' ')) AS tag FROM part UNION SELECT p_partkey, lower(p_type) FROM part""",
)
def tags_explode(spark, d):
    return ing.explode_tags(fx.item_tag_text(spark, d), "tags")


@query(
    "register_entities",
    f"""WITH {SQL_RAW}, base AS (SELECT * FROM raw WHERE event_id % 40 <> 0),
            ku AS (SELECT DISTINCT 'u' || user_id AS client_user_id FROM fx_actions WHERE user_id % 2 = 0),
            nu AS (SELECT client_user_id, min(ts) AS first_op, max(ts) AS last_op FROM base
                   WHERE client_user_id NOT IN (FROM ku) GROUP BY 1)
        SELECT client_user_id, CAST(epoch_us(first_op) AS BIGINT) AS first_op, CAST(epoch_us(last_op) AS BIGINT) AS last_op, 1 AS num_op FROM nu
        UNION ALL SELECT client_user_id, 0, 0, 9 FROM ku
        UNION ALL SELECT 'stored', count(*), count(DISTINCT 'u' || b.client_user_id), 0 FROM base b WHERE action_type IN (2, 3)""",
)
def register_entities(spark, d):
    base = raw_actions(spark, d).where("event_id % 40 <> 0")
    a = fx.actions(spark, d)
    zero = F.timestamp_seconds(F.lit(0))
    known = [zero.alias("first_op"), zero.alias("last_op"), F.lit(9).alias("num_op")]
    users = a.where("user_id % 2 = 0").select(F.concat(F.lit("u"), "user_id").alias("client_user_id"), "user_id").distinct()
    items = a.where("item_id % 3 = 0").select(F.concat(F.lit("i"), "item_id").alias("client_item_id"), "item_id").distinct()
    new_users, _, stored = ing.register(base, users.select("*", *known), items.select("*", *known))
    stats = stored.agg(F.count("*").alias("first_op"), F.countDistinct("client_user_id").alias("last_op"))
    rows = new_users.select("client_user_id", F.unix_micros("first_op").alias("first_op"), F.unix_micros("last_op").alias("last_op"), "num_op")
    return rows.unionByName(stats.select(F.lit("stored").alias("client_user_id"), "first_op", "last_op", F.lit(0).alias("num_op")))


@query(
    "map_user_dims",
    """WITH r AS (SELECT c_custkey AS user_id, unnest([c_nationkey, c_nationkey + 1, 99]) AS dim, c_nationkey % 5 AS m FROM customer)
       SELECT user_id, array_to_string(list_sort(list(DISTINCT dim::INT)), ',') AS dims FROM (
         SELECT user_id, unnest(CASE WHEN dim % 5 = 0 AND m = 0 THEN [dim + 100, dim + 200] ELSE [dim] END) AS dim FROM r) GROUP BY user_id""",
)
def map_user_dims(spark, d):
    c = fx.table(spark, d, "customer")
    n = F.col("c_nationkey")
    requests = c.select(F.col("c_custkey").alias("user_id"), F.array(n, n + 1, F.lit(99)).alias("dims"))
    rules = c.where(n % 5 == 0).select(
        F.col("c_custkey").alias("user_id"), F.array(n).alias("dims_in"), F.array(n + 100, n + 200).alias("dims_out")
    )
    out = ing.map_user_dims(requests, rules)
    return out.select("user_id", F.array_join(F.transform("dims", lambda x: x.cast("string")), ",").alias("dims"))


@query("unique_api_calls", "SELECT DISTINCT '/items/' || item_id || CASE WHEN item_id % 2 = 0 THEN '?limit=' || (user_id % 3) ELSE '' END AS call FROM fx_actions")
def unique_api_calls(spark, d):
    log = fx.actions(spark, d).select(
        F.concat(F.lit("/items/"), "item_id").alias("path"),
        F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("limit="), F.col("user_id") % 3)).alias("query"),
    )
    return ing.unique_calls(log)


# sources and sinks: data derived from the tables is written to the shared folder and read back


def logged(spark, d):
    a = fx.actions(spark, d)
    return a.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp_utc"),
        "client",
        F.concat(F.lit("u"), "user_id").alias("client_userid"),
        F.col("user_id").alias("userid"),
        F.col("item_id").alias("itemid"),
        F.concat(F.lit("i"), "item_id").alias("client_itemid"),
        F.lit("default").alias("rectag"),
        F.col("action_type").alias("type"),
        "value",
        F.unix_date(F.to_date("ts")).alias("day"),
    )


SQL_DAY = "date_diff('day', DATE '1970-01-01', CAST(ts AS DATE))"


@query(
    "src_actions_json",
    f"""SELECT user_id, item_id, action_type, CAST(floor(epoch(ts)) AS BIGINT) AS ts FROM fx_actions WHERE client = 'c1' AND {SQL_DAY} BETWEEN 19726 AND 19730""",
)
def src_actions_json(spark, d):
    root = scratch_path(spark, "actions")
    writers.write_by_client(logged(spark, d), root)
    return readers.read_actions(spark, root, "c1", 19730, 5).select("user_id", "item_id", "action_type", F.unix_timestamp("ts").alias("ts"))


@query("src_day_range", "SELECT user_id AS userid, item_id AS itemid FROM fx_actions WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-05'")
def src_day_range(spark, d):
    root = scratch_path(spark, "days")
    logged(spark, d).withColumn("day", F.date_from_unix_date("day")).write.partitionBy("day").json(root)
    return readers.read_days(spark, root, "2024-01-03", "2024-01-05").select("userid", "itemid")


def tagged_lines(spark, d):
    body = F.to_json(F.struct("userid", "itemid", "type"))
    broken = F.when(F.col("type") == 5, F.lit("{broken")).otherwise(body)
    tag = F.when(F.col("type") == 1, "restapi.calls").otherwise("restapi.ctr")
    return logged(spark, d).select(F.concat_ws("\t", "timestamp_utc", tag, broken).alias("value"))


@query("src_tagged_log", "SELECT user_id AS userid, item_id AS itemid, action_type AS type FROM fx_actions WHERE action_type IN (2, 3, 4)")
def src_tagged_log(spark, d):
    root = scratch_path(spark, "log")
    tagged_lines(spark, d).write.text(root)
    return readers.read_log(spark, root, "restapi.ctr", "userid long, itemid long, type int").select("userid", "itemid", "type")


@query("src_event_log", "SELECT client, count(*) AS n, sum(user_id)::BIGINT AS users FROM fx_actions GROUP BY client")
def src_event_log(spark, d):
    root = scratch_path(spark, "events")
    body = F.to_json(F.struct("client", "userid"))
    logged(spark, d).select(F.concat_ws(" ", "timestamp_utc", F.lit("actions"), body).alias("value")).write.text(root)
    out = readers.read_events(spark, root).withColumn("u", F.get_json_object("json", "$.userid").cast("long"))
    return out.groupBy("client").agg(F.count("*").alias("n"), F.sum("u").alias("users"))


@query("src_jdbc", "SELECT p_partkey AS item_id, p_name AS tags FROM part")
def src_jdbc(spark, d):
    """The same lookup through ``read_table``; with no database around, the parquet form of the config."""
    t = readers.read_table(spark, {"format": "parquet", "path": f"{d}/part.parquet"})
    return t.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("tags"))


@query("src_csv_entities", "SELECT 'u' || user_id AS user_id, 'i' || item_id AS item_id, round(value, 2) AS value, CAST(floor(epoch(ts)) AS BIGINT) AS time FROM fx_actions")
def src_csv_entities(spark, d):
    root = scratch_path(spark, "csv")
    a = fx.actions(spark, d)
    rows = a.select(
        F.concat(F.lit("u"), "user_id").alias("user_id"), F.concat(F.lit("i"), "item_id").alias("item_id"), "value", F.unix_timestamp("ts").alias("time")
    )
    writers.write_frame(rows, root, "csv")
    return readers.read_entities(spark, root, "actions").withColumn("value", F.round("value", 2))


@query("src_vectors", "SELECT vec_id::VARCHAR AS id, len(embedding) AS n, round(list_sum(CAST(embedding AS DOUBLE[])), 4) AS total FROM embeddings")
def src_vectors(spark, d):
    root = scratch_path(spark, "vectors")
    e = fx.table(spark, d, "embeddings")
    line = F.concat_ws(",", F.col("vec_id").cast("string"), F.array_join(F.transform("embedding", lambda x: x.cast("string")), ","))
    e.select(line.alias("value")).write.text(root)
    total = F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return readers.read_vectors(spark, root, ",").select("id", F.size("features").cast("long").alias("n"), F.round(total, 4).alias("total"))


@query("src_frame", "SELECT o_orderkey, round(o_totalprice, 2) AS o_totalprice, CAST(epoch(o_orderdate) AS BIGINT) AS ordered FROM orders")
def src_frame(spark, d):
    root = scratch_path(spark, "frame")
    orders = fx.table(spark, d, "orders").select("o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered"), "o_orderstatus")
    for status in ("F", "O", "P"):
        writers.write_frame(orders.where(F.col("o_orderstatus") == status).drop("o_orderstatus"), f"{root}/{status}", "json")
    out = readers.read_frame(spark, [f"{root}/{s}" for s in ("F", "O", "P")], "json", "o_orderkey long, o_totalprice double, ordered string", {"ordered": "yyyy-MM-dd"})
    return out.select("o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"), F.unix_timestamp("ordered").alias("ordered"))


@query("sink_json", "SELECT item_id, count(*) AS n FROM fx_actions WHERE item_id > 0 GROUP BY item_id")
def sink_json(spark, d):
    root = scratch_path(spark, "json")
    writers.write_json(fx.actions(spark, d).where("item_id > 0").groupBy("item_id").agg(F.count("*").alias("n")), root, gzip=True)
    return spark.read.schema("item_id long, n long").json(root)


@query("sink_partitioned", f"SELECT client, {SQL_DAY} AS day, count(*) AS n FROM fx_actions GROUP BY ALL")
def sink_partitioned(spark, d):
    root = scratch_path(spark, "parts")
    writers.write_by_client(ing.split_events(fx.actions(spark, d)), root)
    back = spark.read.schema("event_id long, client string, day long").json(root)
    return back.groupBy("client", "day").agg(F.count("*").alias("n"))


@query(
    "sink_stage_swap",
    """WITH pop AS (SELECT item_id, CAST(count(*) AS DOUBLE) AS score FROM fx_actions WHERE item_id > 0 GROUP BY 1)
       SELECT * FROM pop UNION ALL SELECT p_partkey, 0.5 FROM part WHERE p_brand = 'Brand#9' AND p_partkey NOT IN (SELECT item_id FROM pop)""",
)
def sink_stage_swap(spark, d):
    root = scratch_path(spark, "table")
    pop = fx.actions(spark, d).where("item_id > 0").groupBy("item_id").agg(F.count("*").cast("double").alias("score"))
    pins = fx.table(spark, d, "part").where("p_brand = 'Brand#9'").select(F.col("p_partkey").alias("item_id"), F.lit(0.5).alias("score"))
    writers.publish(pop.withColumn("score", F.lit(0.0)), root)
    writers.publish(pop, root, pins)
    return writers.read_published(spark, root)


@query(
    "sink_factors",
    "SELECT vec_id::VARCHAR AS id, generate_subscripts(embedding, 1) - 1 AS i, round(unnest(embedding)::DOUBLE, 5) AS x FROM embeddings",
    longs=("i",),
)
def sink_factors(spark, d):
    root = scratch_path(spark, "factors")
    e = fx.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
    writers.write_factors(e, root, gzip=True)
    return readers.read_vectors(spark, root, "|,").select("id", F.posexplode("features").alias("i", "x")).withColumn("x", F.round(F.col("x").cast("double"), 5))

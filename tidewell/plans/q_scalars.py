"""Queries: scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.functions import hashing as hsh, scalars as fn
from tidewell.plans import fixtures as fx
from tidewell.plans.registry import query

SQL_TEMPLATE = """CASE event_type WHEN 'view' THEN '/users/{userid}/recommendations' WHEN 'click' THEN '/users/{userid}/actions/{itemid}'
    WHEN 'purchase' THEN '/items/{itemid}/actions' WHEN 'signup' THEN '/items/{itemid}' ELSE '/js/action/new' END"""


@query("fn_path_template", f"SELECT event_id, {SQL_TEMPLATE} AS path FROM fx_requests")
def fn_path_template(spark, d):
    return fx.request_log(spark, d).select("event_id", fn.path_template("path").alias("path"))


@query("fn_tag_token", """SELECT doc_id, regexp_replace(lower(trim(text)), '[ :;''",]', '_', 'g') AS token FROM documents""")
def fn_tag_token(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", fn.tag_token("text").alias("token"))


@query(
    "fn_default_tags",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'default' ELSE event_type END AS tag,
              CASE WHEN user_id % 2 = 0 THEN 'all' ELSE 'v' END AS variation FROM events""",
)
def fn_default_tags(spark, d):
    e = fx.table(spark, d, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("null").alias("tag"),
        F.when(F.col("user_id") % 2 == 0, "-").otherwise("v").alias("variation"),
    )
    return e.select("event_id", fn.default_tag("tag").alias("tag"), fn.default_variation("variation").alias("variation"))


@query(
    "fn_best_class",
    """SELECT event_id, CASE WHEN value >= greatest(60 - value / 2, 100 - 2 * value) THEN 'high'
                WHEN 60 - value / 2 >= 100 - 2 * value THEN 'mid' ELSE 'low' END AS name,
           round(greatest(value, 60 - value / 2, 100 - 2 * value), 6) AS score FROM events""",
)
def fn_best_class(spark, d):
    v = F.col("value")

    def cls(score, name):
        return F.struct(score.alias("prediction"), F.lit(name).alias("predictedClass"))

    e = fx.table(spark, d, "events").select("event_id", F.array(cls(v, "high"), cls(60 - v / 2, "mid"), cls(100 - 2 * v, "low")).alias("p"))
    best = fn.best_class("p")
    return e.select("event_id", best["name"].alias("name"), F.round(best["score"], 6).alias("score"))


@query(
    "fn_cyclic_date",
    """SELECT event_id, 'h' || hour(ts) AS ts_hour, round(sin(hour(ts) / 24.0 * 2 * pi()), 8) AS ts_h1, round(cos(hour(ts) / 24.0 * 2 * pi()), 8) AS ts_h2,
              'm' || month(ts) AS ts_month, round(sin(month(ts) / 12.0 * 2 * pi()), 8) AS ts_m1, round(cos(month(ts) / 12.0 * 2 * pi()), 8) AS ts_m2,
              'w' || (isodow(ts) - 1) AS ts_w, round(sin((isodow(ts) - 1) / 7.0 * 2 * pi()), 8) AS ts_w1, round(cos((isodow(ts) - 1) / 7.0 * 2 * pi()), 8) AS ts_w2,
              'y' || year(ts) AS ts_year FROM events""",
)
def fn_cyclic_date(spark, d):
    cols = fn.cyclic_date("ts", "ts")
    return fx.table(spark, d, "events").select(
        "event_id", *[(F.round(c, 8) if n[-1].isdigit() else c).alias(n) for n, c in cols.items()]
    )


@query(
    "fn_date_diff",
    """SELECT l_orderkey, l_linenumber, l_partkey, round((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000.0, 6) AS ship_ordered
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def fn_date_diff(spark, d):
    li = fx.table(spark, d, "lineitem").join(fx.table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    li = li.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_shipdate").alias("ship"), F.col("o_orderdate").alias("ordered"))
    diff = fn.date_diffs(["ship", "ordered"])["ship_ordered"]
    return li.select("l_orderkey", "l_linenumber", "l_partkey", F.round(diff, 6).alias("ship_ordered"))


@query(
    "fn_binary",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax = 0 THEN 0 ELSE 1 END AS taxed,
              CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END AS returned FROM lineitem""",
)
def fn_binary(spark, d):
    li = fx.table(spark, d, "lineitem").withColumn("flag", F.when(F.col("l_returnflag") == "N", "").otherwise(F.col("l_returnflag")))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", fn.binary("l_tax").alias("taxed"), fn.binary("flag").alias("returned"))


@query(
    "fn_split_tokens",
    """SELECT event_id, array_to_string(list_filter(list_transform(list_concat(string_split(event_type || ' X7', ' '), string_split(props, ' ')),
              lambda t: lower(rtrim(t))), lambda t: try_cast(t AS DOUBLE) IS NULL), '|') AS tokens FROM events""",
)
def fn_split_tokens(spark, d):
    e = fx.table(spark, d, "events").withColumn("a", F.concat("event_type", F.lit(" X7")))
    return e.select("event_id", F.array_join(fn.split_tokens(["a", "props"], " ", True), "|").alias("tokens"))


@query(
    "fn_bool_map",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 END AS flag FROM lineitem",
)
def fn_bool_map(spark, d):
    text = F.when(F.col("l_returnflag") == "A", "Yes").when(F.col("l_returnflag") == "N", "FALSE").otherwise("maybe")
    return fx.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", fn.bool_map(text).alias("flag"))


@query(
    "fn_ngrams",
    """SELECT seq_id, coalesce(array_to_string(list_transform(range(1, len(tokens)), lambda i: tokens[i] || ' ' || tokens[i + 1]), ';'), '') AS grams FROM fx_sequences""",
)
def fn_ngrams(spark, d):
    grams = F.transform(fn.ngrams("tokens", 2), lambda g: F.array_join(g, " "))
    return fx.sequences(spark, d).select("seq_id", F.array_join(grams, ";").alias("grams"))


@query("fn_unix_day", "SELECT event_id, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day FROM events")
def fn_unix_day(spark, d):
    return fx.table(spark, d, "events").select("event_id", fn.unix_day("ts").cast("long").alias("day"))


@query(
    "fn_publish_date",
    "SELECT event_id, CASE WHEN event_id % 3 = 2 THEN NULL ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS published FROM events",
)
def fn_publish_date(spark, d):
    m = F.col("event_id") % 3
    text = (
        F.when(m == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(m == 1, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.lit("long ago"))
    )
    return fx.table(spark, d, "events").select("event_id", F.unix_timestamp(fn.publish_date(text)).alias("published"))


def _pairs(spark, d):
    """Each vector with the centre of its label."""
    e = fx.table(spark, d, "embeddings")
    flat = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.sum(F.col("x").cast("double")).alias("s"))
    centre = flat.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda t: t.s).alias("centre"))
    return e.join(centre, "label")


SQL_CENTRE = """c AS (SELECT label, list(s ORDER BY i) AS centre FROM (SELECT label, i, sum(x) AS s FROM
    (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1)"""


@query(
    "fn_cosine",
    f"WITH {SQL_CENTRE} SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre), 6) AS cosine FROM embeddings JOIN c USING (label)",
)
def fn_cosine(spark, d):
    return _pairs(spark, d).select("vec_id", F.round(fn.cosine("embedding", "centre"), 6).alias("cosine"))


@query(
    "fn_dot",
    f"WITH {SQL_CENTRE} SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), centre), 5) AS dot FROM embeddings JOIN c USING (label)",
)
def fn_dot(spark, d):
    return _pairs(spark, d).select("vec_id", F.round(fn.dot("embedding", "centre"), 5).alias("dot"))


SQL_INDEX = "((({h})::HUGEINT * 4 + {label} - 1) % 262144 + 262144) % 262144"  # three classes take a stride of four


@query(
    "fn_feature_hash",
    f"""WITH t AS (SELECT DISTINCT tag FROM fx_item_tags), h AS (SELECT tag, {hsh.murmur3_sql("tag", hsh.murmur3_sql("'i'", "0"))} AS h FROM t)
        SELECT item_id, tag, CAST({SQL_INDEX.format(h="h", label=2)} AS BIGINT) AS named, CAST({SQL_INDEX.format(h="item_id", label=1)} AS BIGINT) AS numbered
        FROM fx_item_tags JOIN h USING (tag)""",
)
def fn_feature_hash(spark, d):
    tags = fx.item_tags(spark, d)
    return tags.select(
        "item_id",
        "tag",
        hsh.feature_hash(F.lit("i"), "tag", F.lit(2), 18, 3).alias("named"),
        hsh.feature_hash(F.lit(""), F.col("item_id").cast("string"), F.lit(1), 18, 3).alias("numbered"),
    )


@query(
    "fn_sigmoid_normalise",
    """SELECT event_id, round(a / (a + b), 8) AS p FROM (SELECT event_id, 1 / (1 + exp(-value / 100)) AS a, 1 / (1 + exp(value / 50 - 1)) AS b FROM events)""",
)
def fn_sigmoid_normalise(spark, d):
    e = fx.table(spark, d, "events").withColumn("s", F.array(F.col("value") / 100, 1 - F.col("value") / 50))
    return e.select("event_id", F.round(fn.sigmoid_normalise("s")[0], 8).alias("p"))


@query(
    "fn_json_features",
    """SELECT event_id, 'k=' || k || ';n.v=' || (k + 1) AS features FROM (SELECT event_id, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events)""",
)
def fn_json_features(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    text = F.concat(F.lit('{"k": '), k, F.lit(', "name": "x", "n": {"v": '), k + 1, F.lit(', "w": "text"}}'))
    e = fx.table(spark, d, "events").select("event_id", text.alias("j"))
    show = F.transform(
        fn.json_features("j"),
        lambda f: F.concat(F.when(f.namespace == "", "").otherwise(F.concat(f.namespace, F.lit("."))), f.feature, F.lit("="), f.value.cast("long")),
    )
    return e.select("event_id", F.array_join(show, ";").alias("features"))


@query("base_url", "SELECT page_id, regexp_extract(url, '^(https?://[^/?#:]+)', 1) || regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS base FROM pages")
def base_url(spark, d):
    return fx.table(spark, d, "pages").select("page_id", fn.base_url("url").alias("base"))


@query(
    "fn_prime_hash",
    """SELECT event_id, CAST((CAST(2147483629 AS HUGEINT) * user_id * 1000003 + 1234567) % 4294967311 AS BIGINT) AS h FROM events""",
)
def fn_prime_hash(spark, d):
    big = F.col("user_id").cast("long") * 1000003
    return fx.table(spark, d, "events").select("event_id", hsh.prime_hash(big, 2147483629, 1234567).alias("h"))

"""Queries: model-building jobs."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window as W, functions as F

from tidewell.functions.hashing import feature_hash, murmur3_sql
from tidewell.operators import aggregates as agg, models, sessions as ses, vectors as vec
from tidewell.plans import fixtures as fx
from tidewell.plans.q_core import SQL_AFFINE, WEIGHTS
from tidewell.plans.q_sessions import GAP
from tidewell.plans.registry import query


def fitted(spark, d, implicit=False):
    r = agg.ratings(fx.actions(spark, d), WEIGHTS).where("rating > 0")
    return models.fit_als(r, rank=10, iterations=5, implicit=implicit)


def _rounded(df):
    return df.select("id", F.transform("features", lambda x: F.round(x.cast("double"), 3)).alias("features"))


@query("als_explicit")
def als_explicit(spark, d):
    users, items = models.factors(fitted(spark, d))
    return _rounded(users).select("id", F.lit("user").alias("kind"), "features").union(_rounded(items).select("id", F.lit("item"), "features"))


@query("als_implicit")
def als_implicit(spark, d):
    return _rounded(models.factors(fitted(spark, d, True))[0])


@query("mf_user_clusters")
def mf_user_clusters(spark, d):
    users, items = models.factors(fitted(spark, d, True))
    best, members = models.mf_clusters(users, items, k=8, dims=5, top=20)
    sizes = members.groupBy("cluster_id").agg(F.count("*").alias("users"))
    return best.join(sizes, "cluster_id").withColumn("score", F.round("score", 4))


@query("lda_topics")
def lda_topics(spark, d):
    _, terms = models.fit_topics(fx.actions(spark, d), fx.item_tags(spark, d), k=8, iterations=10, terms=10)
    return terms.withColumn("weight", F.round("weight", 4))


@query("lda_user_mix")
def lda_user_mix(spark, d):
    mix, _ = models.fit_topics(fx.actions(spark, d), fx.item_tags(spark, d), k=8, iterations=10, terms=10)
    return mix.select("user_id", F.posexplode("features").alias("topic", "weight")).withColumn("weight", F.round("weight", 4))


@query("item_word2vec")
def item_word2vec(spark, d):
    s = ses.session_tags(fx.actions(spark, d), fx.item_tags(spark, d), GAP, 2, 100000, 3)
    return models.fit_w2v(s, "words", 30, 50).select("item_id", F.posexplode("features").alias("i", "x")).withColumn("x", F.round("x", 4))


SQL_TERMS = """tk AS (SELECT p_partkey AS item_id, unnest(string_split(lower(p_name || ' ' || p_type), ' ')) AS term FROM part),
    tf AS (SELECT item_id, term, count(*) AS tf FROM tk GROUP BY 1, 2), df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
    tw AS (SELECT item_id, term, tf * ln(((SELECT count(*) FROM part) + 1) / (df + 1)) AS w, ('0x' || substr(md5('0:' || item_id), 1, 15))::BIGINT AS h FROM tf JOIN df USING (term)),
    tv AS (SELECT term, [""" + ", ".join(f"sum(CASE WHEN (h >> {i}) & 1 = 1 THEN w ELSE -w END)" for i in range(16)) + """] AS f FROM tw GROUP BY term)"""


@query("tag_term_vectors", f"WITH {SQL_TERMS} SELECT term, generate_subscripts(f, 1) - 1 AS i, round(unnest(f), 4) AS x FROM tv", longs=("i",))
def tag_term_vectors(spark, d):
    docs = fx.table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " ").alias("words"))
    terms, _ = models.fit_text_vectors(docs, "words", 16)
    return terms.select("term", F.posexplode("features").alias("i", "x")).withColumn("x", F.round("x", 4))


@query(
    "suggest_clusters",
    f"""WITH {SQL_AFFINE}, {SQL_TERMS}, dv AS (SELECT item_id, i, sum(w * x) AS x FROM (SELECT item_id, w, unnest(f) AS x, generate_subscripts(f, 1) AS i FROM tw JOIN tv USING (term)) GROUP BY 1, 2),
        cv AS (SELECT dim, list(x ORDER BY i) AS f FROM (SELECT dim, i, sum(x) AS x FROM dv JOIN fx_item_dims USING (item_id) WHERE dim_group = 'brand' GROUP BY 1, 2) GROUP BY 1),
        tg AS (SELECT user_id, tag FROM k),
        nb AS (SELECT term AS tag, dim, list_cosine_similarity(tv.f, cv.f) AS s FROM tv, cv WHERE term IN (SELECT tag FROM tg)),
        su AS (SELECT user_id, dim, sum(s) AS s FROM tg JOIN nb USING (tag) WHERE s > 0.1 GROUP BY 1, 2)
        SELECT user_id, dim AS cluster_id, round(s / max(s) OVER (PARTITION BY user_id), 5) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, dim) AS r FROM su) WHERE r <= 5""",
)
def suggest_clusters(spark, d):
    """All affine tags of a user to brands, both placed in the space of part texts: the five with the largest sums."""
    docs = fx.table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.split(F.lower(F.concat_ws(" ", "p_name", "p_type")), " ").alias("words"))
    terms, vectors = models.fit_text_vectors(docs, "words", 16)
    brand = fx.item_dims(spark, d).where("dim_group = 'brand'")
    sums = vectors.join(brand.hint("merge"), "item_id").select("dim", F.posexplode("features").alias("i", "x")).groupBy("dim", "i").agg(F.sum("x").alias("s"))
    clusters = sums.groupBy("dim").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda t: t.s).alias("features"))
    tags = agg.tag_affinity(fx.actions(spark, d), fx.item_tags(spark, d), 10, 3, 0.2, None).select("user_id", "tag")
    out = vec.suggest_clusters(tags, terms.withColumnRenamed("term", "tag"), clusters.withColumnRenamed("dim", "cluster_id"), 5, 0.1)
    return out.withColumn("weight", F.round("weight", 5))


@query(
    "user_tag_vw",
    f"""WITH {SQL_AFFINE}, tg AS (SELECT item_id, string_agg(tag, ' ' ORDER BY tag) AS i FROM fx_item_tags GROUP BY 1),
        u AS (SELECT user_id, string_agg(w, ' ' ORDER BY w) AS u FROM (SELECT user_id, printf('%s:%.6f', tag, weight) AS w FROM k
              WHERE user_id IN (SELECT user_id FROM k GROUP BY 1 HAVING count(*) <= 5)) GROUP BY 1)
        SELECT event_id, '1 |i ' || i || ' |u ' || u AS line FROM fx_actions JOIN tg USING (item_id) JOIN u USING (user_id)""",
)
def user_tag_vw(spark, d):
    a, t = fx.actions(spark, d), fx.item_tags(spark, d)
    return models.user_tag_lines(a, t, agg.tag_affinity(a, t, 10, 3, 0.2, 5))


def histories(spark, d):
    return ses.history_features(fx.actions(spark, d), fx.item_tags(spark, d), 1, 12)


SQL_HISTORY = """tw AS (SELECT item_id, list(tag ORDER BY tag) AS tags FROM fx_item_tags GROUP BY item_id),
    h AS (SELECT a.*, tags, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq FROM fx_actions a JOIN tw USING (item_id)),
    f AS (SELECT *, flatten(list(tags) OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS past FROM h WHERE seq <= 12),
    l AS (SELECT event_id, list_concat(list_transform(tags, lambda t: 'i_' || t), list_transform(coalesce(past, []), lambda t: 'u_' || t)) AS e FROM f WHERE seq >= 1),
    x AS (SELECT event_id, unnest(e) AS tag, generate_subscripts(e, 1) AS pos FROM l),
    idf AS (SELECT tag, CASE WHEN count(DISTINCT event_id) >= 10 THEN ln(((SELECT count(*) FROM l) + 1.0) / (count(DISTINCT event_id) + 1.0)) ELSE 0 END AS idf FROM x GROUP BY tag)"""


@query(
    "tfidf_history_lines",
    f"""WITH {SQL_HISTORY}, c AS (SELECT event_id, tag, min(pos) AS pos, count(*) * any_value(idf) AS w FROM x JOIN idf USING (tag) GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (PARTITION BY event_id, tag LIKE 'i\\_%' ESCAPE '\\' ORDER BY w, pos) AS r FROM c)
        SELECT event_id, '1 |i ' || coalesce(string_agg(CASE WHEN tag LIKE 'i\\_%' ESCAPE '\\' THEN tag || ':' || printf('%.6f', w) END, ' ' ORDER BY pos), '') || ' |u ' ||
               coalesce(string_agg(CASE WHEN tag LIKE 'u\\_%' ESCAPE '\\' AND r <= 21 THEN tag || ':' || printf('%.6f', w) END, ' ' ORDER BY r), '') AS line FROM r GROUP BY event_id""",
)
def tfidf_history_lines(spark, d):
    return models.history_tfidf(histories(spark, d), min_df=10, max_user=21)[0]


@query(
    "tfidf_history_idf",
    f"WITH {SQL_HISTORY} SELECT tag, round(idf, 8) AS idf FROM idf",
)
def tfidf_history_idf(spark, d):
    return models.history_tfidf(histories(spark, d), min_df=10, max_user=21)[1].withColumn("idf", F.round("idf", 8))


def flat_maps(spark, d):
    o = fx.table(spark, d, "orders")
    return o.select(
        F.col("o_orderkey").alias("id"),
        "o_orderstatus",
        F.create_map(
            F.lit("prio"), F.col("o_orderpriority"), F.lit("status"), F.col("o_orderstatus"), F.lit("cust"), F.col("o_custkey").cast("string")
        ).alias("m"),
    )


@query(
    "labelled_lines",
    """SELECT o_orderkey AS id, l AS label, l || ' | cust:' || o_custkey || ' prio_' || replace(o_orderpriority, ' ', '_') AS line
       FROM orders JOIN (SELECT o_orderstatus, row_number() OVER (ORDER BY o_orderstatus) AS l FROM orders GROUP BY 1) USING (o_orderstatus)""",
    longs=("label",),
)
def labelled_lines(spark, d):
    return models.labelled_lines(flat_maps(spark, d), "m", "o_orderstatus", ["status"])[0].select("id", "label", "line")


def linear_inputs(spark, d):
    """Tag features of items, and a weight for every hashed (tag, class): the tag's share of the class's parts."""
    tags = fx.item_tags(spark, d)
    kinds = fx.item_dims(spark, d).where("dim_group = 'type'").select("item_id", F.col("dim").alias("target"))
    classes = kinds.select("target").distinct()
    classes = classes.withColumn("label", F.row_number().over(W.orderBy("target")))
    n = tags.join(kinds, "item_id").join(classes, "target").groupBy("tag", "label").agg(F.count("*").alias("n"))
    weights = n.withColumn("idx", feature_hash(F.lit("i"), "tag", F.col("label"), 18, 6)).groupBy("idx").agg((F.sum("n") / 1000.0).alias("weight"))
    rows = tags.select(F.col("item_id").alias("id"), F.lit("i").alias("namespace"), F.col("tag").alias("feature"), F.lit(1.0).alias("value"))
    return rows, weights, classes


@query(
    "linear_score",
    """WITH t AS (SELECT item_id, tag FROM fx_item_tags), k AS (SELECT p_partkey AS item_id, p_type AS target FROM part),
       w AS (SELECT tag, target, count(*) / 1000.0 AS weight FROM t JOIN k USING (item_id) GROUP BY 1, 2),
       s AS (SELECT t.item_id AS id, c.target, 1 / (1 + exp(-sum(coalesce(weight, 0)))) AS p FROM t CROSS JOIN (SELECT DISTINCT target FROM k) c
             LEFT JOIN w ON w.tag = t.tag AND w.target = c.target GROUP BY 1, 2)
       SELECT id, target, round(p / sum(p) OVER (PARTITION BY id), 8) AS score FROM s""",
)
def linear_score(spark, d):
    rows, weights, classes = linear_inputs(spark, d)
    return models.linear_score(rows, weights, classes, 18).withColumn("score", F.round("score", 8))


TEXT_SLOTS = 1 << 12


@query(
    "tfidf_scaler",
    f"""WITH tk AS (SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(lower(text), '\\s+$', ''), '\\s')) AS term FROM documents),
        sl AS (SELECT term, (({murmur3_sql("term", "42")} % {TEXT_SLOTS}) + {TEXT_SLOTS}) % {TEXT_SLOTS} AS slot FROM (SELECT DISTINCT term FROM tk)),
        tf AS (SELECT doc_id, slot, count(*) AS tf FROM tk JOIN sl USING (term) GROUP BY 1, 2),
        df AS (SELECT slot, ln(((SELECT count(*) FROM documents) + 1.0) / (count(*) + 1.0)) AS idf FROM tf GROUP BY 1),
        f AS (SELECT doc_id, slot, tf * idf AS value FROM tf JOIN df USING (slot) UNION ALL SELECT doc_id, {TEXT_SLOTS}, n_chars FROM documents),
        m AS (SELECT avg(n_chars) AS mean, stddev_samp(n_chars) AS dev FROM documents)
        SELECT doc_id, slot::BIGINT AS slot, round(value, 5) AS value, round((n_chars - mean) / dev, 5) AS scaled FROM f JOIN documents USING (doc_id), m WHERE value <> 0""",
    longs=("slot",),
)
def tfidf_scaler(spark, d):
    """Every entry of the documents' feature vectors that is not zero, and the standardised number of characters."""
    docs = fx.table(spark, d, "documents").select("doc_id", "text", F.col("n_chars").cast("double").alias("n_chars"))
    words, scaled = models.text_pipeline(docs, "text", ["n_chars"], TEXT_SLOTS)
    out = scaled.transform(words.transform(docs)).withColumn("f", F.unwrap_udt("features"))
    places = F.coalesce("f.indices", F.sequence(F.lit(0), F.size("f.values") - 1))
    cells = out.select("doc_id", vector_to_array("scaled")[0].alias("scaled"), F.explode(F.arrays_zip(places.alias("slot"), F.col("f.values").alias("value"))).alias("c"))
    return cells.where("c.value <> 0").select("doc_id", "c.slot", F.round("c.value", 5).alias("value"), F.round("scaled", 5).alias("scaled"))


@query("anomaly_inne")
def anomaly_inne(spark, d):
    e = fx.table(spark, d, "embeddings").select("vec_id", "embedding")
    model = models.fit_inne(e, "embedding")
    return models.score_inne(e, "vec_id", "embedding", model).withColumn("score", F.round("score", 5))

"""Queries: batch recommenders, ensembles, experiments, evaluation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tidewell.operators import aggregates as agg, counters, ensemble as ens, evaluation as ev, scoring as sc, sessions as ses, similarity as sim, vectors as vec
from tidewell.operators.topk import topk_by
from tidewell.plans import fixtures as fx
from tidewell.plans.q_core import ALPHA, SQL_AFFINE, SQL_COUNTERS, SQL_RATINGS, SQL_TAG_DEFS, WEIGHTS, now, stored_counts, tag_defs
from tidewell.plans.registry import query, sql_share

K = 8


def users(spark, d):
    return fx.actions(spark, d).select("user_id").distinct()


def bought(spark, d):
    """Exclusions: what users purchased."""
    return fx.actions(spark, d).where("action_type = 3").select("user_id", "item_id").distinct()


def rounded(df, digits=6):
    return df.select("user_id", "item_id", F.round(F.col("score").cast("double"), digits).alias("score"))


SQL_SEEN = "seen AS (SELECT DISTINCT user_id, item_id FROM fx_actions WHERE action_type = 3), us AS (SELECT DISTINCT user_id FROM fx_actions)"
UNSEEN = "NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = x.user_id AND s.item_id = x.item_id)"


def sql_top(source: str, k: int = K, rescale: bool = True, digits: int = 6, order: str = "score DESC, item_id") -> str:
    """Top k per user of ``source`` (user_id, item_id, score), divided by the best."""
    score = "score / max(score) OVER (PARTITION BY user_id)" if rescale else "score"
    return f"""SELECT user_id, item_id, round({score}, {digits}) AS score FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {order}) AS r FROM {source}) WHERE r <= {k}"""


# factor models: factor tables are taken from the embeddings (items) and from sums of them (users)


def item_factors(spark, d):
    return fx.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("features"))


def user_factors(spark, d):
    """Per user the sum of the factors of the items they clicked."""
    a = fx.actions(spark, d).where("action_type = 2").select("user_id", F.col("item_id").alias("id")).distinct()
    flat = a.join(item_factors(spark, d), "id").select("user_id", F.posexplode("features").alias("i", "x")).groupBy("user_id", "i").agg(F.sum(F.col("x").cast("double")).alias("x"))
    return flat.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda t: t.x).alias("features")).withColumnRenamed("user_id", "id")


SQL_FACTORS = """it AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
    uf AS (SELECT user_id, list(x ORDER BY i) AS f FROM (SELECT user_id, i, sum(x) AS x FROM (SELECT user_id, unnest(f) AS x, generate_subscripts(f, 1) AS i
           FROM (SELECT DISTINCT user_id, item_id FROM fx_actions WHERE action_type = 2) JOIN it USING (item_id)) GROUP BY 1, 2) GROUP BY 1),
    x AS (SELECT user_id, item_id, list_dot_product(uf.f, it.f) AS score FROM uf, it)"""


@query("rec_mf", f"WITH {SQL_SEEN}, {SQL_FACTORS}, y AS (SELECT * FROM x WHERE {UNSEEN}) {sql_top('y', K, False, 5)}")
def rec_mf(spark, d):
    return rounded(sc.rec_mf(user_factors(spark, d), item_factors(spark, d), K, bought(spark, d)), 5)


@query("rec_mf_candidates", f"WITH {SQL_SEEN}, {SQL_FACTORS}, y AS (SELECT * FROM x WHERE item_id % 3 = 0) {sql_top('y', K, False, 5)}")
def rec_mf_candidates(spark, d):
    allowed = item_factors(spark, d).where("id % 3 = 0").select(F.col("id").alias("item_id"))
    return rounded(sc.rec_mf(user_factors(spark, d), item_factors(spark, d), K, candidates=allowed), 5)


@query(
    "rec_mf_recent",
    """WITH it AS (SELECT vec_id AS item_id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
       rc AS (SELECT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM fx_actions) WHERE r <= 10),
       sm AS (SELECT user_id, i, sum(x) AS x FROM (SELECT user_id, unnest(f) AS x, generate_subscripts(f, 1) AS i FROM rc JOIN it USING (item_id)) GROUP BY 1, 2),
       uf AS (SELECT user_id, list(x ORDER BY i) AS f, sum(abs(x)) AS l1 FROM sm GROUP BY 1),
       x AS (SELECT user_id, item_id, list_dot_product(uf.f, it.f) / l1 AS score FROM uf, it),
       y AS (SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM rc WHERE rc.user_id = x.user_id AND rc.item_id = x.item_id)) """
    + sql_top("y", K, False, 6),
)
def rec_mf_recent(spark, d):
    recent = ses.recent_actions(fx.actions(spark, d), 10)
    return rounded(sc.rec_mf_recent(recent, item_factors(spark, d), K, invert=False))


@query("rec_mf_foldin")
def rec_mf_foldin(spark, d):
    recent = ses.recent_actions(fx.actions(spark, d), 10)
    return rounded(sc.rec_mf_recent(recent, item_factors(spark, d), K, users=user_factors(spark, d)), 4)


SQL_LISTS = f"""{SQL_COUNTERS}, {SQL_SEEN}, tl AS (SELECT cluster_id, item_id, c / max(c) OVER (PARTITION BY cluster_id) AS c FROM
    (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY c DESC, item_id) AS r FROM live) WHERE r <= {5 * K})"""


def cluster_lists(spark, d):
    at = counters.decay(F.unix_timestamp(now()) - F.unix_timestamp("t"), ALPHA)
    return stored_counts(spark, d).withColumn("count", F.col("count") * at).select("cluster_id", "item_id", "count")


def members(spark, d):
    return fx.user_clusters(spark, d).join(users(spark, d), "user_id", "left_semi")


@query(
    "rec_mf_cluster",
    f"WITH {SQL_LISTS}, x AS (SELECT user_id, item_id, c AS score FROM us JOIN fx_user_clusters USING (user_id) JOIN tl USING (cluster_id) WHERE weight = 1.0), y AS (SELECT * FROM x WHERE {UNSEEN}) {sql_top('y')}",
)
def rec_mf_cluster(spark, d):
    lists = topk_by(cluster_lists(spark, d), "cluster_id", 5 * K, score="count").withColumnRenamed("count", "score")
    return rounded(sc.rec_mf_cluster(members(spark, d).where("weight = 1.0"), lists, K, bought(spark, d)))


SQL_PAIRSIM = """bk AS (SELECT DISTINCT user_id, item_id FROM fx_actions),
    nn AS (SELECT item_id, count(*) AS n FROM bk GROUP BY 1),
    pp AS (SELECT a.item_id AS item_a, b.item_id AS item_b, count(*) AS c FROM bk a JOIN bk b ON a.user_id = b.user_id AND a.item_id <> b.item_id GROUP BY 1, 2),
    rc AS (SELECT DISTINCT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM fx_actions) WHERE r <= 10)"""


@query(
    "rec_item_sim",
    f"""WITH {SQL_PAIRSIM}, cs AS (SELECT item_a, item_b, c / sqrt((u.n * v.n)::DOUBLE) AS s FROM pp JOIN nn u ON u.item_id = item_a JOIN nn v ON v.item_id = item_b
            WHERE item_a < item_b AND item_a > 0),
        tp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_a ORDER BY s DESC, item_b) AS r FROM cs) WHERE r <= 20),
        sy AS (SELECT item_a, item_b, s FROM tp UNION SELECT item_b, item_a, s FROM tp),
        x AS (SELECT user_id, item_b AS item_id, sum(s) AS score FROM rc JOIN sy ON rc.item_id = item_a GROUP BY 1, 2),
        y AS (SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM rc WHERE rc.user_id = x.user_id AND rc.item_id = x.item_id)) {sql_top('y', K, False)}""",
)
def rec_item_sim(spark, d):
    a = fx.actions(spark, d)
    return rounded(sc.rec_item_sim(a, sim.item_similarity(a, limit=20), 10, K))


@query(
    "rec_cooccurrence",
    f"""WITH {SQL_PAIRSIM}, tp AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_a ORDER BY c DESC, item_b) AS r FROM pp) WHERE r <= 20),
        x AS (SELECT user_id, item_b AS item_id, sum(c)::DOUBLE AS score FROM rc JOIN tp ON rc.item_id = item_a GROUP BY 1, 2),
        y AS (SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM rc WHERE rc.user_id = x.user_id AND rc.item_id = x.item_id)
              AND item_id % 10 <> 3 AND item_id IN (SELECT item_id FROM fx_item_dims WHERE dim IN ('LARGE', 'SMALL', 'PROMO'))) {sql_top('y', K, False)}""",
)
def rec_cooccurrence(spark, d):
    a = fx.actions(spark, d)
    cooc = sim.cooccurrence(a.select("user_id", "item_id"), 20)
    q = ses.recent_actions(a, 10)
    block = fx.item_dims(spark, d).where("item_id % 10 = 3").select("item_id").distinct()
    return rounded(sc.rec_cooccurrence(q, cooc, K, block=block, item_dims=fx.item_dims(spark, d), dims=["LARGE", "SMALL", "PROMO"]))


@query(
    "rec_user_based",
    f"""WITH rt AS ({SQL_RATINGS}), pr AS (SELECT a.user_id AS ua, b.user_id AS ub, count(*) AS n, sum(a.rating) AS sx, sum(b.rating) AS sy, sum(a.rating * a.rating) AS sxx,
            sum(b.rating * b.rating) AS syy, sum(a.rating * b.rating) AS sxy FROM rt a JOIN rt b ON a.item_id = b.item_id AND a.user_id <> b.user_id GROUP BY 1, 2),
        sm AS (SELECT ua, ub, (n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy)) AS sim FROM pr WHERE n * sxx - sx * sx > 0 AND n * syy - sy * sy > 0),
        x AS (SELECT ua AS user_id, item_id, sum(sim * rating) / sum(sim) AS score FROM sm JOIN rt ON rt.user_id = ub WHERE sim > 0.1 GROUP BY 1, 2),
        y AS (SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM rt WHERE rt.user_id = x.user_id AND rt.item_id = x.item_id)) {sql_top('y', K, False, order='round(score, 9) DESC, item_id')}""",
)
def rec_user_based(spark, d):
    return rounded(sc.rec_user_based(agg.ratings(fx.actions(spark, d), WEIGHTS), K))


def tag_topic_weights(spark, d):
    """Topic weights per tag: share of the tag's parts in each part type (6 topics)."""
    kinds = fx.item_dims(spark, d).where("dim_group = 'type'").select("item_id", "dim")
    topic = F.when(F.col("dim") == "ECONOMY", 0).when(F.col("dim") == "LARGE", 1).when(F.col("dim") == "MEDIUM", 2)
    topic = topic.when(F.col("dim") == "PROMO", 3).when(F.col("dim") == "SMALL", 4).otherwise(5)
    rows = fx.item_tags(spark, d).join(kinds, "item_id").groupBy("tag", topic.alias("topic")).agg(F.count("*").alias("n"))
    return rows.select("tag", "topic", (F.col("n") / 100.0).alias("weight"))


def active_mix(spark, d):
    """User topic mix: mean item mix of clicked items."""
    mix = sc.item_topics(fx.item_tags(spark, d), tag_topic_weights(spark, d), 6, 2)
    clicked = fx.actions(spark, d).where("action_type = 2").select("user_id", "item_id").distinct()
    flat = clicked.join(mix, "item_id").select("user_id", F.posexplode("features").alias("i", "x")).groupBy("user_id", "i").agg(F.avg("x").alias("x"))
    return flat.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda t: t.x).alias("features"))


SQL_TOPICS = """tw AS (SELECT tag, dim AS topic, count(*) / 100.0 AS weight FROM fx_item_tags JOIN fx_item_dims USING (item_id) WHERE dim_group = 'type' GROUP BY 1, 2),
    en AS (SELECT item_id FROM fx_item_tags GROUP BY 1 HAVING count(*) >= 2),
    im AS (SELECT item_id, topic, sum(weight) / sum(sum(weight)) OVER (PARTITION BY item_id) AS w FROM fx_item_tags JOIN tw USING (tag) WHERE item_id IN (FROM en) GROUP BY 1, 2)"""


def _sql_topics(source: str, seen: str) -> str:
    return f"""WITH {SQL_TOPICS}, src AS ({source}), nn AS (SELECT user_id, count(*) AS n FROM src WHERE item_id IN (SELECT item_id FROM im) GROUP BY 1),
        um AS (SELECT user_id, topic, sum(w) / n AS w FROM src JOIN im USING (item_id) JOIN nn USING (user_id) GROUP BY user_id, topic, n),
        x AS (SELECT user_id, im.item_id, sum(um.w * im.w) AS score FROM um JOIN im USING (topic) GROUP BY 1, 2), seen AS ({seen}),
        y AS (SELECT * FROM x WHERE {UNSEEN}) {sql_top('y', K, True, 6, 'round(score, 10) DESC, item_id')}"""


@query(
    "rec_topics",
    _sql_topics("SELECT DISTINCT user_id, item_id FROM fx_actions WHERE action_type = 2", "SELECT DISTINCT user_id, item_id FROM fx_actions WHERE action_type = 3"),
)
def rec_topics(spark, d):
    mix = sc.item_topics(fx.item_tags(spark, d), tag_topic_weights(spark, d), 6, 2)
    return rounded(sc.rec_topics(active_mix(spark, d), mix, bought(spark, d), K))


SQL_RECENT5 = "SELECT DISTINCT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM fx_actions) WHERE r <= 5"


@query("rec_topics_recent", _sql_topics(SQL_RECENT5, SQL_RECENT5))
def rec_topics_recent(spark, d):
    mix = sc.item_topics(fx.item_tags(spark, d), tag_topic_weights(spark, d), 6, 2)
    recent = ses.recent_actions(fx.actions(spark, d), 5).select("user_id", "item_id").distinct()
    return rounded(sc.rec_topics_recent(recent, mix, K))


def item_vectors(spark, d):
    return fx.table(spark, d, "embeddings").select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("features"))


SQL_COSINE = f"""v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), rc AS ({SQL_RECENT5})"""


@query(
    "rec_vectors",
    f"""WITH {SQL_COSINE}, q AS (SELECT DISTINCT item_id FROM rc),
        s AS (SELECT a.vec_id AS fr, b.vec_id AS item_id, list_cosine_similarity(a.e, b.e) AS score FROM v a JOIN q ON q.item_id = a.vec_id, v b),
        n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fr ORDER BY round(score, 10) DESC, item_id) AS r FROM s) WHERE r <= {10 * K} AND round(score, 9) < 1.0),
        x AS (SELECT user_id, n.item_id, sum(score) AS score FROM rc JOIN n ON rc.item_id = fr GROUP BY 1, 2),
        y AS (SELECT * FROM x WHERE NOT EXISTS (SELECT 1 FROM rc WHERE rc.user_id = x.user_id AND rc.item_id = x.item_id)) {sql_top('y', K, True, 5)}""",
)
def rec_vectors(spark, d):
    recent = ses.recent_actions(fx.actions(spark, d), 5).select("user_id", "item_id").distinct()
    return rounded(vec.rec_vectors(recent, item_vectors(spark, d), K, skip_exact=True), 5)


@query(
    "vector_sort",
    f"""WITH {SQL_COSINE}, ls AS (SELECT user_id, item_id, (item_id * 7 + user_id) % 101 AS pos FROM (SELECT DISTINCT user_id, item_id FROM fx_actions)),
        f AS (SELECT ls.*, CASE WHEN rc.item_id IS NOT NULL THEN 1 WHEN v.vec_id IS NULL THEN 2 ELSE 0 END AS grp FROM ls LEFT JOIN rc USING (user_id, item_id) LEFT JOIN v ON v.vec_id = ls.item_id),
        s AS (SELECT f.user_id, f.item_id, sum(list_cosine_similarity(a.e, b.e)) AS score FROM f JOIN v a ON a.vec_id = f.item_id JOIN rc ON rc.user_id = f.user_id JOIN v b ON b.vec_id = rc.item_id
              WHERE grp = 0 GROUP BY 1, 2)
        SELECT f.user_id, f.item_id, row_number() OVER (PARTITION BY f.user_id ORDER BY grp, round(score, 10) DESC NULLS LAST, pos, f.item_id) AS rank FROM f LEFT JOIN s USING (user_id, item_id)
        WHERE f.user_id IN (SELECT user_id FROM s)""",
    longs=("rank",),
)
def vector_sort(spark, d):
    recent = ses.recent_actions(fx.actions(spark, d), 5).dropDuplicates(["user_id", "item_id"])
    lists = fx.actions(spark, d).select("user_id", "item_id").distinct()
    lists = lists.withColumn("pos", (F.col("item_id") * 7 + F.col("user_id")) % 101)
    return vec.ranked_lists(vec.vector_sort(lists, recent, item_vectors(spark, d))).select("user_id", "item_id", "rank")


# counters


def _sql_cluster(keys: str) -> str:
    return f"""WITH {SQL_LISTS}, x AS (SELECT user_id, item_id, sum(c * weight) AS score FROM ({keys}) JOIN tl USING (cluster_id) GROUP BY 1, 2),
        y AS (SELECT * FROM x WHERE {UNSEEN}), z AS (SELECT * FROM y WHERE user_id IN (SELECT user_id FROM y GROUP BY 1 HAVING count(*) >= 3)) {sql_top('z', K, True, 6, 'round(score, 10) DESC, item_id')}"""


@query(
    "rec_cluster_counts",
    _sql_cluster(
        """SELECT user_id, cluster_id, weight * 0.7 AS weight FROM us JOIN fx_user_clusters USING (user_id) WHERE weight = 1.0
           UNION ALL SELECT user_id, cluster_id, weight * 0.3 FROM us JOIN fx_user_clusters USING (user_id) WHERE weight = 0.5
           UNION ALL SELECT user_id, 'n' || (user_id % 7), 0.7 FROM us"""
    ),
)
def rec_cluster_counts(spark, d):
    m = members(spark, d)
    referred = users(spark, d).withColumn("cluster_id", F.concat(F.lit("n"), (F.col("user_id") % 7).cast("string")))
    out = sc.rec_cluster_counts(
        m.where("weight = 1.0"), cluster_lists(spark, d), K, bought(spark, d), 0.7, m.where("weight = 0.5"), 0.3, referred, min_items=3
    )
    return rounded(out)


@query(
    "rec_global_counts",
    f"""WITH {SQL_COUNTERS}, {SQL_SEEN}, g AS (SELECT item_id, sum(c) AS score FROM live GROUP BY 1), x AS (SELECT user_id, item_id, score FROM us, g), y AS (SELECT * FROM x WHERE {UNSEEN}) {sql_top('y')}""",
)
def rec_global_counts(spark, d):
    counts = cluster_lists(spark, d).groupBy("item_id").agg(F.sum("count").alias("count"))
    return rounded(sc.rec_global_counts(users(spark, d), counts, K, bought(spark, d)))


def current_items(spark, d):
    return ses.recent_actions(fx.actions(spark, d), 1).select("user_id", "item_id")


SQL_CURRENT = "cur AS (SELECT user_id, item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM fx_actions) WHERE r = 1)"


@query(
    "rec_from_item",
    f"""WITH {SQL_SEEN}, {SQL_CURRENT}, ic AS (SELECT dim AS cluster_id, item_id, count(*)::DOUBLE AS c FROM fx_actions JOIN fx_item_dims USING (item_id) GROUP BY 1, 2),
        tl AS (SELECT cluster_id, item_id, c / max(c) OVER (PARTITION BY cluster_id) AS c FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY c DESC, item_id) AS r FROM ic) WHERE r <= {5 * K}),
        x AS (SELECT user_id, tl.item_id, sum(c) AS score FROM cur JOIN fx_item_dims m ON m.item_id = cur.item_id JOIN tl ON tl.cluster_id = m.dim GROUP BY 1, 2),
        y AS (SELECT * FROM x WHERE {UNSEEN}) {sql_top('y', K, True, 6, 'round(score, 10) DESC, item_id')}""",
)
def rec_from_item(spark, d):
    dims = fx.item_dims(spark, d).select("item_id", F.col("dim").alias("cluster_id"))
    per_item = fx.actions(spark, d).groupBy("item_id").agg(F.count("*").cast("double").alias("count"))
    return rounded(sc.rec_from_item(current_items(spark, d), dims, per_item.join(dims, "item_id"), K, bought(spark, d)))


def given_lists(spark, d):
    return fx.actions(spark, d).select("user_id", "item_id").distinct().withColumn("pos", F.col("item_id"))


SQL_GIVEN = "ls AS (SELECT DISTINCT user_id, item_id FROM fx_actions)"


@query(
    "cluster_sort",
    f"""WITH {SQL_COUNTERS}, {SQL_GIVEN}, ce AS (SELECT user_id, cluster_id, item_id, c, weight FROM ls JOIN fx_user_clusters USING (user_id) JOIN live USING (cluster_id, item_id)),
        s AS (SELECT user_id, item_id, sum(c / m * weight) AS score FROM (SELECT *, max(c) OVER (PARTITION BY user_id, cluster_id) AS m FROM ce) GROUP BY 1, 2)
        SELECT user_id, item_id, round(coalesce(score, 0), 6) AS score, row_number() OVER (PARTITION BY user_id ORDER BY round(coalesce(score, 0), 10) DESC, item_id) AS rank
        FROM ls LEFT JOIN s USING (user_id, item_id) WHERE user_id IN (SELECT user_id FROM fx_user_clusters)""",
    longs=("rank",),
)
def cluster_sort(spark, d):
    out = sc.cluster_sort(given_lists(spark, d), members(spark, d), cluster_lists(spark, d))
    return out.withColumn("score", F.round("score", 6))


@query(
    "rec_tag_affinity",
    f"""WITH {SQL_AFFINE}, {SQL_SEEN}, tc AS (SELECT tag, item_id, count(*)::DOUBLE AS c FROM fx_actions JOIN fx_item_tags USING (item_id) GROUP BY 1, 2),
        tl AS (SELECT tag, item_id, c / max(c) OVER (PARTITION BY tag) AS c FROM (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY c DESC, item_id) AS r FROM tc) WHERE r <= {2 * K}),
        x AS (SELECT user_id, item_id, sum(c * weight) AS score FROM k JOIN tl USING (tag) WHERE user_id IN (SELECT user_id FROM k GROUP BY 1 HAVING count(*) <= 5) GROUP BY 1, 2),
        y AS (SELECT * FROM x WHERE {UNSEEN}) {sql_top('y', K, True, 6, 'round(score, 10) DESC, item_id')}""",
)
def rec_tag_affinity(spark, d):
    a, t = fx.actions(spark, d), fx.item_tags(spark, d)
    affinity = agg.tag_affinity(a, t, 10, 3, 0.2, 5)
    counts = a.groupBy("item_id").agg(F.count("*").cast("double").alias("count")).join(t, "item_id")
    return rounded(sc.rec_tag_affinity(affinity, counts, K, bought(spark, d)))


def popularity(spark, d):
    return agg.most_popular(fx.actions(spark, d)).select("item_id", F.col("n").cast("double").alias("score"))


SQL_POP = "pop AS (SELECT item_id, count(*)::DOUBLE AS score FROM fx_actions WHERE item_id > 0 GROUP BY 1)"


@query(
    "rec_popular",
    f"""WITH {SQL_SEEN}, {SQL_POP}, x AS (SELECT user_id, item_id, score FROM us, pop WHERE item_id IN (SELECT item_id FROM fx_item_dims WHERE dim IN ('SMALL', 'LARGE'))),
        y AS (SELECT * FROM x WHERE {UNSEEN}) {sql_top('y')}""",
)
def rec_popular(spark, d):
    return rounded(sc.rec_popular(users(spark, d), popularity(spark, d), K, bought(spark, d), fx.item_dims(spark, d), ["SMALL", "LARGE"]))


@query(
    "rec_popular_dim",
    f"""WITH {SQL_SEEN}, {SQL_POP}, {SQL_CURRENT}, ud AS (SELECT user_id, dim FROM cur JOIN fx_item_dims USING (item_id) WHERE dim_group = 'type'),
        x AS (SELECT user_id, pop.item_id, score FROM ud JOIN fx_item_dims i ON i.dim = ud.dim JOIN pop ON pop.item_id = i.item_id), y AS (SELECT * FROM x WHERE {UNSEEN}) {sql_top('y')}""",
)
def rec_popular_dim(spark, d):
    dims = fx.item_dims(spark, d)
    mine = current_items(spark, d).join(dims.where("dim_group = 'type'"), "item_id").select("user_id", "dim")
    return rounded(sc.rec_popular_dim(mine, popularity(spark, d), dims, K, bought(spark, d)))


@query(
    "reorder_by_popularity",
    f"""WITH {SQL_POP}, {SQL_GIVEN} SELECT user_id, item_id, coalesce(score, 0) AS score, row_number() OVER (PARTITION BY user_id ORDER BY coalesce(score, 0) DESC, item_id) AS rank
        FROM ls LEFT JOIN pop USING (item_id)""",
    longs=("rank",),
)
def reorder_by_popularity(spark, d):
    return sc.reorder_by_popularity(given_lists(spark, d), popularity(spark, d))


SQL_SESSION_ROWS = f"""recent AS (SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM fx_actions) WHERE rank <= 3),
    chosen AS (SELECT item_id, CASE dim_group WHEN 'type' THEN 0 ELSE 1 END AS a, dim FROM fx_item_dims WHERE dim_group IN ('type', 'brand')),
    lists AS (SELECT * FROM (SELECT dim, item_id, score AS cnt, row_number() OVER (PARTITION BY dim ORDER BY score DESC, item_id) AS pos FROM pop JOIN fx_item_dims USING (item_id)) WHERE pos <= 20),
    x AS (SELECT user_id, rank, a, pos, lists.item_id, cnt FROM recent JOIN chosen ON chosen.item_id = recent.item_id JOIN lists USING (dim)),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rank, a, pos, item_id) AS i FROM x WHERE {UNSEEN}),
    walk(user_id, i, rank, a, ceil0, low0, top0, full0, out0, ids0, item_id, value) AS (
      SELECT user_id, i, rank, a, 1.0::DOUBLE, 1.0::DOUBLE, cnt, 1 >= {K}, FALSE, [item_id], item_id, 1.0::DOUBLE FROM r WHERE i = 1
      UNION ALL SELECT user_id, i, rank, a, ceil1, low2, top2, full2, out1, ids1, item_id, value1 FROM (
        SELECT r.user_id, r.i, r.rank, r.a, r.item_id, r.rank <> w.rank AS deeper, NOT deeper AND r.a <> w.a AS other, NOT deeper AND (out0 OR (other AND len(ids0) >= {K})) AS out1,
          CASE WHEN deeper THEN 1.0::DOUBLE WHEN other THEN low0 ELSE ceil0 END AS ceil1, CASE WHEN deeper OR other THEN 1.0::DOUBLE ELSE low0 END AS low1,
          CASE WHEN deeper OR other THEN 0.0::DOUBLE ELSE top0 END AS top1, NOT (deeper OR other) AND full0 AS full1, out1 OR full1 AS halt,
          CASE WHEN halt OR top1 > 0 THEN top1 ELSE r.cnt END AS top2, CASE WHEN NOT halt THEN r.cnt / top2 * ceil1 END AS value1,
          CASE WHEN halt OR list_contains(ids0, r.item_id) THEN ids0 ELSE list_append(ids0, r.item_id) END AS ids1,
          CASE WHEN halt THEN low1 ELSE value1 END AS low2, CASE WHEN halt THEN full1 ELSE len(ids1) >= {K} END AS full2
        FROM walk w JOIN r ON r.user_id = w.user_id AND r.i = w.i + 1)),
    y AS (SELECT user_id, item_id, sum(value) AS score FROM walk WHERE value IS NOT NULL GROUP BY 1, 2)"""


@query("rec_popular_session", f"WITH RECURSIVE {SQL_SEEN}, {SQL_POP}, {SQL_SESSION_ROWS} {sql_top('y')}")
def rec_popular_session(spark, d):
    recent = ses.recent_actions(fx.actions(spark, d), 3)
    attrs = fx.item_dims(spark, d).select("item_id", F.col("dim_group").alias("attr"), "dim")
    lists = popularity(spark, d).join(fx.item_dims(spark, d), "item_id").select("dim", "item_id", F.col("score").alias("count"))
    return rounded(sc.rec_popular_session(recent, attrs, lists, ["type", "brand"], 3, K, 20, bought(spark, d)))


@query(
    "rec_recent",
    f"""WITH {SQL_SEEN}, x AS (SELECT user_id, p_partkey AS item_id FROM us, part), y AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_id DESC) AS r FROM x WHERE {UNSEEN})
        SELECT user_id, item_id, round(1 - (r - 1) / count(*) OVER (PARTITION BY user_id), 6)::DOUBLE AS score FROM y WHERE r <= {K}""",
)
def rec_recent(spark, d):
    items = fx.table(spark, d, "part").select(F.col("p_partkey").alias("item_id"))
    return rounded(sc.rec_recent(users(spark, d), items, K, bought(spark, d)))


@query(
    "rec_recent_category",
    f"""WITH {SQL_CURRENT}, x AS (SELECT user_id, b.item_id FROM cur JOIN fx_item_dims a ON a.item_id = cur.item_id AND a.dim_group = 'brand' JOIN fx_item_dims b ON b.dim = a.dim WHERE b.item_id <> cur.item_id),
        y AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY item_id DESC) AS r FROM x)
        SELECT user_id, item_id, round(1 - (r - 1) / count(*) OVER (PARTITION BY user_id), 6)::DOUBLE AS score FROM y WHERE r <= {K}""",
)
def rec_recent_category(spark, d):
    return rounded(sc.rec_recent_category(current_items(spark, d), fx.item_dims(spark, d), K, "brand"))


@query(
    "rec_interactions",
    f"""SELECT user_id, item_id, round(1 - (r - 1) / count(*) OVER (PARTITION BY user_id), 6)::DOUBLE AS score FROM
        (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM fx_actions) WHERE r <= {K}""",
)
def rec_interactions(spark, d):
    return rounded(ses.recent_interactions(fx.actions(spark, d), K))


@query(
    "rec_static",
    f"""WITH x AS (SELECT user_id, item_id, sum(value) AS score FROM fx_actions GROUP BY 1, 2), y AS (SELECT * FROM x WHERE item_id IN (SELECT item_id FROM fx_item_dims WHERE dim = 'MEDIUM')) {sql_top('y', K, False, 4)}""",
)
def rec_static(spark, d):
    stored = fx.actions(spark, d).groupBy("user_id", "item_id").agg(F.sum("value").alias("score"))
    return rounded(sc.rec_static(stored, K, fx.item_dims(spark, d), ["MEDIUM"]), 4)


# filters and includers


def stored_recs(spark, d):
    return fx.actions(spark, d).groupBy("user_id", "item_id").agg(F.sum("value").alias("score"))


SQL_STORED = "x AS (SELECT user_id, item_id, sum(value) AS score FROM fx_actions GROUP BY 1, 2)"


@query("filter_current", f"WITH {SQL_CURRENT}, {SQL_STORED} SELECT user_id, item_id FROM x WHERE (user_id, item_id) NOT IN (SELECT user_id, item_id FROM cur)")
def filter_current(spark, d):
    return sc.filter_current(stored_recs(spark, d), current_items(spark, d)).select("user_id", "item_id")


@query("filter_recent", f"WITH {SQL_STORED}, rc AS ({SQL_RECENT5}) SELECT user_id, item_id FROM x WHERE (user_id, item_id) NOT IN (SELECT user_id, item_id FROM rc)")
def filter_recent(spark, d):
    return sc.filter_recent(stored_recs(spark, d), fx.actions(spark, d), 5).select("user_id", "item_id")


@query(
    "filter_ignored",
    f"""WITH {SQL_STORED} SELECT user_id, item_id FROM x WHERE (user_id, item_id) NOT IN (SELECT user_id, item_id FROM fx_actions WHERE action_type = 1
        EXCEPT SELECT user_id, item_id FROM fx_actions WHERE action_type = 2)""",
)
def filter_ignored(spark, d):
    a = fx.actions(spark, d)
    return sc.filter_ignored(stored_recs(spark, d), a.where("action_type = 1"), a.where("action_type = 2")).select("user_id", "item_id")


@query(
    "filter_tag_affinity",
    f"""WITH {SQL_AFFINE}, {SQL_TAG_DEFS}, uc AS (SELECT DISTINCT user_id, cluster FROM k JOIN defs USING (tag)),
        tg AS (SELECT DISTINCT cluster, item_id FROM defs JOIN fx_item_tags USING (tag)),
        nw AS (SELECT cluster, item_id FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY item_id DESC) AS r FROM tg) WHERE r <= 15),
        gc AS (SELECT DISTINCT tag_group, cluster FROM defs), rch AS (SELECT DISTINCT user_id, b.cluster FROM uc JOIN gc a USING (cluster) JOIN gc b ON b.tag_group = a.tag_group)
        SELECT DISTINCT user_id, item_id FROM rch JOIN nw USING (cluster) WHERE (user_id, cluster) NOT IN (SELECT user_id, cluster FROM uc)
        EXCEPT SELECT user_id, item_id FROM uc JOIN nw USING (cluster)""",
)
def filter_tag_affinity(spark, d):
    a, t, defs = fx.actions(spark, d), fx.item_tags(spark, d), tag_defs(spark, d)
    mine = agg.tag_affinity_report(a, t, users(spark, d).withColumn("client_user_id", F.lit("")), 10, 3, 0.2).join(defs, "tag").select("user_id", "cluster")
    return sc.filter_tag_affinity(mine, defs, t, 15)


@query("include_recent", f"SELECT user_id, p_partkey AS item_id FROM (SELECT DISTINCT user_id FROM fx_actions), (SELECT p_partkey FROM part ORDER BY 1 DESC LIMIT {K})")
def include_recent(spark, d):
    return sc.include_recent(users(spark, d), fx.table(spark, d, "part").select(F.col("p_partkey").alias("item_id")), K)


@query("include_popular", f"WITH {SQL_POP} SELECT user_id, item_id FROM (SELECT DISTINCT user_id FROM fx_actions), (SELECT item_id FROM pop ORDER BY score DESC, item_id LIMIT {K})")
def include_popular(spark, d):
    return sc.include_popular(users(spark, d), popularity(spark, d), K)


@query("include_explicit", "SELECT user_id, unnest([3, 14, 15])::BIGINT AS item_id FROM (SELECT DISTINCT user_id FROM fx_actions)")
def include_explicit(spark, d):
    return sc.include_explicit(users(spark, d), [3, 14, 15])


# ensembles


def three(spark, d):
    """Three recommendation lists of different lengths per user."""
    a = fx.actions(spark, d)
    own = a.groupBy("user_id", "item_id").agg(F.sum("value").alias("score"))
    return [
        ("rare", sc.rec_static(own.where("score > 250"), 10)),
        ("buys", sc.rec_static(a.where("action_type = 3").groupBy("user_id", "item_id").agg(F.sum("value").alias("score")), 10)),
        ("views", sc.rec_static(a.where("action_type = 1").groupBy("user_id", "item_id").agg((F.sum("value") * 2).alias("score")), 10)),
    ]


SQL_THREE = """al AS (SELECT 0 AS ord, 'rare' AS algo, user_id, item_id, sum(value) AS score FROM fx_actions GROUP BY user_id, item_id HAVING sum(value) > 250
        UNION ALL SELECT 1, 'buys', user_id, item_id, sum(value) FROM fx_actions WHERE action_type = 3 GROUP BY user_id, item_id
        UNION ALL SELECT 2, 'views', user_id, item_id, sum(value) * 2 FROM fx_actions WHERE action_type = 1 GROUP BY user_id, item_id),
    ls AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ord, user_id ORDER BY score DESC, item_id) AS r FROM al) WHERE r <= 10),
    sz AS (SELECT user_id, ord, count(*) AS n FROM ls GROUP BY 1, 2)"""


def _union(spark, d):
    return reduce(lambda x, y: x.unionByName(y), [ens.tagged(r, n, i) for i, (n, r) in enumerate(three(spark, d))])


@query(
    "combine_first",
    f"""WITH {SQL_THREE}, ch AS (SELECT user_id, ord FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY (n >= 6) DESC, CASE WHEN n >= 6 THEN ord ELSE -n END, ord) AS q FROM sz) WHERE q = 1)
        SELECT user_id, item_id, round(score, 4) AS score, algo FROM ls JOIN ch USING (user_id, ord) WHERE r <= 6""",
)
def combine_first(spark, d):
    return ens.combine_first(_union(spark, d), 6).withColumn("score", F.round("score", 4))


def _sql_rank(where: str) -> str:
    return f"""WITH {SQL_THREE} SELECT user_id, item_id, sum(6 - (r - 1))::DOUBLE AS score, string_agg(algo, ':' ORDER BY algo) AS algo FROM ls JOIN sz USING (user_id, ord)
        WHERE r <= 6 {where} GROUP BY 1, 2"""


@query("combine_rank_sum", _sql_rank(""))
def combine_rank_sum(spark, d):
    return ens.combine_rank_sum(_union(spark, d), 6)


@query("combine_rank_sum_strict", _sql_rank("AND n >= 6"))
def combine_rank_sum_strict(spark, d):
    return ens.combine_rank_sum(_union(spark, d), 6, strict=True)


@query(
    "combine_score",
    f"""WITH {SQL_THREE}, m AS (SELECT user_id, item_id, max(score) AS score, string_agg(algo, ':' ORDER BY algo) AS algo FROM ls GROUP BY 1, 2)
        SELECT user_id, item_id, round(score, 4) AS score, algo FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS q FROM m) WHERE q <= 6""",
)
def combine_score(spark, d):
    return ens.combine_score(_union(spark, d), 6).withColumn("score", F.round("score", 4))


@query(
    "ensemble",
    f"""WITH {SQL_THREE}, m AS (SELECT user_id, item_id, sum(6 - (r - 1))::DOUBLE AS score, string_agg(algo, ':' ORDER BY algo) AS algo FROM ls WHERE r <= 6 GROUP BY 1, 2)
        SELECT user_id, item_id, score, algo FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS q FROM m) WHERE q <= 6""",
)
def ensemble(spark, d):
    return ens.ensemble(three(spark, d), "rank_sum", 6)


@query(
    "ab_assign",
    """SELECT c_custkey AS user_id, CASE WHEN b <= 20 THEN 'a' WHEN b <= 50 THEN 'b' ELSE 'c' END AS variation FROM
       (SELECT c_custkey, ('0x' || substr(md5('0:' || c_custkey), 1, 15))::BIGINT % 100 + 1 AS b FROM customer)""",
)
def ab_assign(spark, d):
    return ens.ab_assign(fx.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id")), {"a": 2.0, "b": 3.0, "c": 5.0})


@query("random_variation", f"SELECT event_id, CASE WHEN {sql_share('event_id', 42)} <= 0.25 THEN 'a' ELSE 'b' END AS variation FROM events")
def random_variation(spark, d):
    return ens.random_variation(fx.table(spark, d, "events").select("event_id"), {"a": 0.25, "b": 0.75}, key=["event_id"])


@query(
    "tag_strategy",
    "SELECT event_id, CASE tag WHEN 't0' THEN 'popular' WHEN 't2' THEN 'similar' ELSE 'mf' END AS strategy FROM fx_impressions",
)
def tag_strategy(spark, d):
    imps = fx.impressions(spark, d)
    rules = imps.select("tag").distinct().where("tag in ('t0', 't2')").withColumn("strategy", F.when(F.col("tag") == "t0", "popular").otherwise("similar"))
    return ens.tag_strategy(imps, rules, "mf").select("event_id", "strategy")


@query(
    "diversify",
    f"""WITH {SQL_STORED}, rk AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS r FROM x),
        dr AS (SELECT *, CASE WHEN user_id % 2 = 0 THEN ('0x' || substr(md5('42:' || user_id || ':' || item_id), 1, 15))::BIGINT ELSE r END AS dw FROM rk WHERE r <= 15)
        SELECT user_id, item_id, round(score, 4) AS score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY dw, item_id) AS q FROM dr) WHERE q <= 5""",
)
def diversify(spark, d):
    recs = stored_recs(spark, d)
    shown = ens.list_hash(recs, 5).where("user_id % 2 = 0")
    return ens.diversify(recs, 5, 3, shown).withColumn("score", F.round("score", 4))


# evaluation


@query(
    "split_train_test",
    f"""WITH rt AS ({SQL_RATINGS}), h AS (SELECT *, (('0x' || substr(md5('123:' || user_id || ':' || item_id), 1, 15))::BIGINT % 1000000) / 1e6 AS a,
            (('0x' || substr(md5('124:' || user_id), 1, 15))::BIGINT % 1000000) / 1e6 AS b FROM rt)
        SELECT CASE WHEN a < 0.8 THEN 'train' ELSE 'test' END AS part, user_id, item_id, rating FROM h WHERE a < 0.8 OR b < 0.1""",
)
def split_train_test(spark, d):
    train, test = ev.split(agg.ratings(fx.actions(spark, d), WEIGHTS), ["user_id", "item_id"])
    return train.select(F.lit("train").alias("part"), "user_id", "item_id", "rating").union(test.select(F.lit("test"), "user_id", "item_id", "rating"))


def predicted(spark, d):
    return fx.actions(spark, d).groupBy("user_id", "item_id").agg((F.sum("value") / 50).alias("score"))


@query(
    "eval_error",
    f"""WITH rt AS ({SQL_RATINGS}), p AS (SELECT user_id, item_id, sum(value) / 50 AS score FROM fx_actions GROUP BY 1, 2)
        SELECT round(avg(abs(rating - score)), 6) AS mae, round(sqrt(avg((rating - score) * (rating - score))), 6) AS rmse, count(*) AS n FROM rt JOIN p USING (user_id, item_id)""",
)
def eval_error(spark, d):
    out = ev.rating_error(agg.ratings(fx.actions(spark, d), WEIGHTS), predicted(spark, d))
    return out.select(F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"), "n")


@query(
    "eval_ranking",
    """WITH rel AS (SELECT DISTINCT user_id, item_id FROM fx_actions WHERE action_type = 3), sz AS (SELECT user_id, count(*) AS rel FROM rel GROUP BY 1),
       rk AS (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS r FROM (SELECT user_id, item_id, sum(value) / 50 AS score FROM fx_actions GROUP BY 1, 2)),
       ks AS (SELECT unnest([5, 10, 20]) AS k), h AS (SELECT k, rk.user_id, r, row_number() OVER (PARTITION BY k, rk.user_id ORDER BY r) AS i FROM ks, rk JOIN rel USING (user_id, item_id) WHERE r <= k),
       g AS (SELECT k, user_id, sum(1 / log2(r + 1)) AS dcg, 1.0 / min(r) AS mrr, count(*) AS n, sum(i / r) AS ap FROM h GROUP BY 1, 2),
       u AS (SELECT ks.k, sz.user_id, rel, coalesce(n, 0) AS n, coalesce(mrr, 0) AS mrr, coalesce(ap, 0) / least(rel, ks.k) AS map,
                    coalesce(dcg, 0) / list_sum(list_transform(range(1, least(rel, ks.k) + 1), lambda x: 1 / log2(x + 1))) AS ndcg
             FROM ks CROSS JOIN sz LEFT JOIN g ON g.k = ks.k AND g.user_id = sz.user_id)
       SELECT k, round(avg(ndcg), 6) AS ndcg, round(avg(mrr), 6) AS mrr, round(avg(n / k), 6) AS precision, round(avg(n / rel), 6) AS recall,
              round(avg(CASE WHEN n > 0 THEN 2 * (n / k) * (n / rel) / (n / k + n / rel) ELSE 0 END), 6) AS f1, round(avg(map), 6) AS map FROM u GROUP BY k""",
)
def eval_ranking(spark, d):
    out = ev.ranking_metrics(bought(spark, d), predicted(spark, d))
    return out.select("k", *[F.round(c, 6).alias(c) for c in out.columns if c != "k"])


@query(
    "prefs_model",
    """SELECT user_id, item_id, round(sum(value), 4) AS pref, count(DISTINCT date_trunc('second', ts)) AS times,
              round(sum(sum(value)) OVER (PARTITION BY item_id), 3) AS item_total FROM fx_actions GROUP BY 1, 2""",
)
def prefs_model(spark, d):
    sums, totals, times = ev.prefs(fx.actions(spark, d))
    n = times.groupBy("user_id", "item_id").agg(F.count("*").alias("times"))
    out = sums.join(n, ["user_id", "item_id"]).join(totals, "item_id")
    return out.select("user_id", "item_id", F.round("pref", 4).alias("pref"), "times", F.round("total", 3).alias("item_total"))

"""Behaviour on small literal frames."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row, functions as F

from tidewell.functions import hashing, scalars as fn
from tidewell.operators import aggregates as agg, counters, ensemble as ens, features as ft, filters as flt, graph, ingest, models, rules, scoring, sessions as ses, skew, text, vectors as vec
from tidewell.session import scratch_path
from tidewell.sources import readers, writers


@pytest.mark.parametrize(
    "path, template",
    [
        ("/users/22/recommendations", "/users/{userid}/recommendations"),
        ("/users/22/actions", "/users/{userid}/actions"),
        ("/items/22/actions", "/items/{itemid}/actions"),
        ("/users/22/actions/33", "/users/{userid}/actions/{itemid}"),
        ("/items/22/actions/33", "/items/{itemid}/actions/{userid}"),
        ("/actions/22", "/actions/{actionid}"),
        ("/items/22", "/items/{itemid}"),
        ("/js/users/22/actions", "/js/users/22/actions"),
        ("/other/1", "/other/1"),
    ],
)
def test_path_template(spark, path, template):
    assert spark.createDataFrame([(path,)], "p string").select(fn.path_template("p")).first()[0] == template


def test_binary(spark):
    df = spark.createDataFrame([("something", 2), (None, 0), ("2", None), ("0", 1), ("", 1)], "a string, b int")
    rows = df.select(fn.binary("a").alias("a"), fn.binary("b").alias("b")).collect()
    assert [r.a for r in rows] == [1, 0, 1, 0, 0] and [r.b for r in rows] == [1, 0, 0, 1, 1]


def test_column_sets_and_tokens(spark):
    df = spark.createDataFrame([("a b", "c 1", 3), ("word1", None, None)], "a string, b string, c int")
    assert flt.include(df, ["a", "z"]).columns == ["a"] and flt.exclude(df, ["b", "z"]).columns == ["a", "c"]
    assert flt.require(df, ["b"]).count() == 1
    tokens = [r[0] for r in df.select(fn.split_tokens(["a", "b"], ignore_numbers=True)).collect()]
    assert tokens == [["a", "b", "c"], ["word1"]]


def test_feature_ids(spark):
    df = spark.createDataFrame([("type1",), ("type2",), ("type1",)], "a string")
    kept = ft.FeatureIds("a", "id", max_classes=1, exclude_missing=True).fit_transform(df)
    assert kept.count() == 2 and {r.id for r in kept.collect()} == {1}
    assert ft.FeatureIds("a", "id", min_size=2, exclude_missing=True).fit_transform(df).count() == 2
    rows = {r.a: r.id for r in ft.FeatureIds("a", "id", min_size=2, zero_based=True).fit_transform(df).collect()}
    assert rows == {"type1": 0, "type2": -1}


def test_svm_features(spark):
    rows = [(1, 1.2, "word", ["a", "b"], {"a": "1"}), (2, 3.0, None, ["b", "d"], None), (3, None, None, None, {"k": "1", "k2": "word"})]
    df = spark.createDataFrame(rows, "id long, a double, b string, c array<string>, d map<string,string>")
    t = ft.SvmFeatures("id").fit(df)
    names = {r.id: r.name for r in t.ids.collect()}
    assert sorted(names) == list(range(1, len(names) + 1))
    out = {r.id: {names[x.id]: x.value for x in r.svm} for r in t.transform(df).collect()}
    assert out[1] == {"a": 1.2, "b_word": 1.0, "c_a": 1.0, "c_b": 1.0, "d_a": 1.0}
    assert out[2] == {"a": 3.0, "c_b": 1.0, "c_d": 1.0} and out[3] == {"d_k": 1.0, "d_k2_word": 1.0}
    only = ft.SvmFeatures("id", included=["a"]).fit(df)
    assert [r.svm for r in only.transform(df).orderBy("id").collect()] == [[Row(id=1, value=1.2)], [Row(id=1, value=3.0)], []]


def auto(spark, rows, schema, **kw):
    df = spark.createDataFrame(rows, schema)
    t = ft.AutoTransform(exclude=["id"], **kw).fit(df)
    return t.transform(df).orderBy("id").collect()


def test_auto_numbers_and_missing(spark):
    out = auto(spark, [(1, "NA"), (2, "10"), (3, "12"), (4, "8")], "id int, a string", ignore=["NA"])
    assert [round(r.a, 4) for r in out] == [0.0, 0.0, 1.2247, -1.2247]
    out = auto(spark, [(1, 10), (2, 99), (3, 12), (4, 8)], "id int, a int", ignore=[99])
    assert [round(r.a, 4) for r in out] == [0.0, 0.0, 1.2247, -1.2247]


def test_auto_categories_and_bools(spark):
    out = auto(spark, [(1, ""), (2, "v1"), (3, "v2"), (4, "v3")], "id int, a string")
    assert [r.a for r in out] == ["UKN", "v1", "v2", "v3"]
    out = auto(spark, [(1, "true"), (2, "false"), (3, "")], "id int, a string", missing="?")
    assert [r.a for r in out] == ["true", "false", "?"]
    assert [r.a for r in auto(spark, [(1, True), (2, False)], "id int, a boolean")] == [1, 0]
    out = auto(spark, [(1, 10), (2, 5), (3, 10)], "id int, a int", max_numeric_values=2)
    assert [r.a for r in out] == ["a_10", "a_5", "a_10"]


def test_auto_dates_drops_and_clip(spark):
    out = auto(spark, [(1, "30-01-14 15:11"), (2, "31-01-14 10:11")], "id int, a string", date_cols=["a"], date_formats=["dd-MM-yy HH:mm"])
    assert round(out[0].a_h1, 2) == -0.71 and out[0].a_hour == "h15" and out[0].a_w == "w3" and out[0].a_year == "y2014"
    df = spark.createDataFrame([(1, 12, 12, 7), (2, 10, 10, 7)], "id int, a int, b int, c int")
    assert ft.AutoTransform(exclude=["id"]).fit_transform(df).columns == ["id", "b"]
    t = ft.AutoTransform(exclude=["id"], clip=True).fit(spark.createDataFrame([(1, 9), (2, 12)], "id int, a int"))
    assert [r.a for r in t.transform(spark.createDataFrame([(1, 1), (2, 15)], "id int, a int")).orderBy("id").collect()] == [-1.0, 1.0]


def test_tfidf_weight_of_33_of_unshared_terms(spark):
    a = [str(100 + i) for i in range(33)]
    b = [str(900 + i) for i in range(44)]
    df = spark.createDataFrame([(1, a, 1), (2, b, 1)], "id int, t array<string>, y int")
    w = ft.TfidfFeatures("id", "t", "w").fit_transform(df).orderBy("id").first().w
    assert len(w) == 33 and math.isclose(w["105"], 0.174077655956, rel_tol=1e-9)
    top = ft.TfidfFeatures("id", "t", "w", target="y", top=2).fit_transform(df)
    assert sum(len(r.w) for r in top.collect()) == 2


def test_scale_and_binarise(spark):
    df = spark.createDataFrame([(1.0, "x"), (3.0, "y")], "a double, l string")
    assert sorted(r.a for r in ft.Scale(["a"]).fit_transform(df).collect()) == [-1.0, 1.0]
    assert ft.Binarise("l").fit_transform(df).columns == ["a", "l", "l_0"]


def recs(spark, lists):
    rows = [(1, i, float(s), n, o) for o, (n, items) in enumerate(lists) for i, s in items]
    return spark.createDataFrame(rows, "user_id long, item_id long, score double, algo string, ord int")


def test_combiners(spark):
    few, enough, plenty = [(1, 0.9)], [(1, 0.5), (2, 0.4), (3, 0.3)], [(4, 9.0), (1, 8.0), (2, 7.0), (5, 6.0)]
    r = recs(spark, [("few", few), ("enough", enough), ("plenty", plenty)])
    assert {x.algo for x in ens.combine_first(r, 3).collect()} == {"enough"}
    assert {x.algo for x in ens.combine_first(r, 9).collect()} == {"plenty"}
    sums = {x.item_id: x.score for x in ens.combine_rank_sum(r, 3).collect()}
    assert sums == {1: 3 + 3 + 2, 2: 2 + 1, 3: 1, 4: 3}
    strict = {x.item_id: x.score for x in ens.combine_rank_sum(r, 3, strict=True).collect()}
    assert strict == {1: 3 + 2, 2: 2 + 1, 3: 1, 4: 3}
    assert [x.item_id for x in ens.combine_score(r, 2).orderBy(F.desc("score")).collect()] == [4, 1]
    assert {x.item_id: x.score for x in ens.combine_score(r, 5, first_seen=True).collect()}[1] == 0.9


def test_ab_shares(spark):
    users = spark.range(40000).withColumnRenamed("id", "user_id")
    n = ens.ab_assign(users, {c: 0.25 for c in "abcd"}).groupBy("variation").count().collect()
    assert len(n) == 4 and all(abs(r["count"] / 40000 - 0.25) < 0.015 for r in n)
    m = ens.random_variation(users, {"a": 1.0, "b": 3.0}).groupBy("variation").count().collect()
    assert abs({r.variation: r["count"] for r in m}["b"] / 40000 - 0.75) < 0.015


def plain_session_scores(rows, k):
    """By lists: the rows of one depth and attribute are one list."""
    given, before = {}, (None, None)
    for (depth, _), part in itertools.groupby(rows, lambda r: r[:2]):
        part = list(part)
        new = depth != before[0]
        out = not new and (before[1]["out"] or len(given) >= k)
        ceiling = 1.0 if new else before[1]["low"]
        low = 1.0
        for place, (_, _, item, count) in enumerate(part):
            if out or (place and len(given) >= k):
                break
            low = count / part[0][3] * ceiling
            given[item] = given.get(item, 0.0) + low
        before = depth, {"out": out, "low": low}
    return given


def test_session_popularity(spark):
    def scores(rows, k):
        df = spark.createDataFrame([([(d, a, i, item, n) for i, (d, a, item, n) in enumerate(rows)],)], "r array<struct<rank:int,a:int,pos:int,item_id:bigint,count:double>>")
        out = {}
        for g in df.select(scoring.session_scores(F.col("r"), k).alias("g")).first().g:
            out[g.item_id] = out.get(g.item_id, 0.0) + g.score
        return {i: round(v, 9) for i, v in out.items()}

    assert scores([(1, 0, 22, 10.0), (1, 0, 21, 9.0), (1, 0, 20, 8.0)], 2) == {22: 1.0, 21: 0.9}
    # second attribute starts below the last score of the first; the next depth starts afresh
    got = scores([(1, 0, 1, 10.0), (1, 0, 2, 5.0), (1, 1, 3, 4.0), (1, 1, 1, 2.0), (2, 0, 4, 8.0)], 10)
    assert got == {1: 1.25, 2: 0.5, 3: 0.5, 4: 1.0}
    rng = np.random.default_rng(4)
    for k in (1, 3, 5, 8):
        rows = [(int(d), int(a), int(rng.integers(0, 12)), float(n)) for d in range(1, 4) for a in range(rng.integers(1, 4)) for n in sorted(rng.integers(1, 50, rng.integers(1, 7)))[::-1]]
        assert scores(rows, k) == {i: round(v, 9) for i, v in plain_session_scores(rows, k).items()}
    recent = spark.createDataFrame([(1, 1, 1)], "user_id long, item_id long, rank int")
    attrs = spark.createDataFrame([(i, "attr1", 1) for i in (1, 20, 21, 22)], "item_id long, attr string, dim int")
    lists = spark.createDataFrame([(1, 22, 10.0), (1, 21, 9.0), (1, 20, 8.0)], "dim int, item_id long, count double")
    out = scoring.rec_popular_session(recent, attrs, lists, ["attr1"], 1, 2).collect()
    assert {r.item_id: round(r.score, 6) for r in out} == {22: 1.0, 21: 0.9}


def test_recent_interactions(spark):
    a = spark.createDataFrame([(1, i, i, i) for i in range(5)], "user_id long, item_id long, event_id long, t long").withColumn("ts", F.timestamp_seconds("t"))
    out = ses.recent_interactions(a, 4).orderBy(F.desc("score")).collect()
    assert [(r.item_id, r.score) for r in out] == [(4, 1.0), (3, 0.75), (2, 0.5), (1, 0.25)]


def test_cluster_recs_exclusions_and_scale(spark):
    m = spark.createDataFrame([(1, 7), (2, 8)], "user_id long, cluster_id int")
    lists = spark.createDataFrame([(7, 1, 4.0), (7, 2, 2.0), (7, 3, 1.0)], "cluster_id int, item_id long, score double")
    seen = spark.createDataFrame([(1, 1)], "user_id long, item_id long")
    assert {r.item_id: r.score for r in scoring.rec_mf_cluster(m, lists, 5, seen).collect()} == {2: 1.0, 3: 0.5}


def test_topic_ranking(spark):
    tags = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "a")], "item_id long, tag string")
    topics = spark.createDataFrame([("a", 0, 1.0), ("b", 1, 1.0), ("c", 1, 3.0)], "tag string, topic int, weight double")
    mix = scoring.item_topics(tags, topics, 2, 2)
    assert {r.item_id: r.features for r in mix.collect()} == {1: [0.5, 0.5], 2: [0.0, 1.0]}
    users = spark.createDataFrame([(9, [0.2, 0.8])], "user_id long, features array<double>")
    none = spark.createDataFrame([], "user_id long, item_id long")
    out = {r.item_id: round(r.score, 6) for r in scoring.rec_topics(users, mix, none, 5).collect()}
    assert out == {2: 1.0, 1: 0.625}


def test_decayed_count_equals_recurrence(spark):
    times = [0, 50, 50, 300, 900]
    df = spark.createDataFrame([(1, t) for t in times], "k int, t long").withColumn("ts", F.timestamp_seconds("t"))
    got = counters.decayed_counts(df, ["k"], 200.0, F.timestamp_seconds(F.lit(1000))).first()["count"]
    c, at = 0.0, 0
    for t in times:
        c, at = 1 + math.exp(-(t - at) / 200) * c, t
    assert math.isclose(got, c * math.exp(-(1000 - at) / 200), rel_tol=1e-12)


def test_basket_semantics(spark):
    # (item, kind, second): the gap before the remove does not split, the one before the last add does
    ev = [(1, 1, 0), (2, 1, 10), (2, 2, 5000), (3, 1, 5010), (4, 1, 20000)]
    df = spark.createDataFrame([(1, i, k, t) for i, k, t in ev], "user_id long, item_id long, kind int, t long").withColumn("ts", F.timestamp_seconds("t"))
    out = ses.baskets(df, 1, 1000, 1, 100, ["ts", "item_id"]).orderBy("session").collect()
    assert [r["items"] for r in out] == [[1, 3], [4]]


def test_engagement_drops(spark):
    rows = [("c", 1, "baseline", t) for t in (0, 5, 2000)] + [("c", 2, "baseline", 0), ("c", 2, "normal", 9)] + [("c", 3, "normal", t) for t in range(60)]
    rows += [("c", 3, "normal", 9000)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "client string, user_id long, variation string, t long, event_id long").withColumn("ts", F.timestamp_seconds("t"))
    out = {(r.user_id, r.session): (r.seconds, r.page_views, r.user_count) for r in agg.engagement_sessions(df, 600, 50).collect()}
    assert out == {(1, 1): (5, 2, 1), (1, 2): (1, 1, 0), (3, 2): (1, 1, 1)}


def test_rules_and_assoc(spark):
    baskets = spark.createDataFrame([([1, 2],), ([1, 2, 3],), ([1],), ([2, 3],)], "items array<long>")
    r = {(tuple(x.antecedent), x.item): x for x in rules.assoc_rules(baskets, 0.2, min_confidence=0.0, min_interest=-1.0).collect()}
    x = r[((3,), 2)]
    assert x.confidence == 1.0 and x.interest == 0.25 and math.isclose(x.lift, 4 / 3)
    found = rules.assoc_rules(baskets, 0.2, min_confidence=0.0, min_interest=-1.0)
    users = spark.createDataFrame([(1, [3]), (2, [1, 3]), (3, [1, 2, 3, 4, 5])], "user_id long, items array<long>")
    out = {(y.user_id, y.item_id): y.score for y in rules.rec_assoc(users, found, 5).collect()}
    assert out[(1, 2)] == 1.0 and (3, 2) not in out and (2, 2) in out


def test_short_paths(spark):
    v = spark.createDataFrame([(i, 1) for i in range(7)] + [(9, 50)], "id long, triangles int")
    e = spark.createDataFrame([(0, 1, 0.9), (1, 2, 0.9), (2, 3, 0.9), (3, 4, 0.9), (4, 5, 0.9), (0, 3, 0.2), (0, 9, 0.9), (9, 4, 0.99)], "src long, dst long, weight double")
    src = spark.createDataFrame([(0,)], "id long")
    out = {r.id: round(r.cost, 6) for r in graph.short_paths(v, e, src, v.select("id"), max_triangles=10).collect()}
    # the way of five cheap hops to 5 is too long, the one over 0-3-4 is not
    assert out == {0: 0.0, 1: 0.1, 2: 0.2, 3: 0.3, 4: 0.4, 5: 1.0}
    full = {r.id: round(r.cost, 6) for r in graph.short_paths(v, e, src, hops=2, limit_cost=0.85).collect()}
    assert full == {0: 0.0, 1: 0.1, 2: 0.2, 3: 0.8, 4: 0.11, 9: 0.1}


def test_tag_recommendation(spark):
    docs = [(1, "a"), (1, "b"), (2, "a"), (2, "b"), (2, "c"), (3, "c"), (3, "d")]
    df = spark.createDataFrame(docs, "doc_id long, tag string")
    near = {(r.tag, r.other): r.score for r in text.tag_knn(df, 3, "jaccard", max_share=1.0).collect()}
    assert near[("a", "b")] == 1.0 and math.isclose(near[("a", "c")], 1 / 3) and ("a", "d") not in near
    q = spark.createDataFrame([(1, "a"), (1, "b")], "query_id long, tag string")
    out = {r.other: round(r.score, 6) for r in text.tag_recommend(q, df, 5, metric="jaccard", max_share=1.0).collect()}
    assert out == {"c": 0.666667}


def test_document_neighbours(spark):
    rows = [(1, "cars and more cars on a road"), (2, "cars on the road"), (3, "a cake with sugar"), (4, "sugar cake and sugar")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for method in ("lsi", "rp"):
        v = text.doc_vectors(df, method, 3 if method == "lsi" else 64, vocab_size=50, min_df=1)
        near = {r.doc_id: r.other for r in text.doc_neighbours(v, 1).collect()}
        assert near[1] == 2 and near[4] == 3


def plain_murmur(data, seed):
    h, mask = seed & 0xFFFFFFFF, 0xFFFFFFFF
    for i in range(0, len(data), 4):
        k = int.from_bytes(data[i : i + 4], "little") * 0xCC9E2D51 & mask
        h ^= (k << 15 | k >> 17) * 0x1B873593 & mask
        if i + 4 <= len(data):
            h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - 2**32 if h >> 31 else h


def test_murmur(spark):
    assert plain_murmur(b"", 0) == 0 and plain_murmur(b"hello", 0) == 613153351
    rng = np.random.default_rng(1)
    signs = list("ab cd|ßé日本𝄞\n\x00\x80\xff0")
    texts = [("".join(rng.choice(signs, n)), int(seed)) for n in range(14) for seed in (0, 1, -1, -(2**31), 613153351, 2**31 - 1) for _ in range(4)]
    got = spark.createDataFrame(texts, "t string, s int").select("t", "s", hashing.murmur3(F.col("t"), F.col("s")).alias("h")).collect()
    assert [r.h for r in got] == [plain_murmur(r.t.encode(), r.s) for r in got]
    assert spark.createDataFrame([(None, 1)], "t string, s int").select(hashing.murmur3(F.col("t"), F.col("s")).alias("h")).first().h is None


def test_rules_in_baskets_of_any_size(spark):
    rng = np.random.default_rng(2)
    baskets = [(u, [int(i) for i in rng.choice(80, n, replace=False)]) for u, n in enumerate([0, 1, 3, 5, 20, 50, 50, 70])]
    found = {(tuple(sorted(map(int, rng.choice(80, int(n), replace=False)))), int(i)) for n, i in zip(rng.integers(1, 6, 400), rng.integers(0, 80, 400))}
    found = [([*a], i, float(rng.random()), float(rng.random() + 1)) for a, i in sorted(found) if i not in a]
    want = {}
    for u, items in baskets:
        for a, i, c, lift in found:
            if set(a) <= set(items) and i not in items:
                want[u, i] = want.get((u, i), 0) + c * lift * len(a)
    users = spark.createDataFrame(baskets, "user_id long, items array<long>")
    out = rules.rec_assoc(users, spark.createDataFrame(found, "antecedent array<long>, item long, confidence double, lift double"), 1000)
    best = {u: max(v for (w, _), v in want.items() if w == u) for u, _ in want}
    assert {(r.user_id, r.item_id): round(r.score, 9) for r in out.collect()} == {k: round(v / best[k[0]], 9) for k, v in want.items()} and len({u for u, _ in want}) >= 4


def test_prime_hash_and_feature_hash(spark):
    big = 2**31 - 5
    got = spark.range(1).select(hashing.prime_hash(F.lit(big), big, 77).alias("h")).first().h
    assert got == (big * big + 77) % hashing.PRIME
    f = spark.createDataFrame([("", "12"), ("i", "x")], "n string, f string").select(hashing.feature_hash("n", "f", F.lit(2), 18, 3).alias("h"))
    assert f.first().h == (12 * 4 + 1) & (2**18 - 1)


def test_resolve_and_register(spark):
    a = spark.createDataFrame([("c", "x", 5, 2), ("c", "x", 0, 3), ("c", "y", 0, 2), ("d", "x", 0, 2)], "client string, client_user_id string, user_id long, action_type int")
    assert sorted(r.user_id for r in ingest.resolve_users(a).collect()) == [5, 5]
    rep = {r.client: (r.resolved, r.dropped) for r in ingest.resolve_report(a).collect()}
    assert rep == {"c": (1, 1), "d": (0, 1)}


def test_vector_sort_order(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0])], "item_id long, features array<double>")
    recent = spark.createDataFrame([(7, 1, 1)], "user_id long, item_id long, rank int")
    lists = spark.createDataFrame([(7, i, p) for p, i in enumerate([8, 1, 3, 2])], "user_id long, item_id long, pos int")
    out = vec.ranked_lists(vec.vector_sort(lists, recent, v)).orderBy("rank").collect()
    assert [r.item_id for r in out] == [2, 3, 1, 8]


def test_anomaly_scores_outlier_highest(spark):
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(80)] + [(999, [500.0, 500.0])]
    df = spark.createDataFrame(rows, "id long, x array<double>")
    m = models.fit_inne(df.where("id < 900"), "x", 20, 16)
    out = {r.id: r.score for r in models.score_inne(df, "id", "x", m).collect()}
    assert out[999] == 1.0 and max(s for i, s in out.items() if i != 999) < 1.0


def test_als_beats_the_mean(spark, sf):
    from tidewell.plans import fixtures as fx

    r = spark.createDataFrame([(u, i, float(1 + (u % 3 == i % 3) * 4)) for u in range(30) for i in range(20) if (u * i) % 4], "user_id int, item_id int, rating double")
    m = models.fit_als(r, rank=4, iterations=8)
    p = m.transform(r).select(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2)).alias("e"), F.var_pop("rating").alias("v")).first()
    assert p.e < p.v / 4
    assert fx.actions(spark, sf).count() > 0


def test_publish_swaps_versions(spark):
    root = scratch_path(spark, "pub")
    one = spark.createDataFrame([(1, 1.0)], "item_id long, score double")
    pins = spark.createDataFrame([(1, 9.0), (5, 9.0)], "item_id long, score double")
    writers.publish(one.withColumn("score", F.lit(0.0)), root)
    writers.publish(one, root, pins)
    assert {(r.item_id, r.score) for r in writers.read_published(spark, root).collect()} == {(1, 1.0), (5, 9.0)}


def test_bad_log_lines(spark):
    lines = spark.createDataFrame([('t\tx\t{"a": 1}',), ("t\tx\t{broken",), ('t\ty\t{"a": 2}',)], "value string")
    assert [r.a for r in readers.parse_log(lines, "x", "a int").collect()] == [1]
    assert readers.bad_lines(lines, "x", "a int").count() == 1


def test_user_hooks(spark):
    scoring.register_recommender("echo", lambda frame: frame)
    assert "echo" in scoring.RECOMMENDERS
    out = ft.predict_udf(spark.range(3), lambda pdf: pd.DataFrame({"id": pdf["id"], "y": pdf["id"] * 2}), "id long, y long")
    assert sum(r.y for r in out.collect()) == 6


def test_many_values_are_numbered_by_count_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(skew, "PIECE_ROWS", 40)
    rng = np.random.default_rng(5)
    values = [f"v{int(v):03d}" for v in rng.zipf(1.3, 3000) % 300]
    df = spark.createDataFrame([(v,) for v in values], "a string")
    got = {r.a: r.id for r in ft.FeatureIds("a", "id").fit_transform(df).distinct().collect()}
    want = sorted(set(values), key=lambda v: (-values.count(v), v))
    assert got == {v: i for i, v in enumerate(want, 1)} and len(want) > 100
    with pytest.raises(ValueError):
        ft.Binarise("a", 50).fit(df)


def test_auc_over_pieces(spark):
    rng = np.random.default_rng(6)
    rows = [(int(f), int(y), float(round(rng.random() + 0.3 * y, 2))) for f, y in zip(rng.integers(0, 2, 600), rng.integers(0, 2, 600))]
    df = spark.createDataFrame(rows, "fold int, y int, p double")
    for size in (None, 15):
        got = {r.fold: r.score for r in ft.auc(df, "fold", "y", "p", size).collect()}
        for fold in (0, 1):
            pos, neg = ([p for f, y, p in rows if f == fold and y == label] for label in (1, 0))
            assert math.isclose(got[fold], sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg))


def test_documents_without_a_token_have_vectors(spark):
    df = spark.createDataFrame([(1, "red apple"), (2, "..."), (3, "red pear pear"), (4, None)], "doc_id long, text string")
    for method, empty in (("rp", 0.0), ("lda", 0.25), ("nmf", 0.0)):
        got = {r.doc_id: r.features for r in text.doc_vectors(df, method, 4).collect()}
        assert sorted(got) == [1, 2, 3, 4] and got[2] == got[4] == [empty] * 4 and (method != "lda" or math.isclose(sum(got[3]), 1, abs_tol=1e-9))

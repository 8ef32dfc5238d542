"""Skew-proof building blocks against brute force, with one group holding a large share of the rows."""

import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tidewell.operators import graph, nearest as nn, scoring, skew
from tidewell.operators.topk import global_rank, topk_by


def members(seed=1, groups=60, items=40, hot=3):
    rng = np.random.default_rng(seed)
    rows = {(g, int(i)) for g in range(groups) for i in rng.choice(items, rng.integers(1, 5), replace=False)}
    for h in range(hot):
        rows |= {(1000 + h, int(i)) for i in rng.choice(items, items - 8 * h - 4, replace=False)}
    return sorted(rows)


def brute(rows, k, score, upper=False, tie=lambda n, b: b):
    by_item = {}
    for g, i in rows:
        by_item.setdefault(i, set()).add(g)
    out = {}
    for a, ga in by_item.items():
        found = [(-score(len(ga & gb), len(ga), len(gb)), b) for b, gb in by_item.items() if b != a and ga & gb and (not upper or b > a)]
        for s, b in sorted(found)[:k]:
            out[(a, b)] = round(-s, 9)
    return out


def best(spark, rows, k, expr, **kw):
    df = spark.createDataFrame(rows, "grp long, item long")
    c = skew.cooccurrence_candidates(df, k, **kw).withColumn("score", expr)
    return {(r.item_a, r.item_b): round(r.score, 9) for r in topk_by(c, "item_a", k, tie="item_b").collect()}


def cos():
    return F.col("shared") / F.sqrt((F.col("n_a") * F.col("n_b")).cast("double"))


def test_cosine_with_hot_groups_is_exact(spark):
    for seed in (1, 2):
        rows = members(seed)
        want = brute(rows, 4, lambda s, a, b: s / math.sqrt(a * b))
        assert best(spark, rows, 4, cos(), hot_size=10) == want
        assert best(spark, rows, 4, cos(), hot_size=10**6, salt_size=3) == want


def test_items_met_in_hot_groups_only(spark):
    rows = [(0, i) for i in range(30)] + [(1, i) for i in range(10, 40)] + [(2, 5), (2, 35)]
    want = brute(rows, 3, lambda s, a, b: s / math.sqrt(a * b))
    assert best(spark, rows, 3, cos(), hot_size=10) == want


def test_twenty_hot_groups_without_any_pair_of_theirs(spark, monkeypatch):
    """All groups of more than ten members are hot; none of them reaches the join that lists pairs."""
    rng = np.random.default_rng(11)
    rows = {(g, int(i)) for g in range(80) for i in rng.choice(90, rng.integers(1, 4), replace=False)}
    for h in range(20):
        rows |= {(1000 + h, int(i)) for i in rng.choice(90, int(rng.integers(15, 80)), replace=False)}
    rows, listed, real = sorted(rows), [], skew._shared_light
    monkeypatch.setattr(skew, "_shared_light", lambda light, salt: listed.append(light) or real(light, salt))
    for name, value in (("BLOCK_CLASSES", 16), ("BLOCK_ITEMS", 24), ("ROUND_BITS", 7)):
        monkeypatch.setattr(skew, name, value)
    for upper in (False, True):
        assert best(spark, rows, 3, cos(), hot_size=10, upper=upper) == brute(rows, 3, lambda s, a, b: s / math.sqrt(a * b), upper=upper)
    assert best(spark, rows, 3, F.col("shared").cast("double"), hot_size=10, tie="id") == brute(rows, 3, lambda s, a, b: s)
    assert all(light.where("grp >= 1000").count() == 0 and light.count() > 0 for light in listed)


def test_upper_lists_with_hot_groups(spark):
    rows = members(3)
    want = brute(rows, 4, lambda s, a, b: s / math.sqrt(a * b), upper=True)
    assert best(spark, rows, 4, cos(), hot_size=10, upper=True) == want


def test_count_score_with_hot_groups(spark):
    rows = members(4)
    want = brute(rows, 5, lambda s, a, b: s)
    assert best(spark, rows, 5, F.col("shared").cast("double"), hot_size=10, tie="id") == want


def test_split_score_with_hot_groups(spark):
    rows = members(5)
    both = lambda s, a, b: s / (a + b - s) + (s / b if b >= 9 else 0.0)
    expr = F.col("shared") / (F.col("n_a") + F.col("n_b") - F.col("shared")) + F.when(F.col("n_b") >= 9, F.col("shared") / F.col("n_b")).otherwise(0.0)
    assert best(spark, rows, 3, expr, hot_size=10, split_at=9) == brute(rows, 3, both)


def test_only_partners_that_may_be_best_leave_their_task(spark, monkeypatch):
    """Small groups: no pair is shuffled as a row, whatever the size of the chunks, of the buffer and of an item."""
    rows, passed, real = members(8), [], skew._shared_light
    monkeypatch.setattr(skew, "_shared_light", lambda light, how: passed.append(real(light, how)) or passed[-1])
    want = {u: brute(rows, 2, lambda s, a, b: s / math.sqrt(a * b), upper=u) for u in (False, True)}
    pairs = len(brute(rows, 10**6, lambda s, a, b: s))
    for item_groups, counted, salt in ((10**6, 50, 256), (3, 10**6, 5), (10**6, 10**6, 256)):
        monkeypatch.setattr(skew, "ITEM_GROUPS", item_groups)
        monkeypatch.setattr(skew, "COUNTED", counted)
        for upper in (False, True):
            assert best(spark, rows, 2, cos(), hot_size=10**6, salt_size=salt, upper=upper) == want[upper]
    assert passed[-2].count() < pairs / 2 and passed[0].count() == passed[-2].count()


def test_many_groups_hardly_larger_than_the_hot_size_are_listed(spark):
    """Bit sets of 300 groups that share no item would be compared 300 times 3,600 times 3,600."""
    rows = [(g, 12 * g + i) for g in range(300) for i in range(12)] + [(1000, i) for i in range(400)]
    df = spark.createDataFrame(rows, "grp long, item long")
    hot = {r.grp for r in skew._hot_groups(df, 10).collect()}
    assert 1000 in hot and len(hot) < 100


def test_shared_counts_salted(spark):
    rows = members(6)
    df = spark.createDataFrame(rows, "grp long, item long")
    got = {(r.item_a, r.item_b): r.shared for r in skew.shared_counts(df, salt_size=4).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        for a, b in combinations(sorted(i for x, i in rows if x == g), 2):
            want[(a, b)] = want.get((a, b), 0) + 1
    assert got == want


def test_sessionise_across_buckets(spark):
    rng = np.random.default_rng(0)
    rows = []
    for u in (1, 2):
        t = 0
        for i in range(300 if u == 1 else 20):
            t += int(rng.choice([30, 3000, 40000]))
            rows.append((u, i, t, bool(rng.integers(0, 2))))
    pdf = pd.DataFrame(rows, columns=["u", "i", "t", "f"])
    df = spark.createDataFrame(pdf).withColumn("ts", F.timestamp_seconds("t"))
    for flagged in (False, True):
        d = skew.sessionise(df, ["u"], "ts", ["ts", "i"], 2000, starts=F.col("f") if flagged else None, piece_rows=25)
        got = {(r.u, r.i): (r.session, r.is_break) for r in d.collect()}
        for u, g in pdf.groupby("u"):
            session, prev = 1, None
            for r in g.itertuples():
                brk = prev is None or (r.t - prev > 2000 and (r.f or not flagged))
                session += brk and prev is not None
                assert got[(u, r.i)] == (session, brk)
                prev = r.t
    for rows in (None, 25):
        assert {r.session for r in skew.sessionise(df, ["u"], "ts", ["ts", "i"], -1, piece_rows=rows).collect()} == {1}


def test_one_user_with_a_third_of_all_rows_in_one_day(spark):
    """The user's rows stay spread over pieces of bounded size; sessions, baskets and previous rows are those of plain Python."""
    rng = np.random.default_rng(6)
    hot = [(1, int(t)) for t in rng.integers(0, 86_400, 3000)]  # many equal times
    rest = [(int(u), int(t)) for u, t in zip(rng.integers(2, 400, 6000), rng.integers(0, 30 * 86_400, 6000))]
    pdf = pd.DataFrame(hot + rest, columns=["user_id", "t"]).assign(event_id=range(9000), item_id=rng.integers(0, 50, 9000), kind=rng.integers(0, 2, 9000))
    df = spark.createDataFrame(pdf).withColumn("ts", F.timestamp_seconds("t"))
    pieces = skew.with_pieces(df, ["user_id"], ["ts", "event_id"], "b", 200)
    sizes = {(r.user_id, r.b): r["count"] for r in pieces.groupBy("user_id", "b").count().collect()}
    assert sum(sizes.values()) == 9000 and max(sizes.values()) <= 500 and sum(u == 1 for u, _ in sizes) >= 12
    got = {r.event_id: (r.session, r.is_break) for r in skew.sessionise(df, ["user_id"], "ts", ["ts", "event_id"], 60, starts=F.col("kind") == 1, piece_rows=200).collect()}
    before = {r.event_id: r.prev and r.prev.event_id for r in skew.previous_row(df, ["user_id"], ["ts", "event_id"], ["event_id"], piece_rows=200).collect()}
    for _, g in pdf.sort_values(["t", "event_id"]).groupby("user_id"):
        session, prev = 1, None
        for r in g.itertuples():
            cut = prev is None or (r.t - prev.t > 60 and r.kind == 1)
            session += cut and prev is not None
            assert got[r.event_id] == (session, cut) and before[r.event_id] == (prev and prev.event_id)
            prev = r


def test_previous_row(spark):
    df = spark.range(200).select((F.col("id") % 2).alias("u"), "id", F.timestamp_seconds(F.col("id") * 5000).alias("ts"))
    for rows in (None, 7):
        d = skew.previous_row(df, ["u"], ["ts"], ["id"], piece_rows=rows)
        assert all((r.prev.id if r.prev else None) == (r.id - 2 if r.id > 1 else None) for r in d.collect())


def test_exact_quantiles(spark):
    rng = np.random.default_rng(5)
    a = np.concatenate([rng.exponential(3, 500), np.full(300, 1.0)])
    b = rng.integers(0, 5, 40).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"k": ["a"] * len(a) + ["b"] * len(b), "v": np.concatenate([a, b])}))
    probs = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {(r.k, r.p): r.value for r in skew.exact_quantiles(df, ["k"], "v", probs, buckets=16).collect()}
    for k, x in (("a", a), ("b", b)):
        for p in probs:
            assert math.isclose(got[(k, p)], np.quantile(x, p), rel_tol=1e-12, abs_tol=1e-12)
    one = skew.exact_quantiles(spark.createDataFrame([(float(i),) for i in (15, 20, 35, 40, 50)], "v double"), [], "v", [0.4, 0.05, 0.95], rule="np1")
    assert {r.p: round(r.value, 6) for r in one.collect()} == {0.4: 26.0, 0.05: 15.0, 0.95: 50.0}


def test_dense_ids_and_global_rank(spark):
    df = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 7).cast("double").alias("score"), F.col("id").alias("item_id"))
    ids = sorted(r.n for r in skew.dense_ids(df, "k", "n", slots=16).collect())
    assert ids == list(range(1, 501))
    got = {r.item_id: r["rank"] for r in global_rank(df, buckets=5).collect()}
    want = sorted(range(500), key=lambda i: (-(i % 7), i))
    assert [got[i] for i in want] == list(range(1, 501))


def test_nearest_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((150, 6)) + 3 * rng.standard_normal((5, 6))[rng.integers(0, 5, 150)]
    x[7] = 0
    x[20] = x[21]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "item_id long, features array<double>")
    q = df.withColumnRenamed("item_id", "query_id")
    n = np.linalg.norm(x, axis=1, keepdims=True)
    u = x / np.where(n == 0, 1, n)
    for metric, s in (("cosine", u @ u.T), ("dot", x @ x.T)):
        for cells in (8, None):
            monkeypatch.setattr(nn, "BLOCK", 10 if cells else 2048)
            got = {}
            for r in nn.nearest(q, df, 5, metric, exclude_same=True, cells=cells).collect():
                got.setdefault(r.query_id, []).append((-round(r.score, 8), r.item_id))
            for i in range(150):
                want = sorted((-round(float(s[i, j]), 8), j) for j in range(150) if j != i)[:5]
                have = sorted(got[i])
                assert [w[0] for w in want] == [h[0] for h in have]
                assert [w[1] for w in want] == [h[1] for h in have] or metric == "dot" or i == 7


def _brute_nearest(x, k):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    return {i: sorted((-round(float(s[i, j]), 9), j) for j in range(len(x)) if j != i)[:k] for i in range(len(x))}


def _found(rows):
    got = {}
    for r in rows.collect():
        got.setdefault(r.query_id, []).append((-round(r.score, 9), r.item_id))
    return {q: sorted(x) for q, x in got.items()}


def test_nearest_visits_few_cells_of_clustered_vectors(spark, monkeypatch):
    """Below a fifth of all pairs are compared, and a query stands in one block only."""
    rng = np.random.default_rng(7)
    x = (4 * rng.standard_normal((40, 12)))[rng.integers(0, 40, 2000)] + 0.3 * rng.standard_normal((2000, 12))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "item_id long, features array<double>")
    searches, real = [], nn._search
    monkeypatch.setattr(nn, "_search", lambda asked, *rest: searches.append((asked, rest[-1])) or real(asked, *rest))
    assert _found(nn.nearest(df.withColumnRenamed("item_id", "query_id"), df, 4, exclude_same=True)) == _brute_nearest(x, 4)
    met = 0
    for asked, sizes in searches:
        rows = asked.select("query_id", "cells").collect()
        assert len({r.query_id for r in rows}) == len(rows)
        met += sum(sizes.get(c, 0) for r in rows for c in r.cells)
    assert met < 0.2 * len(x) ** 2 and len(searches[0][1]) >= 30


def test_nearest_with_a_third_of_equal_vectors(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 8))
    x[::3] = x[0]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "item_id long, features array<double>").repartition(3)
    assert _found(nn.nearest(df.withColumnRenamed("item_id", "query_id"), df, 5, exclude_same=True)) == _brute_nearest(x, 5)


def test_needs_of_single_queries_and_zero_queries(spark):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((120, 5))
    df = spark.createDataFrame([(f"v{i:03d}", [float(v) for v in r]) for i, r in enumerate(x)], "item_id string, features array<double>")
    asked = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0, 0.0], 3), (2, [0.0] * 5, 4), (3, [0.0, 1.0, 0.0, 1.0, 0.0], 500)], "query_id int, features array<double>, need int")
    got = {}
    for r in nn.nearest(asked, df, 1).collect():
        got.setdefault(r.query_id, set()).add(r.item_id)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    assert {f"v{i:03d}" for i in np.argsort(-u[:, 0])[:3]} <= got[1] and got[2] == {"v000", "v001", "v002", "v003"} and len(got[3]) == 120


def test_approx_is_the_best_of_common_buckets_without_a_list_of_pairs(spark, monkeypatch):
    from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(12)
    x = rng.standard_normal((90, 5))
    x[::9] = x[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "item_id long, features array<double>")
    v = df.select(array_to_vector("features").alias("v"))
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=0.3, numHashTables=3, seed=42).fit(v)
    h = [[d[0] for d in r.h] for r in model.transform(df.select("item_id", array_to_vector("features").alias("v"))).orderBy("item_id").collect()]
    want = {}
    for i in range(90):
        near = [(-round(float(x[i] @ x[j]), 9), j) for j in range(90) if j != i and any(a == b for a, b in zip(h[i], h[j])) and np.linalg.norm(x[i] - x[j]) < 1.1]
        if near:
            want[i] = sorted(near)[:4]
    monkeypatch.setattr(BucketedRandomProjectionLSHModel, "approxSimilarityJoin", None)
    for block in (2048, 16):
        monkeypatch.setattr(nn, "BLOCK", block)
        twice = df.unionByName(df.where("item_id % 4 = 0"))  # a row given twice counts once
        assert _found(nn.nearest_approx(twice.withColumnRenamed("item_id", "query_id"), twice, 4, 1.1, bucket=0.3, tables=3)) == want


def test_search_holds_few_rows_at_once(spark, monkeypatch):
    """Rows of codes and products with the centres are cut; queries of neighbouring cells share a block."""
    assert [len(p) for p in nn._slices([pd.DataFrame({"a": range(2 * nn.ROWS + 5)})])] == [nn.ROWS, nn.ROWS, 5]
    centres = np.arange(40.0).reshape(-1, 1)[::-1]
    group = nn._together(centres, {c: 10 for c in range(40)}, 100)
    assert sorted(np.bincount(group).tolist()) == [10] * 4 and all(np.ptp(np.flatnonzero(group == g)) == 9 for g in range(4))


def test_triangles_with_hub(spark):
    rng = np.random.default_rng(3)
    e = {(0, i) for i in range(1, 60)} | {tuple(sorted(map(int, rng.choice(60, 2, replace=False)))) for _ in range(200)}
    df = spark.createDataFrame([(b, a) if (a + b) % 2 else (a, b) for a, b in e], "src long, dst long")
    near = {}
    for a, b in e:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    want = {(a, b): len(near[a] & near[b]) for a, b in e if near[a] & near[b]}
    assert {(r.src, r.dst): r.triangles for r in graph.edge_triangles(df).collect()} == want


def test_user_similarity_with_hot_item(spark):
    rng = np.random.default_rng(4)
    rows = [(u, 99, float(rng.integers(1, 6))) for u in range(40)]
    rows += [(u, int(i), float(rng.integers(1, 6))) for u in range(40) for i in rng.choice(12, 4, replace=False)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    pick = lambda d: {(r.user_a, r.user_b): round(r.sim, 9) for r in d.collect()}
    whole = pick(scoring.user_similarity(df, -2.0, hot_size=10**6))
    assert whole and pick(scoring.user_similarity(df, -2.0, hot_size=20, salt_size=5)) == whole
    by = {}
    for u, i, r in rows:
        by.setdefault(u, {})[i] = r
    for (a, b), s in whole.items():
        common = sorted(set(by[a]) & set(by[b]))
        assert math.isclose(s, np.corrcoef([by[a][c] for c in common], [by[b][c] for c in common])[0, 1], abs_tol=1e-8)


def _plain_user_based(rows, k, threshold=0.1):
    by = {}
    for u, i, r in rows:
        by.setdefault(u, {})[i] = r
    out = {}
    for a, mine in by.items():
        num, den = {}, {}
        for b, theirs in by.items():
            common = sorted(set(mine) & set(theirs))
            x, y = [mine[c] for c in common], [theirs[c] for c in common]
            if a == b or len(common) < 2 or len(set(x)) < 2 or len(set(y)) < 2:
                continue
            sim = np.corrcoef(x, y)[0, 1]
            if sim > threshold:
                for i, r in theirs.items():
                    if i not in mine:
                        num[i], den[i] = num.get(i, 0) + sim * r, den.get(i, 0) + sim
        for i in sorted(num, key=lambda i: (-round(num[i] / den[i], 9), i))[:k]:
            out[a, i] = round(num[i] / den[i], 7)
    return out


def test_user_based_with_five_items_rated_by_everybody(spark, monkeypatch):
    """Only items below the limit are expanded into pairs of users; the result is that of plain Python."""
    rng = np.random.default_rng(14)
    rows = [(u, 100 + h, float(rng.integers(1, 5))) for u in range(60) for h in range(5) if h < 4 or u % 7]
    rows += [(u, int(i), float(rng.integers(1, 6))) for u in range(60) for i in rng.choice(40, int(rng.integers(0, 5)), replace=False)]
    rows += [(u, int(i), float(rng.integers(1, 6))) for u in range(60, 66) for i in rng.choice(40, 4, replace=False)]  # none of the five
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    listed, real = [], scoring._common_sums
    monkeypatch.setattr(scoring, "_common_sums", lambda light, salt: listed.append(light) or real(light, salt))
    monkeypatch.setattr(scoring, "BLOCK_CLASSES", 16)
    got = {(r.user_id, r.item_id): round(r.score, 7) for r in scoring.rec_user_based(df, 4, hot_size=20).collect()}
    assert got == _plain_user_based(rows, 4) and len(got) > 200
    assert len(listed) == 1 and listed[0].where("item_id >= 100").count() == 0


def test_search_returns_no_more_copies_than_a_query_needs(spark):
    """Many rows are one vector: a query gets the members it can need, by id, and not all copies of all its heads."""
    rows = [(i, [1.0, float(i % 4)]) for i in range(400)]
    items = spark.createDataFrame(rows, "item_id long, features array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0], 3), (1, [0.0, 1.0], 120)], "query_id long, features array<double>, need int")
    got = {}
    for r in nn.nearest(q, items, 3).collect():
        got.setdefault(r.query_id, []).append(r.item_id)
    assert sorted(got[0]) == [0, 4, 8]  # of 100 copies
    want = sorted(range(400), key=lambda i: (-(i % 4) / (1 + (i % 4) ** 2) ** 0.5, i))[:120]
    assert set(want) <= set(got[1]) and len(got[1]) < 200
    twice = nn.nearest(q, items.union(items), 3).where("query_id = 0").distinct().count()
    assert twice >= 3


def test_cells_to_visit_are_bit_sets(spark):
    """A query may visit every cell; its row stays small."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(300, 3))
    q = spark.createDataFrame([(i, rng.normal(size=3).tolist(), 3, 1e9) for i in range(5)], "query_id long, vec array<double>, need long, reach double")
    sizes = np.ones(300, dtype=np.int64)
    rows = nn._visits(q, centres, np.zeros(300), sizes, second=True).collect()
    assert [len(r.cells) for r in rows] == [5] * 5
    for r in rows:
        flags = [c for c in range(300) if r.cells[c >> 6] >> (c & 63) & 1]
        away = np.linalg.norm(centres - np.array(r.vec), axis=1)
        assert flags == sorted(set(range(300)) - set(np.argsort(away)[:3].tolist()))

"""Fitted models on made data with a known answer: each must find it within a stated threshold."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.operators import features as ft, models, nearest as nn, scoring, text


def taste(user, item):
    """Three groups of users and items; a user likes the items of the own group."""
    return user % 3 == item % 3


@pytest.fixture(scope="module")
def clicks(spark):
    rows = [(u, i, 5.0) for u in range(60) for i in range(30) if taste(u, i) and (u + i) % 4]
    return spark.createDataFrame(rows, "user_id int, item_id int, rating double")


@pytest.fixture(scope="module")
def implicit(clicks):
    return models.fit_als(clicks, rank=6, iterations=8, implicit=True)


def table(df):
    return {r.id: np.array(r.features, dtype=float) for r in df.collect()}


def test_implicit_factors_rank_unseen_items_of_the_own_group_first(implicit, clicks):
    users, items = map(table, models.factors(implicit))
    seen = {(r.user_id, r.item_id) for r in clicks.collect()}
    right = total = 0
    for u, f in users.items():
        unseen = [i for i in items if (u, i) not in seen]
        own = {i for i in unseen if taste(u, i)}
        best = sorted(unseen, key=lambda i: -(f @ items[i]))[: len(own)]
        right, total = right + len(own & set(best)), total + len(own)
    assert total >= 60 and right >= 0.95 * total


def test_user_clusters_are_the_groups(implicit):
    best, members = models.mf_clusters(*models.factors(implicit), k=3, dims=3, top=5)
    groups = {}
    for r in members.collect():
        groups.setdefault(r.cluster_id, set()).add(r.user_id % 3)
    assert len(groups) == 3 and sorted(next(iter(g)) for g in groups.values() if len(g) == 1) == [0, 1, 2]
    lists = {}
    for r in best.collect():
        lists.setdefault(r.cluster_id, set()).add(r.item_id % 3)
    assert lists == groups


def test_foldin_equals_the_normal_equations(spark, implicit):
    users, items = map(table, models.factors(implicit))
    recent = spark.createDataFrame([(1, 4), (1, 7), (2, 5), (99, 4), (99, 8)], "user_id int, item_id int")
    got = table(scoring.fold_in(recent, models.factors(implicit)[1], models.factors(implicit)[0]))
    y = np.stack([items[i] for i in sorted(items)])
    inverse = np.linalg.inv(y.T @ y)
    known = lambda u, seen: users.get(u, 0) + sum(items[i] @ inverse for i in seen)
    assert set(got) == set(users) | {99}
    for u, seen in ((1, [4, 7]), (2, [5]), (99, [4, 8]), (3, [])):
        assert np.allclose(got[u], known(u, seen), atol=1e-3)


def test_topics_separate_two_vocabularies(spark):
    tags = spark.createDataFrame([(i, f"{'ab'[i % 2]}{(i // 2 + k) % 6}") for i in range(24) for k in range(3)], "item_id long, tag string")
    actions = spark.createDataFrame([(u, i) for u in range(40) for i in range(24) if i % 2 == u % 2 and (u + i) % 3], "user_id long, item_id long")
    mix, terms = models.fit_topics(actions, tags, k=2, iterations=30, terms=6)
    lists = {}
    for r in terms.collect():
        lists.setdefault(r.topic, set()).add(r.term[0])
    assert sorted(map(sorted, lists.values())) == [["a"], ["b"]]
    rows = {r.user_id: r.features for r in mix.collect()}
    assert len(rows) == 40 and all(abs(sum(m) - 1) < 1e-6 and max(m) > 0.9 for m in rows.values())
    assert all(np.argmax(rows[u]) == np.argmax(rows[u % 2]) for u in rows)


def test_word_vectors_of_one_context_are_near(spark):
    rng = np.random.default_rng(7)
    rows = [([f"{'ab'[s % 2]}{w}" for w in rng.permutation(8)],) for s in range(600)]
    got = {r.item_id: np.array(r.features) for r in models.fit_w2v(spark.createDataFrame(rows, "words array<string>"), "words", 12, 50, iterations=5, partitions=1).collect()}
    assert len(got) == 16
    cos = lambda x, y: x @ y / np.linalg.norm(x) / np.linalg.norm(y)
    near = [cos(got[x], got[y]) for x in got for y in got if x < y and x[0] == y[0]]
    far = [cos(got[x], got[y]) for x in got for y in got if x < y and x[0] != y[0]]
    assert np.mean(near) > np.mean(far) + 0.3


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(900):
        x, kind = float(rng.normal()), "uvw"[rng.integers(3)]
        rows.append((i, x, kind, int(x + (kind == "u") * 2 - (kind == "w") * 2 + rng.normal() * 0.3 > 0)))
    return spark.createDataFrame(rows, "id long, x double, kind string, label int")


def fitted(df):
    return ft.fit_classifier(df, "label", ["x"], ["kind"], maxIter=30, regParam=0.001)


def test_classifier_finds_the_rule_on_rows_it_never_saw(labelled):
    score = fitted(labelled.where("id % 3 > 0"))
    rows = score(labelled.where("id % 3 = 0")).collect()
    assert len(rows) == 300 and np.mean([r.prediction == str(r.label) for r in rows]) > 0.9
    assert all(abs(sum(r.probabilities) - 1) < 1e-9 for r in rows)


def test_folds_score_every_row_once(labelled):
    for metric in ("accuracy", "auc"):
        scores, predictions = ft.kfold(labelled, "id", "label", fitted, 3, metric)
        values = [r.score for r in scores.collect()]
        assert len(values) == 3 and min(values) > 0.9 and max(values) <= 1
        assert predictions.count() == predictions.select("id").distinct().count() == 900


def test_hashed_neighbours_reach_their_recall(spark):
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(20, 16))
    rows = [(i, [float(x) for x in centres[i % 20] + rng.normal(size=16) * 0.15]) for i in range(400)]
    v = spark.createDataFrame(rows, "item_id long, features array<double>")
    q = v.select(F.col("item_id").alias("query_id"), "features")
    x = np.array([f for _, f in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    scores = x @ x.T - 2 * np.eye(400)
    exact_of = {u: set(np.argsort(-scores[u])[:5].tolist()) for u in range(400)}
    found = {}
    for r in nn.nearest_approx(q, v, 5, 1.3).collect():
        found.setdefault(r.query_id, set()).add(r.item_id)
    assert sum(len(found.get(u, set()) & exact_of[u]) for u in exact_of) >= 0.9 * 5 * 400


def test_document_factors_separate_two_vocabularies(spark):
    rng = np.random.default_rng(5)
    words = {0: "river boat water fish sail".split(), 1: "stock bond price market trade".split()}
    df = spark.createDataFrame([(i, " ".join(rng.choice(words[i % 2], 12))) for i in range(80)], "doc_id long, text string")
    for method in ("lsi", "nmf", "lda"):
        got = {r.doc_id: np.array(r.features) for r in text.doc_vectors(df, method, 2).collect()}
        unit = {i: f / np.linalg.norm(f) for i, f in got.items()}
        assert all(f.min() >= 0 for f in got.values()) or method == "lsi"
        assert min(unit[i] @ unit[i % 2] for i in unit) > 0.9 and max(abs(unit[i] @ unit[1 - i % 2]) for i in unit) < 0.5, method


def test_topic_fit_follows_the_update_of_a_pass(spark):
    # the distributed fit against the same passes with whole matrices: topics x terms nowhere on the driver, same numbers
    rng = np.random.default_rng(3)
    rows = [(int(i), f"w{t}", float(n)) for i in range(120) for t, n in enumerate(rng.poisson(0.7, 30)) if n]
    got = text.lda(spark.createDataFrame(rows, "doc_id long, term string, w double"), 3, 3)
    names = {r.t: r.term for r in got.blocks.terms.collect()}
    numbers = {v: k for k, v in names.items()}
    order = sorted(names)
    docs = {i: ([order.index(numbers[w]) for d, w, _ in rows if d == i], np.array([n for d, _, n in rows if d == i])) for i in {r[0] for r in rows}}
    first = text._first_topics(np.array(order), 3, 42)
    assert abs(first.mean() - 1) < 0.05 and 0.05 < first.std() < 0.15
    lam, alpha, start, done = first.copy(), np.full(3, 1 / 3), np.random.default_rng(42).gamma(100.0, 0.01, 3), 0
    chances = np.cumsum([math.exp(-0.05) * 0.05**i / math.factorial(i) for i in range(6)])
    for number in range(3):
        u = F.pmod(F.xxhash64("doc_id", F.lit(42), F.lit(number)), F.lit(1 << 52)) / float(1 << 52)
        keys = spark.createDataFrame([(i,) for i in docs], "doc_id long").select("doc_id", u.alias("u")).collect()
        times = {r.doc_id: int((r.u >= chances).sum()) for r in keys}
        if not sum(times.values()):
            continue
        beta, add, logs = np.exp(text.digamma(lam) - text.digamma(lam.sum(0))), np.zeros_like(lam), np.zeros(3)
        for i, n in times.items():
            m, e, ratio = text._topics_of(beta[docs[i][0]], docs[i][1], alpha, start)
            add[docs[i][0]] += n * np.outer(ratio, e)
            logs += n * (text.digamma(m) - text.digamma(m.sum()))
        done, n = done + 1, sum(times.values())
        w = (1024 + done) ** -0.51
        lam = (1 - w) * lam + w * (add * beta * len(docs) / math.ceil(0.05 * len(docs)) + 1 / 3)
        slope, bend = n * (logs / n - text.digamma(alpha) + text.digamma(alpha.sum())), -n * text.trigamma(alpha)
        b = (slope / bend).sum() / (1 / (n * text.trigamma(alpha.sum())) + (1 / bend).sum())
        alpha = alpha - w * (slope - b) / bend
    assert done > 1 and np.allclose(got.alpha, alpha) and np.allclose(got.totals, lam.sum(0))
    beta = np.exp(text.digamma(lam) - text.digamma(lam.sum(0)))
    for r in got.mix().collect():
        m, _, _ = text._topics_of(beta[docs[r.doc_id][0]], docs[r.doc_id][1], alpha, start)
        assert np.allclose(r.features, m / m.sum())

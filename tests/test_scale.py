"""Steps whose rows, tasks or batches must not grow faster than the input: right results and the shape of the plan."""

import math
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidewell import session
from tidewell.operators import aggregates as agg, features as ft, graph, models, nearest, pages, scoring, sets, skew, text, vectors


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_linear_score_keeps_a_row_per_feature(spark):
    classes = spark.createDataFrame([("x", 1), ("y", 2)], "target string, label int")
    rows = spark.createDataFrame([(1, "i", "5", 2.0), (2, "i", "nobody", 1.0), (None, "i", "5", 1.0), (3, "i", None, 1.0)], "id long, namespace string, feature string, value double")
    named = rows.where("id = 1").select(models.feature_hash("namespace", "feature", F.lit(1), 10, 2)).first()[0]
    weights = spark.createDataFrame([(named, 0.5)], "idx long, weight double")
    out = models.linear_score(rows, weights, classes, 10)
    got = {(r.id, r.target): round(r.score, 9) for r in out.collect()}
    p = 1 / (1 + math.exp(-1.0))
    assert got == {(1, "x"): round(p / (p + 0.5), 9), (1, "y"): round(0.5 / (p + 0.5), 9), (2, "x"): 0.5, (2, "y"): 0.5, (3, "x"): 0.5, (3, "y"): 0.5}
    assert plan(out).count("Join") <= 2


def test_pages_are_read_a_few_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(pages, "PAGES", 3)
    rows = spark.createDataFrame([(i, f"http://a/{i}", f"<title>t{i}</title>" if i % 4 else None) for i in range(10)], "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: (r.title, r.url) for r in pages.page_attributes(rows, {"title": "title"}).collect()}
    assert got == {i: (f"t{i}" if i % 4 else "", f"http://a/{i}") for i in range(10)}


def test_symmetric_drops_duplicates_before_it_copies(spark):
    rows = [(1, 2, 0.5), (2, 1, 0.5), (1, 2, 0.5), (3, 3, 1.0), (None, 4, 0.1), (4, None, 0.1), (1, 2, 0.7), (None, None, 0.2)]
    out = sets.symmetric(spark.createDataFrame(rows, "item_a long, item_b long, score double"))
    got = sorted(map(str, out.collect()))
    assert got == sorted({str(r) for r in spark.createDataFrame([*rows, *[(b, a, s) for a, b, s in rows]], "item_a long, item_b long, score double").collect()})
    assert plan(out).index("Generate") < plan(out).index("Aggregate")


def test_projection_shuffles_weights_not_sums(spark):
    docs = spark.createDataFrame([(1, "a b b"), (2, "b c"), (2, "c d"), (3, None)], "doc_id long, text string")
    out = text.random_projection(docs, 16)
    assert "REPARTITION_BY_COL" in physical(out)
    assert {r.doc_id for r in out.collect()} == {1, 2, 3}


def test_tfidf_reads_the_texts_of_the_fit_once(spark):
    docs = spark.createDataFrame([(1, "aa bb"), (2, "aa cc")], "doc_id long, text string")
    t = ft.TfidfFeatures("doc_id", "text", "w")
    fitted = t.fit_transform(docs)
    assert "regexp_extract_all" not in plan(fitted)
    other = spark.createDataFrame([(1, "aa bb"), (2, "aa cc")], "doc_id long, text string")
    assert "regexp_extract_all" in plan(t.transform(other))
    assert sorted(map(str, fitted.select("doc_id", F.map_entries("w")).collect())) == sorted(map(str, t.transform(other).select("doc_id", F.map_entries("w")).collect()))


def test_topics_are_fitted_on_documents_made_once(spark):
    actions = spark.createDataFrame([(u, i) for u in range(6) for i in range(u % 3 + 1)], "user_id long, item_id long")
    tags = spark.createDataFrame([(i, f"t{i}") for i in range(3)], "item_id long, tag string")
    mix, _ = models.fit_topics(actions, tags, k=2, iterations=2, terms=2)
    assert "Aggregate" not in plan(mix) and mix.count() == 6


def test_tasks_of_ordered_state_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(skew, "TASK_ROWS", 20)
    rows = spark.range(400).select((F.col("id") % 40).alias("user_id"), F.timestamp_seconds("id").alias("ts"), F.col("id").alias("event_id"))
    cut = skew.with_pieces(rows, ["user_id"], ["ts"], "_b")
    assert cut.rdd.getNumPartitions() == 21
    out = skew.sessionise(rows, ["user_id"], "ts", ["ts", "event_id"], 30)
    assert out.groupBy("user_id").agg(F.max("session").alias("s")).agg(F.min("s"), F.max("s")).first() == (10, 10)


def test_users_of_few_items_meet_in_blocks(spark, monkeypatch):
    """Rows of ratings in products give what listed pairs of users give, with items and users without an id."""
    rng = random.Random(3)
    rows = [(u, i if i else None, float(rng.randint(1, 5))) for u in range(60) for i in range(12) if rng.random() < 0.5] + [(None, 3, 2.0), (99, 1, 2.0)]
    df = spark.createDataFrame(rows, "user_id long, item_id long, rating double")

    def got():
        return sorted((r.user_id, -1 if r.item_id is None else r.item_id, round(r.score, 8)) for r in scoring.rec_user_based(df, 3).collect())

    listed = got()
    monkeypatch.setattr(scoring, "user_similarity", None)  # no pair is listed
    monkeypatch.setattr(scoring, "LISTED", 0)
    monkeypatch.setattr(scoring, "BLOCK_CLASSES", 16)
    assert listed and got() == listed


def test_next_tokens_read_few_continuations_of_a_frequent_word(spark):
    """A word with 400 continuations: only those that can be among the best are listed; the result is that of all."""
    rng = random.Random(4)
    texts = [["the", f"w{i}"] for i in range(400)] + [["a", "the", f"x{rng.randint(0, 6)}"] for _ in range(60)] + [["the", "x1"]] * 100 + [["the", "x2"]] * 90
    model = text.ngram_model(spark.createDataFrame([(t,) for t in texts], "tokens array<string>"))
    recent = spark.createDataFrame([(1, ["a", "the"]), (2, ["the"]), (None, ["b", "a"]), (3, ["x1"])], "user_id long, tokens array<string>")
    rows = [(r.prefix, r.next, 10**r.logp) for r in model.collect() if r.next not in text.MARKS]
    want = set()
    for u, t in ((1, ["a", "the"]), (2, ["the"]), (None, ["b", "a"]), (3, ["x1"])):
        asked = [" ".join(t[i : i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)]
        sums = {}
        for p, n, v in rows:
            sums[n] = sums.get(n, 0) + asked.count(p) * v
        best = sorted(((-round(v, 10), n) for n, v in sums.items() if v > 0))[:3]
        want |= {(u, n, round(-v, 7)) for v, n in best if n not in t}
    assert {(r.user_id, r.item_id, round(r.score, 7)) for r in text.ngram_next(model, recent, 3).collect()} == want
    asked = spark.createDataFrame([((1,), "the", 1), ((1,), "a", 1), ((1,), "a the", 1)], "u struct<user_id:long>, prefix string, times long")
    known = spark.createDataFrame(rows, "prefix string, next string, p double")
    assert text._may_be_next(asked, known, 3).count() < 20


def test_unseen_items_of_lists_make_no_pair_before_the_last_join(spark, monkeypatch):
    monkeypatch.setattr(sets, "LIST_ITEMS", 3)
    monkeypatch.setattr(sets, "LIST_USERS", 2)
    users = [(u, u % 3) for u in range(12)] + [(0, 0), (0, 1), (None, 1), (3, None), (50, 9)]
    items = [(i % 4, i) for i in range(40)] + [(0, 0), (0, 0), (2, 0), (1, None), (None, 5), (8, 8)]
    saw = [(0, 0), (0, 0), (0, 4), (4, 1), (4, 5), (4, 2), (None, 1), (1, None), (77, 1), *[(6, i) for i in range(0, 40, 4)]]
    recs, lists = spark.createDataFrame(users, "user_id long, list_id int"), spark.createDataFrame(items, "list_id int, item_id long")
    out = sets.exclude_seen(recs, spark.createDataFrame(saw, "user_id long, item_id long"), lists)
    expected = [(u, i) for u, x in users for y, i in items if x is not None and x == y and (None in (u, i) or (u, i) not in saw)]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, expected))
    p = physical(out)
    assert "Generate explode" in p and "Exchange" not in p[: p.index("Join")]


def plain_cells(seed=3):
    rng = random.Random(seed)
    return [(d, f"t{t}", rng.random() + 0.1) for d in range(40) for t in sorted(rng.sample(range(60), rng.randint(1, 12)))]


def test_document_factors_meet_a_row_per_term_of_a_block(spark, monkeypatch):
    rows = plain_cells()
    monkeypatch.setattr(text, "BLOCK_CELLS", 50)
    monkeypatch.setattr(text, "TIMES_CELLS", 7)
    names = sorted({t for _, t, _ in rows})
    a = np.zeros((40, len(names)))
    for d, t, w in rows:
        a[d, names.index(t)] = w
    cells = spark.createDataFrame(rows, "doc_id long, term string, w double")
    blocks = text._blocks(cells)
    assert blocks.docs.select("blk").distinct().count() > 3 and blocks.held.count() < len(rows)
    number = {r.term: r.t for r in blocks.terms.collect()}
    dense = {t: [float(i), 1.0 / (i + 1)] for i, t in enumerate(names)}
    given = spark.createDataFrame([(number[t], f) for t, f in dense.items()], "t int, f array<double>")

    def both(b, f, _):
        return {"t": b.terms, "f": text._listed(b.by_term(b.by_doc(f)))}

    out = blocks.products(given, both, "t int, f array<double>")
    got = {r.t: r.f for r in text._term_sums(out, 2).collect()}
    expected = a.T @ (a @ np.array([dense[t] for t in names]))
    assert np.allclose([got[number[t]] for t in names], expected)
    p = physical(out)
    assert "Exchange" not in p[: p.index("InMemory")]  # the cells stay where they are
    found = {r.doc_id: r.features for r in text.lsi(cells, 3, passes=8, extra=20).collect()}
    u, s, _ = np.linalg.svd(a)
    near = np.array([found[d] for d in range(40)])
    assert np.allclose(np.abs(near), np.abs(u[:, :3] * s[:3]), atol=1e-3)


def test_joins_of_tags_of_items_do_not_go_through_the_driver(spark, tmp_path):
    rows = [(i, "red big ring", f"Brand#{i % 3}") for i in range(500)]
    spark.createDataFrame(rows, "item_id long, name string, brand string").write.parquet(f"{tmp_path}/items")
    spark.createDataFrame([(i % 40, i % 500) for i in range(2000)], "user_id long, item_id long").write.parquet(f"{tmp_path}/actions")
    items, actions = spark.read.parquet(f"{tmp_path}/items"), spark.read.parquet(f"{tmp_path}/actions")
    tags = items.select("item_id", F.explode(F.split("name", " ")).alias("tag"))
    terms, vectors = models.fit_text_vectors(items.select("item_id", F.split("name", " ").alias("words")), "words", 4)
    for out in (agg.user_tag_counts(actions, tags), agg.tag_share(actions, tags), vectors):
        assert out.count() and "Broadcast" not in physical(out)


def test_a_cluster_that_is_nearest_to_no_tag_may_have_the_largest_sum(spark):
    """every cluster above the score counts, and a user of many tags is not dropped."""
    at = lambda *angles: [[math.cos(a), math.sin(a)] for a in angles]
    tag_at, cluster_at = at(0.0, 1.0), at(0.1, 0.9, 0.5, 3.0)
    tags = spark.createDataFrame([(f"t{i}", f) for i, f in enumerate(tag_at)], "tag string, features array<double>")
    clusters = spark.createDataFrame([(f"c{i}", f) for i, f in enumerate(cluster_at)] + [(None, [1.0, 0.0])], "cluster_id string, features array<double>")
    mine = spark.createDataFrame([(1, "t0"), (1, "t1"), (2, "t0"), (None, "t1"), (3, "nowhere"), (3, None)], "user_id long, tag string")
    got = {(r.user_id, r.cluster_id): round(r.weight, 6) for r in vectors.suggest_clusters(mine, tags, clusters, 1, 0.5).collect()}
    assert got == {(1, "c2"): 1.0, (2, "c0"): 1.0, (None, "c1"): 1.0}

    many = spark.createDataFrame([(1, 1)] * 6 + [(2, 2)] * 6, "user_id long, item_id long")
    words = spark.createDataFrame([(1, f"a{i}") for i in range(8)] + [(2, "b")], "item_id long, tag string")
    assert agg.tag_affinity(many, words, 1, 1, 0.2, 5).count() == 1
    assert agg.tag_affinity(many, words, 1, 1, 0.2, None).count() == 9


def test_next_tokens_do_not_go_through_the_driver(spark, tmp_path):
    """small files of repeated words let Spark expect few bytes; no side is broadcast all the same."""
    texts = [(i, ["the", f"w{i % 9}", "end"]) for i in range(300)]
    spark.createDataFrame(texts, "user_id long, tokens array<string>").write.parquet(f"{tmp_path}/texts")
    rows = spark.read.parquet(f"{tmp_path}/texts")
    model = text.ngram_model(rows)
    out = text.ngram_next(model, rows.select("user_id", F.slice("tokens", 1, 1).alias("tokens")), 3)
    assert out.count() == 900 and "Broadcast" not in physical(model) + physical(out)


def test_a_block_measures_only_the_pairs_that_may_be_within_reach(spark, monkeypatch):
    """after a query has a reach, one product of single precision picks the pairs; the result is that of all pairs."""
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(40, 8)), rng.normal(size=(640, 8))
    x, y = x / np.linalg.norm(x, axis=1)[:, None], y / np.linalg.norm(y, axis=1)[:, None]
    fields = [pa.array(np.arange(40)), pa.array(list(x)), pa.array(np.full(40, 5)), pa.array(np.full(40, np.inf)), pa.array([[1]] * 40)]
    block = nearest._Block(pa.StructArray.from_arrays(fields, names=["query_id", "vec", "need", "reach", "cells"]))
    err, found, whole, plain = np.full(64, 0.01), set(), [], nearest._distances
    monkeypatch.setattr(nearest, "_distances", lambda a, b: whole.append(a.shape) or plain(a, b))
    for at in range(0, 640, 64):
        rows, cols, low = block.meet(0, y[at : at + 64], err)
        found |= {(r, at + c, round(v, 9)) for r, c, v in zip(rows.tolist(), cols.tolist(), low.tolist())}
    away = plain(x, y)
    reach = np.sort(away + 0.01, axis=1)[:, 4]
    assert whole == [(40, 8)] and np.allclose(block.reach, reach)
    low = away - 0.01 - nearest.SLACK
    assert {(i, j, round(low[i, j], 9)) for i, j in zip(*(v.tolist() for v in np.nonzero(low <= reach[:, None])))} <= found and len(found) < 40 * 320


def test_files_of_earlier_rounds_are_removed(spark, monkeypatch):
    """a pass leaves neither its shuffle files nor what only the pass before it read."""
    kept = session.written(spark.range(100).repartition(3, "id").groupBy("id").count(), "tidy")
    assert kept.count() == 100 and len(kept.inputFiles()) > 0
    session.forget(kept.where("id > 5"))
    assert not list(Path(session.shared_dir(spark).removeprefix("file://")).glob("tidewell-tidy-*"))
    names, real = [], session.written
    monkeypatch.setattr(graph, "written", lambda df, label: names.append(real(df, label)) or names[-1])
    vertices = spark.createDataFrame([(i, 0) for i in range(6)], "id long, triangles long")
    edges = spark.createDataFrame([(i, i + 1, 0.5) for i in range(5)], "src long, dst long, weight double")
    got = graph.short_paths(vertices, edges, vertices.where("id = 0"), vertices, hops=4)
    assert {(r.id, r.cost) for r in got.collect()} == {(i, 0.5 * i) for i in range(5)}
    left = [n for n in names if Path(n.inputFiles()[0].removeprefix("file://")).exists()]
    assert len(names) == 4 and left == names[-1:]

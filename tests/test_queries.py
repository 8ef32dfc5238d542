"""Every registered query runs on the smallest tables and equals its SQL twin there."""

import math

import duckdb
import pytest

from tidewell.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# model fits and other slow jobs, checked by scripts/check_queries.py
QUICK = [
    "ctr_daily", "ctr_by_tag", "most_popular_by_dim", "weighted_ratings", "users_by_dim", "tag_affinity", "rec_recency", "percentile_np1",
    "significant_counts", "session_items", "basket_sessions", "engagement_ab", "history_features", "next_item_features", "item_cosine",
    "item_cooccurrence", "fp_rules", "edge_triangles", "short_paths", "tag_knn", "ngram_next", "rec_item_sim", "rec_cluster_counts",
    "ensemble", "eval_ranking", "page_attributes", "st_minhash_fixed", "resolve_users", "load_attrs", "sink_stage_swap",
    "sample_actions", "random_variation", "rec_mf", "rec_popular", "rec_popular_dim", "doc_rec", "tag_recommend", "src_frame", "st_minhash_sim", "sink_partitioned",
    "vector_neighbours", "fn_feature_hash", "rec_popular_session", "rec_assoc", "rec_user_based", "feature_ids", "doc_vectors_rp", "st_emit_policy_data", "st_popular_forward",
]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5) + 0.0
    if type(v).__name__ == "Decimal":
        return round(float(v), 5) + 0.0
    return v if v is None or isinstance(v, (int, str)) else str(v)


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, sf, con, name):
    df = catalog.QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    cur = con.execute(catalog.ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = sorted((tuple(norm(r[names.index(c)]) for c in cols) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert got == want


def test_registry():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)
    assert len(catalog.QUERIES) > 180

"""Queries: feature transforms and classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewell.operators import features as ft
from tidewell.plans import fixtures as fx
from tidewell.plans.registry import query


@query(
    "feature_ids",
    """WITH c AS (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS id FROM part GROUP BY 1)
       SELECT p_partkey, CASE WHEN id <= 15 THEN id ELSE -1 END AS id FROM part JOIN c USING (p_brand)""",
    longs=("id",),
)
def feature_ids(spark, d):
    p = fx.table(spark, d, "part").select("p_partkey", "p_brand")
    return ft.FeatureIds("p_brand", "id", max_classes=15).fit_transform(p).select("p_partkey", "id")


@query(
    "svm_features",
    """SELECT p_partkey, string_agg(n, ' ' ORDER BY n) AS features FROM (
         SELECT p_partkey, 'size=' || p_size::VARCHAR || '.0' AS n FROM part UNION ALL SELECT p_partkey, 'brand_' || p_brand || '=1.0' FROM part
         UNION ALL SELECT DISTINCT p_partkey, 'words_' || w || '=1.0' FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part)
         UNION ALL SELECT p_partkey, 'm_' || p_type || '=' || p_size::VARCHAR || '.0' FROM part
         UNION ALL SELECT p_partkey, 'm_kind_' || p_type || '=1.0' FROM part) GROUP BY p_partkey""",
)
def svm_features(spark, d):
    p = fx.table(spark, d, "part").select(
        "p_partkey",
        F.col("p_size").alias("size"),
        F.col("p_brand").alias("brand"),
        F.split("p_name", " ").alias("words"),
        F.create_map(F.col("p_type"), F.col("p_size").cast("string"), F.lit("kind"), F.col("p_type")).alias("m"),
    )
    t = ft.SvmFeatures("p_partkey").fit(p)
    rows = t.transform(p).select("p_partkey", F.explode("svm").alias("x")).select("p_partkey", "x.id", "x.value").join(t.ids, "id")
    text = F.concat("name", F.lit("="), F.col("value").cast("string"))
    return rows.groupBy("p_partkey").agg(F.array_join(F.array_sort(F.collect_list(text)), " ").alias("features"))


@query(
    "auto_transform",
    """WITH s AS (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS sd FROM customer WHERE c_nationkey <> 3),
            k AS (SELECT c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1)
       SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 0.0 ELSE round((c_acctbal - m) / sd, 7) END AS balance,
              CASE WHEN c_mktsegment = 'MACHINERY' THEN 'UKN' ELSE lower(c_mktsegment) END AS segment,
              c_nationkey % 2 AS odd, 'n_' || (c_nationkey % 4)::VARCHAR AS n, 'y2024' AS day_year,
              'm' || (1 + c_nationkey % 12) AS day_month FROM customer, s""",
)
def auto_transform(spark, d):
    c = fx.table(spark, d, "customer")
    nation = F.col("c_nationkey")
    wide = c.select(
        "c_custkey",
        F.when(nation == 3, "NA").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(nation % 2 == 1, "yes").otherwise("no").alias("odd"),
        (nation % 4).alias("n"),
        F.lit("same").alias("constant"),
        F.col("c_mktsegment").alias("twin_a"),
        F.col("c_mktsegment").alias("twin_b"),
        F.concat(F.lit("2024-"), F.lpad((1 + nation % 12).cast("string"), 2, "0"), F.lit("-05")).alias("day"),
    )
    t = ft.AutoTransform(exclude=["c_custkey"], ignore=["NA"], max_numeric_values=4, date_cols=["day"])
    out = t.fit_transform(wide)
    if "constant" in out.columns or "twin_a" in out.columns or "twin_b" not in out.columns:
        raise ValueError("constant and duplicate columns must be dropped")
    return out.select("c_custkey", F.round("balance", 7).alias("balance"), "segment", "odd", "n", "day_year", "day_month")


SQL_TFIDF = """t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '([\\p{L}\\p{N}_]{2,})', 1)) AS term FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
    idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + count(*))) + 1 AS idf FROM tf GROUP BY term HAVING count(*) >= 5),
    w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
    nw AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS w FROM w)"""


@query("tfidf_features", f"WITH {SQL_TFIDF} SELECT doc_id, term, round(w, 6) AS weight FROM nw")
def tfidf_features(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id", "text")
    out = ft.TfidfFeatures("doc_id", "text", "tfidf", min_df=5).fit_transform(docs)
    return out.select("doc_id", F.explode("tfidf").alias("term", "weight")).withColumn("weight", F.round("weight", 6))


@query(
    "tfidf_chi2",
    f"""WITH {SQL_TFIDF}, y AS (SELECT doc_id, source AS target FROM documents),
        p AS (SELECT target, count(*) / (SELECT count(*) FROM documents) AS p FROM y GROUP BY 1),
        o AS (SELECT term, target, sum(w) AS o FROM nw JOIN y USING (doc_id) GROUP BY 1, 2),
        tt AS (SELECT term, sum(o) AS t FROM o GROUP BY 1),
        c AS (SELECT tt.term, sum(pow(coalesce(o, 0) - t * p.p, 2) / (t * p.p)) AS chi2 FROM tt CROSS JOIN p LEFT JOIN o ON o.term = tt.term AND o.target = p.target GROUP BY 1)
        SELECT term FROM c ORDER BY chi2 DESC, term LIMIT 50""",
)
def tfidf_chi2(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id", "text", "source")
    return ft.TfidfFeatures("doc_id", "text", "tfidf", min_df=5, target="source", top=50).fit(docs).selected


@query(
    "standard_scale",
    """SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 7) AS p_size,
              round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 7) AS p_retailprice FROM part""",
)
def standard_scale(spark, d):
    p = fx.table(spark, d, "part").select("p_partkey", "p_size", "p_retailprice")
    out = ft.Scale(["p_size", "p_retailprice"]).fit_transform(p)
    return out.select("p_partkey", F.round("p_size", 7).alias("p_size"), F.round("p_retailprice", 7).alias("p_retailprice"))


@query(
    "label_binarise",
    """SELECT p_partkey, (p_type = 'ECONOMY')::INT AS p_type_0, (p_type = 'LARGE')::INT AS p_type_1, (p_type = 'MEDIUM')::INT AS p_type_2,
              (p_type = 'PROMO')::INT AS p_type_3, (p_type = 'SMALL')::INT AS p_type_4, (p_type = 'STANDARD')::INT AS p_type_5 FROM part""",
)
def label_binarise(spark, d):
    return ft.Binarise("p_type").fit_transform(fx.table(spark, d, "part").select("p_partkey", "p_type")).drop("p_type")


def labelled(spark, d):
    docs = fx.table(spark, d, "documents").select("doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"), F.size(F.split("text", " ")).cast("double").alias("n_words"))
    return docs.join(fx.table(spark, d, "labels"), "doc_id")


@query("classifier_fit")
def classifier_fit(spark, d):
    df = labelled(spark, d)
    score = ft.fit_classifier(df, "quality", ["n_chars", "n_words"], ["lang", "source"], maxIter=20, regParam=0.01)
    return score(df).select("doc_id", "quality", "prediction", F.round(F.element_at("probabilities", -1), 4).alias("p"))


def _kfold(spark, d, metric):
    def fit(train):
        return ft.fit_classifier(train, "quality", ["n_chars", "n_words"], ["lang"], maxIter=10, regParam=0.01)

    scores, predictions = ft.kfold(labelled(spark, d), "doc_id", "quality", fit, 3, metric)
    mean = scores.agg(F.avg("score")).scalar()
    return scores.withColumn("score", F.round("score", 4)).withColumn("mean", F.round(mean, 4)).join(predictions.groupBy("fold").agg(F.count("*").alias("n")), "fold")


@query("kfold_score")
def kfold_score(spark, d):
    return _kfold(spark, d, "accuracy")


@query("kfold_auc")
def kfold_auc(spark, d):
    return _kfold(spark, d, "auc")

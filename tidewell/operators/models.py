"""Model-building jobs: factorisation, user clusters, topics, item vectors, text lines, linear scoring."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.feature import IDF, HashingTF, StandardScaler, Tokenizer, VectorAssembler, Word2Vec
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewell.functions.hashing import constant_hash, feature_hash, hash_bits
from tidewell.operators.nearest import gram, nearest, times
from tidewell.operators.text import hash_sign, term_vectors
from tidewell.session import cut_lineage

ALS_COLS = dict(userCol="user_id", itemCol="item_id", ratingCol="rating", coldStartStrategy="drop")


def fit_als(ratings: DataFrame, rank: int = 30, iterations: int = 5, reg: float = 0.01, implicit: bool = False, alpha: float = 1.0, seed: int = 42):
    """Explicit (nonnegative) or implicit alternating least squares."""
    als = ALS(rank=rank, maxIter=iterations, regParam=reg, implicitPrefs=implicit, alpha=alpha, nonnegative=not implicit, seed=seed, **ALS_COLS)
    return als.fit(ratings)


def factors(model) -> tuple[DataFrame, DataFrame]:
    """(user, item) factor tables ``id, features``."""
    return model.userFactors, model.itemFactors


def mf_clusters(users: DataFrame, items: DataFrame, k: int = 20, dims: int = 10, top: int = 200, iterations: int = 200, seed: int = 42):
    """k-means of users in the Euclidean space of the item-factor decomposition.

    Returns (``cluster_id, item_id, score`` top items per centre, ``user_id, cluster_id``). The item factors'
    right singular vectors come from their k x k Gram matrix; only that matrix and the centres reach the driver.
    """
    values, vectors = np.linalg.eigh(gram(items))
    order = np.argsort(values)[::-1][: min(dims, len(values))]
    s = np.sqrt(np.maximum(values[order], 1e-12))
    v = vectors[:, order]
    placed = times(users, v * s[None, :]).select("id", array_to_vector("features").alias("features"))
    model = KMeans(k=k, maxIter=iterations, seed=seed, featuresCol="features", predictionCol="cluster_id").fit(placed)
    centres = np.stack(model.clusterCenters()) @ (v / s[None, :]).T
    spark = users.sparkSession
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(centres)]
    q = spark.createDataFrame(rows, "query_id int, features array<double>")
    best = nearest(q, items.select(F.col("id").alias("item_id"), "features"), top, metric="dot")
    return best.withColumnRenamed("query_id", "cluster_id"), model.transform(placed).select(F.col("id").alias("user_id"), "cluster_id")


def user_documents(actions: DataFrame, item_tags: DataFrame, min_actions: int = 1) -> DataFrame:
    """(user, term, count) of users' item tags, counted before they are packed."""
    ui = actions.groupBy("user_id", "item_id").agg(F.count("*").alias("n"))
    return ui.join(item_tags, "item_id").groupBy("user_id", F.col("tag").alias("term")).agg(F.sum("n").alias("n"))


def fit_topics(actions: DataFrame, item_tags: DataFrame, k: int = 50, iterations: int = 20, vocab_size: int | None = None, terms: int = 50, seed: int = 42):
    """LDA with users as documents of item tags.

    Returns (``user_id, features`` topic mix, ``topic, term, weight`` top terms per topic). The packed cell of
    a user holds distinct terms with counts, so it is bounded by the vocabulary.
    """
    counts = user_documents(actions, item_tags)
    docs, index = term_vectors(counts, "user_id", vocab_size)
    docs = cut_lineage(docs)  # read in every round of the fit
    model = LDA(k=k, maxIter=iterations, seed=seed, optimizer="online").fit(docs)
    mix = model.transform(docs).select("user_id", vector_to_array("topicDistribution").alias("features"))
    top = model.describeTopics(terms).select("topic", F.explode(F.arrays_zip("termIndices", "termWeights")).alias("t"))
    top = top.select("topic", F.col("t.termIndices").alias("i"), F.col("t.termWeights").alias("weight")).join(index, "i").drop("i")
    return mix, top


def fit_w2v(sessions: DataFrame, tokens: str, size: int = 30, min_count: int = 50, iterations: int = 1, partitions: int = 8, seed: int = 42) -> DataFrame:
    """Skip-gram vectors ``item_id, features`` of session tokens, trained in ``partitions`` parts side by side.

    The vectors depend on the number of parts, so it is an argument and not the number of cores.
    """
    model = Word2Vec(inputCol=tokens, outputCol="v", vectorSize=size, minCount=min_count, maxIter=iterations, seed=seed, numPartitions=partitions).fit(sessions)
    return model.getVectors().select(F.col("word").alias("item_id"), vector_to_array("vector").alias("features"))


def fit_text_vectors(items: DataFrame, tokens: str, dim: int = 32) -> tuple[DataFrame, DataFrame]:
    """(term vectors, document vectors): a ±1 direction per document summed into terms by tf-idf, and back.

    ``items``: ``item_id`` and an array column of tokens. Words of items are far more than the file of the items lets Spark expect, so
    neither side of a join goes through the driver.
    """
    n = items.agg(F.count("*")).scalar()
    tf = items.select("item_id", F.explode(tokens).alias("term")).groupBy("item_id", "term").agg(F.count("*").alias("tf"))
    df = tf.groupBy("term").agg(F.count("*").alias("df"))
    weighted = tf.join(df.hint("merge"), "term").select("item_id", "term", (F.col("tf") * F.log((n + 1) / (F.col("df") + 1))).alias("w"))
    signed = weighted.select("item_id", "term", "w", *[hash_bits("item_id", j).alias(f"h{j}") for j in range(-(-dim // 60))])
    terms = cut_lineage(signed.groupBy("term").agg(F.array(*[F.sum(hash_sign("w", i)) for i in range(dim)]).alias("features")))
    back = weighted.join(terms.hint("merge"), "term")
    docs = back.groupBy("item_id").agg(F.array(*[F.sum(F.col("w") * F.col("features")[i]) for i in range(dim)]).alias("features"))
    return terms, docs


# text lines for linear learners


def user_tag_lines(actions: DataFrame, item_tags: DataFrame, affinity: DataFrame) -> DataFrame:
    """``1 |i tags |u tag:weight`` per action of a user with affinities."""
    tags = item_tags.groupBy("item_id").agg(F.array_join(F.array_sort(F.collect_list("tag")), " ").alias("i"))
    weights = affinity.select("user_id", F.format_string("%s:%.6f", "tag", "weight").alias("w"))
    mine = weights.groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_list("w")), " ").alias("u"))
    return actions.join(tags, "item_id").join(mine, "user_id").select("event_id", F.concat(F.lit("1 |i "), "i", F.lit(" |u "), "u").alias("line"))


def history_tfidf(
    features: DataFrame, min_df: int = 100, max_user: int = 21, max_item: int | None = None, ascending: bool = True, num_features: int = 1 << 20
) -> tuple[DataFrame, DataFrame]:
    """Weighted lines of history features and the idf of every tag.

    Hashed term counts times smoothed idf (0 below ``min_df`` documents). A line lists each feature once;
    ``u_*`` (and ``i_*`` with ``max_item``) are limited by tf-idf, smallest first as ``ascending`` says.
    ``features``: ``event_id, features array``.
    """
    rows = features.select("event_id", F.posexplode("features").alias("pos", "feature"))
    tf = rows.groupBy("event_id", "feature").agg(F.count("*").alias("tf"), F.min("pos").alias("pos"))
    slot = F.pmod(F.hash("feature"), F.lit(num_features))
    hashed = tf.withColumn("slot", slot)
    per_slot = hashed.groupBy("event_id", "slot").agg(F.sum("tf").alias("tf"))
    n = features.agg(F.count("*")).scalar()
    df = per_slot.groupBy("slot").agg(F.count("*").alias("df"))
    idf = df.select("slot", F.when(F.col("df") >= min_df, F.log((n + 1.0) / (F.col("df") + 1.0))).otherwise(0.0).alias("idf"))
    weighted = per_slot.join(idf, "slot").select("event_id", "slot", (F.col("tf") * F.col("idf")).alias("w"))
    cells = hashed.select("event_id", "slot", "feature", "pos").join(weighted, ["event_id", "slot"])
    entry = F.struct("w", "pos", "feature")
    packed = cells.groupBy("event_id").agg(F.collect_list(entry).alias("e"))

    def part(prefix: str, limit: int | None) -> Column:
        mine = F.filter("e", lambda x: x.feature.startswith(prefix))
        if limit is None:
            return F.array_sort(F.transform(mine, lambda x: F.struct(x.pos.alias("pos"), x.w.alias("w"), x.feature.alias("feature"))))
        ordered = F.array_sort(F.transform(mine, lambda x: F.struct((x.w if ascending else -x.w).alias("k"), x.pos.alias("pos"), x.w.alias("w"), x.feature.alias("feature"))))
        return F.slice(ordered, 1, limit)

    def text(c: Column) -> Column:
        return F.array_join(F.transform(c, lambda x: F.concat(x.feature, F.lit(":"), F.format_string("%.6f", x.w))), " ")

    lines = packed.select("event_id", F.concat(F.lit("1 |i "), text(part("i_", max_item)), F.lit(" |u "), text(part("u_", max_user))).alias("line"))
    tags = rows.select("feature").dropDuplicates().withColumn("slot", slot).join(idf, "slot").select(F.col("feature").alias("tag"), "idf")
    return lines, tags


def labelled_lines(df: DataFrame, features: str, target: str, exclude: list[str] = (), oaa: bool = True) -> tuple[DataFrame, DataFrame]:
    """Training lines of a flat text map column, and the class list ``label, target``.

    Classes are numbered from 1 in target order (one-against-all), or the two targets become -1 and 1.
    Numeric values read ``k:v``, others ``k_v``.
    """
    classes = df.select(F.col(target).alias("target")).distinct().withColumn("label", F.row_number().over(W.orderBy("target")))
    if not oaa:
        classes = classes.withColumn("label", F.when(F.col("label") == 1, -1).otherwise(1))
    kept = F.map_filter(features, lambda k, _: ~k.isin(*exclude)) if exclude else F.col(features)
    entries = F.array_sort(F.map_entries(kept))
    words = F.transform(
        entries, lambda e: F.when(e.value.try_cast("double").isNotNull(), F.concat(e.key, F.lit(":"), e.value)).otherwise(F.concat(e.key, F.lit("_"), e.value))
    )
    words = F.transform(words, lambda w: F.regexp_replace(w, "[ |]", "_"))
    lines = df.join(classes, df[target] == classes["target"]).select(
        *[c for c in df.columns if c != features], "label", F.concat(F.col("label").cast("string"), F.lit(" | "), F.array_join(words, " ")).alias("line")
    )
    return lines, classes.select("label", "target")


def linear_score(rows: DataFrame, weights: DataFrame, classes: DataFrame, bits: int) -> DataFrame:
    """One-against-all linear scores: sum of ``weight[hash] * value`` plus constant, logistic, divided by the row's sum.

    ``rows``: ``id, namespace, feature, value``; ``weights``: ``idx, weight``; ``classes``: ``label, target`` (hand-sized).
    """
    known = [(r.label, r.target) for r in classes.orderBy("label").collect()]
    n = len(known)
    # hashes are computed once per distinct feature, not once per row and class
    names = rows.select("namespace", "feature").dropDuplicates()
    hashed = names.withColumn("label", F.explode(F.array(*[F.lit(lb) for lb, _ in known])))
    hashed = hashed.withColumn("idx", feature_hash("namespace", "feature", F.col("label"), bits, n))
    # the weights of all classes lie side by side, so a row of features stays one row and a row's sums are one group
    own = [F.sum(F.when(F.col("label") == lb, F.col("weight"))).alias(f"w{i}") for i, (lb, _) in enumerate(known)]
    found = hashed.join(weights, "idx").groupBy("namespace", "feature").agg(*own)
    sums = [F.coalesce(F.sum(F.col("value") * F.col(f"w{i}")), F.lit(0.0)) for i in range(n)]
    parts = rows.where("id is not null").join(found, ["namespace", "feature"], "left").groupBy("id").agg(F.array(*sums).alias("s"))
    label_rows = classes.withColumn("idx", constant_hash(F.col("label"), bits, n)).join(weights, "idx", "left")
    consts = {r.label: r.weight or 0.0 for r in label_rows.select("label", "weight").collect()}
    cells = [F.struct(F.lit(target).cast(classes.schema["target"].dataType).alias("target"), (1.0 / (1.0 + F.exp(-(F.col("s")[i] + F.lit(float(consts[lb])))))).alias("p")) for i, (lb, target) in enumerate(known)]
    total = F.aggregate("e", F.lit(0.0), lambda acc, x: acc + x["p"])
    rated = parts.select("id", F.array(*cells).alias("e"))
    return rated.select("id", total.alias("_t"), F.explode("e").alias("x")).select("id", "x.target", (F.col("x.p") / F.col("_t")).alias("score"))


def text_pipeline(df: DataFrame, text: str, numbers: list[str], num_features: int = 1 << 12):
    """Two fitted pipelines: tokens, hashed counts, idf and numbers in one vector; and the numbers standardised."""
    words = Pipeline(
        stages=[
            Tokenizer(inputCol=text, outputCol="_words"),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=num_features),
            IDF(inputCol="_tf", outputCol="_idf"),
            VectorAssembler(inputCols=["_idf", *numbers], outputCol="features"),
        ]
    ).fit(df)
    scaled = Pipeline(
        stages=[
            VectorAssembler(inputCols=numbers, outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="scaled", withMean=True, withStd=True),
        ]
    ).fit(df)
    return words, scaled


# anomaly detection by isolation with nearest-neighbour ensembles


def fit_inne(df: DataFrame, features: str, ensembles: int = 100, sample: int = 32, metric: str = "euclidean", seed: int = 42) -> dict:
    """Spheres around seeded samples; at most ``ensembles * sample`` rows reach the driver."""
    pool = df.orderBy(F.xxhash64(F.col(features), F.lit(seed)), F.col(features)).limit(ensembles * sample).select(features).collect()
    x = np.array([r[0] for r in pool], dtype=float)
    rng = np.random.default_rng(seed)
    size = min(sample, len(x))
    centres, radii, ratios = [], [], []
    for _ in range(ensembles):
        s = x[rng.permutation(len(x))[:size]]
        dist = _distances(s, s, metric)
        np.fill_diagonal(dist, np.inf)
        nn = dist.argmin(1)
        r = dist.min(1)
        centres.append(s)
        radii.append(r)
        ratios.append(np.divide(r[nn], r, out=np.ones_like(r), where=r > 0))
    return {"centres": centres, "radii": radii, "ratios": ratios, "metric": metric}


def _distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    if metric == "euclidean":
        return np.sqrt(np.maximum((a**2).sum(1)[:, None] - 2 * a @ b.T + (b**2).sum(1)[None, :], 0))
    if metric == "chebyshev":
        return np.abs(a[:, None, :] - b[None, :, :]).max(2)
    if metric == "kolmogorov":
        if not (np.allclose(np.linalg.norm(a, axis=1), 1) and np.allclose(np.linalg.norm(b, axis=1), 1)):
            raise ValueError("kolmogorov distance needs unit vectors")
        return np.sqrt(np.maximum(1 - np.round(np.abs(a @ b.T), 10), 0))
    raise ValueError(f"unknown metric {metric}")


def score_inne(df: DataFrame, key: str, features: str, model: dict) -> DataFrame:
    """Mean anomaly score per row: 1 outside all spheres, else ``1 - r(nn)/r`` of the smallest sphere around it."""
    kind = df.schema[key].dataType.simpleString()

    def score(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf[features].to_numpy()).astype(float)
            total = np.zeros(len(x))
            for c, r, ratio in zip(model["centres"], model["radii"], model["ratios"]):
                inside = _distances(x, c, model["metric"]) <= r[None, :]
                best = np.where(inside, r[None, :], np.inf).argmin(1)
                total += np.where(inside.any(1), 1 - ratio[best], 1.0)
            yield pd.DataFrame({key: pdf[key], "score": total / len(model["centres"])})

    return df.select(key, features).mapInPandas(score, f"{key} {kind}, score double")

"""Batch recommenders: every function scores all users and returns ``user_id, item_id, score``.

``seen`` frames (``user_id, item_id``) are exclusions. A list is cut to ``k`` only after exclusions; where a list
is shared by many users, each user reads as many rows more as they exclude, so results stay exact and the
work is the output plus the exclusions.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewell.functions.scalars import divided
from tidewell.operators.filters import items_with_dims
from tidewell.operators.nearest import gram, nearest, times
from tidewell.operators.sets import symmetric
from tidewell.operators.sessions import recent_actions
from tidewell.operators.skew import dense_ids
from tidewell.operators.topk import global_rank, rescale_topk, select_topk_linear, topk, topk_by
from tidewell.operators.vectors import nearest_unseen
from tidewell.session import written

KEYS = ["user_id", "item_id"]
RECOMMENDERS: dict[str, Callable[..., DataFrame]] = {}


def register_recommender(name: str, fn: Callable[..., DataFrame]) -> None:
    """Make a user-written ``fn(**frames) -> recs`` available to ensembles by name."""
    RECOMMENDERS[name] = fn


def _without(recs: DataFrame, seen: DataFrame | None) -> DataFrame:
    return recs if seen is None else recs.join(seen.select(*KEYS), KEYS, "left_anti")


#: Most rows of a shared list that are ranked in one task.
HEAD = 100_000


def _most(k: int, seen: DataFrame | None) -> int:
    """The last rank any user can reach: ``k`` and the most exclusions of a user."""
    if seen is None:
        return k
    return k + (seen.select(*KEYS).dropDuplicates().groupBy("user_id").agg(F.count("*").alias("_n")).agg(F.max("_n")).first()[0] or 0)


def spread(users: DataFrame, ranked: DataFrame, k: int, seen: DataFrame | None = None, by: list[str] = ()) -> DataFrame:
    """The first ``k`` unseen rows of a shared ranked list (``item_id, score, rank``) for every user.

    ``by`` columns (in both frames) choose among several lists. A user reads ``k`` ranks plus one per exclusion, so a
    user with a long history costs nobody else anything. Ranks nobody can reach are cut off, which leaves a
    list small enough for adaptive execution to broadcast it.
    """
    keys = [*by, "rank"]
    if seen is None:
        asked = users.select("user_id", *by, F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"))
        return asked.join(ranked.where(F.col("rank") <= k), keys).select(*KEYS, "score")
    mine = seen.select(*KEYS).dropDuplicates()
    counts = mine.groupBy("user_id").agg(F.count("*").alias("_n"))
    most = k + (counts.agg(F.max("_n")).first()[0] or 0)  # a plain number, so the ranking keeps a group limit below its shuffle
    need = F.lit(k) + F.coalesce("_n", F.lit(0))
    asked = users.select("user_id", *by).join(counts, "user_id", "left")
    asked = asked.select("user_id", *by, F.explode(F.sequence(F.lit(1).cast("long"), need)).alias("rank"))
    rows = _without(asked.join(ranked.where(F.col("rank") <= most), keys), mine)
    first = rows.withColumn("_r", F.row_number().over(W.partitionBy("user_id", *by).orderBy("rank"))).where(F.col("_r") <= k)
    return first.select(*KEYS, "score")


# factor and vector models


def rec_mf(users: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None, candidates: DataFrame | None = None) -> DataFrame:
    """Inner product of user and item factors (``id, features``); optionally only candidate items."""
    target = items.select(F.col("id").alias("item_id"), "features")
    if candidates is not None:
        target = target.join(candidates.select("item_id"), "item_id", "left_semi")
    q = users.select(F.col("id").alias("query_id"), "features")
    if seen is None:
        found = nearest(q, target, k, metric="dot")
    else:
        found = nearest_unseen(q, target, seen.select(F.col("user_id").alias("query_id"), "item_id"), k, metric="dot")
    return found.withColumnRenamed("query_id", "user_id")


def fold_in(recent: DataFrame, items: DataFrame, users: DataFrame | None = None, invert: bool = True) -> DataFrame:
    """User vectors ``id, features`` from recent items: stored vector plus the sum of rows of ``Y (Y'Y)^-1``.

    Without ``invert`` (or with a singular ``Y'Y``): stored vector plus the L1-normalised sum of item factors.
    """
    rows = items
    if invert:
        g = gram(items)
        if np.linalg.matrix_rank(g) == len(g):
            rows = times(items, np.linalg.inv(g))
        else:
            invert = False
    flat = recent.join(rows.select(F.col("id").alias("item_id"), "features"), "item_id").select("user_id", F.posexplode("features").alias("i", "x"))
    sums = flat.groupBy("user_id", "i").agg(F.sum(F.col("x").cast("double")).alias("x"))
    packed = sums.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda t: t.x).alias("_f"))
    if not invert:
        size = F.aggregate("_f", F.lit(0.0), lambda a, x: a + F.abs(x))
        packed = packed.where(size > 0).select("user_id", divided("_f", size).alias("_f"))
    if users is None:
        return packed.select(F.col("user_id").alias("id"), F.col("_f").alias("features"))
    stored = users.select(F.col("id").alias("user_id"), F.transform("features", lambda x: x.cast("double")).alias("_u"))
    both = packed.join(stored, "user_id", "full_outer")
    added = F.when(F.col("_u").isNull(), F.col("_f")).when(F.col("_f").isNull(), F.col("_u")).otherwise(F.zip_with("_u", "_f", lambda a, b: a + b))
    return both.select(F.col("user_id").alias("id"), added.alias("features"))


def rec_mf_recent(recent: DataFrame, items: DataFrame, k: int, users: DataFrame | None = None, invert: bool = True) -> DataFrame:
    """Factor scores of folded-in user vectors, recent items excluded."""
    return rec_mf(fold_in(recent, items, users, invert), items, k, seen=recent)


def rec_mf_cluster(members: DataFrame, cluster_recs: DataFrame, k: int, seen: DataFrame | None = None) -> DataFrame:
    """Recommendations of the user's cluster without exclusions, rescaled to the best."""
    rows = members.select("user_id", "cluster_id").join(cluster_recs, "cluster_id").select(*KEYS, "score")
    return rescale_topk(_without(rows, seen), ["user_id"], k)


# similarity


def rec_item_sim(actions: DataFrame, sim: DataFrame, n_recent: int, k: int, seen: DataFrame | None = None) -> DataFrame:
    """Sum of similarities to the user's newest ``n_recent`` items; those items are excluded."""
    recent = recent_actions(actions, n_recent).select(*KEYS).dropDuplicates()
    near = symmetric(sim).select(F.col("item_a").alias("_from"), F.col("item_b").alias("item_id"), "score")
    hits = recent.withColumnRenamed("item_id", "_from").join(near, "_from").groupBy(*KEYS).agg(F.sum("score").alias("score"))
    return topk_by(_without(_without(hits, recent), seen), "user_id", k)


def rec_cooccurrence(
    queries: DataFrame, cooc: DataFrame, k: int, allow: DataFrame | None = None, block: DataFrame | None = None, item_dims: DataFrame | None = None, dims: list[str] = ()
) -> DataFrame:
    """Sum of co-occurrence counts over the query items; query items, allow list, block list and categories applied."""
    q = queries.select(*KEYS).dropDuplicates()
    hits = q.withColumnRenamed("item_id", "item_a").join(cooc, "item_a").groupBy("user_id", F.col("item_b").alias("item_id")).agg(F.sum("score").alias("score"))
    hits = _without(hits, q)
    if allow is not None:
        hits = hits.join(allow.select("item_id"), "item_id", "left_semi")
    if block is not None:
        hits = hits.join(block.select("item_id"), "item_id", "left_anti")
    if dims:
        hits = items_with_dims(hits, item_dims, list(dims))
    return topk_by(hits, "user_id", k)


def user_similarity(ratings: DataFrame, threshold: float = 0.1, hot_size: int = 5000, salt_size: int = 256) -> DataFrame:
    """Pearson correlation of users over co-rated items, above ``threshold``: ``user_a, user_b, sim`` (both directions).

    Two common items are needed for a correlation. The item with most raters (beyond ``hot_size``) is not expanded into
    pairs: users meeting only there have no correlation, all others are found through their other items and
    get that item's part added from a per-user lookup. Other items are salted by size.
    """
    top = ratings.groupBy("item_id").agg(F.count("*").alias("n")).where(F.col("n") > hot_size).orderBy(F.desc("n"), "item_id").limit(1).collect()
    light = ratings.where(F.col("item_id") != F.lit(top[0].item_id)) if top else ratings
    sums = _common_sums(light, salt_size)
    x, y = F.col("x"), F.col("y")
    if top:
        hot = ratings.where(F.col("item_id") == F.lit(top[0].item_id))
        sums = sums.join(hot.select(F.col("user_id").alias("user_a"), F.col("rating").alias("x")), "user_a", "left")
        sums = sums.join(hot.select(F.col("user_id").alias("user_b"), F.col("rating").alias("y")), "user_b", "left")
        both = x.isNotNull() & y.isNotNull()
        more = {"n": F.lit(1), "sx": x, "sy": y, "sxx": x * x, "syy": y * y, "sxy": x * y}
        sums = sums.withColumns({c: F.col(c) + F.when(both, v).otherwise(0) for c, v in more.items()})
    sim = sums.select("user_a", "user_b", _pearson().alias("sim")).where(F.col("sim") > threshold)
    ends = F.array(F.struct("user_a", "user_b"), F.struct(F.col("user_b").alias("user_a"), F.col("user_a").alias("user_b")))
    return sim.select(F.explode(ends).alias("e"), "sim").select("e.*", "sim")


def _correlations(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Pearson correlation of every two rows over the columns both have (missing is nan); nan where there is none."""
    ml, mr = ~np.isnan(left), ~np.isnan(right)
    x, y, ml, mr = np.where(ml, left, 0), np.where(mr, right, 0), ml.astype(float), mr.astype(float)
    n, sx, sy, sxx, syy, sxy = ml @ mr.T, x @ mr.T, ml @ y.T, (x * x) @ mr.T, ml @ (y * y).T, x @ y.T
    va, vb = n * sxx - sx * sx, n * syy - sy * sy
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where((va > 0) & (vb > 0), (n * sxy - sx * sy) / np.sqrt(va * vb), np.nan)


#: Classes of a block.
BLOCK_CLASSES = 512


def _class_similarity(classes: DataFrame, bits: int, threshold: float) -> DataFrame:
    """(cls, other, sim) of classes (``cls, sig``: array of bit and rating) above ``threshold``; blocks of classes meet in matrix products."""
    n = max(1, -(-classes.count() // BLOCK_CLASSES))
    blocks = classes.groupBy(F.pmod("cls", F.lit(n)).alias("part")).agg(F.collect_list(F.struct("cls", "sig")).alias("rows"))
    asked = blocks.select("rows", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("part"))
    met = asked.join(blocks.withColumnRenamed("rows", "others"), "part")

    def ratings(rows) -> np.ndarray:
        out = np.full((len(rows), bits), np.nan)
        for i, r in enumerate(rows):
            for x in r["sig"]:
                out[i, x["bit"]] = x["rating"]
        return out

    def run(batches):
        for pdf in batches:
            for rows, others in zip(pdf["rows"], pdf["others"]):
                sim = _correlations(ratings(rows), ratings(others))
                i, j = np.nonzero(sim > threshold)
                a, b = (np.array([r["cls"] for r in x]) for x in (rows, others))
                yield pd.DataFrame({"cls": a[i], "other": b[j], "sim": sim[i, j]})

    return met.select("rows", "others").mapInPandas(run, "cls bigint, other bigint, sim double")


#: Pairs of raters that are always listed, items of a row of ratings, ratings compared in the time of listing a pair, users and ratings of a block.
LISTED, MOST_COLUMNS, DENSE, RATERS, RATINGS = 20_000_000, 4096, 500, 16384, 8_000_000


class _Raters:
    """A block of users while others stream by: weighted sums of their neighbours' ratings. The last column is the item without an id, which makes no one alike."""

    def __init__(self, rows: pa.StructArray, width: int):
        self.users, self.x = self.read(rows, width)
        self.num, self.den, self.width = np.zeros(self.x.shape), np.zeros(self.x.shape), width

    @staticmethod
    def read(rows: pa.StructArray, width: int) -> tuple[np.ndarray, np.ndarray]:
        part = dict(zip((f.name for f in rows.type), rows.flatten()))
        sizes = pc.list_value_length(part["s"]).to_numpy(zero_copy_only=False)
        item, rating = part["s"].flatten().flatten()
        out = np.full((len(rows), width + 1), np.nan)
        out[np.repeat(np.arange(len(rows)), sizes), item.to_numpy(zero_copy_only=False)] = rating.to_numpy(zero_copy_only=False)
        return part["u"].to_numpy(zero_copy_only=False), out

    def meet(self, rows: pa.StructArray, threshold: float) -> None:
        users, other = self.read(rows, self.width)
        rated, known = np.nan_to_num(other), (~np.isnan(other)).astype(float)
        for at in range(0, len(self.x), BLOCK_CLASSES):
            part = slice(at, at + BLOCK_CLASSES)
            sim = _correlations(self.x[part, :-1], other[:, :-1])
            sim[~(sim > threshold) | (self.users[part, None] == users[None, :])] = 0
            self.num[part] += sim @ rated
            self.den[part] += sim @ known

    def best(self, k: int) -> pa.RecordBatch:
        """(u, i, score) of the items a user has not rated, that may be among the ``k`` best once scores are rounded."""
        rated = ~np.isnan(self.x)
        rated[:, -1] = False
        with np.errstate(invalid="ignore", divide="ignore"):
            score = np.where((self.den > 0) & ~rated, self.num / self.den, -np.inf)
        at = min(k, score.shape[1])
        i, j = np.nonzero((score >= -np.partition(-score, at - 1, axis=1)[:, at - 1 : at] - 1e-8) & (score > -np.inf))
        return pa.RecordBatch.from_arrays([pa.array(self.users[i]), pa.array(j.astype(np.int32)), pa.array(score[i, j])], names=["u", "i", "score"])


def _rated_in_blocks(ratings: DataFrame, items: int, everyone: int, k: int, threshold: float) -> DataFrame:
    """``rec_user_based`` for many users of few items. A block of users stands in one task while all others stream by, and only the best rows leave it."""
    rated = ratings.where("user_id is not null").select("user_id", "item_id", F.col("rating").cast("double").alias("rating"))
    names = rated.select("item_id").where("item_id is not null").distinct()
    names = written(dense_ids(names, "item_id", "i").select("item_id", (F.col("i") - 1).cast("int").alias("i")), "items")
    cell = F.struct(F.coalesce("i", F.lit(items)).alias("i"), "rating")
    packed = rated.join(names, "item_id", "left").groupBy("user_id").agg(F.collect_list(cell).alias("s"))
    packed = written(dense_ids(packed, "user_id", "u"), "user-ratings")
    size = max(1, min(RATERS, RATINGS // (items + 1), max(BLOCK_CLASSES, -(-everyone // (4 * ratings.sparkSession.sparkContext.defaultParallelism)))))
    owners, others = -(-everyone // size), -(-everyone // BLOCK_CLASSES)
    rows = F.collect_list(F.struct("u", "s")).alias("rows")
    asked = packed.groupBy(F.pmod("u", F.lit(owners)).cast("int").alias("own")).agg(rows).select("own", F.lit(0).alias("kind"), "rows")
    met = packed.groupBy(F.pmod("u", F.lit(others)).alias("part")).agg(rows)
    met = met.select(F.explode(F.sequence(F.lit(0), F.lit(owners - 1))).alias("own"), F.lit(1).alias("kind"), "rows")
    parts = max(int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions")), 2 * owners)
    stream = asked.unionByName(met).repartition(parts, F.struct("own")).sortWithinPartitions("own", "kind")

    def run(batches):
        block = None
        for batch in batches:
            kinds, lists = batch.column("kind").to_pylist(), batch.column("rows")
            for kind, users in zip(kinds, lists):
                if kind == 1:
                    block.meet(users.values, threshold)
                    continue
                if block is not None:
                    yield block.best(k)
                block = _Raters(users.values, items)
        if block is not None:
            yield block.best(k)

    found = stream.mapInArrow(run, "u bigint, i int, score double").join(packed.select("u", "user_id"), "u").join(names, "i", "left")
    return topk_by(found.select(*KEYS, "score").withColumn("_s", F.round("score", 9)), "user_id", k, score="_s").drop("_s")


def rec_user_based(ratings: DataFrame, k: int, threshold: float = 0.1, hot_size: int = 5000) -> DataFrame:
    """Mean of the neighbours' ratings weighted by similarity, for items the user has not rated.

    Items with more than ``hot_size`` raters never make pairs of users. Users with the same ratings of these hot items form a class; what
    a class's neighbours say comes from sums per class and item, and pairs of users who also meet at another item are corrected by
    the difference to their true similarity. Exact. The work of the hot part grows with the square of the number of classes, that is of
    different ratings of the hot items, and not with the number of users; with graded ratings and few hot items it is bounded
    by the grades to the power of the hot items. Where users meet at so many of few items that products of whole rows of ratings are less
    work than listing their pairs, blocks of users meet in such products instead (``_rated_in_blocks``).
    """
    sizes = written(ratings.groupBy("item_id").agg(F.count("*").alias("n"), F.count_if(F.col("rating").isNull()).alias("gone")), "raters")
    items, listed, gone = sizes.where("item_id is not null").agg(F.count("*"), F.sum(F.col("n").cast("double") * F.col("n")), F.sum("gone")).first()
    if threshold >= 0 and items <= MOST_COLUMNS and (listed or 0) > LISTED and not gone:
        everyone = ratings.select("user_id").where("user_id is not null").distinct().count()
        if float(everyone) ** 2 * items <= DENSE * listed:
            return _rated_in_blocks(ratings, items, everyone, k, threshold)
    hot = sizes.where(F.col("n") > hot_size).select("item_id")
    hot = written(dense_ids(hot, "item_id", "bit").select("item_id", (F.col("bit") - 1).cast("int").alias("bit")), "hot-items")
    bits = hot.count()
    if not bits:
        near = user_similarity(ratings, threshold, hot_size)
        other = ratings.select(F.col("user_id").alias("user_b"), "item_id", "rating")
        est = near.join(other, "user_b").groupBy(F.col("user_a").alias("user_id"), "item_id").agg((F.sum(F.col("sim") * F.col("rating")) / F.sum("sim")).alias("score"))
        best = _without(est, ratings).withColumn("_s", F.round("score", 9))
        return topk_by(best, "user_id", k, score="_s").drop("_s")
    rated = ratings.select("user_id", "item_id", F.col("rating").cast("double").alias("rating"))
    one = F.struct("bit", "rating")
    signed = rated.join(hot, "item_id").groupBy("user_id").agg(F.array_sort(F.collect_list(one)).alias("sig"))
    classes = written(dense_ids(signed.select("sig").dropDuplicates(), "sig", "cls"), "classes").select("cls", "sig")
    users = written(signed.join(classes, "sig").select("user_id", "cls", "sig"), "user-classes")
    class_sim = written(_class_similarity(classes, bits, threshold), "class-sim")
    said = rated.join(users.select("user_id", "cls"), "user_id").groupBy(F.col("cls").alias("other"), "item_id").agg(F.sum("rating").alias("r"), F.count("*").alias("c"))
    sums = (F.sum(F.col("sim") * F.col("r")).alias("num"), F.sum(F.col("sim") * F.col("c")).alias("den"), F.sum("c").alias("voices"))
    by_class = written(class_sim.join(said, "other").groupBy("cls", "item_id").agg(*sums), "class-votes")

    # pairs that meet at other items: their true similarity in place of that of their classes
    pairs = written(_pair_similarity(rated.join(hot, "item_id", "left_anti"), users), "user-pairs")
    known = class_sim.select(F.col("cls").alias("cls_a"), F.col("other").alias("cls_b"), F.col("sim").alias("was"))
    changed = pairs.join(known, ["cls_a", "cls_b"], "left")
    weight = F.when(F.col("sim") > threshold, F.col("sim")).otherwise(0.0)
    more = F.when(F.col("sim") > threshold, 1).otherwise(0) - F.when(F.col("was").isNotNull(), 1).otherwise(0)
    changed = changed.select("user_a", "user_b", (weight - F.coalesce("was", F.lit(0.0))).alias("d"), more.alias("v")).where("d <> 0")
    ends = F.array(F.struct("user_a", "user_b"), F.struct(F.col("user_b").alias("user_a"), F.col("user_a").alias("user_b")))
    changed = changed.select(F.explode(ends).alias("e"), "d", "v").select(F.col("e.user_a").alias("user_id"), F.col("e.user_b").alias("_from"), "d", "v")
    votes = changed.join(rated.withColumnRenamed("user_id", "_from"), "_from").groupBy(*KEYS)
    votes = votes.agg(F.sum(F.col("d") * F.col("rating")).alias("dnum"), F.sum("d").alias("dden"), F.sum("v").alias("dvoices"))
    votes = written(_without(votes, rated), "corrections")
    own = users.select("user_id", "cls")
    fixed = votes.join(own, "user_id", "left").join(by_class, ["cls", "item_id"], "left")
    total = {c: F.coalesce(c, F.lit(0)) + F.col(f"d{c}") for c in ("num", "den", "voices")}
    fixed = fixed.where(total["voices"] > 0).select(*KEYS, (total["num"] / total["den"]).alias("score"))
    lists = by_class.select("cls", "item_id", (F.col("num") / F.col("den")).alias("score"))
    rank = F.row_number().over(W.partitionBy("cls").orderBy(F.desc(F.round("score", 9)), "item_id"))
    shared = spread(own, lists.withColumn("rank", rank), k, rated.select(*KEYS).unionByName(votes.select(*KEYS)), ["cls"])
    best = shared.select(*KEYS, "score").unionByName(fixed).withColumn("_s", F.round("score", 9))
    return topk_by(best, "user_id", k, score="_s").drop("_s")


def _pair_similarity(light: DataFrame, users: DataFrame, salt_size: int = 256) -> DataFrame:
    """(user_a < user_b, cls_a, cls_b, sim) of users who meet at an item of ``light``: correlation over all common items, those of their signatures included."""
    ends = [users.select(F.col("user_id").alias(f"user_{e}"), F.col("cls").alias(f"cls_{e}"), F.col("sig").alias(f"sig_{e}")) for e in "ab"]
    sums = _common_sums(light, salt_size).join(ends[0], "user_a", "left").join(ends[1], "user_b", "left")
    # the ratings of the hot items both have
    mine, theirs = (F.map_from_entries(F.coalesce(f"sig_{e}", F.array().cast("array<struct<bit:int,rating:double>>"))) for e in "ab")
    common = F.map_filter(F.map_zip_with(mine, theirs, lambda _, x, y: F.struct(x.alias("x"), y.alias("y"))), lambda _, p: p["x"].isNotNull() & p["y"].isNotNull())
    sums = sums.withColumn("both", F.map_values(common))

    def add(term) -> Column:
        return F.aggregate("both", F.lit(0.0), lambda acc, p: acc + term(p["x"], p["y"]))

    parts = {"sx": lambda x, y: x, "sy": lambda x, y: y, "sxx": lambda x, y: x * x, "syy": lambda x, y: y * y, "sxy": lambda x, y: x * y}
    sums = sums.withColumns({"n": F.col("n") + F.size("both")} | {c: F.col(c) + add(t) for c, t in parts.items()})
    return sums.select("user_a", "user_b", "cls_a", "cls_b", _pearson().alias("sim"))


def _pearson() -> Column:
    """Correlation from n and the sums; null where there is none."""
    va = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vb = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    return F.when((va > 0) & (vb > 0), (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / F.sqrt(va * vb))


def _common_sums(light: DataFrame, salt_size: int) -> DataFrame:
    """n, sx, sy, sxx, syy, sxy of every two users ``user_a < user_b`` over their common items; items are salted by size."""
    sizes = light.groupBy("item_id").agg(F.ceil(F.count("*") / salt_size).cast("int").alias("_s"))
    sized = light.join(sizes, "item_id")
    a = sized.select("item_id", F.col("user_id").alias("user_a"), F.col("rating").alias("x"), F.pmod(F.xxhash64("user_id"), "_s").cast("int").alias("salt"))
    b = sized.select("item_id", F.col("user_id").alias("user_b"), F.col("rating").alias("y"), F.explode(F.sequence(F.lit(0), F.col("_s") - 1)).alias("salt"))
    x, y = F.col("x"), F.col("y")
    met = a.join(b, ["item_id", "salt"]).where("user_a < user_b").groupBy("user_a", "user_b")
    return met.agg(F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"), F.sum(y * y).alias("syy"), F.sum(x * y).alias("sxy"))


# topics


def item_topics(item_tags: DataFrame, tag_topics: DataFrame, topics: int, min_tags: int) -> DataFrame:
    """Topic mix per item (``item_id, features``): tag weights summed per topic over their total; items need ``min_tags`` tags."""
    enough = item_tags.groupBy("item_id").agg(F.count("*").alias("n")).where(F.col("n") >= min_tags).select("item_id")
    w = item_tags.join(enough, "item_id", "left_semi").join(tag_topics, "tag").groupBy("item_id", "topic").agg(F.sum("weight").alias("w"))
    total = w.groupBy("item_id").agg(F.sum("w").alias("_t"), F.map_from_entries(F.collect_list(F.struct("topic", "w"))).alias("m"))
    ids = F.array(*[F.lit(i) for i in range(topics)])
    mix = F.transform(ids, lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0.0)) / F.col("_t"))
    return total.where("_t > 0").select("item_id", mix.alias("features"))


def rec_topics(user_mix: DataFrame, item_mix: DataFrame, seen: DataFrame, k: int) -> DataFrame:
    """Inner product of user and item topic mixes, seen items excluded, rescaled to the best."""
    q = user_mix.select(F.col("user_id").alias("query_id"), "features")
    found = nearest_unseen(q, item_mix, seen.select(F.col("user_id").alias("query_id"), "item_id"), k, metric="dot")
    return rescale_topk(found.withColumnRenamed("query_id", "user_id"), ["user_id"], k)


def rec_topics_recent(recent: DataFrame, item_mix: DataFrame, k: int) -> DataFrame:
    """User mix = mean of the mixes of the recent items; then as ``rec_topics``."""
    flat = recent.join(item_mix, "item_id").select("user_id", F.posexplode("features").alias("i", "x")).groupBy("user_id", "i").agg(F.avg("x").alias("x"))
    mix = flat.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda t: t.x).alias("features"))
    return rec_topics(mix, item_mix, recent, k)


# counters


def _weighted_lists(user_keys: DataFrame, lists: DataFrame, key: str, seen: DataFrame | None, k: int, min_items: int) -> DataFrame:
    """Sum over a user's keys of ``count / list maximum * weight``; too short results give nothing; rescaled."""
    top = lists.groupBy(key).agg(F.max("count").alias("_m")).where("_m > 0")
    share = lists.join(top, key).select(key, "item_id", (F.col("count") / F.col("_m")).alias("_c"))
    rows = user_keys.join(share, key).groupBy(*KEYS).agg(F.sum(F.col("_c") * F.col("weight")).alias("score"))
    rows = _without(rows, seen)
    enough = rows.groupBy("user_id").agg(F.count("*").alias("_n")).where(F.col("_n") >= min(min_items, k)).select("user_id")
    return rescale_topk(rows.join(enough, "user_id", "left_semi"), ["user_id"], k)


def rec_cluster_counts(
    user_clusters: DataFrame,
    cluster_lists: DataFrame,
    k: int,
    seen: DataFrame | None = None,
    long_weight: float = 1.0,
    short_clusters: DataFrame | None = None,
    short_weight: float = 1.0,
    referrer_clusters: DataFrame | None = None,
    min_items: int = 1,
) -> DataFrame:
    """Top counts of the user's clusters, each over its maximum, times cluster and long/short-term weight.

    ``cluster_lists``: ``cluster_id, item_id, count``, at most ``5*k`` per cluster. Referrer clusters weigh 1
    and take part in the long-term weight.
    """
    keys = user_clusters.select("user_id", "cluster_id", (F.col("weight") * long_weight).alias("weight"))
    if short_clusters is not None:
        keys = keys.unionByName(short_clusters.select("user_id", "cluster_id", (F.col("weight") * short_weight).alias("weight")))
    if referrer_clusters is not None:
        keys = keys.unionByName(referrer_clusters.select("user_id", "cluster_id", F.lit(long_weight).alias("weight")))
    lists = topk_by(cluster_lists, "cluster_id", 5 * k, score="count")
    return _weighted_lists(keys, lists, "cluster_id", seen, k, min_items)


def rec_global_counts(users: DataFrame, counts: DataFrame, k: int, seen: DataFrame | None = None) -> DataFrame:
    """Globally most counted items (``item_id, count``) without exclusions, rescaled per user."""
    ranked = global_rank(counts.select("item_id", F.col("count").alias("score")))
    return rescale_topk(spread(users, ranked, k, seen), ["user_id"], k)


def rec_from_item(current: DataFrame, item_clusters: DataFrame, cluster_lists: DataFrame, k: int, seen: DataFrame | None = None, min_items: int = 1) -> DataFrame:
    """Counts of the current item's clusters (its dimensions or its item cluster), weight 1. ``current``: ``user_id, item_id``."""
    keys = current.join(item_clusters, "item_id").select("user_id", "cluster_id", F.lit(1.0).alias("weight")).dropDuplicates()
    lists = topk_by(cluster_lists, "cluster_id", 5 * k, score="count")
    return _weighted_lists(keys, lists, "cluster_id", seen, k, min_items)


def cluster_sort(lists: DataFrame, user_clusters: DataFrame, counts: DataFrame, weight: float = 1.0, fill: bool = False) -> DataFrame:
    """Order a given list by the user's weighted cluster counts. ``lists``: ``user_id, item_id, pos``.

    A count is divided by the cluster's maximum over the listed items. Items without counts come last, or are
    left out with ``fill`` (the caller tops up with popular items). Users without clusters vanish.
    """
    mine = user_clusters.select("user_id", "cluster_id", (F.col("weight") * weight).alias("weight"))
    cells = lists.join(mine, "user_id").join(counts.select("cluster_id", "item_id", "count"), ["cluster_id", "item_id"])
    top = cells.groupBy("user_id", "cluster_id").agg(F.max("count").alias("_m")).where("_m > 0")
    score = cells.join(top, ["user_id", "cluster_id"]).groupBy(*KEYS).agg(F.sum(F.col("count") / F.col("_m") * F.col("weight")).alias("score"))
    known = lists.join(mine.select("user_id"), "user_id", "left_semi").join(score, KEYS, "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    known = known.where("score > 0") if fill else known
    rank = F.row_number().over(W.partitionBy("user_id").orderBy(F.desc(F.round("score", 10)), "item_id"))
    return known.withColumn("rank", rank).select(*KEYS, "score", "rank")


def rec_tag_affinity(affinity: DataFrame, tag_counts: DataFrame, k: int, seen: DataFrame | None = None, min_items: int = 1) -> DataFrame:
    """Top items of the user's tags, each count over the tag's maximum times the affinity, summed and rescaled.

    ``tag_counts``: ``tag, item_id, count``, cut to ``2*k`` per tag.
    """
    lists = topk_by(tag_counts, "tag", 2 * k, score="count")
    return _weighted_lists(affinity.select("user_id", "tag", "weight"), lists, "tag", seen, k, min_items)


def rec_popular(users: DataFrame, popularity: DataFrame, k: int, seen: DataFrame | None = None, item_dims: DataFrame | None = None, dims: list[str] = ()) -> DataFrame:
    """Recently popular items (``item_id, score``), optionally in dimensions, without exclusions, rescaled."""
    if dims:
        popularity = items_with_dims(popularity, item_dims, list(dims))
    return rescale_topk(spread(users, global_rank(popularity.select("item_id", "score")), k, seen), ["user_id"], k)


def rec_popular_dim(user_dims: DataFrame, popularity: DataFrame, item_dims: DataFrame, k: int, seen: DataFrame | None = None) -> DataFrame:
    """Popular items inside the user's dimension (``user_id, dim``), rescaled."""
    per_dim = popularity.join(item_dims.select("item_id", "dim"), "item_id")
    ranked = per_dim.withColumn("rank", F.row_number().over(W.partitionBy("dim").orderBy(F.desc("score"), "item_id")))
    rows = spread(user_dims.select("user_id", "dim"), ranked, k, seen, ["dim"])
    best = rows.groupBy(*KEYS).agg(F.max("score").alias("score"))  # an item may be in several of the user's dimensions
    return rescale_topk(best, ["user_id"], k)


def reorder_by_popularity(lists: DataFrame, popularity: DataFrame) -> DataFrame:
    """A given list (``user_id, item_id``) in popularity order; unknown items count 0."""
    scored = lists.join(popularity.select("item_id", "score"), "item_id", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    rank = F.row_number().over(W.partitionBy("user_id").orderBy(F.desc("score"), "item_id"))
    return scored.withColumn("rank", rank).select(*KEYS, "score", "rank")


def session_scores(rows: Column, k: int) -> Column:
    """Scores given to one user's candidates: an array of (item_id, score), an item once for each time it is scored.

    ``rows``: array of (rank, a, pos, item_id, count) in order. Each attribute ``a`` of a depth (``rank``) has a scale: its first count
    stands for the ceiling, which is 1 at the start of a depth and then the last score given before. A list ends when ``k`` different items are
    scored, and later attributes of a full depth are left out; a new depth adds its first row all the same. One fold over the array, in the JVM.
    """
    item = "array<bigint>"
    start = F.struct(
        F.lit(None).cast("int").alias("rank"), F.lit(None).cast("int").alias("a"), F.lit(1.0).alias("ceiling"), F.lit(1.0).alias("low"), F.lit(0.0).alias("top"),
        F.lit(False).alias("full"), F.lit(False).alias("left_out"), F.array().cast(item).alias("items"),
        F.array().cast("array<struct<item_id:bigint,score:double>>").alias("given"),
    )

    def step(acc: Column, x: Column) -> Column:
        deeper = ~acc["rank"].eqNullSafe(x["rank"])
        other = deeper | (acc["a"] != x["a"])
        left_out = ~deeper & (acc["left_out"] | (other & (F.size(acc["items"]) >= k)))
        scale = F.struct(
            left_out.alias("left_out"),
            F.when(deeper, 1.0).when(other, acc["low"]).otherwise(acc["ceiling"]).alias("ceiling"),
            F.when(other, 1.0).otherwise(acc["low"]).alias("low"),
            F.when(other | (acc["top"] == 0), F.when(left_out, 0.0).otherwise(x["count"])).otherwise(acc["top"]).alias("top"),
            (~other & acc["full"]).alias("full"),
        )
        return F.transform(F.array(scale), lambda s: scored(acc, x, s))[0]

    def scored(acc: Column, x: Column, s: Column) -> Column:
        out = s["left_out"] | s["full"]
        value = F.when(s["top"] == 0, 0.0).otherwise(x["count"] / s["top"] * s["ceiling"])
        items = F.when(out, acc["items"]).otherwise(F.array_union(acc["items"], F.array(x["item_id"])))
        return F.struct(
            x["rank"].cast("int").alias("rank"), x["a"].cast("int").alias("a"), s["ceiling"].alias("ceiling"), F.when(out, s["low"]).otherwise(value).alias("low"),
            s["top"].alias("top"), F.when(out, s["full"]).otherwise(F.size(items) >= k).alias("full"), s["left_out"].alias("left_out"), items.alias("items"),
            F.when(out, acc["given"]).otherwise(F.array_append(acc["given"], F.struct(x["item_id"].alias("item_id"), value.alias("score")))).alias("given"),
        )

    return F.aggregate(rows, start, step, lambda acc: acc["given"])


def rec_popular_session(
    recent: DataFrame, item_attrs: DataFrame, dim_lists: DataFrame, attrs: list[str], depth: int, k: int, list_size: int = 100, seen: DataFrame | None = None
) -> DataFrame:
    """Popular items of the dimensions of a user's last viewed items.

    ``recent``: ``user_id, item_id, rank``; ``item_attrs``: ``item_id, attr, dim``; ``dim_lists``: ``dim, item_id, count``.
    A user's candidates number at most ``depth * len(attrs) * list_size``.
    """
    order = F.lit(-1)
    for i, a in enumerate(attrs):
        order = F.when(F.col("attr") == a, F.lit(i)).otherwise(order)
    chosen = item_attrs.where(F.col("attr").isin(attrs)).select("item_id", order.alias("a"), "dim")
    lists = topk_by(dim_lists, "dim", list_size, score="count", rank="pos").select("dim", F.col("item_id").alias("cand"), "count", "pos")
    rows = recent.where(F.col("rank") <= depth).join(chosen, "item_id").join(lists, "dim").select("user_id", "rank", "a", "pos", F.col("cand").alias("item_id"), "count")
    rows = _without(rows, seen)
    one = F.struct("rank", "a", "pos", F.col("item_id").cast("long").alias("item_id"), F.col("count").cast("double").alias("count"))
    packed = rows.groupBy("user_id").agg(F.array_sort(F.collect_list(one)).alias("r"))
    given = packed.select("user_id", F.explode(session_scores(F.col("r"), k)).alias("g")).select("user_id", "g.*")
    return rescale_topk(given.groupBy("user_id", "item_id").agg(F.sum("score").alias("score")), ["user_id"], k)


def rec_recent(users: DataFrame, items: DataFrame, k: int, seen: DataFrame | None = None) -> DataFrame:
    """Newest items (largest ids) per user, scored ``1 - i/n``; only the head that a user can reach is ranked."""
    scored = items.select("item_id", F.col("item_id").cast("double").alias("score"))
    most = _most(k, seen)
    head = topk(scored, most).withColumn("rank", F.row_number().over(W.orderBy(F.desc("score"), "item_id"))) if most <= HEAD else None
    ranked = global_rank(scored) if head is None else head
    rows = spread(users, ranked, k, seen).withColumnRenamed("score", "_age")
    return select_topk_linear(rows, ["user_id"], k, [F.desc("_age")]).select(*KEYS, "score")


def rec_recent_category(current: DataFrame, item_dims: DataFrame, k: int, group: str | None = None) -> DataFrame:
    """Newest items in the dimension of the user's current item (itself excluded), scored ``1 - i/n``."""
    dims = item_dims if group is None else item_dims.where(F.col("dim_group") == group)
    mine = current.join(dims.select("item_id", "dim"), "item_id").select("user_id", F.col("item_id").alias("_now"), "dim")
    newest = topk_by(dims.select("dim", "item_id", F.col("item_id").alias("_age")), "dim", k + 1, score="_age")
    rows = mine.join(newest, "dim").where("item_id <> _now").select("user_id", "item_id").dropDuplicates()
    return select_topk_linear(rows, ["user_id"], k, [F.desc("item_id")]).select(*KEYS, "score")


def rec_static(stored: DataFrame, k: int, item_dims: DataFrame | None = None, dims: list[str] = ()) -> DataFrame:
    """Precomputed ``user_id, item_id, score`` rows, optionally in dimensions."""
    rows = items_with_dims(stored, item_dims, list(dims)) if dims else stored
    return topk_by(rows.select(*KEYS, "score"), "user_id", k)


# filters and includers: frames of (user_id, item_id)


def filter_current(recs: DataFrame, current: DataFrame) -> DataFrame:
    """Without the item being viewed."""
    return _without(recs, current)


def filter_recent(recs: DataFrame, actions: DataFrame, n: int) -> DataFrame:
    """Without the user's newest ``n`` items."""
    return _without(recs, recent_actions(actions, n))


def filter_ignored(recs: DataFrame, shown: DataFrame, clicked: DataFrame) -> DataFrame:
    """Without items shown to the user but not clicked."""
    ignored = shown.select(*KEYS).join(clicked.select(*KEYS), KEYS, "left_anti")
    return _without(recs, ignored)


def filter_tag_affinity(user_clusters: DataFrame, clusters: DataFrame, item_tags: DataFrame, n: int) -> DataFrame:
    """Exclusions: for groups the user has a cluster in, the newest ``n`` items of the group's other clusters unless
    they are also among those of one of the user's. ``clusters``: ``tag, tag_group, cluster``."""
    tagged = clusters.join(item_tags, "tag").select("cluster", "item_id").dropDuplicates()
    newest = topk_by(tagged.withColumn("_age", F.col("item_id")), "cluster", n, score="_age").select("cluster", "item_id")
    groups = clusters.select("tag_group", "cluster").distinct()
    mine = user_clusters.select("user_id", "cluster").dropDuplicates()
    reach = mine.join(groups, "cluster").select("user_id", "tag_group").dropDuplicates().join(groups, "tag_group").select("user_id", "cluster")
    mine_in = mine.join(groups.select("cluster").distinct(), "cluster", "left_semi")
    others = reach.join(mine, ["user_id", "cluster"], "left_anti")
    bad = others.join(newest, "cluster").select(*KEYS).dropDuplicates()
    good = mine_in.join(newest, "cluster").select(*KEYS)
    return bad.join(good, KEYS, "left_anti")


def include_recent(users: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """Candidates: the newest ``n`` items."""
    return rec_recent(users, items, n).select(*KEYS)


def include_popular(users: DataFrame, popularity: DataFrame, n: int) -> DataFrame:
    """Candidates: the ``n`` most popular items."""
    return spread(users, global_rank(popularity.select("item_id", "score")), n).select(*KEYS)


def include_explicit(users: DataFrame, items: list[int]) -> DataFrame:
    """Candidates: a configured list of items."""
    return users.select("user_id", F.explode(F.array(*[F.lit(i).cast("long") for i in items])).alias("item_id"))

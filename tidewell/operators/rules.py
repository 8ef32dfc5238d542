"""Frequent itemsets and association rules."""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window as W, functions as F

from tidewell.operators.topk import rescale_topk


def itemsets(baskets: DataFrame, min_support: float) -> DataFrame:
    """``(items sorted, freq)`` of all frequent itemsets; duplicates inside a basket count once."""
    clean = baskets.select(F.array_distinct("items").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support).fit(clean)
    return model.freqItemsets.select(F.array_sort("items").alias("items"), "freq")


def assoc_rules(
    baskets: DataFrame,
    min_support: float = 0.005,
    min_freq: int = 0,
    max_size: int = 5,
    min_confidence: float = 0.2,
    min_interest: float = 0.1,
    min_lift: float = 0.0,
) -> DataFrame:
    """Rules ``antecedent -> item`` of every frequent itemset with more than one item.

    ``confidence = s(AB)/s(A)``, ``interest = confidence - s(B)``, ``lift = confidence/s(B)``; supports are
    looked up among itemsets with ``freq > min_freq`` and at most ``max_size`` items.
    """
    total = baskets.agg(F.count("*")).scalar()
    sets = itemsets(baskets, min_support)
    known = sets.where((F.col("freq") > min_freq) & (F.size("items") <= max_size))
    known = known.select("items", (F.col("freq") / total).alias("support"))
    split = sets.where(F.size("items") > 1).select("items", "freq", F.explode("items").alias("item"))
    split = split.select(F.filter("items", lambda x: x != F.col("item")).alias("antecedent"), "item", (F.col("freq") / total).alias("s_ab"))
    single = known.where(F.size("items") == 1).select(F.col("items")[0].alias("item"), F.col("support").alias("s_b"))
    rules = split.join(known.select(F.col("items").alias("antecedent"), F.col("support").alias("s_a")), "antecedent").join(single, "item")
    rules = rules.withColumn("confidence", F.col("s_ab") / F.col("s_a"))
    rules = rules.withColumn("interest", F.col("confidence") - F.col("s_b")).withColumn("lift", F.col("confidence") / F.col("s_b"))
    return rules.where(
        (F.col("confidence") > min_confidence) & (F.col("interest") > min_interest) & (F.col("lift") >= min_lift)
    ).select("antecedent", "item", "confidence", "interest", "lift")


def last_baskets(events: DataFrame, add: int, remove: int, order: list[str], max_items: int = 4) -> DataFrame:
    """Current basket per user from add/remove events: the newest ``max_items`` items whose last event is an add."""
    kept = events.where(F.col("kind").isin(add, remove))
    last = kept.groupBy("user_id", "item_id").agg(F.max(F.struct(*order, "kind")).alias("x")).where(F.col("x.kind") == add)
    rank = F.row_number().over(W.partitionBy("user_id").orderBy(*[F.desc(f"x.{c}") for c in order], F.desc("item_id")))
    newest = last.withColumn("_r", rank).where(F.col("_r") <= max_items)
    return newest.groupBy("user_id").agg(F.array_sort(F.collect_list("item_id")).alias("items"))


def contained_rules(baskets: DataFrame, rules: DataFrame, key: str = "user_id") -> DataFrame:
    """Every (basket, rule) whose antecedent lies in the basket, for baskets of any size; the basket's columns and the rule's.

    Each rule is indexed under the rarest item of its antecedent, so a basket meets a rule at most once and frequent
    items lead to few rules; the other items are looked up in the basket it meets.
    """
    entries = baskets.select(key, F.array_distinct("items").alias("items")).withColumn("_at", F.explode("items"))
    wanted = rules.select(F.explode("antecedent").alias("_at")).dropDuplicates()
    sizes = entries.join(wanted, "_at", "left_semi").groupBy("_at").agg(F.count("*").alias("_n"))
    spread = rules.withColumn("_at", F.explode("antecedent")).join(sizes, "_at", "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    columns = [c for c in rules.columns if c != "antecedent"]
    indexed = spread.groupBy("antecedent", *columns).agg(F.min(F.struct("_n", "_at")).alias("_rare")).where("_rare._n > 0")
    indexed = indexed.withColumn("_at", F.col("_rare._at")).drop("_rare")
    return entries.join(indexed, "_at").where(F.size(F.array_except("antecedent", "items")) == 0).drop("_at")


def rec_assoc(baskets: DataFrame, rules: DataFrame, k: int) -> DataFrame:
    """Rules whose antecedent is a subset of the basket: ``confidence * lift * |antecedent|``, summed, over the best.

    ``baskets``: ``user_id, items`` of any size; a rule whose item is in the basket already says nothing.
    """
    hits = contained_rules(baskets, rules.dropDuplicates(["antecedent", "item"])).where(~F.array_contains("items", F.col("item")))
    score = F.col("confidence") * F.col("lift") * F.size("antecedent")
    scored = hits.groupBy("user_id", F.col("item").alias("item_id")).agg(F.sum(score).alias("score"))
    return rescale_topk(scored, ["user_id"], k)

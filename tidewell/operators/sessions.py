"""Sessions, baskets and per-user histories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tidewell.functions.scalars import tag_token
from tidewell.operators.filters import filter_users
from tidewell.operators.skew import previous_row, sessionise
from tidewell.operators.topk import select_topk_linear

ORDER = ["ts", "event_id"]


def _listed(rows: DataFrame, keys: list[str], order: list[str], col: str, out: str) -> DataFrame:
    """Values per key as an ordered array; lists are bounded by the per-user action limit."""
    ordered = F.array_sort(F.collect_list(F.struct(*order, col)))
    return rows.groupBy(*keys).agg(F.transform(ordered, lambda s: s[col]).alias(out))


def session_items(actions: DataFrame, gap_s: float, lo: int, hi: int) -> DataFrame:
    """Item list per session of users with ``lo``..``hi`` actions; ``gap_s < 0`` never splits."""
    kept = filter_users(actions, lo, hi)
    return _listed(sessionise(kept, ["user_id"], "ts", ORDER, gap_s), ["user_id", "session"], ORDER, "item_id", "items")


def session_tags(actions: DataFrame, item_tags: DataFrame, gap_s: float, lo: int, hi: int, min_tags: int) -> DataFrame:
    """Tag words per session in action order (tags of one action in alphabetical order).

    User bounds are strict. Words are lower-cased with blanks as ``_``; short sessions are dropped.
    """
    words = item_tags.groupBy("item_id").agg(F.array_sort(F.collect_list(F.regexp_replace(F.lower("tag"), " ", "_"))).alias("words"))
    tagged = actions.join(words, "item_id")
    kept = filter_users(tagged, lo, hi, strict=True)
    listed = _listed(sessionise(kept, ["user_id"], "ts", ORDER, gap_s), ["user_id", "session"], ORDER, "words", "words")
    return listed.withColumn("words", F.flatten("words")).where(F.size("words") >= min_tags)


def baskets(events: DataFrame, add: int, gap_s: float, lo: int, hi: int, order: list[str]) -> DataFrame:
    """Items left in the basket at the end of each session of add/remove events.

    A session ends only before an add, when the gap to the user's previous event of any type is too long.
    An item is in the basket when its last event in the session is an add.
    """
    kept = filter_users(events, lo, hi)
    d = sessionise(kept, ["user_id"], "ts", order, gap_s, starts=F.col("kind") == add)
    last = d.groupBy("user_id", "session", "item_id").agg(F.max_by("kind", F.struct(*order)).alias("kind")).where(F.col("kind") == add)
    return last.groupBy("user_id", "session").agg(F.array_sort(F.collect_list("item_id")).alias("items"))


def _tagged(actions: DataFrame, item_tags: DataFrame) -> DataFrame:
    tokens = item_tags.groupBy("item_id").agg(F.array_sort(F.collect_list(tag_token("tag"))).alias("tags"))
    return actions.join(tokens, "item_id")


def _prefixed(prefix: str, col: Column | str) -> Column:
    return F.transform(col, lambda t: F.concat(F.lit(prefix), t))


def history_features(actions: DataFrame, item_tags: DataFrame, start: int, max_actions: int) -> DataFrame:
    """For the user's actions number ``start``..``max_actions`` (from 0): current tags ``i_*`` and all earlier tags ``u_*``.

    Only the first ``max_actions + 1`` actions of a user matter, and the rank filter is applied below the
    shuffle, so a hot user never reaches one task whole.
    """
    w = W.partitionBy("user_id").orderBy(*ORDER)
    first = _tagged(actions, item_tags).withColumn("seq", F.row_number().over(w) - 1).where(F.col("seq") <= max_actions)
    before = F.flatten(F.collect_list("tags").over(W.partitionBy("user_id").orderBy("seq").rowsBetween(W.unboundedPreceding, -1)))
    rows = first.withColumn("history", before).where(F.col("seq") >= start)
    return rows.select("user_id", "event_id", "seq", F.concat(_prefixed("i_", "tags"), _prefixed("u_", "history")).alias("features"))


def next_item_features(actions: DataFrame, item_tags: DataFrame, threshold: float = 3.0) -> DataFrame:
    """Tags of an action as ``i_*`` and those of the user's previous one as ``u_*``; ``value > threshold`` only."""
    liked = _tagged(actions.where(F.col("value") > threshold), item_tags)
    d = previous_row(liked, ["user_id"], ORDER, ["tags"]).where(F.col("prev").isNotNull())
    return d.select("user_id", "event_id", F.concat(_prefixed("i_", "tags"), _prefixed("u_", "prev.tags")).alias("features"))


def recent_actions(actions: DataFrame, n: int) -> DataFrame:
    """Last ``n`` actions per user, newest first (rank from 1)."""
    w = W.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return actions.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select("user_id", "item_id", "rank")


def recent_interactions(actions: DataFrame, n: int) -> DataFrame:
    """The user's own last ``n`` items, scored ``1 - rank/n``."""
    return select_topk_linear(actions, ["user_id"], n, [F.desc("ts"), F.desc("event_id")]).select("user_id", "item_id", "score")

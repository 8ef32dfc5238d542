"""Projections, filters and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.hashing import hash_share
from tidewell.operators.skew import with_key_count


def include(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[c for c in cols if c in df.columns])


def exclude(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.drop(*cols)


def require(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def filter_keys(col: str | Column, keys: list[str], mode: str = "inclusive") -> Column:
    """Keep (inclusive) or drop (exclusive) the listed keys of a map column."""
    wanted = [F.lit(k) for k in keys]
    if mode == "inclusive":
        return F.map_filter(col, lambda k, _: k.isin(*wanted))
    return F.map_filter(col, lambda k, _: ~k.isin(*wanted))


def filter_types(df: DataFrame, types: list[int] | int) -> DataFrame:
    """Keep the listed action types; an empty list or -1 keeps all."""
    if types in ([], -1, [-1]):
        return df
    return df.where(F.col("action_type").isin(types))


def filter_users(df: DataFrame, lo: int, hi: int, strict: bool = False) -> DataFrame:
    """Rows of users whose row count lies within the bounds."""
    counted = with_key_count(df, ["user_id"], "_n")
    keep = (F.col("_n") > lo) & (F.col("_n") < hi) if strict else F.col("_n").between(lo, hi)
    return counted.where(keep).drop("_n")


def filter_items(df: DataFrame, lo: int, hi: int) -> DataFrame:
    """Distinct (item, user) of items whose number of users lies within the bounds."""
    pairs = df.select("item_id", "user_id").dropDuplicates()
    return with_key_count(pairs, ["item_id"], "_n").where(F.col("_n").between(lo, hi)).drop("_n")


def filter_value(df: DataFrame, threshold: float = 3.0) -> DataFrame:
    return df.where(F.col("value") > threshold)


def allow_users(df: DataFrame, users: DataFrame | None) -> DataFrame:
    """Keep listed users; an empty list means no filter."""
    if users is None or users.isEmpty():
        return df
    return df.join(users.select("user_id").dropDuplicates(), "user_id", "left_semi")


def sample(df: DataFrame, p: float, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """About a share ``p`` of the rows, by a hash of their ``key`` columns (all by default): the same rows whatever the partitioning."""
    return df.where(hash_share(key or df.columns, seed) < p)


def items_with_dims(items: DataFrame, item_dims: DataFrame, dims: list[str]) -> DataFrame:
    """Items having at least one of the dimensions; an empty list keeps all."""
    if not dims:
        return items
    return items.join(item_dims.where(F.col("dim").isin(dims)).select("item_id"), "item_id", "left_semi")


def items_two_dims(items: DataFrame, item_dims: DataFrame, dims: list[str], dim2: str) -> DataFrame:
    """Items in any of ``dims`` and in ``dim2``."""
    return items_with_dims(items_with_dims(items, item_dims, dims), item_dims, [dim2])


def has_tag(col: str | Column, tag: str) -> Column:
    """Comma-separated list holds the tag, blanks around it ignored."""
    col = F.col(col) if isinstance(col, str) else col
    return F.exists(F.split(col, ","), lambda t: F.trim(t) == tag)


def actions_for(actions: DataFrame, n: int, user=None, item=None, type=None) -> DataFrame:
    """Newest ``n`` actions of a user, an item, a pair, or a user and type."""
    for name, v in (("user_id", user), ("item_id", item), ("action_type", type)):
        if v is not None:
            actions = actions.where(F.col(name) == v)
    return actions.orderBy(F.desc("ts"), F.desc("event_id")).limit(n)


def items_by_action(actions: DataFrame, type_names: DataFrame, name: str, user: int) -> DataFrame:
    """Items a user touched by a named action type with the latest time."""
    wanted = type_names.where(F.col("name") == name).select("action_type")
    return (
        actions.where(F.col("user_id") == user)
        .join(wanted, "action_type")
        .groupBy("item_id")
        .agg(F.max("ts").alias("last_ts"))
    )


def items_list(items: DataFrame, order: str, skip: int, n: int, type: str | None = None) -> DataFrame:
    """A page of items: newest id first (``order='id'``) or by name (``order='name'``)."""
    if type is not None:
        items = items.where(F.col("item_type") == type)
    cols = [F.desc("item_id")] if order == "id" else [F.asc("name"), F.asc("item_id")]
    return items.orderBy(*cols).offset(skip).limit(n)


def users_with(users: DataFrame, eav: DataFrame, attr: str, value) -> DataFrame:
    """Users whose typed attribute equals a value."""
    hit = eav.where((F.col("attr") == attr) & (F.col("value") == F.lit(value))).select("user_id")
    return users.join(hit, "user_id", "left_semi")


def active_users(users: DataFrame, since: str | None = None, n: int | None = None) -> DataFrame:
    """Users by last activity, newest first."""
    out = users if since is None else users.where(F.col("last_op") >= F.to_timestamp(F.lit(since)))
    return out if n is None else out.orderBy(F.desc("last_op"), "user_id").limit(n)


def ignore(df: DataFrame, values: list, cols: list[str] | None = None) -> DataFrame:
    """Listed values and empty strings become null."""
    texts = ["", *[str(v) for v in values]]
    names = cols or df.columns
    return df.select(*[F.when(~F.col(c).cast("string").isin(texts), F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns])

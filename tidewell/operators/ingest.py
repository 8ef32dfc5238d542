"""Ingest, cleaning and the attribute catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from tidewell.operators.skew import dense_ids

# Attribute types of the catalogue and their column types.
ATTR_TYPES = {
    "int": "int",
    "bigint": "bigint",
    "double": "double",
    "boolean": "boolean",
    "varchar": "string",
    "text": "string",
    "datetime": "timestamp",
    "enum": "string",
}
# Order in which typed values of an attribute are looked up.
VALUE_ORDER = ["int", "double", "bigint", "boolean", "text", "datetime", "varchar", "enum"]

SCHEMA_JSON = (
    "struct<types:array<struct<type_id:int,type_name:string,"
    "type_attrs:array<struct<name:string,value_type:string,enum_values:array<string>>>>>>"
)


def resolve_users(actions: DataFrame) -> DataFrame:
    """Rows with ``user_id = 0`` take the id seen for the same (client, client_user_id); the rest is dropped.

    Known ids are aggregated first and joined only to the unknown rows, so known users do not shuffle.
    """
    known = actions.where("user_id <> 0")
    ids = known.groupBy("client", "client_user_id").agg(F.max("user_id").alias("_id"))
    found = actions.where("user_id = 0").drop("user_id").join(ids, ["client", "client_user_id"])
    return known.unionByName(found.withColumnRenamed("_id", "user_id"))


def resolve_report(actions: DataFrame) -> DataFrame:
    """Per client how many rows were resolved and dropped."""
    ids = actions.where("user_id <> 0").select("client", "client_user_id").dropDuplicates().withColumn("_hit", F.lit(1))
    open_rows = actions.where("user_id = 0").groupBy("client", "client_user_id").agg(F.count("*").alias("n"))
    return (
        open_rows.join(ids, ["client", "client_user_id"], "left")
        .groupBy("client")
        .agg(
            F.sum(F.when(F.col("_hit") == 1, F.col("n")).otherwise(0)).alias("resolved"),
            F.sum(F.when(F.col("_hit").isNull(), F.col("n")).otherwise(0)).alias("dropped"),
        )
    )


def split_events(events: DataFrame, client: str | None = None) -> DataFrame:
    """Events with their partition columns ``client`` and unix ``day``; optionally one client."""
    d = events if client is None else events.where(F.col("client") == client)
    return d.withColumn("day", F.unix_date(F.to_date("ts")))


def define_attrs(schema: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Attribute rows, enum values numbered from 1, and one dimension per enum value.

    ``schema``: ``item_type, attr, value_type, enum_values array<string>`` (a hand-made, small catalogue).
    """
    attrs = schema.select("item_type", "attr", "value_type", "enum_values").withColumn(
        "attr_id", F.row_number().over(W.orderBy("item_type", "attr"))
    )
    enums = attrs.where("value_type = 'enum'").select(
        "item_type", "attr_id", "attr", F.posexplode("enum_values").alias("pos", "value_name")
    )
    enums = enums.select("item_type", "attr_id", "attr", (F.col("pos") + 1).alias("value_id"), "value_name")
    dims = enums.withColumn("dim_id", F.row_number().over(W.orderBy("attr_id", "value_id")))
    return attrs.drop("enum_values"), enums, dims.select("dim_id", "item_type", "attr_id", "value_id")


def validate_items(df: DataFrame, attrs: DataFrame, enums: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, bad cells): columns must be in the catalogue, enum values must be known."""
    known = {r.attr: r.value_type for r in attrs.select("attr", "value_type").collect()}  # the hand-made catalogue
    extra = [c for c in df.columns if c != "item_id" and c not in known]
    enum_cols = [c for c in df.columns if known.get(c) == "enum"]
    none = df.sparkSession.createDataFrame([], "item_id long, attr string, value string, reason string")
    bad = none
    if extra:
        cells = F.explode(F.array(*[F.lit(c) for c in extra])).alias("attr")
        bad = df.select("item_id", cells).select("item_id", "attr", F.lit(None).cast("string").alias("value"), F.lit("unknown attribute").alias("reason"))
    if enum_cols:
        cells = df.select(
            "item_id", F.explode(F.array(*[F.struct(F.lit(c).alias("attr"), F.col(c).alias("value")) for c in enum_cols])).alias("x")
        ).select("item_id", "x.attr", "x.value").where("value is not null")
        names = enums.select("attr", F.col("value_name").alias("value"))
        bad = bad.unionByName(cells.join(names, ["attr", "value"], "left_anti").withColumn("reason", F.lit("unknown enum value")))
    good = df.drop(*extra).join(bad.where("reason = 'unknown enum value'").select("item_id"), "item_id", "left_anti")
    return good, bad


def items_to_eav(df: DataFrame, attrs: dict[str, str], enums: DataFrame | None = None) -> dict[str, DataFrame]:
    """Wide items to one typed ``(item_id, attr, value)`` frame per attribute type; unparsable cells vanish."""
    out: dict[str, DataFrame] = {}
    for kind in sorted(set(attrs.values())):
        cols = [c for c, t in attrs.items() if t == kind]
        cells = F.array(*[F.struct(F.lit(c).alias("attr"), F.col(c).cast("string").alias("text")) for c in cols])
        rows = df.select("item_id", F.explode(cells).alias("x")).select("item_id", "x.attr", "x.text")
        if kind == "enum" and enums is not None:
            ids = enums.select("attr", F.col("value_name").alias("text"), F.col("value_id").alias("value"))
            out[kind] = rows.join(ids, ["attr", "text"]).select("item_id", "attr", "value")
        else:
            typed = rows.select("item_id", "attr", F.col("text").try_cast(ATTR_TYPES[kind]).alias("value"))
            out[kind] = typed.where("value is not null")
    return out


def map_action_ids(actions: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Client ids to internal ids and epoch seconds to a UTC time string."""
    return (
        actions.join(users.select("client_user_id", "user_id"), "client_user_id")
        .join(items.select("client_item_id", "item_id"), "client_item_id")
        .select(
            "user_id",
            "item_id",
            "client_user_id",
            "client_item_id",
            "action_type",
            "value",
            F.date_format(F.timestamp_seconds("epoch"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp_utc"),
        )
    )


def attr_value(eav: dict[str, DataFrame], enums: DataFrame | None = None) -> DataFrame:
    """One text value per (item, attr): the first type in lookup order that has one, multi-values by position.

    All typed frames are stacked and reduced in one aggregation instead of a chain of outer joins.
    """
    stacked = None
    for rank, kind in enumerate(VALUE_ORDER):
        if kind not in eav:
            continue
        frame = eav[kind]
        if kind == "enum" and enums is not None:
            frame = frame.join(enums.select("attr", F.col("value").alias("_v") if "value" in enums.columns else F.col("value_id").alias("_v"), "value_name"), (F.col("_v") == F.col("value")) & (enums["attr"] == frame["attr"])).select(
                "item_id", frame["attr"], F.col("value_name").alias("value")
            )
        pos = F.col("pos") if "pos" in frame.columns else F.lit(0)
        part = frame.select("item_id", "attr", F.lit(rank).alias("rank"), pos.alias("pos"), F.col("value").cast("string").alias("value"))
        stacked = part if stacked is None else stacked.unionByName(part)
    return (
        stacked.where("value is not null")
        .groupBy("item_id", "attr")
        .agg(F.min(F.struct("rank", "pos", "value")).alias("x"))
        .select("item_id", "attr", "x.value")
    )


def item_dims(map_enum: DataFrame, dimension: DataFrame, excluded: DataFrame | None = None) -> DataFrame:
    """Item to dimension through (attr, enum value), without the excluded dimensions."""
    dims = dimension if excluded is None else dimension.join(excluded.select("dim_id"), "dim_id", "left_anti")
    return map_enum.join(dims, ["attr_id", "value_id"]).select("item_id", "dim_id")


def explode_tags(items: DataFrame, col: str) -> DataFrame:
    """Comma-separated tags as distinct trimmed lower-case ``(item_id, tag)`` rows."""
    tags = F.array_distinct(F.transform(F.split(F.lower(F.col(col)), ","), lambda t: F.trim(t)))
    return items.select("item_id", F.explode(F.filter(tags, lambda t: t != "")).alias("tag"))


def register(actions: DataFrame, users: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(users, items, stored actions) after adding unseen users and items; known rows stay untouched.

    New ids continue after the largest known one, numbered by the client's id. Actions keep types 2 and 3
    only and get the internal ids of their client ids.
    """

    def extended(known: DataFrame, key: str, out: str) -> DataFrame:
        seen = actions.groupBy(key).agg(F.min("ts").alias("first_op"), F.max("ts").alias("last_op"), F.lit(1).alias("num_op"))
        fresh = seen.join(known, key, "left_anti")
        return known.select(key, out, "first_op", "last_op", "num_op").unionByName(number_new(fresh, known, key, out))

    all_users = extended(users, "client_user_id", "user_id")
    all_items = extended(items, "client_item_id", "item_id")
    kept = actions.where(F.col("action_type").isin(2, 3))
    if "user_id" in kept.columns:
        kept = kept.withColumnsRenamed({"user_id": "_u", "item_id": "_i"})
    else:
        kept = kept.withColumn("_u", F.lit(0)).withColumn("_i", F.lit(0))
    stored = (
        kept.join(all_users.select("client_user_id", F.col("user_id").alias("_ru")), "client_user_id")
        .join(all_items.select("client_item_id", F.col("item_id").alias("_ri")), "client_item_id")
        .withColumn("user_id", F.when(F.col("_u") == 0, F.col("_ru")).otherwise(F.col("_u")))
        .withColumn("item_id", F.when(F.col("_i") == 0, F.col("_ri")).otherwise(F.col("_i")))
        .drop("_u", "_i", "_ru", "_ri")
    )
    return all_users, all_items, stored


def number_new(fresh: DataFrame, known: DataFrame, key: str, out: str) -> DataFrame:
    """New rows numbered after the largest known id."""
    start = F.coalesce(known.agg(F.max(out)).scalar(), F.lit(0))
    return dense_ids(fresh, key, out).withColumn(out, start + F.col(out))


def map_user_dims(requests: DataFrame, mapping: DataFrame) -> DataFrame:
    """Requested dimensions per user, each replaced by all ``dims_out`` of the user's rule that lists it.

    ``requests``: ``user_id, dims array``; ``mapping``: ``user_id, dims_in array, dims_out array``.
    """
    rules = mapping.select("user_id", F.explode("dims_in").alias("dim"), "dims_out")
    asked = requests.select("user_id", F.explode("dims").alias("dim"))
    return (
        asked.join(rules, ["user_id", "dim"], "left")
        .select("user_id", F.explode(F.coalesce("dims_out", F.array("dim"))).alias("dim"))
        .groupBy("user_id")
        .agg(F.array_sort(F.collect_set("dim")).alias("dims"))
    )


def unique_calls(log: DataFrame) -> DataFrame:
    """Distinct ``path?query`` of the logged calls."""
    call = F.when(F.coalesce(F.col("query"), F.lit("")) == "", F.col("path")).otherwise(F.concat_ws("?", "path", "query"))
    return log.select(call.alias("call")).distinct()

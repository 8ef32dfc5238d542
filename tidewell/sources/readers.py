"""Readers: action and event logs, JDBC tables, entity CSVs, vectors, feature frames, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

ACTION_SCHEMA = (
    "timestamp_utc string, client string, client_userid string, userid long, itemid long, "
    "client_itemid string, rectag string, type int, value double, extra_data string"
)
# Columns of the entity import files.
ENTITY_SCHEMAS = {
    "users": "id string, name string",
    "items": "id string, name string",
    "actions": "user_id string, item_id string, value double, time long",
}
CORRUPT = "_corrupt_record"


def normalise_actions(raw: DataFrame) -> DataFrame:
    """Logged action fields to the canonical column names."""
    return raw.select(
        F.col("client"),
        F.col("client_userid").alias("client_user_id"),
        F.col("userid").alias("user_id"),
        F.col("itemid").alias("item_id"),
        F.col("client_itemid").alias("client_item_id"),
        F.col("type").alias("action_type"),
        "value",
        F.to_timestamp("timestamp_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"),
        "rectag",
        "extra_data",
        *[c for c in ("day",) if c in raw.columns],
    )


def read_actions(spark: SparkSession, root: str, client: str, start_day: int, days: int = 1) -> DataFrame:
    """Actions of ``days`` unix days ending at ``start_day``; ``client`` and ``day`` prune folders."""
    raw = spark.read.schema(f"{ACTION_SCHEMA}, day int").json(root)
    return normalise_actions(raw.where((F.col("client") == client) & F.col("day").between(start_day - days + 1, start_day)))


def read_days(spark: SparkSession, root: str, start: str, end: str, schema: str | StructType = ACTION_SCHEMA) -> DataFrame:
    """Rows of ``day=yyyy-MM-dd`` folders between two dates, both included."""
    ddl = schema if isinstance(schema, str) else ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    raw = spark.read.schema(f"{ddl}, day date").json(root)
    return raw.where(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def parse_log(lines: DataFrame, tag: str, schema: str) -> DataFrame:
    """``date<TAB>tag<TAB>json`` lines of one tag; lines whose JSON does not parse are dropped."""
    parts = F.split("value", "\t", 3)
    rows = lines.select(parts[0].alias("logged"), parts[1].alias("tag"), parts[2].alias("json")).where(F.col("tag") == tag)
    return _parsed(rows, schema, ["logged"])


def _parsed(rows: DataFrame, schema: str, keep: list[str]) -> DataFrame:
    body = F.from_json("json", f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    good = rows.select(*keep, body.alias("b")).where(f"b is not null and b.{CORRUPT} is null")
    return good.select(*keep, "b.*").drop(CORRUPT)


def bad_lines(lines: DataFrame, tag: str, schema: str) -> DataFrame:
    """The lines ``parse_log`` drops, for counting and repair."""
    parts = F.split("value", "\t", 3)
    body = F.from_json(parts[2], f"{schema}, {CORRUPT} string", {"columnNameOfCorruptRecord": CORRUPT})
    return lines.where(parts[1] == tag).where(body.isNull() | body[CORRUPT].isNotNull())


def read_log(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    return parse_log(spark.read.text(path), tag, schema)


def parse_events(lines: DataFrame) -> DataFrame:
    """Log lines of three blank-separated parts: keep the JSON and its client."""
    parts = F.split("value", r"\s+", 3)
    rows = lines.where(F.size(parts) == 3).select(parts[0].alias("logged"), parts[1].alias("tag"), parts[2].alias("json"))
    return rows.withColumn("client", F.get_json_object("json", "$.client")).where("client is not null")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return parse_events(spark.read.text(path))


def read_table(spark: SparkSession, cfg: dict) -> DataFrame:
    """Lookup table over JDBC, split over ``num_partitions`` ranges of ``partition_column``; any other format by path.

    ``cfg``: either ``url, table, partition_column, lower, upper, num_partitions`` or ``format, path``.
    """
    if "url" not in cfg:
        return spark.read.format(cfg.get("format", "parquet")).load(cfg["path"])
    reader = spark.read.format("jdbc").option("url", cfg["url"]).option("dbtable", cfg["table"])
    for key in ("user", "password", "driver", "fetchsize"):
        if key in cfg:
            reader = reader.option(key, cfg[key])
    if "partition_column" in cfg:
        reader = (
            reader.option("partitionColumn", cfg["partition_column"])
            .option("lowerBound", cfg["lower"])
            .option("upperBound", cfg["upper"])
            .option("numPartitions", cfg.get("num_partitions", 32))
        )
    return reader.load()


def read_entities(spark: SparkSession, path: str, kind: str, extra: str | None = None) -> DataFrame:
    """Import CSV of users, items or actions with a header; ``extra`` adds attribute columns (DDL)."""
    schema = ENTITY_SCHEMAS[kind] + (f", {extra}" if extra else "")
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def read_vectors(spark: SparkSession, path: str, sep: str = ",", header: bool = False) -> DataFrame:
    """``key<sep>v1<sep>v2…`` lines as ``(id, features)``; header lines start with ``-vectortype``."""
    lines = spark.read.text(path)
    if header:
        lines = lines.where(~F.col("value").startswith("-vectortype"))
    parts = F.split("value", "[" + sep.replace("\\", "\\\\") + "]")
    return lines.select(parts[0].alias("id"), F.slice(parts, F.lit(2), F.size(parts)).cast("array<float>").alias("features"))


def read_frame(spark: SparkSession, paths: list[str] | str, fmt: str, schema: str, dates: dict[str, str] | None = None) -> DataFrame:
    """Feature files (CSV with header, or JSON lines) from one or many folders; date columns parsed by format."""
    reader = spark.read.schema(schema)
    df = reader.option("header", True).csv(paths) if fmt == "csv" else reader.json(paths)
    for col, f in (dates or {}).items():
        df = df.withColumn(col, F.try_to_timestamp(F.col(col), F.lit(f)))
    return df


def read_stream(spark: SparkSession, fmt: str, opts: dict[str, str], schema: str) -> DataFrame:
    """JSON stream: Kafka topic values, or a folder of JSON or parquet files."""
    if fmt == "kafka":
        raw = spark.readStream.format("kafka").options(**opts).load()
        return raw.select(F.from_json(F.col("value").cast("string"), schema).alias("b")).where("b is not null").select("b.*")
    opts = dict(opts)
    path = opts.pop("path")
    return spark.readStream.schema(schema).format(fmt).options(**opts).load(path)

"""Session settings, shared scratch space and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN_DIR: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidewell") -> SparkSession:
    """Local session for tests and the bench; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` when the cluster names one.

    Only where it is unset (local tests) a temporary folder takes its place.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        path = _OWN_DIR.setdefault(app, tempfile.mkdtemp(prefix="tidewell-") if app not in _OWN_DIR else _OWN_DIR[app])
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nobody used before."""
    return f"{shared_dir(spark).rstrip('/')}/tidewell-{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint: survives executor loss, unlike a local one."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


#: Spark removes the shuffle files of a job at its end instead of when the driver happens to collect its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder as Parquet and read again: like a checkpoint, compressed and by column.

    Nothing reads the shuffle files of that job again, so they go at its end.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Removes the files of a ``written`` frame that nothing reads any more, as those of an earlier pass."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if folder.rsplit("/", 1)[1].startswith("tidewell-"):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

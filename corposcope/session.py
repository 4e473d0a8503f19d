"""Session defaults and the shared folder that durable intermediates go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def local_session(app: str, cores: int | str = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where that is unset, a session whose executor is the driver itself, as in tests, gets a folder of its own.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if context.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = context.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="corposcope-")
        root = _local_dirs[app]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared folder."""
    return f"{shared_dir(spark)}/corposcope/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write a small intermediate to the shared folder and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a large intermediate once as parquet and read it back.

    Later passes get column pruning and filter pushdown instead of repeating
    the work behind ``df``.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


"""Session settings and the shared folder used for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Zoned timestamps (feeds) are read and shown in one fixed zone.
    "spark.sql.session.timeZone": "UTC",
    # A duplicate key in a JSON object keeps the last value instead of failing.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the next step groups on the join key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Temporary folders of local sessions without a named one, by application.
_LOCAL_DIRS: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library relies on to an existing session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_DIRS[application]


def _own_scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"


def release_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote below the shared folder; results read from it are gone."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_scratch(spark))
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{_own_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def written(df, label: str):
    """Write ``df`` to the shared folder and read it back: lineage ends at the files."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)

"""One JSON document per line as a one-column collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_json(spark: SparkSession, path: str, mode: str = "failfast") -> DataFrame:
    """Documents of all files below ``path`` as column ``doc``.

    ``failfast`` raises on a bad line. ``permissive`` leaves bad lines out; get them from
    ``rejected_json``. Blank lines are no documents.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "")
    if mode == "failfast":
        return lines.select(F.parse_json("value").alias("doc"))
    if mode == "permissive":
        return lines.select(F.try_parse_json("value").alias("doc")).filter(F.col("doc").isNotNull())
    raise ValueError(f"unknown mode {mode}")


def rejected_json(spark: SparkSession, path: str) -> DataFrame:
    """The lines ``permissive`` loading leaves out."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    return lines.filter(F.try_parse_json("value").isNull()).select(F.col("value").alias("line"))

"""Reproducible rows for load tests of versioned tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT_LENGTH = 25


def hashed_text(value: Column) -> Column:
    """The first characters of the md5 digest of a value."""
    return F.substring(F.md5(value.cast("string")), 1, TEXT_LENGTH)


def drawn_id(value: Column, ids: int, seed: int = 42) -> Column:
    """A repeatable draw from 1..ids."""
    return F.pmod(F.xxhash64(value, F.lit(seed)), F.lit(ids)) + 1


def insert_rows(spark: SparkSession, n: int) -> DataFrame:
    """n rows (n, text)."""
    return spark.range(1, n + 1).select(F.col("id").alias("n"), hashed_text(F.col("id")).alias("text"))


def update_draws(spark: SparkSession, n: int, ids: int, seed: int = 42) -> DataFrame:
    """n draws (n, id, text) of ids to update; ids repeat."""
    row = F.col("id")
    return spark.range(1, n + 1).select(
        row.alias("n"), drawn_id(row, ids, seed).alias("id"), hashed_text(row + F.lit(n)).alias("text")
    )

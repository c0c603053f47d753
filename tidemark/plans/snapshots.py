"""Stored query results with versions.

Layout of a snapshot folder::

    data/<id>/...          the rows of one version, written completely before it is published
    published/<n>          a marker naming the data folder of version n

A version exists once its marker has content. Markers are written under another name and renamed to one that must not
exist, so a reader never sees half of one, two writers cannot publish the same version, and readers that started on an
older version keep reading it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.operators.checks import assert_unique


class PublishConflict(RuntimeError):
    """Another writer published this version first."""


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def _full_names(spark: SparkSession, path: str) -> list[str]:
    """The files of a folder that have content."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(where) if status.getLen() > 0)


def create_marker(spark: SparkSession, path: str, text: str) -> None:
    """Create a small file that must not exist yet, in one step: a full file gets its name by a rename."""
    fs, where = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    draft = jvm.org.apache.hadoop.fs.Path(f"{where.getParent()}/.draft-{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    try:
        if fs.exists(where) and fs.getFileStatus(where).getLen() == 0:
            fs.delete(where, False)  # left by a writer that died
        # Unlike that of a file system, the rename of a file context refuses to replace a file.
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context.rename(draft, fs.makeQualified(where), none)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            raise PublishConflict(f"{path} already exists") from error
        raise


def read_marker(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds."""
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def published_versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n) for n in _full_names(spark, f"{path}/published") if n.isdigit())


def latest_version(spark: SparkSession, path: str) -> int:
    """The newest published version, 0 when there is none."""
    return max(published_versions(spark, path), default=0)


@dataclass(frozen=True)
class Snapshot:
    spark: SparkSession
    path: str

    def version(self) -> int:
        number = latest_version(self.spark, self.path)
        if number == 0:
            raise LookupError(f"nothing published in {self.path}")
        return number

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or a given one. The version is fixed when this is called."""
        number = self.version() if version is None else version
        name = read_marker(self.spark, f"{self.path}/published/{number:010d}")
        return self.spark.read.parquet(f"{self.path}/data/{name}")

    def refresh(
        self, df: DataFrame, key: Sequence[str | Column] | None = None, concurrent: bool = True, base: int | None = None
    ) -> int:
        """Store ``df`` as the next version and return its number.

        A concurrent refresh leaves the old version readable while it runs and needs a unique key,
        which is checked on the written rows before they are published. Give the version that ``df``
        was made from as ``base`` to fail where another writer has published since.
        """
        if concurrent and not key:
            raise ValueError("a concurrent refresh needs a unique key")
        number = (latest_version(self.spark, self.path) if base is None else base) + 1
        name = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/{name}")
        if key:
            assert_unique(self.spark.read.parquet(f"{self.path}/data/{name}"), key)
        create_marker(self.spark, f"{self.path}/published/{number:010d}", name)
        return number


def materialize(df: DataFrame, path: str, key: Sequence[str | Column] | None = None) -> Snapshot:
    """Store a query result as version 1 of a new snapshot."""
    snapshot = Snapshot(df.sparkSession, path)
    snapshot.refresh(df, key, concurrent=key is not None)
    return snapshot

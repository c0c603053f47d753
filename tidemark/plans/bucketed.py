"""Keyed results that are refreshed by what has changed.

Rows lie in buckets by a hash of their key, one folder per bucket. A version names for each bucket the folder that holds it and a
fingerprint of its rows, so a refresh writes only the buckets whose rows differ, and a merge reads and writes only the
buckets of the rows that arrive. Versions, markers and conflicts are those of ``snapshots``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.checks import assert_unique
from tidemark.plans.snapshots import create_marker, latest_version, list_names, published_versions, read_marker, remove
from tidemark.session import written

BUCKET = "part_bucket"


@dataclass(frozen=True)
class BucketedSnapshot:
    """A stored result with a unique ``key`` of named columns.

    ``buckets`` is fixed with the first version: choose it so that a bucket has some tens of megabytes.
    """

    spark: SparkSession
    path: str
    key: Sequence[str]
    buckets: int = 256

    # --- reading ---

    def version(self) -> int:
        number = latest_version(self.spark, self.path)
        if number == 0:
            raise LookupError(f"nothing published in {self.path}")
        return number

    def _manifest(self, number: int) -> dict:
        if number == 0:
            return {"buckets": {}, "schema": None}
        return json.loads(read_marker(self.spark, f"{self.path}/published/{number:010d}"))

    def _folders(self, manifest: dict, wanted: Iterable[str] | None = None) -> list[str]:
        held = manifest["buckets"]
        return [f"{self.path}/data/{held[b]['snap']}/{BUCKET}={b}" for b in sorted(held if wanted is None else set(wanted) & set(held))]

    def _read(self, manifest: dict, wanted: Iterable[str] | None = None) -> DataFrame:
        schema, folders = StructType.fromJson(manifest["schema"]), self._folders(manifest, wanted)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or a given one. The version is fixed when this is called."""
        return self._read(self._manifest(self.version() if version is None else version))

    @contextmanager
    def reading(self, version: int | None = None) -> Iterator[DataFrame]:
        """A version that ``expire`` leaves alone while the block runs."""
        number = self.version() if version is None else version
        pin = f"{self.path}/reading/{number}-{uuid.uuid4().hex}"
        create_marker(self.spark, pin, "reading")
        try:
            yield self.read(number)
        finally:
            remove(self.spark, pin)

    # --- writing ---

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int"))

    def _prints(self, placed: DataFrame) -> dict[str, list]:
        """Bucket -> number of rows and two sums over their hashes; as many as there are buckets."""
        columns = [c for c in placed.columns if c != BUCKET]
        row = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        prints = [F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(row)).alias("x"), F.sum(F.hash(row).cast("long")).alias("s")]
        return {str(r[BUCKET]): [r.n, r.x, r.s] for r in placed.groupBy(BUCKET).agg(*prints).collect()}

    def _publish(self, df: DataFrame, touched: set[str] | None, base: int, manifest: dict) -> int:
        """Write the buckets in ``touched`` out of ``df`` (None: all), and publish them with the others of ``manifest``.

        Rows that come with their bucket are taken to lie together by it; if they don't, a bucket has more files.
        """
        lying = BUCKET in df.columns
        placed, snap = df if lying else self._placed(df).repartition(BUCKET), uuid.uuid4().hex
        held = {} if touched is None else {b: v for b, v in manifest["buckets"].items() if b not in touched}
        if touched is None or touched:
            rows = placed if touched is None else placed.filter(F.col(BUCKET).isin(sorted(map(int, touched))))
            where = f"{self.path}/data/{snap}"
            rows.sortWithinPartitions(BUCKET, *self.key).write.partitionBy(BUCKET).parquet(where)
            back = self.spark.read.schema(rows.schema).parquet(where)
            # Other buckets can't hold a key of these.
            assert_unique(back, list(self.key))
            held |= {b: {"snap": snap, "print": p} for b, p in self._prints(back).items()}
        marker = json.dumps({"buckets": held, "schema": manifest["schema"] or df.drop(BUCKET).schema.jsonValue()})
        create_marker(self.spark, f"{self.path}/published/{base + 1:010d}", marker)
        return base + 1

    def refresh(self, df: DataFrame, base: int | None = None) -> int:
        """Make ``df`` the next version. It is evaluated once for fingerprints, and again for the buckets that differ."""
        base = latest_version(self.spark, self.path) if base is None else base
        manifest = self._manifest(base)
        if manifest["schema"] is None:
            return self._publish(df, None, base, manifest)
        df = df.select(*[field["name"] for field in manifest["schema"]["fields"]])
        now = self._prints(self._placed(df))
        before = {b: v["print"] for b, v in manifest["buckets"].items()}
        touched = {b for b in now.keys() | before.keys() if now.get(b) != before.get(b)}
        return self._publish(df, touched, base, manifest)

    def merge(self, arrived: DataFrame, merged: Callable[[DataFrame | None, DataFrame], DataFrame], base: int | None = None) -> int:
        """Replace the buckets of the arrived rows by ``merged(their rows so far, arrived)``; nothing else is read or written.

        Both come with their bucket in ``BUCKET``. If ``merged`` leaves it, its rows have to lie together by bucket, and
        are written as they lie; otherwise they are placed anew. What arrives is evaluated once.
        """
        base = latest_version(self.spark, self.path) if base is None else base
        manifest = self._manifest(base)
        if manifest["schema"] is None:
            return self._publish(merged(None, self._placed(arrived)), None, base, manifest)
        arrived = written(self._placed(arrived), "arrived")
        touched = {str(r[0]) for r in arrived.select(BUCKET).distinct().collect()}
        return self._publish(merged(self._placed(self._read(manifest, touched)), arrived), touched, base, manifest)

    # --- retention ---

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all versions but the newest ``keep`` and those being read, with the folders nobody else names; what went."""
        versions = published_versions(self.spark, self.path)
        pinned = {int(n.split("-")[0]) for n in list_names(self.spark, f"{self.path}/reading") if n[:1].isdigit()}
        gone = [v for v in versions[: max(0, len(versions) - max(1, keep))] if v not in pinned]
        used = {v["snap"] for n in versions if n not in gone for v in self._manifest(n)["buckets"].values()}
        mine = {v["snap"] for n in gone for v in self._manifest(n)["buckets"].values()}
        for number in gone:
            remove(self.spark, f"{self.path}/published/{number:010d}")
        for snap in mine - used:
            remove(self.spark, f"{self.path}/data/{snap}")
        return gone


"""A version table on disk, in folders by year of the lower bound and of the upper one.

``data/snap=<id>/part_year=Y/part_close=C/`` holds rows that begin in year Y and end in year C as one writer left them; open rows are in
``part_close=9999``. ``keys/<id>/`` has the keys one writer added. A published marker lists the folders that are valid and the
key folders. A batch of changes replaces the open rows of the years it touches and adds the rows it closes; files of closed rows
are never read or written again for it. A read as of a moment opens neither what begins in later years nor what ended in earlier ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import next_year_start, year_start
from tidemark.plans import temporal
from tidemark.plans.snapshots import create_marker, latest_version, list_names, read_marker

YEAR, CLOSE = "part_year", "part_close"
# The year of an open end.
OPEN = "9999"


def _manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    number = latest_version(spark, path) if version is None else version
    if number == 0:
        return {"years": {}, "keys": []}
    return json.loads(read_marker(spark, f"{path}/published/{number:010d}"))


def write_versions(
    df: DataFrame,
    path: str,
    start: str = "valid_from",
    key: str = "id",
    end: str = "valid_to",
    years: Iterable[int] | None = None,
    new_keys: DataFrame | None = None,
    base: int | None = None,
) -> int:
    """Publish ``df`` as the content of ``years`` (default: every year, replacing all versions).

    Folders for new years appear as they are needed. Files hold neighbouring keys, so that the
    history of a key is found by file statistics; neither a year nor a key has to fit one task.
    ``new_keys`` are added to the key table in the same step. ``base`` is the version the change was
    made from; publishing fails where another writer has published since.
    """
    spark = df.sparkSession
    snap = uuid.uuid4().hex
    before = latest_version(spark, path) if base is None else base
    number = before + 1
    held = _manifest(spark, path, before)
    touched = None if years is None else sorted(set(years))
    written = _write(df if touched is None else df.filter(F.year(start).isin(touched)), path, snap, start, end, key)
    kept = {} if touched is None else {y: parts for y, parts in held["years"].items() if int(y) not in touched}
    kept |= {y: {c: [snap] for c in ends} for y, ends in written.items()}
    return _publish(spark, path, number, kept, _with_keys(held, path, snap, new_keys))


def _write(df: DataFrame, path: str, snap: str, start: str, end: str, key: str) -> dict[str, list[str]]:
    """Write rows into the folders of a snap: the years of their ends, by the years of their beginnings."""
    spark = df.sparkSession
    dated = df.withColumn(YEAR, F.year(start)).withColumn(CLOSE, F.year(end))
    order = [F.col(YEAR).asc(), F.col(CLOSE).asc(), F.col(key).asc(), F.col(start).asc()]
    where = f"{path}/data/snap={snap}"
    dated.repartitionByRange(*order).sortWithinPartitions(*order).write.partitionBy(YEAR, CLOSE).parquet(where)
    names = lambda at, part: [n.split("=", 1)[1] for n in list_names(spark, at) if n.startswith(f"{part}=")]
    return {y: names(f"{where}/{YEAR}={y}", CLOSE) for y in names(where, YEAR)}


def _with_keys(held: dict, path: str, snap: str, new_keys: DataFrame | None) -> list[str]:
    if new_keys is None:
        return held["keys"]
    new_keys.write.parquet(f"{path}/keys/{snap}")
    return [*held["keys"], snap]


def _publish(spark: SparkSession, path: str, number: int, years: dict, keys: list[str]) -> int:
    create_marker(spark, f"{path}/published/{number:010d}", json.dumps({"years": years, "keys": keys}))
    return number


def _read(spark: SparkSession, path: str, years: dict, wanted=lambda year, close: True) -> DataFrame | None:
    """The rows of the folders whose years are wanted; None if there is no such folder."""
    folders = [
        f"{path}/data/snap={snap}/{YEAR}={year}/{CLOSE}={close}"
        for year, parts in sorted(years.items())
        for close, snaps in sorted(parts.items())
        for snap in snaps
        if wanted(int(year), int(close))
    ]
    if not folders:
        return None
    return spark.read.option("basePath", f"{path}/data").parquet(*folders).drop("snap", CLOSE)


def _years(spark: SparkSession, path: str, version: int | None = None) -> dict:
    years = _manifest(spark, path, version)["years"]
    if not years:
        raise LookupError(f"nothing published in {path}")
    return years


def read_versions(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The published rows with ``part_year``, which prunes folders when filtered on."""
    return _read(spark, path, _years(spark, path, version))


def read_open(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The open rows alone, with ``part_year``; folders of closed ones are not opened."""
    years = _years(spark, path, version)
    rows = _read(spark, path, years, lambda year, close: close == int(OPEN))
    return _read(spark, path, years).limit(0) if rows is None else rows


def read_as_of(spark: SparkSession, path: str, ts: str, start: str = "valid_from", end: str = "valid_to"):
    """Rows valid at ``ts``; folders that begin in years after it or end in years before it are not opened."""
    at, year = F.lit(ts).cast("timestamp_ntz"), int(ts[:4])
    years = _years(spark, path)
    rows = _read(spark, path, years, lambda begun, close: begun <= year <= close)
    rows = _read(spark, path, years).limit(0) if rows is None else rows
    return rows.filter((F.col(YEAR) <= F.year(at)) & (F.col(start) <= at) & (at < F.col(end)))


def touched_years(changed: DataFrame, start: str = "valid_from") -> list[int]:
    """Years of the given rows. There are only as many as the table has years."""
    return [r[0] for r in changed.select(F.year(start)).distinct().collect()]


def partition_registry(df: DataFrame, start: str = "valid_from") -> DataFrame:
    """(part_year, start_value, end_value) of every year in use."""
    first = df.groupBy(F.year(start).cast("int").alias(YEAR)).agg(F.min(start).alias("__any"))
    return first.select(
        YEAR, year_start(F.col("__any")).alias("start_value"), next_year_start(F.col("__any")).alias("end_value")
    )


@dataclass(frozen=True)
class VersionTable:
    """Stored versions and their keys, changed in batches. Versions are stored with their numbers."""

    spark: SparkSession
    path: str

    def create(self, versions: DataFrame, keys: DataFrame) -> int:
        return write_versions(temporal.numbered(versions), self.path, new_keys=keys)

    def versions(self, version: int | None = None, numbers: bool = False) -> DataFrame:
        rows = read_versions(self.spark, self.path, version).drop(YEAR)
        return rows if numbers else rows.drop("rec_version")

    def keys(self, version: int | None = None) -> DataFrame:
        folders = _manifest(self.spark, self.path, version)["keys"]
        return self.spark.read.parquet(*[f"{self.path}/keys/{name}" for name in folders])

    def current(self) -> DataFrame:
        """The current view, from open rows and keys alone."""
        return temporal.current(read_open(self.spark, self.path).drop(YEAR), self.keys())

    def as_of(self, ts: str) -> DataFrame:
        """Versions valid at ``ts``, with the ``created`` of their ids."""
        return temporal.as_of(read_as_of(self.spark, self.path, ts).drop(YEAR), ts, self.keys())

    def apply(self, changes: DataFrame, ts: str, order: Sequence[str]) -> int:
        """Check a batch, then publish it: open rows of the years of the versions it closes and of ``ts`` are replaced, closed
        rows are added. Nothing but open rows is read."""
        at = F.lit(ts).cast("timestamp_ntz")
        base = latest_version(self.spark, self.path)
        held, snap = _manifest(self.spark, self.path, base), uuid.uuid4().hex
        stored = read_open(self.spark, self.path, base)
        temporal.check_changes(stored.drop(YEAR), changes, at)
        hit = stored.join(changes.filter(F.col("op") != "insert").select("id"), "id", "left_semi")
        touched = {*(str(r[0]) for r in hit.select(YEAR).distinct().collect()), ts[:4]}
        affected = stored.filter(F.col(YEAR).isin(sorted(map(int, touched)))).drop(YEAR)
        new_keys, after = temporal.change_batch(self.keys(base), affected, changes, at, order, check=False)
        found = _write(after, self.path, snap, "valid_from", "valid_to", "id")
        years = {y: dict(parts) for y, parts in held["years"].items()}
        for year in touched:
            years.setdefault(year, {}).pop(OPEN, None)
        for year, ends in found.items():
            for close in ends:
                own = years.setdefault(year, {})
                own[close] = [snap] if close == OPEN else [*own.get(close, []), snap]
        years = {y: parts for y, parts in years.items() if parts}
        return _publish(self.spark, self.path, base + 1, years, _with_keys(held, self.path, snap, new_keys))

    def compact(self, most: int = 16) -> int | None:
        """Rewrite the years that have more than ``most`` folders for one year of closing, and the keys where they have more
        folders. None if there was nothing to do."""
        base = latest_version(self.spark, self.path)
        held, snap = _manifest(self.spark, self.path, base), uuid.uuid4().hex
        many = {y for y, parts in held["years"].items() if any(len(snaps) > most for snaps in parts.values())}
        if not many and len(held["keys"]) <= most:
            return None
        years, keys = dict(held["years"]), held["keys"]
        if many:
            rows = _read(self.spark, self.path, {y: years[y] for y in many}).drop(YEAR)
            found = _write(rows, self.path, snap, "valid_from", "valid_to", "id")
            years |= {y: {c: [snap] for c in ends} for y, ends in found.items()}
        if len(keys) > most:
            keys = _with_keys({"keys": []}, self.path, snap, self.keys(base))
        return _publish(self.spark, self.path, base + 1, years, keys)

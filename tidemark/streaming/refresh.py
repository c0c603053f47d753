"""A job that keeps a feed snapshot fresh and logs every run."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.distinct import first_per_key
from tidemark.plans.bucketed import BUCKET, BucketedSnapshot
from tidemark.plans.snapshots import Snapshot, latest_version
from tidemark.sources.feeds import read_feed, stream_files

LOG_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.LongType(), False),
        T.StructField("time_stamp_begin", T.TimestampType(), False),
        T.StructField("time_stamp_end", T.TimestampType(), False),
        T.StructField("executed", T.StringType(), False),
    ]
)


def merge_items(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """One row per guid: the newest publication, and of equal ones the row that came first.

    Items that come with their bucket are brought together by it once, and stay so.
    """
    arrived = new.withColumn("__later", F.lit(1))
    if old is not None:
        arrived = old.withColumn("__later", F.lit(0)).unionByName(arrived)
    # max_by on (published, -later, content) is a total order for rows of one guid.
    ranked = arrived.withColumn("__rank", -F.col("__later")).withColumn(
        "__known", F.coalesce("published", F.lit("0001-01-01 00:00:00").cast("timestamp_ntz"))
    )
    keys = ["guid"]
    if BUCKET in ranked.columns:
        ranked, keys = ranked.repartition(BUCKET), [BUCKET, "guid"]
    best = first_per_key(ranked, keys, ["__known", "__rank", "title", "link", "description"], last=True)
    return best.drop("__later", "__rank", "__known")


@dataclass(frozen=True)
class RefreshJob:
    """Where the feed files land, and where snapshot, log and stream checkpoint are kept.

    A ``BucketedSnapshot`` with ``guid`` as its key is changed by the items that arrive; a plain one is written anew in each batch.
    """

    spark: SparkSession
    feed: str
    snapshot: Snapshot | BucketedSnapshot
    log: str
    checkpoint: str
    encoded: bool = False

    def _run(self, items: DataFrame, batch: int) -> None:
        begin = dt.datetime.now(dt.timezone.utc)
        # A batch runs in a session of its own.
        snapshot = replace(self.snapshot, spark=items.sparkSession)
        base = latest_version(snapshot.spark, snapshot.path)
        if isinstance(snapshot, BucketedSnapshot):
            # Only the buckets of the batch's guids are read and written.
            snapshot.merge(items, merge_items, base)
        else:
            old = snapshot.read(base) if base else None
            snapshot.refresh(merge_items(old, items), key=["guid"], base=base)
        end = dt.datetime.now(dt.timezone.utc)
        row = [(batch, begin, end, "refresh feed snapshot")]
        # A batch that is run again after a failure replaces its own log row.
        snapshot.spark.createDataFrame(row, LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            f"{self.log}/batch={batch}"
        )

    def _read(self, files: DataFrame, batch: int) -> None:
        """The items of a batch's files; only the names of the files, a batch's worth, come to the driver."""
        paths = [row.path for row in files.collect()]
        if paths:
            self._run(read_feed(files.sparkSession, paths, self.encoded), batch)

    def start(self, interval: str | None = "1 minute", files_per_batch: int | None = None):
        """Start the stream. Without ``interval`` it takes what is there and stops by itself."""
        files = stream_files(self.spark, self.feed, files_per_batch)
        writer = files.writeStream.foreachBatch(self._read).option("checkpointLocation", self.checkpoint)
        trigger = {"processingTime": interval} if interval else {"availableNow": True}
        return writer.trigger(**trigger).start()

    def log_rows(self) -> DataFrame:
        return self.spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", "true").parquet(self.log)

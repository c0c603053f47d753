"""Mixing sources to target weights by systematic sampling.

Every source has a target in words. Documents of a source are put in order of size; each is expected to be taken
target / size-of-source times, and with one random offset per source a document is emitted once for every integer that
the running sum of expected copies crosses. The copies of a document differ from the expected number by less than one, and
as neighbours in the order have like sizes, the words taken come near the target.

The order within sources is one range partitioning over all rows, numbered with one summary row per partition, so a source
of any size is spread over many tasks. Sources are a small table (one row each).

Defined results: a null or blank text has size zero; a null source is a source of its own, after all others; a source
without words has target zero and is not taken; rows that repeat are sampled one by one. An empty table gives an empty one.
The offset comes from a digest of seed and source, so reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import number_rows
from tidemark.session import written

SPACES = "[\\x20\\x09-\\x0D]+"
WEIGHTS, SHARE, CAP, SEED = (5, 2, 1), 1.5, 2.0, "mix-1"


def word_count(text: Column) -> Column:
    """Number of words; zero for null."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    edges = F.when(F.element_at(parts, 1) == "", 1).otherwise(0) + F.when(
        (F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1
    ).otherwise(0)
    return (F.size(parts) - edges).cast("bigint")


def targets(sizes: DataFrame, source: str, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per source: rows, words, the target, and the number of rows in sources before it.

    Targets share ``share`` of all words by weight. A target stops at ``cap`` times its source; what is over goes to the
    others by weight. In the order of cap by weight there is one level below which all are capped, found with running sums.
    """
    by = sizes.groupBy(source).agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    everything = Window.orderBy(F.col(source).asc_nulls_last())  # one row per source
    by = by.withColumn("k", F.row_number().over(everything) - 1)
    by = by.withColumn("before", F.sum("rows").over(everything) - F.col("rows"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    by = by.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    total = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by = by.withColumn("budget", share * F.sum("source_size").over(total))
    fill = Window.orderBy(F.col("most") / F.col("weight"), "k")
    capped = F.coalesce(F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    by = by.withColumn("level", (F.col("budget") - capped) / left)
    open_ = F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("level"))
    by = by.withColumn("level", F.first(open_, ignorenulls=True).over(fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.least(F.col("most"), F.coalesce(F.col("level") * F.col("weight"), F.col("most")))
    return by.select(source, "before", "source_size", target.alias("target"))


def offset(source: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1, fixed by seed and source."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit("")))), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(1 << 32))


def copies(
    rows: DataFrame, source: str = "source", order: list[Column] = (), weights=WEIGHTS, share=SHARE, cap=CAP, seed=SEED
) -> DataFrame:
    """Rows with a column ``size``, and source_size, target, and the ``copies`` the mix takes of each.

    ``order`` breaks ties of size; the place in the input comes last, so equal rows don't meet in one task.
    """
    by = targets(rows, source, weights, share, cap).withColumnRenamed(source, "__source")
    ordered = number_rows(
        rows.withColumn("__place", F.monotonically_increasing_id()),
        [F.col(source).asc_nulls_last(), F.col("size").asc(), *order, F.col("__place")],
        "__rank",
        start=0,
    )
    joined = ordered.join(F.broadcast(by) if by.count() <= 100_000 else by, F.col(source).eqNullSafe(F.col("__source")))
    rate = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    rank = (F.col("__rank") - F.col("before")).cast("double")
    start = offset(F.col(source), seed)
    taken = F.floor(rate * (rank + 1) + start) - F.floor(rate * rank + start)
    return joined.withColumn("copies", taken.cast("bigint")).drop("__source", "__rank", "__place", "before")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The documents with their own columns, each as often as the mix takes it.

    Rows that are equal in id, text and source are sampled one by one, and one of them stands for all that are taken.
    """
    key = [F.col(doc_id).alias("__id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__text")]
    slim = written(docs.select(*key, F.col(source).alias("__from"), word_count(F.col(text)).alias("size")), "sizes")
    ids = [F.col("__id").asc_nulls_last(), F.col("__text")]
    taken = copies(slim, "__from", ids, **how)
    taken = taken.groupBy("__id", "__text", "__from").agg(F.sum("copies").alias("__copies"))
    taken = taken.filter("__copies > 0").withColumnRenamed("__id", "__i").withColumnRenamed("__text", "__t")
    same = (
        F.col(doc_id).eqNullSafe(F.col("__i"))
        & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("__t"))
        & F.col(source).eqNullSafe(F.col("__from"))
    )
    once = docs
    if slim.groupBy("__id", "__text", "__from").count().agg(F.coalesce(F.max("count"), F.lit(0))).first()[0] > 1:
        once = docs.dropDuplicates([doc_id, text, source])
    joined = once.join(taken, same)
    repeated = joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return repeated.select(*[F.col(c) for c in docs.columns])

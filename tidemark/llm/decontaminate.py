"""Benchmark decontamination with built-in functions only.

Benchmark items are cut into windows of ``window`` consecutive words (an item of fewer words is one window). Windows are
hashed; the hash table is broadcast where the benchmark has at most ``MAX_BROADCAST_WINDOWS`` windows, which bounds its
size, and joined by a shuffle otherwise. Every document's own windows are hashed in one scan; where a hash is found, the
words are compared, so that a hit is never a mere collision.

Defined results: a null text and a text without words have no hits; a null item, or one without words, has no windows; an
item without an id takes part as an item whose id is the empty string. Rows that repeat are judged one by one; two rows
with one doc_id are told apart by their texts. Other columns are not looked at. Empty tables give empty or clean results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import written

BREAKS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
WINDOW = 10
#: A window in the broadcast table takes about 200 bytes.
MAX_BROADCAST_WINDOWS = 500_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, all else as it is; texts of plain ASCII take the fast built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """The normalised words of a text."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS), lambda w: w != "")


def _windows(hashes: str, length: int) -> Column:
    column = F.col(hashes)
    # Used outside the lambda too, so that the optimiser doesn't compute it for each element.
    return F.when(
        F.size(column) >= length,
        F.transform(
            F.sequence(F.lit(0), F.size(column) - length), lambda i: F.xxhash64(F.slice(column, i + 1, F.lit(length)))
        ),
    )


def _worded(df: DataFrame, text: str, keys: list[Column]) -> DataFrame:
    words = df.select(*keys, words_of(F.col(text)).alias("__words"))
    return words.withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))


def _exploded(worded: DataFrame, keys: list[str], length: int, keep_words: bool = True) -> DataFrame:
    hashed = worded.withColumn("__windows", _windows("__hashes", length))
    kept = ["__words"] if keep_words else []
    # The outer form: for the inner one the optimiser would add a filter on the size of the windows and compute them twice.
    return hashed.select(*keys, *kept, F.posexplode_outer("__windows").alias("__pos", "__hash"))


def benchmark_windows(benchmark: DataFrame, item: str, text: str, window: int = WINDOW) -> DataFrame:
    """(hash, gram, length, item) of every window of every item, written once."""
    worded = _worded(benchmark, text, [F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item")])
    worded = worded.filter(F.size("__words") > 0)
    size = F.least(F.size("__words"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("__words") - size)
    places = worded.select("item", "__words", "__hashes", size.alias("length"), F.explode(starts).alias("__at"))
    part = lambda name: F.slice(name, F.col("__at") + 1, F.col("length"))
    rows = places.select(
        F.xxhash64(part("__hashes")).alias("hash"), F.array_join(part("__words"), " ").alias("gram"), "length", "item"
    )
    return written(rows.distinct(), "benchmark-windows")


def _hits(docs: DataFrame, text: str, keys: list[Column], windows: DataFrame) -> DataFrame:
    """(keys, gram, length, places) of every window found in a document, written once."""
    names = ["__id", "__text"]
    grams = windows.select("hash", "gram", "length").distinct()
    lengths = sorted(r[0] for r in grams.select("length").distinct().collect())  # at most ``window`` values
    small = grams.count() <= MAX_BROADCAST_WINDOWS
    found = []
    for length in lengths:
        own = grams.filter(F.col("length") == length)
        worded = _worded(docs, text, keys)
        at = F.slice("__words", F.col("__pos") + 1, F.lit(length))
        if small:
            joined = _exploded(worded, names, length).join(F.broadcast(own), F.col("__hash") == F.col("hash"))
        else:  # only keys and hashes travel; the words are fetched for the documents with candidates
            pairs = _exploded(worded, names, length, keep_words=False).join(own, F.col("__hash") == F.col("hash"))
            pairs = pairs.withColumnsRenamed({"__id": "__i", "__text": "__x"})
            same = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__text") == F.col("__x"))
            # Rows that repeat have the same words; one of them is enough.
            joined = pairs.join(worded.select(*names, "__words").dropDuplicates(names), same)
        found.append(joined.filter(F.array_join(at, " ") == F.col("gram")).select(*names, "gram", "length", "__pos"))
    if not found:
        return None
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return written(every.groupBy(*names, "gram", "length").agg(F.collect_set("__pos").alias("places")), "hits")


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    keep_spans: bool = False,
) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated; ``spans`` (first, after last) too if wanted."""
    keys = [F.col(doc_id).alias("__id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("__text")]
    windows = benchmark_windows(benchmark, item, item_text, window)
    hits = _hits(docs, text, keys, windows)
    counted = docs.select(*keys, F.size(words_of(F.col(text))).cast("bigint").alias("n_words"))
    span = "array<struct<first:int,last:int>>"
    if hits is None:
        joined = counted.withColumns({"spans": F.lit(None).cast(span), "items": F.lit(None).cast("array<string>")})
    else:
        spans = hits.select(
            F.col("__id").alias("__i"), F.col("__text").alias("__x"), F.transform("places", lambda p: F.struct(p.alias("first"), (p + F.col("length")).alias("last"))).alias("s")
        )
        spans = spans.groupBy("__i", "__x").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("s")))).alias("spans"))
        owners = windows.select("gram", "item")
        named = hits.select("__id", "__text", "gram").join(owners, "gram").select("__id", "__text", "item").distinct()
        items = named.groupBy("__id", "__text").agg(F.sort_array(F.collect_set("item")).alias("items"))
        items = items.withColumnsRenamed({"__id": "__j", "__text": "__y"})
        found = spans.join(items, F.col("__i").eqNullSafe(F.col("__j")) & (F.col("__x") == F.col("__y")))
        same = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__text") == F.col("__x"))
        joined = counted.join(found.select("__i", "__x", "spans", "items"), same, "left")
    n_hit = F.aggregate(
        F.coalesce(F.col("spans"), F.array().cast(span)),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["last"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(acc["end"], s["first"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )
    items = F.coalesce(F.col("items"), F.array().cast("array<string>"))
    return joined.select(
        F.col("__id").alias(doc_id),
        "n_words",
        n_hit.alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        F.col("spans").isNotNull().alias("contaminated"),
        *(["__text", "spans"] if keep_spans else []),
    )


def _without_spans(text: Column, spans: Column) -> Column:
    """The text without the words in the spans and the breaks behind them."""
    words = F.regexp_extract_all(text, F.lit("([^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+)"), F.lit(1))
    breaks = F.split(text, "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
    pieces = F.transform(
        words,
        lambda w, i: F.when(F.exists(spans, lambda s: (i >= s["first"]) & (i < s["last"])), F.lit("")).otherwise(
            F.concat(w, F.get(breaks, i + 1))
        ),
    )
    return F.concat(F.get(breaks, F.lit(0)), F.array_join(pieces, ""))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents with their own columns, without contaminated ones or (``remove="spans"``) without the hit words."""
    report = contamination(docs, benchmark, doc_id=doc_id, text=text, keep_spans=True, **how)
    hit = report.filter("contaminated").select(F.col(doc_id).alias("__hit_id"), F.col("__text").alias("__hit_text"), "spans")
    hit = hit.dropDuplicates(["__hit_id", "__hit_text"])
    same = F.col(doc_id).eqNullSafe(F.col("__hit_id")) & (
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("__hit_text")
    )
    if remove == "documents":
        return docs.join(hit, same, "left_anti")
    left = docs.join(hit.withColumnRenamed("spans", "__spans"), same, "left")
    cut = F.when(F.col("__spans").isNull(), F.col(text)).otherwise(_without_spans(F.col(text), F.col("__spans")))
    return left.select(*[cut.alias(c) if c == text else F.col(c) for c in docs.columns])

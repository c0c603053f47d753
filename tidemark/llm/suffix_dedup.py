"""Removal of passages that occur twice, by suffix arrays over groups of like contexts.

A string of ``LENGTH`` bytes that starts at two places has the same anchor at both: the leftmost of its ``GRAM``-byte pieces
with the smallest hash. All anchors of a text are found with two running minima; a text has one about every 80 bytes. Places
are grouped by their anchor piece. A group of two or more places may hold repeated strings, all within the context of the anchor:
``BACK`` bytes before it and ``LENGTH`` bytes from it on.

Contexts found twice or more are repeated as a whole. All others are decided in suffix arrays: the right and the (reversed)
left halves of the contexts of whole groups are cut into pieces of ``PIECE`` bytes, one number each, and the suffix array of
all halves, one after the other, is made by the linear grouping construction. It puts the halves in order; with the
bytes that neighbours share, two contexts agree on the string that begins d bytes before the anchor exactly if their left halves
share d bytes and their right halves ``LENGTH`` - d. So no text is compared twice with another and no pairs are made.

Groups with more than ``MAX_GROUP`` different contexts are not brought into one task; their strings are counted by 128-bit hashes
with map-side sums instead. The anchor rows of a very frequent piece are counted by windows, which spill to disk.

The result is exact but for collisions of 64-bit hashes of anchor pieces with equal contexts. Defined results: a null
text is empty; texts of fewer than ``LENGTH`` bytes lose nothing; rows that repeat are repeated passages of each other; ids
don't matter. Other columns are not looked at; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytesops import mix, prefix_hash, seed, span_hash, text_slices
from tidemark.llm.grouping import suffix_array
from tidemark.session import written

LENGTH, GRAM, PIECE = 200, 32, 25
BACK = LENGTH - GRAM
MAX_GROUP, CHUNK = 20_000, 3000
_BITS = 9  # for each of the context's two lengths


def _running(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Smallest (or largest) of every ``width`` values in a row."""
    best, span, take = values, 1, np.minimum if least else np.maximum
    while span * 2 <= width:
        best = take(best[:-span], best[span:])
        span *= 2
    n = len(values) - width + 1
    return take(best[:n], best[width - span : width - span + n])


def anchors(data: np.ndarray, offsets: np.ndarray):
    """Places, rows, piece hashes, context hashes, and bytes of context before and from the place on."""
    n = len(data)
    if n < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64), none, none
    prefix = prefix_hash(data)
    at = np.arange(n - GRAM + 1)
    pieces = span_hash(prefix, at, at + GRAM) | np.uint64(1)
    width = BACK + 1
    least = _running(pieces, width, True)
    starts = np.arange(len(least))
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    least = np.where(starts + LENGTH <= offsets[rows[: len(least)] + 1], least, np.uint64(0))  # strings don't cross texts
    edge = np.zeros(BACK, np.uint64)
    most = _running(np.concatenate([edge, least, edge]), width, False)[: len(pieces)]
    at = np.flatnonzero(most == pieces)
    row = rows[at]
    left = np.minimum(at - offsets[row], BACK)
    right = np.minimum(offsets[row + 1] - at, LENGTH)
    context = span_hash(prefix, at - left, at + right)
    return at - offsets[row], row, pieces[at], mix(context ^ left.astype(np.uint64) * seed(5)), left, right


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, stop, data, offsets in text_slices(batch.column(1)):
            at, row, piece, context, left, right = anchors(data, offsets)
            keys = batch.column(0).slice(first, stop - first).to_numpy(zero_copy_only=False)
            place = at << 2 * _BITS | left << _BITS | right
            yield pa.record_batch(
                [pa.array(keys[row]), pa.array(place), pa.array(piece.view(np.int64)), pa.array(context.view(np.int64))],
                ["t", "place", "g", "f"],
            )


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the contexts asked for: (t, text, wanted) to one row per context."""
    for batch in batches:
        for key, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            data = unpacked(text.as_buffer().to_pybytes())
            rows = wanted.as_py()
            spots = [(r["place"] >> 2 * _BITS, r["place"] >> _BITS & 511, r["place"] & 511) for r in rows]
            yield pa.record_batch(
                [
                    pa.array([r["g"] for r in rows], pa.int64()),
                    pa.array([r["n"] for r in rows], pa.int64()),
                    pa.array([r["m"] for r in rows], pa.int64()),
                    pa.array([key] * len(rows), pa.int64()),
                    pa.array([r["place"] for r in rows], pa.int64()),
                    pa.array([data[at - left : at + right] for at, left, right in spots], pa.binary()),
                ],
                ["g", "n", "m", "t", "place", "bytes"],
            )


def ordered(halves: list[bytes]) -> np.ndarray:
    """Indices of different strings in ascending order, from the suffix array of all of them."""
    cut = [[h[a : a + PIECE] for a in range(0, len(h), PIECE)] for h in halves]
    numbers = {piece: k + 2 for k, piece in enumerate(sorted({p for c in cut for p in c}))}
    text: list[int] = []
    begins: dict[int, int] = {}
    for k, pieces in enumerate(cut):
        begins[len(text)] = k
        text += [numbers[p] for p in pieces]
        text.append(1)
    text.append(0)
    return np.array([begins[i] for i in suffix_array(text) if i in begins], np.int64)


def shared_bytes(halves: list[bytes], order: np.ndarray) -> np.ndarray:
    """How many leading bytes each string in order shares with the one before it."""
    sizes = np.array([len(h) for h in halves])[order]
    table = np.frombuffer(b"".join(halves[k].ljust(LENGTH, b"\0") for k in order), np.uint8).reshape(-1, LENGTH)
    apart = table[1:] != table[:-1]
    first = np.where(apart.any(1), apart.argmax(1), LENGTH)
    return np.concatenate([[0], np.minimum(np.minimum(first, sizes[1:]), sizes[:-1])]) if len(order) else np.zeros(0, np.int64)


def decide(contexts: list[bytes], lefts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest and smallest number of bytes before the anchor at which a repeated string begins; -1 where none does."""
    left_of, right_of = {}, {}
    left = np.array([left_of.setdefault(c[:k][::-1], len(left_of)) for c, k in zip(contexts, lefts, strict=True)])
    right = np.array([right_of.setdefault(c[k:], len(right_of)) for c, k in zip(contexts, lefts, strict=True)])
    sides = []
    for names, own in ((list(left_of), left), (list(right_of), right)):
        order = ordered(names)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        sides.append((shared_bytes(names, order), rank[own]))
    (left_shared, left_rank), (right_shared, right_rank) = sides
    rights = np.array([len(c) for c in contexts]) - lefts
    most, least = np.full(len(contexts), -1), np.full(len(contexts), -1)
    for d in range(BACK + 1):
        fits = np.flatnonzero((lefts >= d) & (rights >= LENGTH - d))
        if not len(fits):
            continue
        # Halves that share enough bytes are neighbours in order; a class ends where too few are shared.
        a = np.cumsum(left_shared < d)[left_rank[fits]]
        b = np.cumsum(right_shared < LENGTH - d)[right_rank[fits]]
        key = a * np.int64(len(right_shared) + 1) + b
        _, where = np.unique(key, return_inverse=True)
        again = fits[np.bincount(where, counts[fits])[where] > 1]
        most[again] = d
        least[again[least[again] < 0]] = d
    return most, least


def _decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; whole groups are gathered until there are ``CHUNK`` contexts."""
    kept: list[pa.RecordBatch] = []

    def out(table):
        data = [v.as_buffer().to_pybytes() for v in table.column(5)]
        places = table.column(4).to_numpy()
        lefts = places >> _BITS & 511
        most, least = decide(data, lefts, table.column(1).to_numpy())
        yes = most >= 0
        at = places >> 2 * _BITS
        return pa.record_batch(
            [pa.array(table.column(3).to_numpy()[yes]), pa.array((at - most)[yes]), pa.array((at + LENGTH - least)[yes])], ["t", "first", "last"]
        )

    def cut(final):
        table = pa.concat_batches(kept)
        groups = table.column(0).to_numpy()
        ends = np.append(np.flatnonzero(groups[1:] != groups[:-1]) + 1, [len(groups)] if final else [])
        begin = 0
        while begin < len(groups):
            fitting = ends[(ends > begin) & (ends <= begin + CHUNK)]
            later = ends[ends > begin]
            if not len(later) or (not final and not len(fitting) and len(later) == 0):
                break
            end = int(fitting[-1]) if len(fitting) else int(later[0])
            if not final and end == ends[-1] and len(groups) - begin < CHUNK:
                break
            yield out(table.slice(begin, end - begin))
            begin = end
        kept[:] = [table.slice(begin)] if begin < len(groups) else []

    for batch in batches:
        kept.append(batch)
        if sum(len(b) for b in kept) >= CHUNK:
            yield from cut(False)
    if kept:
        yield from cut(True)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of every string of the contexts of very large groups, with the group and the place in the context."""
    for batch in batches:
        for g, n, key, place, value in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4)), batch.column(5), strict=True):
            data, left = value.as_buffer().to_pybytes(), place >> _BITS & 511
            begins = range(0, min(left, len(data) - LENGTH) + 1)
            sums = [hashlib.md5(b"%d %d " % (g, left - b) + data[b : b + LENGTH]).digest() for b in begins]
            at = (place >> 2 * _BITS) - left
            yield pa.record_batch(
                [pa.array(sums, pa.binary()), pa.array([n] * len(sums), pa.int64()), pa.array([key] * len(sums), pa.int64()), pa.array([at + b for b in begins], pa.int64())],
                ["h", "n", "t", "first"],
            )


def unpacked(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in a smaller form for the shuffle."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        texts = [pack(v.as_buffer() if v.is_valid and v.as_buffer() is not None else b"") for v in batch.column(batch.num_columns - 1)]
        yield pa.record_batch([*batch.columns[:-1], pa.array(texts, pa.binary())], batch.schema.names)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The texts without their spans."""
    for batch in batches:
        rows = []
        for value, firsts, lasts in zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            data, out, at, removed, spans = unpacked(value.as_buffer().to_pybytes()), [], 0, 0, 0
            end = -1
            for first, last in sorted(zip(firsts or [], lasts or [], strict=True)):
                if first > end:  # a new run
                    spans += 1
                    out.append(data[at:first])
                    removed -= first
                    if end >= 0:
                        removed += end
                    end = last
                else:
                    end = max(end, last)
                at = end
            removed += max(end, 0)
            out.append(data[at:])
            rows.append((len(data), removed, spans, b"".join(out)))
        yield pa.record_batch(
            [batch.column(0), *[pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], pa.array([r[3] for r in rows], pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def repeated_spans(texts: DataFrame, packed: DataFrame) -> DataFrame:
    """(t, first, last) of byte spans covered by repeated strings; ``texts``: t, text, one row per occurrence of a text."""
    found = texts.mapInArrow(_anchored, "t bigint, place bigint, g bigint, f bigint").repartition("g")
    same, group = Window.partitionBy("g", "f"), Window.partitionBy("g")
    counted = (
        found.withColumn("k", F.row_number().over(same.orderBy("t", "place")))
        .withColumn("n", F.count(F.lit(1)).over(same))
        .withColumn("total", F.count(F.lit(1)).over(group))
        .withColumn("m", F.sum(F.when(F.col("k") == 1, 1).otherwise(0)).over(group))
    )
    counted = written(counted.filter("total > 1").drop("total", "f"), "anchors")
    at, left, right = F.shiftright("place", 2 * _BITS), F.shiftright("place", _BITS).bitwiseAND(511), F.col("place").bitwiseAND(511)
    whole = counted.filter("n > 1").filter(left + right >= LENGTH).select("t", (at - left).alias("first"), (at + right).alias("last"))
    wanted = counted.filter("m > 1 AND k = 1").groupBy("t").agg(F.collect_list(F.struct("g", "n", "m", "place")).alias("wanted"))
    # One row stands for all copies of a text.
    asked = wanted.join(packed, "t").select("t", "packed", "wanted")
    shape = "g bigint, n bigint, m bigint, t bigint, place bigint, bytes binary"
    contexts = asked.mapInArrow(_contexts, shape)
    huge = counted.agg(F.coalesce(F.max("m"), F.lit(0))).first()[0] > MAX_GROUP
    if huge:
        contexts = written(contexts, "contexts")
    usual = contexts.filter(F.col("m") <= MAX_GROUP).repartition("g").sortWithinPartitions("g")
    parts = usual.mapInArrow(_decided, "t bigint, first bigint, last bigint")
    if huge:
        strings = contexts.filter(F.col("m") > MAX_GROUP).mapInArrow(_strings, "h binary, n bigint, t bigint, first bigint")
        again = strings.groupBy("h").agg(F.sum("n").alias("times")).filter("times > 1").select("h")
        parts = parts.unionByName(strings.join(again, "h", "left_semi").select("t", "first", (F.col("first") + LENGTH).alias("last")))
    return whole.unionByName(parts)


def remove_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of every document; ``kept`` has the bytes that are left."""
    whole = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(whole).alias("t"), whole.cast("binary").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    packed = slim.mapInArrow(_packed, f"doc_id {kind}, t bigint, packed binary")
    one = slim.groupBy("t").agg(F.min("doc_id").alias("first_id")).withColumnRenamed("t", "u")
    copies = slim.select("doc_id", "t").groupBy("doc_id", "t").count().filter("count > 1").limit(1).count() > 0
    # A text's smallest id is null where all its rows have none.
    unique = packed.join(one, (F.col("t") == F.col("u")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi")
    if copies:
        unique = unique.dropDuplicates(["t"])
    spans = repeated_spans(slim.filter(F.octet_length("text") >= LENGTH).select("t", "text"), unique.select("t", "packed"))
    spans = spans.groupBy("t").agg(F.collect_set(F.struct("first", "last")).alias("s"))
    spans = spans.select(F.col("t").alias("u"), F.col("s.first").alias("firsts"), F.col("s.last").alias("lasts"))
    joined = packed.join(spans, F.col("t") == F.col("u"), "left").select("doc_id", "packed", "firsts", "lasts")
    return joined.mapInArrow(_cut, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary").withColumnRenamed("doc_id", doc_id)

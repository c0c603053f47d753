"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set has its distinct shingles of five words. The sketch has ``BINS`` coordinates: in each round every shingle
is thrown into one bin, and a bin that is still empty keeps the smallest value; after as many rounds as bins, each bin that is
left takes the smallest value of a round of its own. So every coordinate is filled, and the share of equal coordinates of two
sketches is concentrated around their similarity like a sum of independent trials.

Documents with equal sets are one class from then on. Classes that agree in one band of three coordinates are candidates:
at a similarity of 0.75 a pair agrees in none of the 42 bands with probability 1e-10. A candidate pair with fewer than
``LEAST_EQUAL`` of 126 equal coordinates is passed over; at 0.75 that is five standard deviations away (below 1e-6). All
others are compared on their full sets. With ``least_equal=0`` no candidate is passed over.

No bucket is expanded into pairs. First each member is compared with its bucket's smallest member, which unites large groups
of copies. Buckets that still hold several components are compared across components in blocks of bounded size, by sketches;
a block passes on which members hang together, not the pairs. What hangs together so is compared once more in blocks, on the
full sets, by matrix products; a block passes on stars of linked members, fewer rows than it has members. So every candidate pair
is decided. Before the blocks, a group's members are sent to the blocks they take part in: each of ``s`` members to about
ceil(o / ``BLOCK``) of them, where ``o`` counts those outside the group's largest component, and these to ceil(s / ``BLOCK``).

Defined results: a null text and one without words has an empty set and is linked with nothing; a text of fewer than five words
has its whole sequence as its only shingle; rows that repeat are in one component and, as they share the id, all kept; a row
without an id has no component, links nothing and is kept. Where an id names several texts, each counts with its links, and
documents that are linked to any of them are in one component. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesops import LOWER, mix, prefix_hash, seed, span_hash, text_slices, window_hash, word_spans
from tidemark.llm.components import components
from tidemark.session import written

SHINGLE, BANDS, ROWS = 5, 42, 3
BINS = BANDS * ROWS
LEAST_EQUAL = 70
#: Members of one side of a block in which sketches or sets are compared.
BLOCK = 1000


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each row, and their rows."""
    lowered = LOWER[data]
    starts, ends, rows = word_spans(lowered, offsets)
    words = span_hash(prefix_hash(lowered), starts, ends)
    hashes, first = window_hash(words, rows, SHINGLE)
    of = rows[first]
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    for n in range(1, SHINGLE):
        if (counts == n).any():
            short = counts[rows] == n
            some, where = window_hash(words[short], rows[short], n)
            hashes = np.concatenate([hashes, mix(some ^ seed(1000 + n))])
            of = np.concatenate([of, rows[short][where]])
    order = np.lexsort((hashes, of))
    hashes, of = hashes[order], of[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], of[new]


def sketches(hashes: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """The 16-bit coordinates of the rows' sketches; rows without shingles are left at zero."""
    out = np.zeros((count, BINS), np.uint16)
    empty = np.zeros((count, BINS), bool)
    empty[np.unique(rows)] = True

    def place(values, where, bins, k):
        low = values & np.uint64((1 << 40) - 1)
        packed = np.sort((where * BINS + bins).astype(np.uint64) << np.uint64(40) | low)
        spot = packed >> np.uint64(40)
        first = np.ones(len(packed), bool)
        first[1:] = spot[1:] != spot[:-1]
        at, kept = spot[first].astype(np.int64), packed[first]
        row, column = at // BINS, at % BINS
        free = empty[row, column]
        row, column = row[free], column[free]
        out[row, column] = mix(kept[free] & np.uint64((1 << 40) - 1) ^ seed(k)) & np.uint64(0xFFFF)
        empty[row, column] = False

    some, where = hashes, rows
    for k in range(2 * BINS):
        if not len(some):
            break
        values = mix(some ^ seed(k))
        if k < BINS:
            bins = ((values >> np.uint64(40)) * np.uint64(BINS) >> np.uint64(24)).astype(np.int64)
            place(values, where, bins, k)
        else:
            place(values, where, np.full(len(values), k - BINS), k)
        open_ = empty.any(1)[where]
        some, where = some[open_], where[open_]
    return out


def bands_of(sketch: np.ndarray) -> np.ndarray:
    """The three coordinates of each band in the low 48 bits, the band's number above them."""
    three = sketch.reshape(-1, BANDS, ROWS).astype(np.int64)
    return three[:, :, 0] | three[:, :, 1] << 16 | three[:, :, 2] << 32 | np.arange(BANDS, dtype=np.int64) << 48


def coordinates(bands: np.ndarray) -> np.ndarray:
    """The sketches of rows of bands."""
    return np.ascontiguousarray(bands).view(np.uint16).reshape(-1, BANDS, 4)[:, :, :3].reshape(len(bands), BINS)


def equal_coordinates(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many coordinates each sketch of a shares with each of b."""
    if len(a) * len(b) < 2000:
        return (a[:, None, :] == b[None, :, :]).sum(2)
    total = np.zeros((len(a), len(b)), np.int16)
    for k in range(BINS):
        total += a[:, k, None] == b[None, :, k]
    return total


def _keys(hashes: np.ndarray, rows: np.ndarray, count: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Size of each set, and two hashes of it; together they name a class of equal sets."""
    keys = [np.zeros(count, np.uint64) for _ in range(2)]
    if len(rows):
        begins = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
        for k, key in enumerate(keys):
            key[rows[begins]] = np.add.reduceat(mix(hashes ^ seed(2000 + k)), begins)
    return np.bincount(rows, minlength=count), keys


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, stop, data, offsets in text_slices(batch.column(1)):
            count = stop - first
            hashes, rows = shingles(data, offsets)
            sizes, keys = _keys(hashes, rows, count)
            bands = bands_of(sketches(hashes, rows, count))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * BANDS, pa.int32()), pa.array(bands.reshape(-1)))
            yield pa.record_batch(
                [batch.column(0).slice(first, count), pa.array(sizes), *[pa.array(k.view(np.int64)) for k in keys], lists],
                ["id", "n", "k1", "k2", "bands"],
            )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, stop, data, offsets in text_slices(batch.column(1)):
            hashes, rows = shingles(data, offsets)
            bounds = np.searchsorted(rows, np.arange(stop - first + 1)) * 8
            data = pa.Array.from_buffers(
                pa.large_binary(), stop - first, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(hashes)]
            )
            sizes, keys = _keys(hashes, rows, stop - first)
            columns = [pa.array(sizes), *[pa.array(k.view(np.int64)) for k in keys]]
            yield pa.record_batch([batch.column(0).slice(first, stop - first), *columns, data.cast(pa.binary())], ["id", "n", "k1", "k2", "shingles"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        linked = np.zeros(len(batch), bool)
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            both = np.sort(np.concatenate([a, b]), kind="stable")
            common = int((both[1:] == both[:-1]).sum())
            linked[i] = common > 0 and 100 * common >= 75 * (len(both) - common)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(linked)], ["a", "b", "linked"])


def joined_pairs(hit: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star for every connected part of the graph between x and y: its smallest node beside each other one."""
    names, where = np.unique(np.concatenate([x, y]), return_inverse=True)
    i, j = np.nonzero(hit)
    a, b = where[: len(x)][i], where[len(x) :][j]
    label = np.arange(len(names))
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    far = np.flatnonzero(label != np.arange(len(names)))
    return names[label[far]], names[far]


def alike(side, cid, comp, size, data, least: int = LEAST_EQUAL) -> tuple[np.ndarray, np.ndarray]:
    """Which members of a block may be linked across components, by sizes and sketches, as stars."""
    x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    sketch = coordinates(data.flatten().to_numpy().reshape(-1, BANDS))
    hit = equal_coordinates(sketch[x], sketch[y]) >= least
    small, large = np.minimum(size[x][:, None], size[y][None]), np.maximum(size[x][:, None], size[y][None])
    hit &= (comp[x][:, None] != comp[y][None]) & (100 * small >= 75 * large)
    return joined_pairs(hit, cid[x], cid[y])


def common_shingles(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """The sizes of all intersections, by products of 0/1 matrices over the shingles that both sides have."""
    both = np.intersect1d(np.concatenate(x), np.concatenate(y))
    total = np.zeros((len(x), len(y)), np.float32)

    def entries(sets):
        rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        values = np.concatenate(sets)
        at = np.minimum(np.searchsorted(both, values), max(len(both) - 1, 0))
        known = both[at] == values if len(both) else np.zeros(len(values), bool)
        return rows[known], at[known]

    sides = [entries(s) for s in (x, y)]
    for first in range(0, len(both), 4096):
        parts = []
        for (rows, columns), n in zip(sides, total.shape, strict=True):
            own = (columns >= first) & (columns < first + 4096)
            part = np.zeros((n, min(4096, len(both) - first)), np.float32)
            part[rows[own], columns[own] - first] = 1
            parts.append(part)
        total += parts[0] @ parts[1].T
    return total.astype(np.int64)


def linked(side, cid, comp, size, data) -> tuple[np.ndarray, np.ndarray]:
    """Which members of a block are linked across components, by their full sets, as stars."""
    x, y = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in data]
    common = common_shingles([sets[k] for k in x], [sets[k] for k in y])
    hit = 100 * common >= 75 * (size[x][:, None] + size[y][None] - common)
    return joined_pairs(hit & (comp[x][:, None] != comp[y][None]), cid[x], cid[y])


def _blocks(decide):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block; a block has at most about ``BLOCK`` members on each side."""
        kept: list[pa.RecordBatch] = []

        def out(final):
            rows = pa.concat_batches(kept)
            keys = np.stack([rows.column(k).to_numpy() for k in range(3)])
            bounds = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [len(rows)] if final else []]).astype(int)
            columns = [rows.column(k).to_numpy() for k in range(3, 7)]
            found = [
                decide(*[c[s:e] for c in columns], rows.column(7).slice(s, e - s))
                for s, e in zip(bounds[:-1], bounds[1:], strict=True)
                if columns[0][s] == 0 and columns[0][e - 1] == 1
            ]
            kept[:] = [rows.slice(int(bounds[-1]))]
            if found:
                a, b = (np.concatenate(c) for c in zip(*found, strict=True))
                yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for batch in batches:
            kept.append(batch)
            if sum(len(b) for b in kept) >= 2 * BLOCK:
                yield from out(False)
        if kept and sum(len(b) for b in kept):
            yield from out(True)

    return run


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, linked) of candidate pairs, compared on their full sets and written."""
    of_a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    of_b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    full = pairs.join(of_b, "b").join(of_a, "a").select("a", "b", "x", "y")
    return written(full.mapInArrow(_compared, "a bigint, b bigint, linked boolean"), "verified")


def _alike(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """Candidate pairs whose sizes and sketches allow a similarity of 0.75."""
    of = lambda name, x: classes.select(F.col("cid").alias(name), F.col("n").alias(f"n{x}"), F.col("bands").alias(f"s{x}"))
    both = pairs.join(of("a", "a"), "a").join(of("b", "b"), "b")
    low, mid, high = (lambda z: z.bitwiseAND(0xFFFF)), (lambda z: z.bitwiseAND(0xFFFF0000)), (lambda z: z.bitwiseAND(0xFFFF00000000))
    same = lambda p: lambda z: F.when(p(z) == 0, 1).otherwise(0)
    apart = F.zip_with("sa", "sb", lambda x, y: x.bitwiseXOR(y))
    equal = F.aggregate(apart, F.lit(0), lambda total, z: total + same(low)(z) + same(mid)(z) + same(high)(z))
    sizes = 100 * F.least("na", "nb") >= 75 * F.greatest("na", "nb")
    return both.filter(sizes).filter(equal >= least).select("a", "b")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least_equal: int = LEAST_EQUAL) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    ``least_equal`` is how many coordinates of two sketches must be equal before their full sets are compared; 0 compares
    the sets of all candidates whose sizes allow a link.
    """
    slim = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    schema = "id bigint, n bigint, k1 bigint, k2 bigint, bands array<bigint>"
    rows = written(slim.mapInArrow(_sketched, schema), "sketches")
    named = rows.filter("id IS NOT NULL AND n > 0")
    repeats = _repeats(named)
    classes = named.groupBy("k1", "k2", "n").agg(F.min("id").alias("first"), F.min_by("bands", "id").alias("bands"))
    # A class is known by its smallest id; where ids name several texts, and so several classes, by a number of its own.
    number = F.monotonically_increasing_id() if repeats else F.col("first")
    classes = written(classes.withColumn("cid", number), "classes")
    member = classes.select("cid", F.explode("bands").alias("band"))
    # Buckets of one class are dropped before anything else is done with them.
    leaders = member.groupBy("band").agg(F.min("cid").alias("a"), F.max("cid").alias("last")).filter("a < last")
    buckets = written(member.join(leaders.select("band", "a"), "band"), "buckets")
    stars = buckets.filter("cid <> a").select("a", F.col("cid").alias("b")).distinct()
    stars = written(_alike(stars, classes, least_equal), "stars")

    shared = buckets.select("cid").distinct()
    sets = _class_sets(slim, classes, shared) if repeats else _sets_of(slim.join(shared.select(F.col("cid").alias("id")), "id"))
    sets = written(sets.select("id", "shingles"), "sets")

    tested = _verified(stars, sets)
    edges = tested.filter("linked").select("a", "b")
    if repeats:
        edges = written(edges.unionByName(_same_id(named, classes)), "edges")
    labels = components(edges)
    # Similar members of different components, first by sketches within buckets, then by full sets within what these connect.
    sketched = classes.select("cid", "n", F.col("bands").alias("data"))
    near = _across(buckets.select(F.col("band").alias("group"), "cid"), labels, sketched, partial(alike, least=least_equal)).distinct()
    clusters = components(near).select(F.col("label").alias("group"), F.col("node").alias("cid"))
    full = sets.select(F.col("id").alias("cid"), (F.octet_length("shingles") / 8).cast("bigint").alias("n"), F.col("shingles").alias("data"))
    more = written(_across(clusters, labels, full, linked), "links")
    if more.limit(1).count():
        labels = components(edges.unionByName(more))
    by_class = classes.join(labels, classes["cid"] == labels["node"], "left").select(
        "k1", "k2", "n", "first", F.coalesce("label", "cid").alias("component")
    )
    if repeats:
        by_class = by_class.join(by_class.groupBy("component").agg(F.min("first").alias("least")), "component")
        by_class = by_class.withColumn("component", F.col("least")).drop("least")
    out = rows.select("id", "n", "k1", "k2").join(by_class.drop("first"), ["k1", "k2", "n"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    out = out.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(doc_id) == F.col("component_id"), F.lit(True)))


def _repeats(named: DataFrame) -> bool:
    """Does any id stand in several rows?"""
    return named.groupBy("id").count().filter("count > 1").limit(1).count() > 0


def _sets_of(texts: DataFrame) -> DataFrame:
    return texts.mapInArrow(_sets, "id bigint, n bigint, k1 bigint, k2 bigint, shingles binary")


def _class_sets(slim: DataFrame, classes: DataFrame, shared: DataFrame) -> DataFrame:
    """(id, shingles) with the number of each shared class as id, where an id may name several texts."""
    wanted = classes.join(shared, "cid").select("cid", "first", "k1", "k2", "n")
    texts = slim.join(wanted.select(F.col("first").alias("id")).distinct(), "id")
    found = _sets_of(texts).withColumnRenamed("id", "first").join(wanted, ["first", "k1", "k2", "n"])
    return found.dropDuplicates(["cid"]).select(F.col("cid").alias("id"), "shingles")


def _same_id(named: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b) of classes that have an id in common: the smallest one beside each other one."""
    of = named.select("id", "k1", "k2", "n").distinct().join(classes.select("cid", "k1", "k2", "n"), ["k1", "k2", "n"]).select("id", "cid")
    least = of.groupBy("id").agg(F.min("cid").alias("a"), F.max("cid").alias("last")).filter("a < last").select("id", "a")
    return of.join(least, "id").filter("cid <> a").select("a", F.col("cid").alias("b")).distinct()


def _across(groups: DataFrame, labels: DataFrame, details: DataFrame, decide) -> DataFrame:
    """Edges (a, b) that ``decide`` finds between components that meet in a group.

    ``groups``: (group, cid); ``labels``: (node, label); ``details``: (cid, n, data). Members of the group's largest component are
    compared with all others, these also with each other, in blocks of bounded size: each pair meets in one.
    """
    of = labels.select(F.col("node").alias("cid"), F.col("label").alias("comp"))
    member = groups.join(of, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    parts = member.groupBy("group", "comp").agg(F.count(F.lit(1)).alias("size"))
    mixed = parts.groupBy("group").agg(
        F.count(F.lit(1)).alias("parts"), F.sum("size").alias("all"), F.max(F.struct("size", "comp"))["comp"].alias("major"), F.max("size").alias("most")
    )
    member = member.join(mixed.filter("parts > 1"), "group").join(details, "cid")
    blocks = F.ceil(F.col("all") / BLOCK).cast("int")
    minor_blocks = F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int")
    spread = lambda n, salt: F.pmod(F.xxhash64(F.col("cid"), F.lit(salt)), n).cast("int")
    columns = ["cid", "comp", "n", "data"]
    minor = member.filter(F.col("comp") != F.col("major")).select(
        "group", spread(minor_blocks, 1).alias("i"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("j"), F.lit(0).alias("side"), *columns
    )
    whole = member.select(
        "group", F.explode(F.sequence(F.lit(0), minor_blocks - 1)).alias("i"), spread(blocks, 2).alias("j"), F.lit(1).alias("side"), *columns
    )
    rows = minor.unionByName(whole).repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "side")
    return rows.mapInArrow(_blocks(decide), "a bigint, b bigint")


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with their own columns, one of each component."""
    verdict = near_duplicates(docs, doc_id, text)
    gone = verdict.filter("NOT kept").select(F.col(doc_id).alias("__gone")).distinct()
    return docs.join(gone, F.col(doc_id) == F.col("__gone"), "left_anti")

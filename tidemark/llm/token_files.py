"""Token-id files: ids of all documents in ascending id order, coded with one Huffman code for the whole collection.

``write_token_files`` encodes the texts once, keeps the ids and counts them in the same tasks, makes one canonical code of
at most ``MAX_BITS`` bits (more only where the ids need it), range-partitions the documents by id, and writes segments of
about ``SEGMENT`` ids. ``read_token_files`` decodes every segment by itself.

File format: a folder with a table ``code`` (one row: magic, code lengths by id, end id) and a table ``segments`` with the
columns part, seq and payload. Tables are Parquet, as that is what Spark can write to any store; the payload is the binary
format: five little-endian 64-bit numbers (magic, documents, ids, blocks, bytes of bits), then per document its id and number
of ids (64-bit) and a byte that tells if the id is null, then per block its bit offset (64-bit), then the bits.

Defined results: a null or empty text has the end id only; a null doc_id comes first; rows that repeat are written one by
one; columns other than id and text are not looked at. An empty table gives files without segments.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import huffman
from tidemark.llm.token_ids import encoder
from tidemark.session import scratch_path

MAGIC, MAX_BITS, SEGMENT = 0x31444954, 16, 1 << 18
#: Texts handed to the tokenizer at a time, in characters.
CHARACTERS = 1 << 20


def squeeze(ids: np.ndarray) -> bytes:
    """Ids between the steps: two bytes each where they fit, compressed."""
    small = not len(ids) or int(ids.max()) < 1 << 16
    return (b"2" if small else b"4") + zstandard.ZstdCompressor(level=1).compress(ids.astype("<u2" if small else "<u4").tobytes())


def unsqueeze(value: pa.Scalar) -> np.ndarray:
    data = value.as_buffer().to_pybytes()
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), "<u2" if data[:1] == b"2" else "<u4")


def _encoded(path: str, end_id: int):
    """Ids of every document, and after a task's last document one row with its counts of all ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        total = np.zeros(end_id + 1, np.int64)
        names = ["id", "ids", "counts"]
        for batch in batches:
            texts = batch.column(1)
            row = 0
            while row < len(texts):
                some, size, first = [], 0, row
                while row < len(texts) and size < CHARACTERS:
                    some.append(texts[row].as_py() or "")
                    size += len(some[-1])
                    row += 1
                ids, counts = coder.encode(some)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                ends += np.arange(1, len(ends) + 1)
                found = np.bincount(ids, minlength=len(total))
                found[: len(total)] += total
                total = found
                data = [squeeze(ids[a:b]) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                columns = [batch.column(0).slice(first, row - first), pa.array(data, pa.binary()), pa.nulls(row - first, pa.binary())]
                yield pa.record_batch(columns, names)
        used = np.flatnonzero(total)
        counts = np.concatenate([used, total[used]]).astype("<i8").tobytes()
        yield pa.record_batch([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([counts], pa.binary())], names)

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for value in batch.column(0):
            tokens, n = np.frombuffer(value.as_buffer(), "<i8").reshape(2, -1)
            yield pa.record_batch([pa.array(tokens), pa.array(n)], ["token", "n"])


def pack_segment(doc_ids: list, arrays: list[np.ndarray], lengths: np.ndarray, codes: np.ndarray) -> bytes:
    """The payload of one segment."""
    ids = np.concatenate(arrays)
    bits, checkpoints = huffman.pack(ids, lengths, codes)
    head = np.array([MAGIC, len(doc_ids), len(ids), len(checkpoints), len(bits)], "<i8")
    names = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    sizes = np.array([len(a) for a in arrays], "<i8")
    return b"".join([x.tobytes() for x in (head, names, sizes, nulls, checkpoints.astype("<i8"))] + [bits])


def unpack_segment(payload: bytes, table) -> tuple[list, np.ndarray, np.ndarray]:
    """Document ids, ids per document, and all ids."""
    magic, docs, count, blocks, _ = np.frombuffer(payload, "<i8", 5)
    if magic != MAGIC:
        raise ValueError("not a segment of token ids")
    at = 40
    names = np.frombuffer(payload, "<i8", docs, at)
    sizes = np.frombuffer(payload, "<i8", docs, at + 8 * docs)
    nulls = np.frombuffer(payload, np.uint8, docs, at + 16 * docs)
    at += 17 * int(docs)
    checkpoints = np.frombuffer(payload, "<i8", blocks, at)
    ids = huffman.unpack(payload[at + 8 * int(blocks) :], int(count), checkpoints, table)
    return [None if z else int(d) for d, z in zip(names, nulls, strict=True)], sizes, ids


def _packed(lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, seq, part = huffman.canonical_codes(lengths), 0, None
        names, arrays, size = [], [], 0

        def segment():
            payload = pack_segment(names, arrays, lengths, codes)
            return pa.record_batch(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([payload], pa.binary())], ["part", "seq", "payload"]
            )

        for batch in batches:
            for doc, value, own in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                part = own.as_py()
                names.append(doc.as_py())
                arrays.append(unsqueeze(value))
                size += len(arrays[-1])
                if size >= SEGMENT:
                    yield segment()
                    names, arrays, size, seq = [], [], 0, seq + 1
        if names:
            yield segment()

    return run


def _unpacked(lengths: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decode_table(lengths)
        for batch in batches:
            for part, seq, payload in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                names, sizes, ids = unpack_segment(payload.as_buffer().to_pybytes(), table)
                n, starts = len(names), np.cumsum(sizes) - sizes
                sums = [zlib.crc32(ids[s : s + k].astype("<u4", copy=False)) for s, k in zip(starts, sizes, strict=True)]
                yield pa.record_batch(
                    [
                        pa.array([part.as_py()] * n, pa.int32()),
                        pa.array([seq.as_py()] * n, pa.int64()),
                        pa.array(np.arange(n)),
                        pa.array(names, pa.int64()),
                        pa.array(starts),
                        pa.array(sizes),
                        pa.array(sums, pa.int64()),
                    ],
                    ["part", "seq", "k", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text"):
    """Encode all texts and write them as token files below ``folder``; ids must be integers."""
    spark = docs.sparkSession
    slim = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    raw = f"{folder}/ids"
    kind = "id bigint, ids binary, counts binary"
    slim.mapInArrow(_encoded(tokenizer, end_id), kind).write.option("compression", "uncompressed").parquet(raw)
    coded = spark.read.schema(kind).parquet(raw)
    ids = coded.filter("ids IS NOT NULL").select("id", "ids")
    counts = coded.filter("counts IS NOT NULL").select("counts").mapInArrow(_counted, "token bigint, n bigint").groupBy("token").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(max([end_id, *(r[0] for r in counts)]) + 1, np.int64)  # as many as the tokenizer has ids
    for token, n in counts:
        total[token] = n
    limit = max(MAX_BITS, int(np.ceil(np.log2(max(2, np.count_nonzero(total))))))
    if limit > 24:
        raise ValueError("more than 2**24 different ids")
    lengths = huffman.limited_lengths(total, limit)
    code = [(MAGIC, bytearray(lengths.tobytes()), end_id)]
    spark.createDataFrame(code, "magic bigint, lengths binary, end_id bigint").coalesce(1).write.parquet(f"{folder}/code")
    laid = ids.repartitionByRange(F.col("id").asc()).sortWithinPartitions(F.col("id").asc())
    laid = laid.withColumn("part", F.spark_partition_id())
    packed = laid.mapInArrow(_packed(lengths), "part int, seq bigint, payload binary")
    packed.write.option("compression", "uncompressed").parquet(f"{folder}/segments")


def read_token_files(spark, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    code = spark.read.parquet(f"{folder}/code").first()
    if code["magic"] != MAGIC:
        raise ValueError("not a folder of token files")
    lengths = np.frombuffer(bytes(code["lengths"]), np.uint8)
    segments = spark.read.schema("part int, seq bigint, payload binary").parquet(f"{folder}/segments")
    out = "part int, seq bigint, k bigint, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint"
    path = f"{folder}/index"
    segments.mapInArrow(_unpacked(lengths), out).write.mode("overwrite").parquet(path)
    docs = spark.read.schema(out).parquet(path)
    parts = docs.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    whole = parts.groupBy("part").agg(F.sum("n").alias("n"))
    up_to = (Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(*up_to)), F.lit(0))  # one row per partition
    inner = F.coalesce(F.sum("n").over(Window.partitionBy("part").orderBy("seq").rowsBetween(*up_to)), F.lit(0))
    firsts = whole.select(F.col("part").alias("p"), before.alias("before"))
    offsets = parts.select("part", "seq", inner.alias("inner")).join(F.broadcast(firsts), F.col("part") == F.col("p"))
    offsets = offsets.select(F.col("part").alias("p"), F.col("seq").alias("s"), (F.col("before") + F.col("inner")).alias("base"))
    joined = docs.join(offsets, (F.col("part") == F.col("p")) & (F.col("seq") == F.col("s")))
    return joined.select("doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write token files to the shared folder and read them back."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, folder, tokenizer, end_id, doc_id, text)
    return read_token_files(docs.sparkSession, folder)

"""Exact duplicates by a tree-merge of sorted digest runs.

Every row becomes one record: SHA-256 and length of its text, its id, its row number, a count of one. A task sorts its records
into runs with one record per text. Runs are then exchanged along a binomial tree: there are 2^b parts, numbered with b bits, and a
round replaces some of the upper bits of a part's number by the same bits of the digests, so each part sends slices of its
sorted run to its partners of that round and merges what they send it. ``RADIX_BITS`` steps of the tree make one exchange, that is
a merge of 2^``RADIX_BITS`` runs. At every merge equal texts become one record with the preferred id and the summed count, so a
text that a third of all rows share is one record per run from the first round on. After the last round a part holds
the digests that begin with its number, each once.

Records are ordered by the first 64 bits of the digest; equality is verified on all 256 bits and the length at every merge. No text
travels. Answers return to the rows by a join on the digest: groups that hold at least a thousandth of all rows (at most
``1000`` of them, whatever the table) are broadcast, the others are shuffled.

Results: a null text counts as empty, and empty texts are equal. Among equal texts the row with the preferred id stays, a null id after all
others; of rows with the same id (repeated rows) the first in the table's order stays, exactly one in any case. An empty table
gives an empty result. Further columns are not looked at; ``drop_exact_duplicates`` returns all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import written

#: Records that a run, and a part after the last round, holds at most (about 19 MB); more rows mean more parts.
RUN_ROWS = 1 << 18
#: Steps of the binomial tree that are done in one exchange: a task merges runs of 2^4 partners.
RADIX_BITS = 4
#: Groups with at least this part of all rows are broadcast; there can't be more of them than this number.
HOT_SHARE = 1000

RECORD = np.dtype([(f"d{i}", "<u8") for i in range(4)] + [(x, "<i8") for x in ("size", "has", "id", "row", "n")])
_KEY = ("d0", "d1", "d2", "d3", "size")
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def merge(runs: list[np.ndarray], largest: bool) -> np.ndarray:
    """One sorted run with one record per text out of several sorted runs.

    The sort is NumPy's stable one, which finds the ascending runs in its input and merges them.
    """
    rows = np.concatenate(runs) if runs else np.empty(0, RECORD)
    if not len(rows):
        return rows
    rows = rows[np.argsort(rows["d0"], kind="stable")]
    alike = rows["d0"][1:] == rows["d0"][:-1]
    same = _same(rows)
    if (alike & ~same).any():  # different texts whose digests begin alike
        rows = rows[np.lexsort([rows[x] for x in reversed(_KEY)])]
        same = _same(rows)
    first = np.flatnonzero(np.r_[True, ~same])
    if len(first) == len(rows):
        return rows
    group = np.cumsum(np.r_[True, ~same]) - 1
    out = rows[first]
    out["n"] = np.add.reduceat(rows["n"], first)
    out["has"] = np.maximum.reduceat(rows["has"], first)
    valid = rows["has"] == 1
    if largest:
        out["id"] = np.maximum.reduceat(np.where(valid, rows["id"], _LEAST), first)
    else:
        out["id"] = np.minimum.reduceat(np.where(valid, rows["id"], _MOST), first)
    out["id"][out["has"] == 0] = 0
    best = (rows["has"] == out["has"][group]) & (~valid | (rows["id"] == out["id"][group]))
    out["row"] = np.minimum.reduceat(np.where(best, rows["row"], _MOST), first)
    return out


def _same(rows: np.ndarray) -> np.ndarray:
    """Has a record the text of the one before it?"""
    same = np.ones(len(rows) - 1, bool)
    for name in _KEY:
        same &= rows[name][1:] == rows[name][:-1]
    return same


def _records(batch: pa.RecordBatch) -> np.ndarray:
    out = np.empty(batch.num_rows, RECORD)
    digests = np.frombuffer(b"".join(batch.column("digest").to_pylist()), ">u8").reshape(-1, 4)
    for i in range(4):
        out[f"d{i}"] = digests[:, i]
    ids = batch.column("id")
    out["has"] = np.asarray(ids.is_valid())
    out["id"] = ids.fill_null(0).to_numpy(zero_copy_only=False)
    out["size"], out["row"], out["n"] = batch.column("size").to_numpy(), batch.column("row").to_numpy(), 1
    return out


def _slices(run: np.ndarray, part: int, bits: int, done: int, step: int) -> Iterator[tuple[int, bytes]]:
    """What goes to each partner: the next ``step`` bits of the part's number become those of the digests."""
    if not len(run):
        return
    left = bits - done - step
    top = (run["d0"] >> np.uint64(64 - done - step)).astype(np.int64) if done + step else np.zeros(len(run), np.int64)
    cuts = np.r_[0, np.flatnonzero(top[1:] != top[:-1]) + 1, len(run)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield (int(top[a]) << left) | (part & ((1 << left) - 1)), run[a:b].tobytes()


def _blocks(found: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    for part, block in found:
        yield pa.record_batch([pa.array([part], pa.int32()), pa.array([block], pa.binary())], ["part", "block"])


def _first_runs(batches, bits: int, step: int, largest: bool):
    """Sorted runs of a task's rows, cut for the partners of the first round."""
    part, held, rows = TaskContext.get().partitionId() & ((1 << bits) - 1), [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(merge([_records(batch)], largest))
            rows += batch.num_rows
        if rows >= RUN_ROWS:
            yield from _blocks(_slices(merge(held, largest), part, bits, 0, step))
            held, rows = [], 0
    yield from _blocks(_slices(merge(held, largest), part, bits, 0, step))


def _received(batches, largest: bool) -> Iterator[tuple[int, np.ndarray]]:
    runs: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for part, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            runs.setdefault(part, []).append(np.frombuffer(block.as_buffer(), RECORD).copy())
    for part in list(runs):
        yield part, merge(runs.pop(part), largest)


def _next_runs(batches, bits: int, done: int, step: int, largest: bool):
    """Merges the runs of a part and cuts the result for the partners of the next round."""
    for part, run in _received(batches, largest):
        yield from _blocks(_slices(run, part, bits, done, step))


def _last_runs(batches, largest: bool, rows: int = 1 << 14):
    """Merges the runs of a part for the last time: a row for every text."""
    for _, run in _received(batches, largest):
        for at in range(0, len(run), rows):
            x = run[at : at + rows]
            digests = np.stack([x[f"d{i}"] for i in range(4)], axis=1).astype(">u8").tobytes()
            ids = pa.array(x["id"], mask=x["has"] == 0)
            columns = [
                pa.array([digests[i : i + 32] for i in range(0, len(digests), 32)], pa.binary()),
                pa.array(x["size"]),
                ids,
                *(pa.array(x[c]) for c in ("row", "n")),
            ]
            yield pa.record_batch(columns, ["digest", "size", "keep_id", "keep_row", "n"])


def digests(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    normalise: Callable[[Column], Column] | None = None,
    row: Column | None = None,
) -> DataFrame:
    """(id, digest, size, row) of every row, written; ``row`` numbers rows, in the table's order if not given."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    text = normalise(text) if normalise else text
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
        (F.monotonically_increasing_id() if row is None else row).alias("row"),
    )
    return written(rows, "digests")


def merged(rows: DataFrame, keep: str = "smallest", n_rows: int | None = None) -> DataFrame:
    """(digest, size, keep_id, keep_row, n) of every text of ``digests``: its preferred id and row, and how many rows have it."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    largest = keep == "largest"
    n_rows = rows.count() if n_rows is None else n_rows
    wanted = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // RUN_ROWS))
    bits = max(1, (wanted - 1).bit_length())
    steps = [min(RADIX_BITS, bits - done) for done in range(0, bits, RADIX_BITS)]
    kind = "part int, block binary"
    runs = rows.mapInArrow(partial(_first_runs, bits=bits, step=steps[0], largest=largest), kind)
    done = steps[0]
    for step in steps[1:]:
        runs = runs.repartitionById(1 << bits, F.col("part"))
        runs = runs.mapInArrow(partial(_next_runs, bits=bits, done=done, step=step, largest=largest), kind)
        done += step
    runs = runs.repartitionById(1 << bits, F.col("part"))
    return runs.mapInArrow(partial(_last_runs, largest=largest), "digest binary, size long, keep_id long, keep_row long, n long")


def _groups(rows: DataFrame, keep: str) -> DataFrame:
    """Rows of ``digests`` with keep_id, keep_row and n of their text."""
    n_rows = rows.count()
    found = written(merged(rows, keep, n_rows), "texts")
    key = ["digest", "size"]
    hot = F.broadcast(found.filter(F.col("n") * HOT_SHARE >= max(n_rows, 1)))
    marked = rows.join(hot, key, "left")
    rest = marked.filter(F.col("n").isNull()).select(*rows.columns)
    return marked.filter(F.col("n").isNotNull()).unionByName(rest.join(found, key))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``, dropped ones too.

    ``keep`` says which id stays; ``normalise`` maps the text column to what is compared (as it is by default).
    """
    found = _groups(digests(docs, id_col, text_col, normalise), keep)
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normalise: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    row = "__row"
    held = written(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    rows = digests(held, id_col, text_col, normalise, F.col(row))
    gone = _groups(rows, keep).filter(F.col("row") != F.col("keep_row")).select(F.col("row").alias(row))
    return held.join(gone, row, "left_anti").drop(row)

"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are shares of byte classes, lengths and repetition, of the line itself and of
its two neighbours. The field is fitted on labelled documents, each line with its document's label; at most ``FIT_DOCS`` of
them are used, chosen by a hash of their id. Forward and backward sums give every line's probability of being good; their
mean, weighted by line length, is mapped to a probability by a logistic curve fitted on the same documents.

The fit is small (a bounded sample) and runs on the driver; scoring is one pass over all texts without a shuffle.

Defined results: a null or empty text, or one of white space, has the mean of no good lines; rows that repeat are scored one by
one; a null id is in no fold (its crc32 counts as zero, so held out). Labels that are null are not used; where an id has
several labels, the smallest counts. Without labels every score is 0.5. Other columns are not looked at; an empty table gives
an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesops import SPACE, prefix_hash, span_hash, text_slices, word_spans

FIT_DOCS, STEPS, RATE, PENALTY, THRESHOLD = 4000, 150, 0.1, 1e-3, 0.3


def _class(chars) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


#: Byte classes whose share of a line is a feature.
CLASSES = {
    "symbols": _class(b"#*$%&<>@^~=_{}[]\\"),
    "bars": _class(b"|"),
    "loud": _class(b"!"),
    "stops": _class(b".,;:?"),
    "capitals": _class(range(0x41, 0x5B)),
    "digits": _class(range(0x30, 0x3A)),
    "wide": _class(range(0x80, 0x100)),
    "space": SPACE,
}
N_FEATURES = len(CLASSES) + 4


def lines_of(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends and rows of all lines; every text has one at least."""
    breaks = np.flatnonzero(data == 0x0A)
    # A break that ends a text still opens its last, empty line; starts are in order of (row, place).
    rows_of_breaks = np.searchsorted(offsets, breaks, "right") - 1
    n = len(offsets) - 1
    rows = np.concatenate([np.arange(n), rows_of_breaks])
    starts = np.concatenate([offsets[:-1], breaks + 1])
    order = np.lexsort((starts, rows))
    rows, starts = rows[order], starts[order]
    last = np.ones(len(rows), bool)
    last[:-1] = rows[1:] != rows[:-1]
    ends = np.empty(len(rows), np.int64)
    ends[last] = offsets[1:]
    ends[~last] = starts[1:][~last[:-1]] - 1
    return starts, ends, rows


def line_features(data: np.ndarray, offsets: np.ndarray):
    """(features of every line, bytes that aren't white space, rows)."""
    starts, ends, rows = lines_of(data, offsets)
    size = ends - starts
    own = np.zeros((len(rows), N_FEATURES), np.float32)
    total = np.zeros(len(data) + 1, np.int32)
    for k, table in enumerate(CLASSES.values()):
        np.cumsum(table[data], out=total[1:])
        own[:, k] = (total[ends] - total[starts]) / np.maximum(size, 1)
    visible = size - np.round(own[:, -5] * np.maximum(size, 1)).astype(np.int64)
    words, _, _ = word_spans(data, offsets)
    n_words = np.searchsorted(words, ends) - np.searchsorted(words, starts)
    at = len(CLASSES)
    own[:, at] = np.log1p(size)
    own[:, at + 1] = np.minimum(visible / np.maximum(n_words, 1), 30) / 10
    hashes = span_hash(prefix_hash(data), starts, ends)
    order = np.lexsort((np.arange(len(rows)), hashes, rows))
    again = np.zeros(len(rows), bool)
    again[1:] = (hashes[order][1:] == hashes[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    repeated = np.zeros(len(rows), bool)
    repeated[order] = again
    own[:, at + 2] = repeated & (n_words > 0)
    own[:, at + 3] = n_words == 0
    return own, visible, rows


def with_neighbours(own: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """A constant, a line's features, and those of the lines before and after it in its text."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    same = (rows[1:] == rows[:-1])[:, None]
    before[1:] = own[:-1] * same
    after[:-1] = own[1:] * same
    return np.concatenate([np.ones((len(own), 1), np.float32), own, before, after], axis=1)


@dataclass
class Field:
    """Fitted weights: of features for good lines, between states, and of the curve for documents."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    links: np.ndarray
    curve: tuple[float, float]


def _logsum(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(x[..., 0], x[..., 1])


def _chains(rows: np.ndarray, count: int):
    """Texts by number of lines, longest first, and where each begins."""
    sizes = np.bincount(rows, minlength=count)
    begins = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    return sizes[order], begins[order]


def marginals(score: np.ndarray, links: np.ndarray, rows: np.ndarray, count: int, pairs: bool = False):
    """Probability of good for every line, by forward and backward sums over all texts at once.

    With ``pairs`` also the expected number of each of the four successions of states.
    """
    sizes, begins = _chains(rows, count)
    emit = np.zeros((len(score), 2))
    emit[:, 1] = score
    ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
    longest = int(sizes[0]) if len(sizes) else 0
    live = np.searchsorted(-sizes, -np.arange(longest), "left")  # texts with more than t lines
    for t in range(longest):
        at = begins[: live[t]] + t
        if t == 0:
            ahead[at] = emit[at]
        else:
            ahead[at] = emit[at] + _logsum((ahead[at - 1][:, None, :] + links.T[None]))
    for t in range(longest - 2, -1, -1):
        at = begins[: live[t + 1]] + t
        behind[at] = _logsum(links[None] + (emit[at + 1] + behind[at + 1])[:, None, :])
    both = ahead + behind
    total = _logsum(both)
    good = np.exp(both[:, 1] - total)
    if not pairs:
        return good
    inner = np.flatnonzero(rows[1:] == rows[:-1])
    joint = ahead[inner][:, :, None] + links[None] + (emit[inner + 1] + behind[inner + 1])[:, None, :] - total[inner][:, None, None]
    return good, np.exp(joint).sum(0)


def document_means(good: np.ndarray, visible: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Mean of the lines' probabilities, weighted by length; zero for a text without visible bytes."""
    weight = np.bincount(rows, visible, count)
    return np.bincount(rows, visible * good, count) / np.maximum(weight, 1)


def fit(own: np.ndarray, visible: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> Field:
    """Maximise the field's likelihood by Adam steps, then fit the curve for documents."""
    count = len(labels)
    wide = with_neighbours(own, rows)
    mean, scale = wide.mean(0), wide.std(0)
    mean[0], scale[0] = 0, 1
    scale[scale < 1e-6] = 1
    x = ((wide - mean) / scale).astype(np.float64)
    y = labels[rows].astype(np.float64)
    inner = np.flatnonzero(rows[1:] == rows[:-1])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner].astype(int), y[inner + 1].astype(int)), 1)
    theta = np.zeros(x.shape[1] + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        good, joint = marginals(x @ theta[:-4], theta[-4:].reshape(2, 2), rows, count, pairs=True)
        slope = np.concatenate([x.T @ (y - good), (seen - joint).reshape(-1)]) / len(y) - PENALTY * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta += RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights, links = theta[:-4], theta[-4:].reshape(2, 2)
    means = document_means(marginals(x @ weights, links, rows, count), visible, rows, count)
    a, b = 0.0, 0.0
    target = np.where(labels > 0, 1 - 1 / (labels.sum() + 2), 1 / ((1 - labels).sum() + 2))
    for _ in range(50):  # Newton steps of a logistic regression on one feature
        p = 1 / (1 + np.exp(-(a * means + b)))
        d = np.maximum(p * (1 - p), 1e-9)
        slope = np.array([((target - p) * means).sum() - 1e-3 * a, (target - p).sum()])
        bend = np.array([[(d * means**2).sum() + 1e-3, (d * means).sum()], [(d * means).sum(), d.sum() + 1e-9]])
        da, db = np.linalg.solve(bend, slope)
        a, b = a + np.clip(da, -2, 2), b + np.clip(db, -2, 2)
    return Field(mean.astype(np.float32), scale.astype(np.float32), weights.astype(np.float32), links, (max(a, 0.0), b))


def crc_fold(doc_id: Column, folds: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, stop, data, offsets in text_slices(batch.column(1)):
            own, visible, rows = line_features(data, offsets)
            bounds = np.searchsorted(rows, np.arange(stop - first + 1))
            pieces = [(own[a:b].tobytes(), visible[a:b].astype("<i8").tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.record_batch(
                [batch.column(0).slice(first, stop - first), pa.array([p[0] for p in pieces], pa.binary()), pa.array([p[1] for p in pieces], pa.binary())],
                ["label", "own", "visible"],
            )


def fit_field(docs: DataFrame, labels: DataFrame, usable: Column, doc_id="doc_id", text="text", label="quality") -> Field | None:
    """Fit on at most ``FIT_DOCS`` labelled documents for which ``usable`` (over ``__id``) holds."""
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label")).filter("__label IS NOT NULL AND __id IS NOT NULL")
    known = known.filter(usable).groupBy("__id").agg(F.min("__label").alias("__label"))
    some = known.orderBy(F.xxhash64("__id"), "__id").limit(FIT_DOCS)
    chosen = docs.select(F.col(doc_id).alias("__d"), F.col(text).alias("__text")).join(F.broadcast(some), F.col("__d") == F.col("__id"))
    found = chosen.select("__label", "__text").mapInArrow(_measured, "label int, own binary, visible binary").collect()
    if not found:
        return None
    found = sorted(found, key=lambda r: (r["label"], bytes(r["own"])))  # rows come in any order
    own = np.concatenate([np.frombuffer(bytes(r["own"]), np.float32).reshape(-1, N_FEATURES) for r in found])
    visible = np.concatenate([np.frombuffer(bytes(r["visible"]), "<i8") for r in found])
    rows = np.repeat(np.arange(len(found)), [len(r["visible"]) // 8 for r in found])
    return fit(own, visible, rows, np.array([r["label"] for r in found]))


def score_texts(field: Field | None, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The score of every text of a slice."""
    count = len(offsets) - 1
    if field is None:
        return np.full(count, 0.5)
    own, visible, rows = line_features(data, offsets)
    x = (with_neighbours(own, rows) - field.mean) / field.scale
    means = document_means(marginals(x @ field.weights, field.links, rows, count), visible, rows, count)
    a, b = field.curve
    return 1 / (1 + np.exp(-(a * means + b)))


def quality_scores(docs: DataFrame, field: Field | None, carry: list[str], text: str = "text") -> DataFrame:
    """The columns ``carry`` of every document, and its score as the last column."""
    texts = docs.select(*[F.col(c) for c in carry], F.col(text).alias("__text"))
    schema = texts.drop("__text").withColumn("score", F.lit(0.0)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in text_slices(batch.column(len(carry))):
                own = [batch.column(k).slice(first, stop - first) for k in range(len(carry))]
                yield pa.record_batch([*own, pa.array(score_texts(field, data, offsets))], [*carry, "score"])

    return texts.mapInArrow(run, schema)


def line_quality(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="quality", folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted); labels of the held-out fold are not used."""
    field = fit_field(docs, labels, crc_fold(F.col("__id"), folds) != 0, doc_id, text, label)
    scored = quality_scores(docs, field, [doc_id], text)
    return scored.select(
        doc_id, (crc_fold(F.col(doc_id), folds) == 0).alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )


def drop_low_quality(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="quality", folds: int = 5) -> DataFrame:
    """The documents with their own columns, without those that the classifier rejects."""
    field = fit_field(docs, labels, crc_fold(F.col("__id"), folds) != 0, doc_id, text, label)
    names = docs.columns
    renamed = docs.toDF(*[f"c{k}" for k in range(len(names))])
    scored = quality_scores(renamed, field, renamed.columns, f"c{names.index(text)}")
    return scored.filter(F.col("score") >= THRESHOLD).drop("score").toDF(*names)

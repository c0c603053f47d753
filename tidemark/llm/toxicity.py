"""Toxicity categories by a chain of linear models.

Categories are predicted one after the other. Each model is a logistic regression over the presence of hashed words and over
the log-odds that the models before it gave. In training, a later model sees out-of-fold predictions of the earlier
ones (each made by a model that had not seen the document), so it learns how far they can be trusted on new texts.

The chain is fitted on at most ``FIT_DOCS`` labelled documents, chosen by a hash of their id, with the ``KEPT`` hashed words
that tell most by a chi-square test; that sample is bounded and fitted on the driver. Scoring is one pass over all texts.

The categories of this collection are ``toxic``, which is labelled, and ``severe``: a toxic document whose share of words
that the first model takes as marks of toxicity is above the median of the toxic ones.

Defined results: a null or empty text has no words, so its score is that of the constant; rows that repeat are scored one by
one; a null id is not held out and not trained on. Null labels are not used; of several labels of an id the largest counts.
Without labels of both kinds every score is zero. Other columns are not looked at; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesops import LOWER, prefix_hash, span_hash, text_slices, word_spans
from tidemark.llm.line_quality import crc_fold

FIT_DOCS, KEPT, BUCKETS, FOLDS, STEPS, PENALTY, THRESHOLD = 12_000, 4000, 1 << 22, 3, 120, 1.0, 0.5
#: Words are runs of letters and digits; every other byte of ASCII separates.
BREAK = np.zeros(256, bool)
BREAK[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def words_in(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket and row of every word."""
    lowered = LOWER[data]
    starts, ends, rows = word_spans(lowered, offsets, BREAK)
    return (span_hash(prefix_hash(lowered), starts, ends) & np.uint64(BUCKETS - 1)).astype(np.int64), rows


@dataclass
class Bags:
    """Presence of words in documents, sorted by document: column and row of each."""

    columns: np.ndarray
    rows: np.ndarray
    count: int

    def product(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.columns], self.count)

    def transposed(self, errors: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, errors[self.rows], width)

    def where(self, keep: np.ndarray) -> Bags:
        renumbered = np.cumsum(keep) - 1
        own = keep[self.rows]
        return Bags(self.columns[own], renumbered[self.rows[own]], int(keep.sum()))


def distinct(columns: np.ndarray, rows: np.ndarray, count: int) -> Bags:
    packed = np.unique(rows * np.int64(BUCKETS) + columns)
    return Bags(packed % BUCKETS, packed // BUCKETS, count)


@dataclass
class Linear:
    """Weights of words, of the log-odds of earlier categories, and the constant."""

    weights: np.ndarray
    earlier: np.ndarray
    constant: float

    def odds(self, bags: Bags, earlier: np.ndarray) -> np.ndarray:
        return bags.product(self.weights) + earlier @ self.earlier + self.constant


def fit_linear(bags: Bags, earlier: np.ndarray, y: np.ndarray) -> Linear:
    """Penalised logistic regression by Adam steps."""
    n, k = KEPT, earlier.shape[1]
    start = np.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    theta = np.concatenate([np.zeros(n + k), [start]])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, STEPS + 1):
        odds = bags.product(theta[:n]) + earlier @ theta[n : n + k] + theta[-1]
        error = 1 / (1 + np.exp(-odds)) - y
        slope = np.concatenate([bags.transposed(error, n), earlier.T @ error, [error.sum()]])
        slope[:-1] += PENALTY * theta[:-1]
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta -= 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Linear(theta[:n], theta[n : n + k], float(theta[-1]))


def telling_words(bags: Bags, y: np.ndarray) -> np.ndarray:
    """The buckets with the largest chi-square against the label, in ascending order."""
    with_word = np.bincount(bags.columns, minlength=BUCKETS).astype(float)
    both = np.bincount(bags.columns, y[bags.rows], BUCKETS)
    n, p = len(y), y.mean()
    gap = (both - with_word * p) ** 2 / np.maximum(with_word * p * (1 - p) * (1 - with_word / n), 1e-9)
    gap[(with_word < 3) | (with_word >= n)] = 0
    best = np.argsort(-gap, kind="stable")[:KEPT]
    return np.sort(best[gap[best] > 3.84])


@dataclass
class Chain:
    """The telling words and one linear model per category."""

    words: np.ndarray
    models: list[Linear]

    def bags(self, columns: np.ndarray, rows: np.ndarray, count: int) -> Bags:
        if not len(self.words):
            return Bags(np.zeros(0, np.int64), np.zeros(0, np.int64), count)
        at = np.minimum(np.searchsorted(self.words, columns), len(self.words) - 1)
        hit = self.words[at] == columns
        packed = np.unique(rows[hit] * np.int64(KEPT) + at[hit])
        return Bags(packed % KEPT, packed // KEPT, count)

    def probabilities(self, bags: Bags) -> np.ndarray:
        odds = np.zeros((bags.count, 0))
        for model in self.models:
            odds = np.concatenate([odds, model.odds(bags, odds)[:, None]], axis=1)
        return 1 / (1 + np.exp(-odds))


def fit_chain(columns: np.ndarray, rows: np.ndarray, toxic: np.ndarray, folds: np.ndarray) -> Chain:
    """Fit all categories; ``folds`` deals the documents out for out-of-fold predictions."""
    count = len(toxic)
    chain = Chain(telling_words(distinct(columns, rows, count), toxic), [])
    bags = chain.bags(columns, rows, count)
    first = fit_linear(bags, np.zeros((count, 0)), toxic)
    marks = chain.words[first.weights[: len(chain.words)] > 1.0]
    share = np.bincount(rows, np.isin(columns, marks), count) / np.maximum(np.bincount(rows, minlength=count), 1)
    severe = toxic * (share > np.median(share[toxic > 0]))
    earlier = np.zeros((count, 0))
    for y in (toxic, severe.astype(float)):
        unseen = np.zeros(count)
        for fold in range(FOLDS):
            out = folds == fold
            if not out.any():
                continue
            part = fit_linear(bags.where(~out), earlier[~out], y[~out])
            unseen[out] = part.odds(bags.where(out), earlier[out])
        chain.models.append(fit_linear(bags, earlier, y))
        earlier = np.concatenate([earlier, unseen[:, None]], axis=1)
    return chain


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, stop, data, offsets in text_slices(batch.column(2)):
            columns, rows = words_in(data, offsets)
            bounds = np.searchsorted(rows, np.arange(stop - first + 1))
            lists = [columns[a:b].astype("<i4").tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.record_batch(
                [*[batch.column(k).slice(first, stop - first) for k in (0, 1)], pa.array(lists, pa.binary())], ["id", "label", "words"]
            )


def fit(docs: DataFrame, labels: DataFrame, usable: Column, doc_id="doc_id", text="text", label="toxic") -> Chain | None:
    """Fit on the labelled documents for which ``usable`` (over ``__id``) holds; None without labels of both kinds."""
    known = labels.select(F.col(doc_id).alias("__id"), F.col(label).cast("int").alias("__label")).filter("__label IS NOT NULL AND __id IS NOT NULL")
    known = known.filter(usable).groupBy("__id").agg(F.max("__label").alias("__label"))
    some = known.orderBy(F.xxhash64("__id"), "__id").limit(FIT_DOCS)
    chosen = docs.select(F.col(doc_id).alias("__d"), F.col(text).alias("__text")).join(F.broadcast(some), F.col("__d") == F.col("__id"))
    found = chosen.select(F.col("__id").cast("string").alias("__id"), "__label", "__text").mapInArrow(_worded, "id string, label int, words binary")
    found = sorted(found.collect(), key=lambda r: (r["id"], bytes(r["words"])))
    toxic = np.array([float(r["label"] > 0) for r in found])
    if not 0 < toxic.sum() < len(toxic):
        return None
    columns = np.concatenate([np.frombuffer(bytes(r["words"]), "<i4") for r in found]).astype(np.int64)
    rows = np.repeat(np.arange(len(found)), [len(r["words"]) // 4 for r in found])
    return fit_chain(columns, rows, toxic, np.arange(len(found)) % FOLDS)


def toxicity(docs: DataFrame, labels: DataFrame, doc_id="doc_id", text="text", label="toxic", folds: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted, severe_score); labels of the held-out fold are not used."""
    chain = fit(docs, labels, crc_fold(F.col("__id"), folds) != 0, doc_id, text, label)
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, data, offsets in text_slices(batch.column(1)):
                count = stop - first
                found = chain.probabilities(chain.bags(*words_in(data, offsets), count)) if chain else np.zeros((count, 2))
                yield pa.record_batch(
                    [batch.column(0).slice(first, count), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["doc_id", "score", "severe_score"]
                )

    kind = texts.schema["doc_id"].dataType.simpleString()
    scored = texts.mapInArrow(run, f"doc_id {kind}, score double, severe_score double")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == 0, F.lit(False))
    predicted = F.when(F.col("score") >= THRESHOLD, 1).otherwise(0)
    return scored.select(
        F.col("doc_id").alias(doc_id), out.alias("held_out"), "score", predicted.alias("predicted"), (F.col("score") >= THRESHOLD).alias("toxic"), "severe_score"
    )

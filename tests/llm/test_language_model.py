"""Words within their class depend on the context, and all probabilities together are those of a distribution."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_model

def test_context_tells_words_of_one_class_apart(spark):
    # The words after "leads" are of one shape and equally frequent, and none is among the most frequent words.
    filler = " ".join(f"{c}{c}" for c in "abcdefghijklmnopqrst")
    pairs = [(f"lead{k}", f"w{k}xyz") for k in range(10, 20)]
    rows = [(10_000 + 100 * k + i, f"{filler} {filler} {a} {b}") for k, (a, b) in enumerate(pairs) for i in range(60)]
    rows += [(k, f"{filler} {a} {b}") for k, (a, b) in enumerate(pairs)]
    rows += [(100 + k, f"{filler} {a} {pairs[(k + 3) % 10][1]}") for k, (a, _) in enumerate(pairs)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = language_model.language_model_scores(docs, train_on=F.col("doc_id") >= 10_000)
    score = {r.doc_id: r.score for r in found.filter("doc_id < 10000").collect()}
    assert np.mean([score[k] - score[100 + k] for k in range(10)]) > 1


def test_shares_along_the_ways():
    rng = np.random.default_rng(3)
    mass, group = rng.zipf(1.4, 500).clip(max=10**6), np.concatenate([np.arange(7), rng.integers(0, 7, 493)])
    starts, nodes, digits, bias = language_model.class_tree(mass, group)
    logs = np.add.reduceat(bias[nodes, digits].astype(float), starts[:-1])
    assert np.allclose(np.exp(logs), mass / mass.sum(), rtol=1e-4)
    assert np.allclose(np.exp(bias).sum(1), 1, atol=1e-5)
    ways = {tuple(zip(nodes[a:b], digits[a:b], strict=True)) for a, b in zip(starts[:-1], starts[1:], strict=True)}
    assert len(ways) == len(mass) and len(digits) < 25 * len(mass)


def test_words_beyond_the_top_ones(spark, monkeypatch):
    rows = [(k, " ".join(f"v{k * 7 % 50} u{j}" for j in range(k % 9))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    whole = {r.doc_id: r for r in language_model.language_model_scores(docs).collect()}
    monkeypatch.setattr(language_model, "TOP_WORDS", 5)
    few = language_model.language_model_scores(docs).collect()
    assert len(few) == 300 and all(r[:5] == whole[r.doc_id][:5] for r in few)
    assert all(np.isclose(r.base_score, whole[r.doc_id].base_score) and r.score < 0 for r in few)
    # Without contexts' weights, words of a last class have their share of it.
    texts = docs.select("text")
    counts = texts.mapInArrow(language_model._counted, "h bigint, class bigint, n bigint").groupBy("h")
    counts = counts.agg(F.min("class").alias("class"), F.sum("n").alias("n"))
    model, _, different, n, last = language_model.train(texts, counts)
    leaves = language_model._last_classes(counts, last, model.depths).collect()
    assert sum(r.words for r in leaves) == different - 6 and all(len(r.held) == r.words for r in leaves)
    assert sum(r.total for r in leaves) + n.sum() == sum(r.n for r in counts.collect())
    assert np.mean([r.words for r in leaves]) < 4


def test_weights_follow_the_cluster(spark):
    texts = spark.createDataFrame([(f"a b {k}",) for k in range(500)], "text string")
    most = language_model.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert language_model._long_tasks(texts.repartition(most + 100)).rdd.getNumPartitions() == most
    assert language_model._long_tasks(texts.repartition(3)).rdd.getNumPartitions() == 3


def test_tokens_of_pieces_are_those_of_the_whole(monkeypatch):
    texts = ["", "Über  den Fluß\tgeht", "a", "", "EINE lange Zeile " * 9, "x" * 40, ""]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    whole = language_model.tokens_of(data, offsets)
    for size in (1, 7, 40, 100):
        monkeypatch.setattr(language_model, "BYTES_AT_ONCE", size)
        assert all(np.array_equal(a, b) for a, b in zip(whole, language_model.tokens_of(data, offsets), strict=True))


def test_a_step_follows_the_errors_of_single_classes():
    rng, k, n = np.random.default_rng(4), language_model.CLASSES, 300
    buckets = rng.integers(0, 20, (language_model.FEATURES, n)) * 1000
    weights, squares = rng.normal(size=(language_model.BUCKETS, k)).astype(np.float32), np.zeros(language_model.BUCKETS, np.float32)
    bias, own, part = rng.normal(size=(5, k)).astype(np.float32), rng.integers(0, 5, n), rng.integers(0, k, n)
    slope = np.zeros(weights.shape)
    for i in range(n):
        chance = np.exp(weights[buckets[:, i]].sum(0) + bias[own[i]])
        for b in buckets[:, i]:
            slope[b] += chance / chance.sum() - (np.arange(k) == part[i])
    expected = weights - slope * language_model.RATE / np.sqrt((slope**2).sum(1) + 1)[:, None]
    sums = np.zeros((k - 1, language_model.BUCKETS))
    language_model.add_errors(weights, bias, own, buckets, part, sums, language_model.Room())
    language_model.gradient_step(weights, squares, sums)
    assert np.allclose(weights, expected, atol=1e-4) and np.allclose(squares, (slope**2).sum(1), rtol=1e-3) and not sums.any()


def test_kinds_of_words_beyond_ascii():
    for text in ("plain words and one größer", "ну вот и всё да x", "größer", "x"):
        data = np.frombuffer(text.encode(), np.uint8)
        _, kinds, _ = language_model.tokens_of(data, np.array([0, len(data)]))
        words = [w.encode() for w in text.split()]
        assert kinds.tolist() == [*(language_model.KINDS[w[-1], min(len(w), 12) // 3, int(max(w) >= 0x80)] for w in words), 0]


@pytest.mark.parametrize("at_once", [1, 7, 1 << 14])
def test_blocks_have_every_class_once(monkeypatch, at_once):
    monkeypatch.setattr(language_model, "TOKENS_AT_ONCE", at_once)
    rng, n, few, shapes = np.random.default_rng(5), 60, 40, 1 + language_model.SHAPES
    known = np.sort(rng.integers(0, 1 << 63, few).astype(np.uint64))
    group = np.concatenate([np.arange(few) % shapes, np.arange(shapes)])
    starts, nodes, digits, bias = language_model.class_tree(rng.zipf(1.4, len(group)).clip(max=10**6), group)
    depths = np.concatenate([[0], np.full(shapes - 1, 3)])
    model = language_model.Model(np.zeros((language_model.BUCKETS, language_model.CLASSES), np.float32), bias, known, starts, nodes, digits, depths)
    h = np.where(rng.random(n) < 0.5, rng.choice(known, n), rng.integers(0, 1 << 63, n).astype(np.uint64))
    kinds, (at, hit) = rng.integers(0, shapes, n), model.lookup()(h)
    features = rng.integers(0, 1 << 63, (language_model.FEATURES, n)).astype(np.uint64)
    expected = Counter()
    with np.errstate(over="ignore"):
        def add(i, key, row, part):
            rows = ((f ^ key) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(65 - language_model.BUCKETS.bit_length()) for f in features[:, i])
            expected[(i, int(row), *map(int, rows), int(part))] += 1

        for i in range(n):
            thing = at[i] if hit[i] else few + kinds[i]
            for step in range(starts[thing], starts[thing + 1]):
                add(i, model.keys[nodes[step]], nodes[step], digits[step])
            for level in range(0, 0 if hit[i] else 2 * depths[kinds[i]], 2):
                before = int(h[i]) % (1 << level) ^ int(language_model.seed(5)) ^ level << 50 ^ int(kinds[i]) << 58
                add(i, language_model.mix(np.array([before], np.uint64))[0], len(bias) - 1, int(h[i]) >> level & 3)
    found = Counter()
    for token, own, buckets, part in model.classes(h, kinds, at, hit, features, language_model.Room()):
        found.update(zip(token.tolist(), own.tolist(), *buckets.tolist(), part.tolist(), strict=True))
    assert hit.any() and not hit.all() and found == expected


def test_rare_words_are_counted_in_their_text():
    h, rows = np.array([9, 5, 9, 9, 5, 7, 7], np.uint64), np.array([1, 1, 1, 2, 2, 4, 4])
    kinds, depths = np.array([1, 2, 1, 1, 2, 3, 3]), np.full(1 + language_model.SHAPES, 2)
    found = language_model._lists(h, kinds, rows, 6, depths).to_pylist()
    pairs = [[(r["h"], r["leaf"], r["times"]) for r in one] for one in found]
    assert pairs == [[], [(5, 5 << 5 | 2, 1), (9, 9 << 5 | 1, 2)], [(5, 5 << 5 | 2, 1), (9, 9 << 5 | 1, 1)], [], [(7, 7 << 5 | 3, 2)], []]
    none = language_model._lists(h[:0], kinds[:0], rows[:0], 2, depths)
    assert none.to_pylist() == [[], []]


def test_rare_words_are_shuffled_once_before_their_join(spark):
    docs = spark.createDataFrame([(k, f"a b {k}") for k in range(50)], "doc_id bigint, text string")
    plan = language_model.language_model_scores(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2  # the last classes, and the sums by document

"""Near duplicates where ids name several texts, and without the sketch filter."""

import random

import brute
import pytest

from tidemark.llm.near_dedup import near_duplicates

BASE = ["one two three four five six seven eight nine ten " * 3, "red orange yellow green blue indigo violet black white grey " * 3]


def distinct_words(k, n=40):
    return " ".join(f"w{k}x{i}" for i in range(n))


def plain(rows):
    """doc_id -> component, with one node per text and one per id."""
    texts = [(f"t{i}", x) for i, (_, x) in enumerate(rows)]
    found = brute.near_duplicates([(k, x) for k, (_, x) in enumerate(texts)])
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (d, _) in enumerate(rows):
        if found[k][0]:
            parent[find(("text", found[k][1]))] = find(("id", d))
    groups = {}
    for k, (d, _) in enumerate(rows):
        if found[k][0]:
            groups.setdefault(find(("id", d)), set()).add(d)
    return sorted((d, found[k][0], min(groups[find(("id", d))]) if found[k][0] else d) for k, (d, _) in enumerate(rows))


@pytest.mark.parametrize("order", [1, -1])
def test_one_id_on_two_texts(spark, order):
    a, b = distinct_words(1), distinct_words(2)
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, distinct_words(3))][::order]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1))
    assert {r.doc_id: r.component_id for r in found.collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


@pytest.mark.parametrize("seed", [1, 2])
def test_ids_on_several_texts(spark, seed):
    rng = random.Random(seed)
    bases = [distinct_words(k) for k in range(12)]
    rows = []
    for _ in range(70):
        words = rng.choice(bases).split()
        if rng.random() < 0.5:
            words[rng.randrange(len(words))] = "other"
        rows.append((rng.randrange(1, 40), " ".join(words)))
    rows += [(90, ""), (90, "short text"), (91, "short text"), (91, None)]
    rng.shuffle(rows)
    found = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()) == plain(rows)


def test_without_the_sketch_filter(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {tuple(r) for r in near_duplicates(docs).collect()}
    assert {tuple(r) for r in near_duplicates(docs, least_equal=0).collect()} == found

"""Exact duplicates against a plain grouping; merging of runs; rounds of the tree."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup
from tidemark.llm.exact_dedup import RECORD, drop_exact_duplicates, exact_duplicates, merge

LONG = "a b " * 200_000
TEXTS = [(1, None), (2, ""), (3, " "), (4, LONG), (5, LONG), (6, LONG + "x"), (7, "é"), (8, "é"), (9, "é"), (9, "é")]
TEXTS += [(None, "é"), (None, "only"), (None, "only"), (20, "x\x00y"), (21, "x\x00y"), (-5, "x\x00y")]
SCHEMA = "doc_id bigint, text string, id int, digest string, size int, row int, n int, keep_id string, part int"


def plain(rows, largest):
    groups = defaultdict(list)
    for d, text in rows:
        groups[text or ""].append(d)
    out = Counter()
    for text, ids in groups.items():
        known = [d for d in ids if d is not None]
        best = (max(known) if largest else min(known)) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        left = True
        for d in ids:
            out[d, best, len(ids), d == best and left, sha] += 1
            left = left and d != best
    return out


def table(spark, rows, partitions=3):
    wide = [(d, x, 1, "d", 2, 3, 4, "k", 5) for d, x in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(partitions)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_edges(spark, keep):
    found = exact_duplicates(table(spark, TEXTS), keep=keep).collect()
    assert Counter(map(tuple, found)) == plain(TEXTS, keep == "largest")


def test_empty(spark):
    assert exact_duplicates(table(spark, [])).collect() == []
    assert drop_exact_duplicates(table(spark, [])).columns == table(spark, []).columns


def test_large_groups_over_several_rounds(spark, setting, monkeypatch):
    setting("spark.sql.shuffle.partitions", 13)
    monkeypatch.setattr(exact_dedup, "RADIX_BITS", 1)
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 3)
    rows = [(i, f"t{i % 50}" if i % 3 else "hot") for i in range(900)]
    found = exact_duplicates(table(spark, rows, 9), keep="largest").collect()
    assert Counter(map(tuple, found)) == plain(rows, True)


def test_drop_keeps_columns(spark):
    docs = table(spark, TEXTS)
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    found = Counter((r.doc_id, r.text or "") for r in left.collect())
    expected = Counter()
    for (d, _best, _n, kept, sha), n in plain(TEXTS, False).items():
        if kept:
            expected[d, sha] += n
    # A group without any id keeps one row, too.
    assert sum(found.values()) == len({x or "" for _, x in TEXTS}) and max(found.values()) == 1
    assert all(found[d, x] for d, x in found if (d, hashlib.sha256(x.encode()).hexdigest()) in expected or d is None)


def test_normalised(spark):
    rows = [(1, "A b"), (2, "a  B"), (3, "ab")]
    found = exact_duplicates(table(spark, rows), normalise=lambda c: F.lower(F.regexp_replace(c, " +", " "))).collect()
    assert {r.doc_id: r.keep_id for r in found} == {1: 1, 2: 1, 3: 3}
    assert {r.text_sha256 for r in found if r.doc_id < 3} == {hashlib.sha256(b"a b").hexdigest()}


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        exact_duplicates(table(spark, TEXTS), keep="first")


records = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2), st.integers(0, 1), st.integers(-3, 3)), max_size=40)


@settings(deadline=None, max_examples=200)
@given(records, st.integers(1, 5), st.booleans())
def test_merge(rows, ways, largest):
    """Digests that begin alike stay apart; merging in any grouping gives the same as one grouping of all."""
    runs = []
    for w in range(ways):
        mine = np.zeros(len(rows[w::ways]), RECORD)
        for i, (head, tail, has, x) in enumerate(rows[w::ways]):
            mine[i] = (head, 0, 0, tail, 5, has, x if has else 0, w + i * ways, 1)
        runs.append(merge([mine], largest))
    found = merge(runs, largest)
    groups = defaultdict(list)
    for k, (head, tail, has, x) in enumerate(rows):
        groups[head, tail].append((has, x if has else 0, k))
    expected = []
    for (head, tail), own in sorted(groups.items()):
        best = max(own, key=lambda r: (r[0], r[1] if largest else -r[1], -r[2]))
        expected.append((head, tail, *best, len(own)))
    assert [(r["d0"], r["d3"], r["has"], r["id"], r["row"], r["n"]) for r in found] == expected

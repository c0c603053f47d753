"""Spelling variants against pairs found by trying every edit."""

import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import spelling
from tidemark.llm.spelling import neighbours, replace_variants, slip, spelling_variants, word_counts


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[at + 1 :] == b[at + 1 :] if len(a) == len(b) else a[at:] == b[at + 1 :]


def plain(counts):
    out = {}
    for word, n in counts.items():
        own = [w for w in counts if near(w, word)]
        best = min(own, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[word] = (form, n, len(own), counts[form] if form else None)
    found = {}
    for word, (form, n, n_near, form_n) in out.items():
        root = word
        while out[root][0]:
            root = out[root][0]
        found[word] = (form, root, n, n_near, form_n)
    return found


def run(spark, counts):
    rows = spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert len(rows) == len(counts)
    return {r.word: tuple(r)[1:] for r in rows}


LONG = "abcdefghij" * 300
FAMILY = {
    "house": 90, "houses": 40, "houde": 3, "hous": 8, "ouse": 5, "mouse": 200, "mouse": 3, "h": 1, "i": 4, "hi": 9, "aaaa": 4,
    "aaaaa": 9, "aaaaaa": 20, "éclair": 30, "eclair": 10, "éclairs": 3, "xhouse": 3, "housex": 3, "hoouse": 4, "huose": 5,
    LONG: 9, LONG + "x": 3, "x" + LONG: 4, LONG[:900] + LONG[901:]: 3, LONG[:2000] + "z" + LONG[2001:]: 3, "tie-a": 1,
}


def test_family(spark):
    assert run(spark, FAMILY) == plain(FAMILY)


def test_empty_and_single(spark):
    assert run(spark, {}) == {}
    assert run(spark, {"alone": 5}) == {"alone": (None, "alone", 5, 0, None)}


def test_ties_take_the_smaller_word(spark):
    counts = {"worda": 10, "wordb": 10, "wordc": 2, "wordé": 10}
    found = run(spark, counts)
    assert found == plain(counts) and found["wordc"][0] == "worda"


def test_long_chain(spark):
    counts = {"chain" + "x" * i: 3 * 2**i for i in range(14)}
    found = run(spark, counts)
    assert found == plain(counts) and found["chain"][1] == "chain" + "x" * 13


words = st.lists(st.text("ab", min_size=1, max_size=7), min_size=1, max_size=60, unique=True)


@settings(deadline=None, max_examples=4)
@given(words, st.randoms(use_true_random=False))
def test_dense_vocabulary(spark, found, rng):
    counts = {w: rng.randint(1, 30) for w in found}
    assert run(spark, counts) == plain(counts)


def test_hot_prefix(spark):
    """A third of all words on one node: every pair is found, and no pair twice."""
    counts = {"prefixes" + a + b: 3 + i for i, (a, b) in enumerate((a, b) for a in "abcdefghijklmn" for b in "opqrstuvw")}
    pairs = neighbours(spark.createDataFrame([(w,) for w in counts], "word string")).collect()
    expected = {(a, b) for a in counts for b in counts if near(a, b)}
    assert len(pairs) == len(expected) and {tuple(p) for p in pairs} == expected


TEXTS = [(1, "The THE the ÉTÉ été"), (2, None), (None, "the"), (3, ""), (3, "the-the_the9the"), (3, "the-the_the9the"), (4, "ß÷×ñ 1a"), (5, "xx " * 400_000)]


def test_word_counts(spark, monkeypatch):
    schema = "doc_id bigint, text string, word string, n int, i string, t int"
    docs = spark.createDataFrame([(d, x, "w", 1, "i", 2) for d, x in TEXTS], schema)
    expected = Counter({"the": 12, "ÉtÉ": 1, "été": 1, "ß÷×ñ": 1, "a": 1, "xx": 400_000})
    assert dict(word_counts(docs, least_letters=1, least_count=1).collect()) == expected
    monkeypatch.setattr(spelling, "HELD_WORDS", 2)
    assert dict(word_counts(docs, least_letters=2, least_count=2).collect()) == {"the": 12, "xx": 400_000}
    assert word_counts(docs.limit(0)).collect() == []


def test_pieces_cut_between_words():
    text = "abc " * 700_000 + "d" * 3_000_000
    pieces = list(spelling._pieces(text))
    assert "".join(pieces) == text and len(pieces) >= 3 and sum(len(spelling._RUN.findall(p)) for p in pieces) == 700_001


def test_slip():
    all_ = [f"word{i}" for i in range(2000)]
    for before, after in zip(all_, slip("7", all_), strict=True):
        h = zlib.crc32(f"7:{before}".encode())
        at = h % len(before)
        assert after == (before[:at] + before[at + 1 :] if h % 97 == 0 else before)
    assert sum(a != b for a, b in zip(all_, slip("7", all_), strict=True)) > 5


def test_roots_of_texts(spark):
    docs = spark.createDataFrame([(1, "The hous Houses", "k"), (2, None, "k"), (2, None, "k")], "doc_id bigint, text string, roots_of string")
    table = spark.createDataFrame([("hous", "house"), ("houses", "house"), ("the", "the")], "word string, root string")
    rows = replace_variants(docs, table).orderBy("doc_id").collect()
    assert [r.roots for r in rows] == [["house", "the"], None, None]


@pytest.mark.parametrize("text", ["Ünïcode ABC", "ABC xyz", "ÀÉ"])
def test_lower_is_that_of_the_jvm(spark, text):
    assert spelling._lower(text) == spark.createDataFrame([(text,)], "t string").select(spelling._lowered(F.col("t"))).first()[0]

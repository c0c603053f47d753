"""Nulls, empty and very long texts, ties, repeated rows, empty tables and further columns with clashing names."""

import hashlib

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate,
    grouping,
    html_extract,
    huffman,
    language_model,
    line_quality,
    mixing,
    near_dedup,
    suffix_dedup,
    token_files,
    toxicity,
)
from tidemark.llm.components import components
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.token_ids import Encoder

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
TEXTS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one two"),
    (5, "One  two"),
    (6, LONG),
    (7, LONG + " end"),
    (8, "The cat sat on the mat, and then it went away to the house of the king.\n" * 6),
    (9, "The cat sat on the mat, and then it went away to the house of the king.\n" * 6),
    (9, "The cat sat on the mat, and then it went away to the house of the king.\n" * 6),
    (10, "aaaa" * 200),
    (11, "é" * 150 + " naïve <|endoftext|>  x"),
    (12, "x\x00y \x1c z"),
]
SCHEMA = "doc_id bigint, text string, source string, id int, t string, n int, size string, score string, words string"


@pytest.fixture
def docs(spark):
    rows = [(d, x, None if d % 3 == 0 else "ab"[d % 2], d, "t", 1, "s", "q", "w") for d, x in TEXTS]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def labels(spark):
    rows = [(d, d % 2, (d + 1) % 2) for d in range(4, 12)] + [(5, None, None), (None, 1, 1), (6, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture
def bench(spark):
    rows = [(1, "the cat sat"), (2, None), (None, "ONE, two"), (3, ""), (3, "on the mat and then it went away to the house of")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def once(rows):
    return list(dict(rows).items())


def test_quality_rules(docs, none):
    rows = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert [rows[d].n_words for d in (1, 2, 3, 4)] == [0, 0, 0, 2] and not any(rows[d].kept for d in (1, 2, 3, 4))
    assert rows[8].n_repeat_words == 102 and rows[8].base_failed and rows[8].n_dup_lines == 5
    assert rows[6].n_words == 30_000
    assert quality_rules(docs).count() == len(TEXTS) and quality_rules(none).count() == 0


def test_decontamination(docs, bench, none):
    rows = [r for r in decontaminate.contamination(docs, bench).collect()]
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(TEXTS) and by[9] and [r for r in rows if r.doc_id == 9][0] == [r for r in rows if r.doc_id == 9][1]
    assert (by[4].n_hit, by[4].n_items, by[5].n_hit) == (2, 1, 2)
    assert by[8].n_items == 2 and by[8].items_sha256 == hashlib.sha256(b"1,3").hexdigest()
    assert not by[1].contaminated and not by[6].contaminated
    assert decontaminate.contamination(none, bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.contamination(docs, bench.limit(0)).collect())
    left = decontaminate.decontaminate(docs, bench)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {1, 2, 3, 6, 7, 10, 11, 12}
    cut = {r.doc_id: r.text for r in decontaminate.decontaminate(docs, bench, remove="spans").collect()}
    assert cut[4] == "" and cut[6] == LONG and "cat" not in cut[8] and "king" in cut[8]


def test_large_benchmarks_are_joined_by_a_shuffle(docs, bench, monkeypatch):
    small = sorted(map(tuple, decontaminate.contamination(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST_WINDOWS", 0)
    assert sorted(map(tuple, decontaminate.contamination(docs, bench).collect())) == small


def test_mixing(docs, none):
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixing.mix(none).count() == 0
    words = lambda x: len(brute.WORD.findall(x or ""))
    taken = sum(words(r.text) for r in mixed.collect())
    total = sum(words(x) for _, x in TEXTS)
    assert abs(taken - 1.5 * total) <= 2 * max(words(x) for _, x in TEXTS)
    again = mixing.mix(docs)
    assert sorted(map(str, again.collect())) == sorted(map(str, mixed.collect()))


def test_near_duplicates(docs, none, spark):
    expected = brute.near_duplicates(TEXTS)
    rows = near_dedup.near_duplicates(docs).collect()
    assert len(rows) == len(TEXTS)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == expected
    assert near_dedup.near_duplicates(none).count() == 0
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {1, 2, 3, 4, 6, 8, 10, 11, 12}
    nameless = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f")], "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(nameless).collect()} == {(None, None, True), (7, 7, True)}


def test_many_alike_in_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for d in range(150):  # copies of one text with more and more words changed
        words = [f"w{i}" for i in range(120)]
        for i in rng.integers(0, 120, d % 8):
            words[i] = f"n{rng.integers(10**6)}"
        rows.append((d, " ".join(words)))
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute.near_duplicates(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200), (200, 150)] + [(300, k) for k in range(301, 340)]
    rows = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert {r.label for r in rows} == {0, 100, 300} and sum(r.label == 0 for r in rows) == 61
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_token_files(docs, none, spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert sorted(map(tuple, token_files.token_files(docs, path).collect())) == brute.token_files(TEXTS, path)
    assert token_files.token_files(none, path).count() == 0
    nameless = spark.createDataFrame([(None, "a"), (-5, "b")], "doc_id bigint, text string")
    assert sorted(map(tuple, token_files.token_files(nameless, path).collect()), key=str)[0][0] == -5


def test_pieces_are_encoded_as_the_whole_text_is():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    plain, coder = Tokenizer.from_file(path), Encoder(path)
    rng = np.random.default_rng(1)
    alphabet = list("ab .,'\n\t   é9!") + ["don't", "  ", " \n", "\x1c", "\x85", "日本"]
    texts = ["".join(rng.choice(alphabet, rng.integers(0, 40))) for _ in range(600)]
    ids, counts = coder.encode(texts)
    ends = np.cumsum(counts)
    for text, first, last in zip(texts, ends - counts, ends, strict=True):
        assert ids[first:last].tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_huffman_round_trip():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 60, 5000):
        counts = rng.integers(0, 10, n) ** 6
        counts[0] = 1
        lengths = huffman.limited_lengths(counts, 13)
        assert lengths.max() <= 13 and (n == 1 or (2.0 ** -lengths[lengths > 0].astype(float)).sum() <= 1)
        codes, table = huffman.canonical_codes(lengths), huffman.decode_table(lengths)
        for size in (0, 1, 255, 256, 257, 3000):
            ids = rng.choice(np.flatnonzero(counts), size)
            bits, checkpoints = huffman.pack(ids, lengths, codes)
            assert (huffman.unpack(bits, size, checkpoints, table) == ids).all()


def test_suffix_arrays():
    rng = np.random.default_rng(4)
    for _ in range(400):
        text = [*rng.integers(1, rng.integers(2, 6), rng.integers(0, 40)).tolist(), 0]
        assert grouping.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("largest", [20_000, 1])
def test_repeated_passages(docs, none, monkeypatch, largest):
    monkeypatch.setattr(suffix_dedup, "MAX_GROUP", largest)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 5)
    counts = {}
    for d, x in TEXTS:
        counts.setdefault(d, []).append(x)
    expected = brute.removed([((d, k), x) for d, xs in counts.items() for k, x in enumerate(xs)])
    rows = suffix_dedup.remove_repeated(docs).collect()
    assert len(rows) == len(TEXTS)
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows} == {(d, *x) for (d, _), x in expected.items()}
    assert suffix_dedup.remove_repeated(none).count() == 0


def test_overlapping_repeats(spark):
    rng = np.random.default_rng(5)
    base = "".join(rng.choice(list("abcd "), 3000))
    rows = [(d, base[a : a + int(rng.integers(150, 900))] + str(d) * int(rng.integers(0, 260))) for d, a in enumerate(rng.integers(0, 2500, 60))]
    found = suffix_dedup.remove_repeated(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found} == brute.removed(rows)


def test_repeats_of_texts_without_an_id(spark):
    rng = np.random.default_rng(9)
    made = lambda n: "".join(rng.choice(list("abcdefgh "), n))
    shared, twice = made(250), made(900)
    texts = [(None, made(300) + shared + made(310)), (1, made(280) + shared + made(330)), (None, made(500))]
    texts += [(None, twice), (None, twice), (2, made(400) + twice[300:600] + made(350))]
    expected = brute.removed(list(enumerate(x for _, x in texts)))
    rows = suffix_dedup.remove_repeated(spark.createDataFrame(texts, "doc_id bigint, text string")).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows), key=str)
    assert found == sorted(((d, *expected[k]) for k, (d, _) in enumerate(texts)), key=str)
    assert expected[0][1] >= 250 and expected[1][1] >= 250


def test_line_quality(docs, labels, none):
    rows = line_quality.line_quality(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1
    assert line_quality.line_quality(none, labels).count() == 0
    assert {r.score for r in line_quality.line_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert line_quality.drop_low_quality(docs, labels).columns == docs.columns


def test_field_marginals_match_enumeration():
    import itertools

    rng = np.random.default_rng(6)
    rows, score, links = np.array([0, 0, 0, 1, 2, 2]), rng.normal(size=6), rng.normal(size=(2, 2))
    good, pairs = line_quality.marginals(score, links, rows, 3, pairs=True)
    expected, successions = np.zeros(6), np.zeros((2, 2))
    for text in range(3):
        at = np.flatnonzero(rows == text)
        weights = {}
        for states in itertools.product((0, 1), repeat=len(at)):
            total = sum(score[i] * s for i, s in zip(at, states, strict=True)) + sum(links[a, b] for a, b in itertools.pairwise(states))
            weights[states] = np.exp(total)
        z = sum(weights.values())
        for states, w in weights.items():
            expected[at] += w / z * np.array(states)
            for a, b in itertools.pairwise(states):
                successions[a, b] += w / z
    assert np.allclose(good, expected) and np.allclose(pairs, successions)


def test_toxicity(docs, labels, none):
    rows = toxicity.toxicity(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r.predicted for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0}


def test_language_model(docs, none, spark):
    expected = brute.base_scores(TEXTS[:9] + TEXTS[10:])
    rows = language_model.language_model_scores(docs.dropDuplicates(["doc_id"])).collect()
    assert {r.doc_id: tuple(r)[1:5] for r in rows} == {d: x[:4] for d, x in expected.items()}
    assert all(r.base_score == pytest.approx(expected[r.doc_id][4], rel=1e-9) and r.score < 0 for r in rows)
    assert language_model.language_model_scores(docs).count() == len(TEXTS)
    assert language_model.language_model_scores(none).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_every_round_trains_on_all_tokens(spark, monkeypatch, partitions):
    texts = spark.createDataFrame([(f"the cat sat {k}",) for k in range(5000)], "text string").repartition(partitions)
    counts = texts.mapInArrow(language_model._counted, "h bigint, class bigint, n bigint").groupBy("h")
    counts = counts.agg(F.min("class").alias("class"), F.sum("n").alias("n"))
    rounds, trained = [], language_model._trained
    monkeypatch.setattr(language_model, "_trained", lambda *x: rounds.append(trained(*x)) or rounds[-1])
    _, tokens, *_ = language_model.train(texts, counts)
    shape = "block bigint, share bigint, seen bigint, data binary"
    seen = [texts.mapInArrow(r, shape).filter("block = 0").agg(F.sum("seen")).first()[0] for r in rounds]
    assert tokens == 25_000 and seen == [tokens] * language_model.ROUNDS


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(7)
    weights = rng.normal(size=(language_model.BUCKETS, language_model.CLASSES)).astype(np.float32)
    buckets = rng.integers(0, language_model.BUCKETS, (4, 50))
    logs = language_model.log_classes(weights, np.zeros(language_model.CLASSES, np.float32), buckets)
    assert np.allclose(np.exp(logs).sum(1), 1, atol=1e-4)


def test_html(spark):
    page = (
        '<html><head><title>x</title></head><body><nav><ul><li><a href="#">Home</a></li><li><a href="#">News</a></li></ul></nav>'
        "<article><h1>On  rivers &amp; seas</h1><p>Water runs down, and the sea takes it all in the end.<br><p>It is <b>so</b>&#33;"
        '</article><div class="ad">Buy now</div><script>var t="</p>";</script><footer>&copy; all of us</footer></body></html>'
    )
    rows = [(1, "u", page, "x"), (2, "u", None, "x"), (3, None, "", "x"), (4, "u", "<p>", "x"), (1, "u", page, "x")]
    rows += [(100 + k, "u", page.replace("rivers", "lakes " * (k % 5 + 1)), "x") for k in range(30)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    found = html_extract.main_text(pages).collect()
    text = "On rivers & seas\nWater runs down, and the sea takes it all in the end.\nIt is so!"
    assert len(found) == len(rows)
    assert all(r.text == text and r.n_chars == len(text) for r in found if r.page_id == 1)
    assert all(r.text == "" for r in found if r.page_id in (2, 3, 4))
    assert html_extract.main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    "source, text",
    [
        ("<html><head><meta charset=utf-8><title>x</title><style>p {}</style><body><p>One</p><p>Two</p></body></html>", "One|Two"),
        ("<head><title>x</title><script>a()</script><p>One<p>Two", "One|Two"),
        ("<head><title>x</title></head><body><noscript><p>no</p></noscript><p>One", "One"),
        ("<head><title>x<body><p>One</p><svg><title>y</title></svg><p>Two</p>", "One|Two"),
        ("<p>One <svg width='5'/> two</p><p>Three <svg><svg><path/></svg><text>no</text></svg>four</p>", "One two|Three four"),
        ("<p>One <svg width=5/><path/></svg> two</p>", "One two"),
        ("<div><p>One</p><button>no</div><p>Two</p><button>no</button>", "One|Two"),
        ("<p>One</p><button>no<p>Two</p><button><div>no</div> no</button><p>Three", "One|Two|Three"),
        ("<p>One <button>no</p><p>Two</p></button><p>Three</p>", "One|Two|Three"),
        ("<p>One <select><option>no</p><p>Two</p>", "One|Two"),
        ("<form><select><option>no<option>no</select>One</form><select><option>no<h2>Two</h2>", "One|Two"),
        ("<p>One</p><iframe src=a><p>Two</p><iframe src=b>no</iframe><p>Three</p>", "One|Two|Three"),
        ("<p>One</p><textarea>no<p>Two</p>", "One|Two"),
        ("<button-bar>One</button-bar><p>Two <svg-icon>three</svg-icon></p><title-x>Four</title-x>", "One|Two three|Four"),
        ("<header>One</header><p>Two</p>", "One|Two"),
        ("<p>One</p><template><p>no</p><template><p>no</p></template><p>no</p></template><p>Two</p>", "One|Two"),
        ("<p>One</p><script>var a = '<p>no</p>';", "One"),
        ("<p>One</p><!-- no <button> --><style>no</style ><p>Two</p><textarea><button></textarea><p>Three", "One|Two|Three"),
    ],
)
def test_markup_that_is_not_closed(source, text):
    assert html_extract.extract([source], None) == [text.replace("|", "\n")]


def test_chosen_nodes_agree_along_the_tree():
    parents = np.array([-1, 0, 1, 1, 0, 4])
    depth = np.array([0, 1, 2, 2, 1, 2])
    keep = html_extract.chosen(np.array([0.0, -1.0, 3.0, -2.0, -4.0, 3.0]), parents, depth)
    assert keep.tolist() == [True, True, True, False, False, False]

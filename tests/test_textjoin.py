"""The blocking join returns exactly the pairs of a nested loop with ILIKE."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.textjoin import _lowered, _text_anchors, anchored, bitmap, contains_join, needle_forms

NEEDLES = [
    "", "%", "_", "%%", "a", "B", "AC/DC", "u2", "red hot chili peppers", "RED HOT chili", "the the the the the",
    "50\\% off", "a_c", "x%z", "straße", "ÉTÉ", "İstanbul", "one two three four five", "two, three. four", "日本語テキスト",
    "😀 ok", " ", "\n", "ab", "abc", "abcd", "wx_yz end", "in the middle of % the night here", None,
]
TEXTS = [
    "", "a", "AC/DC live", "I love U2 and ac/dc", "Red Hot Chili Peppers in concert", "one two three four five six",
    "zone two three four fiver", "one two, three. four five", "50% off today", "the the the the the the", "STRASSE straße",
    "l'été à Paris", "İstanbul istanbul", "これは日本語テキストです", "say 😀 OK\nnext line", "abc\nabd aXc", "x123z",
    "wxAyz end", "in the middle of nowhere the night here", "in the middle of the night here", None, "ab" * 50,
]


def pairs(df):
    return sorted((r.t, r.n) for r in df.select("t", "n").collect())


def both(spark, texts, needles):
    t = spark.createDataFrame(list(enumerate(texts)), "t int, text string")
    n = spark.createDataFrame(list(enumerate(needles)), "n int, needle string")
    return t, n


def loop(t, n, columns=("text",)):
    pattern = F.concat(F.lit("%"), F.col("needle"), F.lit("%"))
    test = F.lit(False)
    for c in columns:
        test = test | F.coalesce(F.ilike(F.col(c), pattern), F.lit(False))
    return t.crossJoin(n).filter(test)


@pytest.fixture(params=["sent", "counted", "shuffled"])
def route(request, setting):
    if request.param == "counted":
        setting("tidemark.textjoin.countFrom", 1)
    if request.param == "shuffled":
        setting("tidemark.textjoin.maxNeedles", 0)
    return request.param


def test_edge_cases(spark, route):
    t, n = both(spark, TEXTS, NEEDLES)
    assert pairs(contains_join(t, n, "t", ["text"], "needle")) == pairs(loop(t, n))


def test_random_strings(spark, route):
    draw = random.Random(7)
    alphabet = "aAbB cé%_ .,\nß1"
    words = ["red", "hot", "chili", "the", "Night", "été", "x_1", "50%"]
    texts = ["".join(draw.choices(alphabet, k=draw.randint(0, 40))) for _ in range(60)]
    texts += [" ".join(draw.choices(words, k=draw.randint(1, 12))) for _ in range(60)]
    needles = ["".join(draw.choices(alphabet, k=draw.randint(0, 5))) for _ in range(60)]
    needles += [" ".join(draw.choices(words, k=draw.randint(1, 7))) for _ in range(60)]
    t, n = both(spark, texts, needles)
    assert pairs(contains_join(t, n, "t", ["text"], "needle")) == pairs(loop(t, n))


def test_two_columns(spark, route):
    t, n = both(spark, TEXTS, NEEDLES)
    t = t.withColumn("other", F.reverse("text"))
    expected = pairs(loop(t, n, ["text", "other"]))
    assert pairs(contains_join(t, n, "t", ["text", "other"], "needle")) == expected


def test_no_needles(spark, route):
    t, n = both(spark, TEXTS, NEEDLES)
    assert contains_join(t, n.filter("n < 0"), "t", ["text"], "needle").count() == 0


def test_copies_of_a_needle(spark, route):
    t, n = both(spark, TEXTS, ["AC/DC", "ac/dc", "AC/DC", "red hot chili peppers", "RED hot chili peppers"])
    assert pairs(contains_join(t, n, "t", ["text"], "needle")) == pairs(loop(t, n))


def anchors_of(texts, needles):
    lowered, lows = _lowered(texts, ["text"])
    return anchored(needle_forms(needles, "needle"), lowered, lows)


def test_anchor_kinds(spark):
    t, n = both(spark, ["x"], ["one two Three four five", "AC/DC", "u2", "abc", "%", "a_b_c d", "é_", "u2"])
    kinds = {r["__low"]: (r["__kind"], r["__anchor"]) for r in anchors_of(t, n).collect()}
    assert kinds["one two three four five"] == ("words", "two three four") and len(kinds) == 7
    assert kinds["ac/dc"][0] == "gram4" and kinds["u2"] == ("gram2", "u2") and kinds["abc"] == ("gram3", "abc")
    assert kinds["a_b_c d"] == ("gram3", "c d") and kinds["é_"] == ("gram1", "é")
    assert kinds["%"] == ("empty", "")


def test_rarest_anchor(spark, setting):
    t, n = both(spark, ["x"], ["x common words here one y", "x common words here two y", "x common words here six y"])
    assert {r["__anchor"] for r in anchors_of(t, n).collect()} == {"words here one", "words here two", "words here six"}
    setting("tidemark.textjoin.countFrom", 2)
    t, n = both(spark, ["theaters", "the quick", "a theme", None], ["theatre", "quickly"])
    # Every gram that no text has is as good as another; the smallest is taken.
    assert {r["__anchor"] for r in anchors_of(t, n).collect()} == {"atre", "ckly"}


def test_no_row_for_a_piece_nobody_asks_for(spark):
    """Texts make rows for anchors alone, whatever their length and the needles' kinds."""
    draw = random.Random(4)
    texts = ["".join(draw.choices("abcdefghijklmnop ", k=400)) for _ in range(60)]
    needles = ["ab", "cde", "fghi", "one two three four", "p", "zz", "zzzz%z"]
    t, n = both(spark, texts, needles)
    lowered, lows = _lowered(t, ["text"])
    sent = anchored(needle_forms(n, "needle"), lowered, lows)
    kinds = [r[0] for r in sent.select("__kind").distinct().collect()]
    bits = bitmap(sent.select("__anchor").distinct(), "__anchor")
    made = lowered.select("t", F.explode(_text_anchors(lows, kinds, bits)).alias("piece")).collect()
    wanted = {r["__anchor"] for r in sent.collect()}
    # With 32 bits for every piece, one in 32 others may pass; every wanted one does.
    expected = {(i, a) for i, x in enumerate(texts) for a in wanted if a in x}
    assert expected <= {tuple(r) for r in made} and len(made) == len(set(made))
    assert len(made) <= len(expected) + 60 * 1600 // 16
    plan = contains_join(t, n, "t", ["text"], "needle")._jdf.queryExecution().executedPlan().toString()
    # The bits are folded into the plan, and tested before the pieces become rows.
    assert "from_json" not in plan and "Generate explode(array_distinct" in plan and plan.count("getbit(") + plan.count("bit_get(") >= 1


def test_names_in_titles(spark, route):
    """Short names, a third of the texts with the same one: equal to the loop."""
    draw = random.Random(9)
    names = ["".join(draw.choices("aeiourst", k=draw.randint(2, 8))) for _ in range(120)] + ["U2", "abba"]
    titles = [" ".join(draw.choices(names, k=4)) if i % 3 else "U2 live" for i in range(150)]
    t, n = both(spark, titles, names)
    assert pairs(contains_join(t, n, "t", ["text"], "needle")) == pairs(loop(t, n))


def test_plan_has_no_loop_join(spark, route):
    t, n = both(spark, TEXTS, NEEDLES)
    plan = contains_join(t, n, "t", ["text"], "needle")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("most", [200_000, 0])
def test_repeated_and_null_keys(spark, setting, most):
    setting("tidemark.textjoin.maxNeedles", most)
    texts = spark.createDataFrame([(1, "the red fox"), (1, "a red fox"), (None, "red fox here"), (2, None)], "k int, text string")
    needles = spark.createDataFrame([("red fox",), ("red fox",), ("dog",)], "needle string")
    found = contains_join(texts, needles, "k", ["text"], "needle")
    assert sorted((r.k or 0, r.text) for r in found.collect()) == sorted(
        2 * [(1, "the red fox"), (1, "a red fox"), (0, "red fox here")]
    )


def test_grams_by_bytes():
    """Every run that is asked for is found, across blocks and for characters of any width, and few others."""
    import numpy as np
    import pyarrow as pa

    from tidemark.operators import textjoin

    draw = random.Random(11)
    texts = ["".join(draw.choices("abcé漢😀 ", k=k)) for k in (0, 1, 3, 50, 400)] + [None, "x" * 300 + "yz"]
    nothing, everything = np.zeros(64, bool), np.ones(64, bool)
    for block in (7, 1 << 18):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(textjoin, "_BLOCK", block)
            found = textjoin.grams_asked(pa.array(texts), [4, 3, 2, 1], everything).to_pylist()
            assert textjoin.grams_asked(pa.array(texts), [2], nothing).to_pylist() == [[]] * len(texts)
        for text, grams in zip(texts, found, strict=True):
            text = text or ""
            assert sorted(grams) == sorted({text[i : i + n] for n in (4, 3, 2, 1) for i in range(len(text) - n + 1)})

"""Spelling variants: words one edit apart, found by a frontier of states moving through a trie that is a table.

The trie holds every word forwards and backwards (``side`` 0 and 1). A node is known by a hash of its side and prefix; the edge
table has one row per node with the characters of its edges, at most as many as the alphabet has. A state is (word,
path, position, node): the word it started from, the path it is on, which is the word with one edit made, and how many
characters of that path are known to be in the trie.

Every word starts at the node of its own first half. From each node of its second half it may leave its own path once: by a
*greater* character of another edge of that node, or by skipping its character, so that the paths are those of the words that differ in
the second half; edits in the first half are the second half of the reversed word. Insertions are deletions seen from the
other word, and smaller characters are greater ones seen from there. Then the frontier is joined with the edge
table round by round; a state lives on if the next node of its path exists and has the edge that follows. The stride
doubles with every round, since few states but true ones get far, so a word of any length takes log2(length) rounds. A state
that reaches the end of its path on a node that ends a word is a neighbour; the two words are then compared, as nodes are hashes.

Words, counts, pairs and forms cover all documents; nothing is capped. A node's fan-out is bounded by the alphabet and a word's
neighbours by length x alphabet, so no join can square a group: a prefix that a third of all words share gives each of them at
most one state per edge. AQE splits the rows of such a node, as the edge table has one row per node.

Results: null and empty texts have no words; a null id reads as an empty one; repeated rows count again; an empty table
gives an empty result; further columns aren't looked at. Long texts are read in pieces that end between words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import written

#: What a word is made of, the least length of a word, how often it must occur.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: Characters of a text that are split into words at a time, and counts that a task holds.
PIECE_CHARS, HELD_WORDS = 1 << 20, 300_000

_RUN = re.compile(f"[{LETTERS}]+")
_UPPER = {c: c + 32 for c in range(65, 91)}

Change = Callable[[str, list[str]], list[str]]


def _lower(word: str) -> str:
    """A-Z alone are lower-cased."""
    return word.lower() if word.isascii() else word.translate(_UPPER)


def _pieces(text: str) -> Iterator[str]:
    """The text in pieces that end between words."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        end = at + PIECE_CHARS
        if rest := _RUN.match(text, end):
            end = rest.end()
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def slip(doc_id: str, words: list[str]) -> list[str]:
    """A typing error made by rule: where 97 divides the CRC-32 of ``<doc_id>:<word>``, the code point at its remainder goes."""
    start = zlib.crc32(f"{doc_id}:".encode())
    out = []
    for word in words:
        h = zlib.crc32(word.encode(), start)
        if h % 97 == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
        out.append(word)
    return out


def _count(batches, least: int, change: Change | None):
    held: Counter[str] = Counter()

    def flush():
        batch = pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
        held.clear()
        return batch

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for piece in _pieces(text.as_py() or ""):
                found = Counter(_RUN.findall(piece))
                words = [_lower(w) for w in found]
                if change:
                    words = change(doc_id or "", words)
                for word, n in zip(words, found.values(), strict=True):
                    if len(word) >= least:
                        held[word] += n
            if len(held) > HELD_WORDS:
                yield flush()
    yield flush()


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
    change: Change | None = None,
) -> DataFrame:
    """(word, n) of the words of all texts with enough letters that occur often enough; ``change`` may alter a text's words."""
    texts = docs.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    counts = texts.mapInArrow(partial(_count, least=least_letters, change=change), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _node(path: Column, length: Column) -> Column:
    """The node at ``length`` characters of a path."""
    return F.xxhash64("side", F.substring(path, F.lit(1), length))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near) for every two of the distinct words in column ``word`` that are one edit apart, in both directions."""
    length = F.char_length("word")
    sides = F.explode(F.array(F.lit(0), F.lit(1))).alias("side")
    both = words.select("word", sides).select("word", "side", F.when(F.col("side") == 0, F.col("word")).otherwise(F.reverse("word")).alias("path"))
    # Half of the word, and the other half where it is read backwards.
    both = both.withColumn("half", F.when(F.col("side") == 0, F.floor(length / 2)).otherwise(length - F.floor(length / 2)).cast("int"))
    steps = F.explode(F.sequence(F.col("half"), length)).alias("position")
    here = both.filter(length > 0).select("word", "side", "path", steps)
    here = here.select("*", _node(F.col("path"), F.col("position")).alias("node"), _char("path", F.col("position")).alias("own"))
    # The edge of a word's end is the empty character.
    edges = written(here.groupBy("node").agg(F.collect_set("own").alias("edges")), "edges")

    inside = here.filter(F.col("own") != "")
    # A greater character instead of the word's own: only nodes with several edges.
    several = edges.filter(F.size("edges") > 1)
    other = F.explode(F.filter("edges", lambda c: c > F.col("own"))).alias("c")
    replaced = inside.join(several, "node").select("word", "side", "path", "position", other)
    replaced = replaced.select("word", "side", _spliced("c").alias("path"), (F.col("position") + 1).alias("position"))
    # The word's character skipped; of a run of equal ones the last will do.
    skipped = inside.filter(_char("path", F.col("position") + 1) != F.col("own"))
    skipped = skipped.select("word", "side", _spliced(None).alias("path"), "position")

    frontier, stride, reached = replaced.unionByName(skipped), 1, []
    end = F.char_length("path") + 1
    while True:
        ahead = F.least(F.col("position") + stride, end).cast("int")
        moved = frontier.select("word", "side", "path", ahead.alias("position"))
        at = moved.select("*", _node(F.col("path"), F.col("position") - 1).alias("node"))
        lives = F.array_contains("edges", _char("path", F.col("position") - 1))
        moved = written(at.join(edges, "node").filter(lives).select("word", "side", "path", "position"), "frontier")
        reached.append(moved.filter(F.col("position") == end))
        frontier = moved.filter(F.col("position") < end)
        if not frontier.limit(1).count():
            break
        stride *= 2
    found = reduce(DataFrame.unionByName, reached)
    forth = found.select("word", F.when(F.col("side") == 0, F.col("path")).otherwise(F.reverse("path")).alias("near")).distinct()
    # Nodes are hashes: the word that was reached must be one.
    forth = written(forth.join(words.select(F.col("word").alias("near")), "near", "left_semi"), "pairs").select("word", "near")
    return forth.unionByName(forth.select(F.col("near").alias("word"), F.col("word").alias("near")))


def _char(path: str, at: Column) -> Column:
    """The character after ``at`` characters."""
    return F.substring(F.col(path), at + 1, F.lit(1))


def _spliced(by: str | None) -> Column:
    """The path with the character at ``position`` replaced, or left out."""
    parts = [F.substring("path", F.lit(1), F.col("position"))]
    if by:
        parts.append(F.col(by))
    parts.append(F.substring(F.col("path"), F.col("position") + 2, F.char_length("path")))
    return F.concat(*parts)


def forms(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): how many near words a word has, and the most frequent one if it is at least twice as frequent."""
    counts = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    # The greatest count, then the smallest word, whose bytes are ordered as its code points.
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = pairs.join(counts, "near").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    strong = -F.col("best.less") >= 2 * F.col("n")
    return joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame) -> DataFrame:
    """(word, root) for every word that has a form: the last word when forms are followed.

    Each round lets every word ask for the pointer of its pointer, so it takes log2 of the longest chain; counts at least
    double along a chain, which is why it is short and has no cycle.
    """
    links = written(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = links.join(further, "root", "left")
        moved = moved.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = written(moved, "roots")
        links = moved.select("word", "root")
        if not moved.filter("moved").limit(1).count():
            return links


def spelling_variants(counts: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for the distinct words of ``counts`` (word, n)."""
    words = written(counts.select("word", "n"), "words")
    formed = written(forms(words, neighbours(words.select("word"))), "forms")
    found = formed.join(roots(formed), "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def replace_variants(docs: DataFrame, variants: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, root) table applied: ``docs`` with a further column ``roots``, the distinct roots of each text's words, sorted.

    Texts and words meet by a join on the word after each text has listed its distinct words once.
    """
    row = "__row"
    held = written(docs.withColumn(row, F.monotonically_increasing_id()), "docs")
    listed = F.explode(F.array_distinct(F.regexp_extract_all(_lowered(F.coalesce(F.col(text_col), F.lit(""))), F.lit(f"[{LETTERS}]+"), F.lit(0))))
    words = held.select(row, listed.alias("__word"))
    known = variants.select(F.col("word").alias("__word"), F.col("root").alias("__root"))
    found = words.join(known, "__word").groupBy(row).agg(F.array_sort(F.collect_set("__root")).alias("roots"))
    return held.join(found, row, "left").drop(row)


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

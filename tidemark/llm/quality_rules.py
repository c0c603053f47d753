"""Quality rules: a table of thresholds compiled into one projection.

Each rule names a measure of the text and the range it may have. All measures are built-in functions, so the whole table
is one Spark projection without user functions, shuffles or joins.

Defined results: a null, empty or blank text has no words, zero for every count, and is not kept. Rows that repeat are
judged alike, one by one. Columns of the input other than the text are not looked at; a column whose name clashes with a
result is replaced. An empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = "[\\x20\\x09-\\x0D]+"

#: Frequent function words of the four languages of the corpus (fixed values).
STOP_WORDS = (
    "the of and to in is that it for was on are as with be at by this from or an "
    "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch "
    "de la que el en y a los del se las por un para con no una su al lo "
    "le et les des est dans qui une pour pas sur au plus par il elle du ou"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure may lie from ``least`` to ``most``; it is looked at where the text has ``from_words`` words or more."""

    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: The default table. Ratios are per word, or per line for the line ratios.
RULES = (
    Rule("n_words", least=20),
    Rule("repeat_word_ratio", most=0.30),
    Rule("mean_word_chars", least=2.0, most=14.0),
    Rule("symbol_ratio", most=0.25),
    Rule("loud_ratio", most=0.30),
    Rule("bar_ratio", most=0.25),
    Rule("dup_line_ratio", most=0.50),
    Rule("stop_word_ratio", least=0.01, from_words=50),
)


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def _text_measures(df: DataFrame, text: str) -> DataFrame:
    """Columns that need the words or lines of the text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.col("__words")
    line_words = F.filter(F.split(whole, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    hashes = F.col("__hashes")
    starts = F.sequence(F.lit(0), F.size(hashes) - 8)
    # Every column that a lambda looks into is also used outside it: a column used once only would be merged into the
    # lambda by the optimiser, and computed again for each element.
    windows = F.when(
        F.size(hashes) >= 9, F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i + 1, F.lit(8))))
    ).otherwise(F.array().cast("array<bigint>"))
    return (
        df.withColumn("__words", words_of(F.col(text)))
        .withColumn("__lines", line_words)
        .withColumn("__hashes", F.transform(words, lambda w: F.xxhash64(w)))
        .withColumn("__windows", windows)
        .withColumn("__once", F.size(F.array_distinct("__windows")) == F.size("__windows"))
    )


def _repeated_words(df: DataFrame) -> DataFrame:
    """Words that lie in windows of eight words found twice or more.

    Texts whose window hashes all differ have none. In the others, the windows are put in order together with their
    places, those equal to a neighbour are repeated, and their places in order tell how many words they cover.
    """
    words = F.col("__words")
    hashed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(column, key):
        def test(x, i):
            before = F.when(i > 0, F.get(column, i - 1)[key] == x[key]).otherwise(False)
            return before | F.coalesce(F.get(column, i + 1)[key] == x[key], F.lit(False))

        return F.filter(column, test)

    texts = F.sort_array(
        F.transform(
            twice(F.col("__hashed"), "h"),
            lambda x: F.struct(F.array_join(F.slice(words, x["i"] + 1, F.lit(8)), " ").alias("w"), x["i"].alias("i")),
        )
    )
    places = F.sort_array(F.transform(twice(F.col("__texts"), "w"), lambda x: x["i"]))
    covered = F.aggregate(
        F.transform(
            "__places",
            lambda p, i: F.least(F.lit(8), F.coalesce(F.get(F.col("__places"), i + 1) - p, F.lit(8))),
        ),
        F.lit(0).cast("bigint"),
        lambda total, x: total + x,
    )
    none = F.lit(None)
    return (
        df.withColumn("__hashed", F.when(~F.col("__once"), hashed).otherwise(none))
        .withColumn("__texts", F.when(~F.col("__once") & (F.size(words) >= 9), texts).otherwise(none))
        .withColumn("__places", F.when(~F.col("__once"), places).otherwise(none))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))
    )


def _count(text: Column, chars: str) -> Column:
    """How often the characters, all of one byte, occur: what the text loses without each."""
    total = F.lit(0)
    for char in chars:
        total = total + F.octet_length(text) - F.octet_length(F.replace(text, F.lit(char), F.lit("")))
    return total.cast("bigint")


def quality_rules(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` with their measures, ``base_failed`` and ``kept``; ``failed`` lists the rules a text breaks."""
    whole = F.coalesce(F.col(text), F.lit(""))
    measured = _repeated_words(_text_measures(df, text))
    words, lines = F.col("__words"), F.col("__lines")
    measured = (
        measured.withColumn("n_words", F.size(words).cast("bigint"))
        .withColumn("word_chars", F.length(F.array_join(words, "")).cast("bigint"))
        .withColumn("n_symbols", _count(whole, "#*$%&|<>"))
        .withColumn("n_bars", _count(whole, "|"))
        .withColumn("n_loud", _count(whole, "!"))
        .withColumn("n_lines", F.size(lines).cast("bigint"))
        .withColumn("n_dup_lines", (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"))
        .withColumn("n_stop_words", F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("bigint"))
    )
    per_word = lambda name: F.try_divide(F.col(name), F.col("n_words"))
    measures = {
        "n_words": F.col("n_words").cast("double"),
        "repeat_word_ratio": per_word("n_repeat_words"),
        "mean_word_chars": per_word("word_chars"),
        "symbol_ratio": per_word("n_symbols"),
        "loud_ratio": per_word("n_loud"),
        "bar_ratio": per_word("n_bars"),
        "dup_line_ratio": F.try_divide(F.col("n_dup_lines"), F.col("n_lines")),
        "stop_word_ratio": per_word("n_stop_words"),
    }
    broken = []
    for rule in rules:
        value = measures[rule.measure]
        bad = F.lit(False)
        if rule.least is not None:
            bad = bad | (value < rule.least)
        if rule.most is not None:
            bad = bad | (value > rule.most)
        bad = F.coalesce(bad, F.lit(False)) & (F.col("n_words") >= rule.from_words)
        broken.append(F.when(bad, F.lit(rule.measure)))
    base = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    measured = measured.withColumn("base_failed", base).withColumn("failed", F.array_compact(F.array(*broken)))
    return measured.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).drop(
        "__words", "__lines", "__hashes", "__windows", "__once", "__hashed", "__texts", "__places"
    )

"""Join texts to the needles they contain, case-insensitively (text ILIKE '%needle%').

No text is compared with every needle. Each needle gets one *anchor*: a piece that every text
matching it must contain. Texts list their own pieces of the same kinds, the two are joined on
equality, and the remaining pairs are verified with ILIKE itself. Kinds, most selective first:

``words``  three consecutive whole words with what stands between them,
``gram4`` .. ``gram1``  four, three, two or one consecutive characters,
``empty``  nothing: the needle has only wildcards, or no characters at all.

Of several pieces of a needle the one is taken that fewest other needles have; where there are many needles, the gram that
fewest texts have, counted over all texts. A bitmap of the hashes of
what is asked for stands inside the scan, so a text makes a row only for pieces that some needle may have as its anchor.

Wildcards in a needle keep their meaning; an anchor never touches one. As a needle has exactly one
anchor and the pieces of a text are distinct, a pair arises at most once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import written

# Needle tables up to this many rows and characters (all columns) are sent to every executor.
MAX_NEEDLES = 200_000
MAX_CHARS = 50_000_000
# Bits of the bitmap per piece asked for, and at most: 256 kB. A full one lets more pieces through, with the same result.
BITS_PER_PIECE, MAX_BITS = 32, 1 << 21
# From so many needles without three words on, one more reading of the texts, which finds each needle's rarest gram, costs
# less than the candidates that it saves. Below, the gram is taken that fewest other needles have. The result is the same.
COUNT_FROM = 10_000
# Shares a frequent anchor is split into when needles are too many to send.
SALTS = 32
# Bytes of a text handled at a time.
_BLOCK = 1 << 18

_W = r"[\p{L}\p{N}]"
_D = r"[^\p{L}\p{N}]"
# Pieces of a text. The lookahead lets neighbouring pieces overlap; possessive repeats never back up.
_TEXT_WORDS = rf"(?=({_W}++{_D}++{_W}++{_D}++{_W}++)){_W}++"
# Pieces of a needle. Words must be whole (something else on both sides), and nothing in or next to
# the piece may be a wildcard (%, _) or an escape (\).
_N = r"[^\p{L}\p{N}%_\\]"
_NEEDLE_PIECES = {
    "words": rf"(?<={_N})(?=({_W}++{_N}++{_W}++{_N}++{_W}++){_N})",
    **{f"gram{n}": rf"(?s)(?=([^%_\\]{{{n}}}))." for n in (4, 3, 2, 1)},
}
_ROW = "__row"
_KINDS = [*_NEEDLE_PIECES, "empty"]


# Spreads the numbers made of the bytes of a gram; a product stays below 2**63.
_SPREAD = 402_653_189


def _bytes_place(piece: Column, size: int) -> Column:
    """The bit of a piece by its first four and last four bytes, which tasks also find by array arithmetic."""
    data = F.encode(piece, "UTF-8")
    first, last = (F.conv(F.hex(part), 16, 10).cast("bigint") for part in (F.substring(data, 1, 4), F.substring(data, -4, 4)))
    return F.pmod(F.shiftright((first + last * 3) * _SPREAD, 16), F.lit(size))


def _number(data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The number that up to four bytes from ``starts`` on make."""
    out = data[starts].astype(np.int64)
    for k in (1, 2, 3):
        more = length > k
        out = np.where(more, (out << 8) | data[np.where(more, starts + k, 0)], out)
    return out


def grams_asked(texts: pa.Array, lengths: Sequence[int], held: np.ndarray) -> pa.Array:
    """For every text its runs of so many characters whose bit by bytes is set, as few times as they are different."""
    values, counts = [], []
    for text in texts:
        found = set()
        data = np.frombuffer(text.as_buffer() or b"", np.uint8) if text.is_valid else np.zeros(0, np.uint8)
        for at in range(0, len(data), _BLOCK):
            # Characters begin at bytes that don't continue one; a block goes on into the next by one run.
            own = data[at : at + _BLOCK + 4 * max(lengths)]
            marks = np.append(np.flatnonzero((own & 0xC0) != 0x80), len(own))
            inside = int(np.searchsorted(marks, min(_BLOCK, len(own))))
            whole = at + len(own) == len(data)
            for n in lengths:
                starts = marks[: max(0, min(inside, len(marks) - n - (0 if whole else 1)))]
                ends = marks[n : n + len(starts)]
                size = ends - starts
                short = np.minimum(size, 4)
                key = _number(own, starts, short)
                last = key if not len(size) or size.max() <= 4 else _number(own, ends - short, short)
                number = (key + last * 3) * _SPREAD >> 16
                hit = np.flatnonzero(held[number & (len(held) - 1)])
                if len(hit):
                    if size[hit].max() <= 4:  # then the number and the size tell runs apart
                        hit = hit[np.unique(key[hit] << 3 | size[hit], return_index=True)[1]]
                    found.update(own[a:b].tobytes() for a, b in zip(starts[hit].tolist(), ends[hit].tolist(), strict=True))
        values += found
        counts.append(len(found))
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, pa.binary()).cast(pa.string()))


def _pieces(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def needle_forms(needles: DataFrame, needle: str) -> DataFrame:
    """One row per different needle, compared in lower case; NULL needles are left out.

    ``__low`` is the needle, ``__form`` a digest of it, ``__plain`` says that it has no wildcard or
    escape, ``__kind`` is its most selective kind, and ``__pieces`` holds its pieces of that kind.
    """
    low = F.col("__low")
    forms = needles.filter(F.col(needle).isNotNull()).select(F.lower(needle).alias("__low")).distinct()
    kind, pieces = F.lit("empty"), F.array(F.lit(""))
    for name, pattern in reversed(_NEEDLE_PIECES.items()):
        found = F.array_distinct(_pieces(low, pattern))
        kind = F.when(F.size(found) > 0, F.lit(name)).otherwise(kind)
        pieces = F.when(F.size(found) > 0, found).otherwise(pieces)
    return forms.select(
        "__low",
        _form(low).alias("__form"),
        (~low.rlike(r"[%_\\]")).alias("__plain"),
        kind.alias("__kind"),
        pieces.alias("__pieces"),
    )


def _form(low: Column) -> Column:
    return F.sha2(low, 256)


def bitmap(pieces: DataFrame, piece: str) -> list[int]:
    """The hashes of a column, and its places by bytes, as bits of a list of longs; at most ``MAX_BITS`` come to the driver."""
    n = pieces.count()
    size = min(MAX_BITS, 1 << (max(32, BITS_PER_PIECE * n) - 1).bit_length())
    size = max(size, 64)
    places = F.array(F.pmod(F.xxhash64(piece), F.lit(size)), F.coalesce(_bytes_place(F.col(piece), size), F.lit(0)))
    bit = F.col("bit")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))
    bits = pieces.select(F.explode(places).alias("bit"))
    found = bits.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(one).alias("bits")).collect()
    held = [0] * (size // 64)
    for row in found:
        held[row.at] = row.bits
    return held


def _asked(pieces: Column, bits: list[int]) -> Column:
    """The pieces whose hash has its bit set. The bits are a constant of the plan, as a lambda takes no subquery."""
    held = F.from_json(F.lit(str(bits)), "array<bigint>")

    def known(piece: Column) -> Column:
        bit = F.pmod(F.xxhash64(piece), F.lit(64 * len(bits)))
        return F.getbit(F.get(held, F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(F.lit(63)).cast("int")) == 1

    return F.filter(pieces, known)


def anchored(forms: DataFrame, lowered: DataFrame, lows: Sequence[str]) -> DataFrame:
    """``__anchor`` for every needle, written: the piece that fewest other needles have, or of many needles the gram that
    fewest texts have. For that, texts make rows for grams of needles alone, and those are summed in the tasks.
    """
    rows = written(forms.select("__form", "__kind", F.size("__pieces").alias("__of"), F.explode("__pieces").alias("__piece")), "pieces")
    shared = rows.groupBy("__piece").agg(F.count("*").alias("__n"))
    ranked = rows.join(shared, "__piece")
    many = int(lowered.sparkSession.conf.get("tidemark.textjoin.countFrom", str(COUNT_FROM)))
    open_ = rows.filter(F.col("__kind").startswith("gram") & (F.col("__of") > 1))
    if open_.select("__form").distinct().limit(many).count() >= many:
        kinds = [r[0] for r in open_.select("__kind").distinct().collect()]
        bits = bitmap(open_.select("__piece").distinct(), "__piece")
        listed = lowered.select(F.explode(_text_anchors(lows, kinds, bits)).alias("__piece"))
        counted = listed.groupBy("__piece").agg(F.count("*").alias("__texts"))
        grams = rows.filter(F.col("__kind").startswith("gram")).join(counted, "__piece", "left")
        grams = grams.select(*rows.columns, F.coalesce("__texts", F.lit(0)).alias("__n"))
        ranked = ranked.filter(~F.col("__kind").startswith("gram")).unionByName(grams)
    rank = F.struct(F.col("__n"), -F.length("__piece"), F.col("__piece"))
    best = ranked.groupBy("__form").agg(F.min_by("__piece", rank).alias("__anchor"))
    return written(forms.drop("__pieces").join(best, "__form"), "anchors")


def _lowered(texts: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Texts with each searched column also in lower case, computed once per text."""
    names = {f"__low_{i}": F.lower(F.col(c)) for i, c in enumerate(columns)}
    return texts.withColumns(names), list(names)


def _text_anchors(lows: Sequence[str], kinds: Sequence[str], bits: list[int]) -> Column:
    """The distinct pieces of a text that are asked for."""
    none = F.array().cast("array<string>")
    arrays = []
    for low in lows:
        found = []
        if "words" in kinds:
            found.append(_asked(_pieces(F.col(low), _TEXT_WORDS), bits))
        lengths = [n for n in (4, 3, 2, 1) if f"gram{n}" in kinds]
        if lengths:
            found.append(_asked(F.array_distinct(_grams(F.col(low), lengths, bits)), bits))
        if "empty" in kinds:
            found.append(F.array(F.lit("")))
        arrays.append(F.when(F.col(low).isNotNull(), F.concat(*found) if found else none).otherwise(none))
    return F.array_distinct(F.concat(*arrays))


def _grams(text: Column, lengths: list[int], bits: list[int]) -> Column:
    """Runs of characters that are asked for, by their bytes; found in arrays of bytes, many times faster than by a pattern."""
    words = np.array(bits, np.int64)

    @F.arrow_udf("array<string>")
    def found(texts: pa.Array) -> pa.Array:
        return grams_asked(texts, lengths, np.unpackbits(words.view(np.uint8), bitorder="little").view(bool))

    return found(text)


def _matches(lows: Sequence[str]) -> Column:
    """The exact test, column ILIKE '%needle%' for any column, on lower-cased text.

    ILIKE is LIKE on both sides in lower case; without wildcards that is a plain substring test.
    """
    pattern = F.concat(F.lit("%"), F.col("__low"), F.lit("%"))
    tests = [
        F.when(F.col("__plain"), F.contains(F.col(low), F.col("__low"))).otherwise(F.like(F.col(low), pattern))
        for low in lows
    ]
    return reduce(lambda a, b: a | b, [F.coalesce(test, F.lit(False)) for test in tests])


def contains_join(
    texts: DataFrame,
    needles: DataFrame,
    text_key: str,
    columns: Sequence[str],
    needle: str,
) -> DataFrame:
    """All pairs where one of ``columns`` contains ``needle``, with the columns of both sides.

    ``text_key`` names a text to its readers; it may repeat or be NULL, as every row of ``texts`` is a text of its own. The
    column names of the two sides must differ. Needles may repeat.
    """
    lowered, lows = _lowered(texts, columns)
    forms = needle_forms(needles, needle)
    # Two small jobs: which kinds occur, and may the needles be sent to every executor?
    kinds_found = {r[0] for r in forms.select("__kind").distinct().collect()}
    size = needles.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.length(F.to_json(F.struct(*needles.columns)))), F.lit(0)).alias("chars"),
    ).first()
    kinds = [k for k in _KINDS if k in kinds_found] or ["words"]
    conf = texts.sparkSession.conf
    few = size["n"] <= int(conf.get("tidemark.textjoin.maxNeedles", str(MAX_NEEDLES))) and size["chars"] <= MAX_CHARS
    # Copies of a needle are matched once, and found texts are given to each copy afterwards.
    copies = needles.withColumn("__copy", _form(F.lower(needle)))
    if few:
        # Texts stay where they are: pieces, lookup and verification run in one stage.
        sent = anchored(forms, lowered, lows)
        bits = bitmap(sent.select("__anchor").distinct(), "__anchor")
        found = lowered.withColumn("__piece", F.explode(_text_anchors(lows, kinds, bits)))
        pairs = found.join(F.broadcast(sent), F.col("__piece") == F.col("__anchor"))
        copies = F.broadcast(copies)
    else:
        # Rows get numbers of their own, which the written table keeps.
        numbered = written(texts.withColumn(_ROW, F.monotonically_increasing_id()), "texts")
        lowered = _lowered(numbered, columns)[0]
        pairs = _shuffled(lowered, lows, anchored(forms, lowered, lows), kinds, _ROW)
    matched = pairs.filter(_matches(lows)).select(*texts.columns, "__form")
    return matched.join(copies, F.col("__form") == F.col("__copy")).select(*texts.columns, *needles.columns)


def _shuffled(lowered, lows, anchors, kinds, text_key) -> DataFrame:
    """Candidate pairs for needles too many to send: only keys and hashed pieces that are asked for travel.

    A frequent piece is spread over SALTS shares, and every needle is copied to each share.
    """
    salt = F.pmod(F.xxhash64(text_key), F.lit(SALTS)).cast("int").alias("__salt")
    bits = bitmap(anchors.select("__anchor").distinct(), "__anchor")
    hashed = F.array_distinct(F.transform(_text_anchors(lows, kinds, bits), lambda p: F.xxhash64(p)))
    left = lowered.select(F.col(text_key).alias("__t"), salt, F.explode(hashed).alias("__h"))
    right = anchors.select(
        F.col("__form").alias("__f"),
        F.xxhash64("__anchor").alias("__h"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"),
    )
    pairs = left.join(right, ["__h", "__salt"]).select("__t", "__f")
    return pairs.join(anchors, F.col("__f") == F.col("__form")).join(lowered, F.col("__t") == F.col(text_key))

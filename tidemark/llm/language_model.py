"""Language-model scoring with a hashed maximum-entropy model whose softmax is factored by classes.

The probability of a token is a product of softmaxes over classes, from the whole vocabulary down to the single word: a class has
at most ``CLASSES`` parts, which are classes again or single words, and every one of these softmaxes, that of a word within
its class too, sees the context. Its features are the previous word, the pair of previous words, and two skip features (the word
before the previous one, and the one before that), hashed together with the class into ``BUCKETS`` rows of weights; its bias is the
log of the shares of the parts among the training tokens.

Classes are by frequency: the ``TOP_WORDS`` most frequent words, the end of a text and 16 kinds of other words by shape (last byte,
length, bytes beyond ASCII) are in classes: the end, the ``SINGLES`` most frequent words one by one, and the words of a kind. Each
of them, ordered by count, is cut into parts of about equal counts again and again. The words that aren't among the top ones, however many, are told
apart within their kind by digits of their hashes, so many that a last class has about one word. Words that still share one, and words
never seen, have it by count: (c + 1) / (all of the class + its words + 1).

Training covers all training texts in each of ``ROUNDS`` rounds: every task makes gradient steps over its own tokens, the weights
are averaged, and the next round starts from the average. A row of weights counts in the average by the squares of the slopes that a task
had for it, so that a context which few tasks meet isn't drawn to nothing by the others. Counts are exact over all training texts, combined in each
task before the shuffle. For scoring, the counts of the ``TOP_WORDS`` most frequent words (a fixed bound) travel with the code; all other
tokens of a text are joined to the table of counts.

Words are known by 64-bit hashes. Defined results: a null or empty text is its end only; a null id is not held out;
rows that repeat are scored one by one; without training texts every word is unknown and kinds are equally likely. Other columns
are not looked at; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesops import mix, prefix_hash, seed, span_hash, text_slices, word_spans
from tidemark.session import written

SINGLES, SHAPES, CLASSES = 15, 16, 4
BITS = CLASSES.bit_length() - 1
BUCKETS, FEATURES, MINIBATCH, RATE, ROUNDS = 1 << 18, 4, 32768, 0.3, 2
#: Mini-batches of a task double from so many tokens to ``MINIBATCH``, so that a task of few texts makes several steps too.
FIRST_BATCH = 256
TOP_WORDS = 200_000
BLOCKS, TASKS_PER_CORE = 32, 2
#: Bytes of texts, rows of weights and tokens that are worked on at once: their arrays stay near a core.
BYTES_AT_ONCE, ROWS_AT_ONCE, TOKENS_AT_ONCE = 1 << 18, 1 << 14, 1 << 14
#: What contexts add to the logs of shares, at most.
MOST = 30.0
END = np.uint64(seed(77))
START = np.uint64(seed(78))
#: Kinds of words by last byte, length and whether bytes are beyond ASCII.
_BYTE, _LENGTH, _WIDE = np.indices((256, 5, 2)).astype(np.uint64)
KINDS = (mix(_BYTE << np.uint64(8) | _LENGTH << np.uint64(1) | _WIDE) % np.uint64(SHAPES)).astype(np.int64) + 1



def tokens_of(data: np.ndarray, offsets: np.ndarray):
    """Hash, kind by shape (the end's is 0) and row of every token; each text ends with the end token."""
    if len(data) <= BYTES_AT_ONCE or len(offsets) == 2:
        return _tokens_of(data, offsets)
    cuts = np.unique(np.searchsorted(offsets, np.arange(0, len(data), BYTES_AT_ONCE), "right") - 1)
    cuts[0] = 0  # empty texts before the first byte
    pieces = []
    for a, b in zip(cuts, [*cuts[1:], len(offsets) - 1], strict=True):
        h, kinds, rows = _tokens_of(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        pieces.append((h, kinds, rows + a))
    return tuple(np.concatenate(x) for x in zip(*pieces, strict=True))


def _tokens_of(data: np.ndarray, offsets: np.ndarray):
    lowered = data + ((data - np.uint8(0x41)) < 26).view(np.uint8) * np.uint8(32)
    starts, ends, rows = word_spans(lowered, offsets)
    hashes = span_hash(prefix_hash(lowered), starts, ends)
    kinds = np.zeros(0, np.int64)
    if len(starts):
        beyond, wide = np.flatnonzero(lowered >= 0x80), np.zeros(len(starts), np.uint8)  # what stands between words is below
        if len(beyond) > len(lowered) // 8:
            wide[np.maximum.reduceat(lowered, starts) >= 0x80] = 1
        else:
            wide[np.searchsorted(starts, beyond, "right") - 1] = 1
        kinds = KINDS[lowered[ends - 1], np.minimum(ends - starts, 12) // 3, wide]
    at = np.searchsorted(rows, np.arange(len(offsets) - 1), "right")
    return np.insert(hashes, at, END), np.insert(kinds, at, 0), np.insert(rows, at, np.arange(len(offsets) - 1))


def contexts(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The four features of every token."""
    before = []
    for k in (1, 2, 3):
        prev = np.full(len(hashes), START)
        same = rows[k:] == rows[:-k]
        prev[k:][same] = hashes[:-k][same]
        before.append(prev)
    one, two, three = before
    return np.stack([mix(f) for f in (one ^ seed(1), mix(one ^ seed(2)) + two, two ^ seed(3), three ^ seed(4))])


def _cut(mass: np.ndarray, things: np.ndarray, node: np.ndarray, count: int):
    """(thing, node, part) on all levels, and logs of shares by node, of nodes whose things stand in a row, cut into equal parts."""
    found, shares = [], []
    while len(things):
        own = mass[things].astype(float)
        at = np.flatnonzero(np.diff(node, prepend=-1))
        sizes = np.diff(at, append=len(things))
        whole = np.add.reduceat(own, at)
        done = np.cumsum(own)
        inside = done - own / 2 - np.repeat(done[at] - own[at], sizes)
        digit = np.minimum((inside / np.repeat(whole, sizes) * CLASSES).astype(np.int64), CLASSES - 1)
        found.append((things, node, digit))
        part = (node - node[0]) * CLASSES + digit
        share = np.bincount(part, own, len(at) * CLASSES).reshape(-1, CLASSES)
        with np.errstate(divide="ignore"):
            shares.append(np.log(share / whole[:, None]))
        count += len(at)
        many = np.bincount(part)[part] > 1
        things, part = things[many], part[many]
        node = count + np.cumsum(np.diff(part, prepend=part[:1]) != 0)
    return [np.concatenate(x) for x in zip(*found, strict=True)], np.concatenate(shares)


def class_tree(mass: np.ndarray, group: np.ndarray):
    """Classes over things of the given counts: (starts, nodes, digits, bias). The groups (from 0, none empty) are told apart first.

    From ``starts[i]`` to ``starts[i + 1]`` are the classes on the way to thing i, and which part of them it is in; ``bias`` has the
    logs of the shares of their parts. What is in one part has at most half of its class or is alone, so ways stay short.
    """
    sums, members = np.bincount(group, mass), np.bincount(group)
    (tops, node, digit), bias = _cut(sums, np.argsort(-sums, kind="stable"), np.zeros(len(sums), np.int64), 0)
    order = np.argsort(tops, kind="stable")
    node, digit, ways = node[order], digit[order], np.bincount(tops, minlength=len(sums))
    thing, step = _steps(ways[group])
    step += (np.cumsum(ways) - ways)[group[thing]]
    node, digit = node[step], digit[step]
    inner = np.lexsort((-mass, group))
    inner = inner[members[group[inner]] > 1]
    if len(inner):
        first = len(bias) + np.cumsum(np.diff(group[inner], prepend=group[inner[:1]]) != 0)
        (more, below, part), shares = _cut(mass, inner, first, len(bias))
        thing, node, digit = (np.concatenate(x) for x in ((thing, more), (node, below), (digit, part)))
        bias = np.concatenate([bias, shares])
    order = np.argsort(thing, kind="stable")
    starts = np.concatenate([[0], np.cumsum(np.bincount(thing, minlength=len(mass)))])
    return starts, node[order].astype(np.int32), digit[order].astype(np.uint8), bias.astype(np.float32)


class Room:
    """Arrays by name that are used again for the next tokens, so that their memory isn't asked for each time."""

    def __init__(self):
        self.held = {}

    def __call__(self, name: str, shape: int | tuple[int, ...], kind=np.int64) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self.held or len(self.held[name]) < size:
            self.held[name] = np.empty(size + size // 4, kind)
        return self.held[name][:size].reshape(shape)


def _logits(weights: np.ndarray, bias: np.ndarray, own: np.ndarray, buckets: np.ndarray, room: Room) -> np.ndarray:
    z, more = (room(name, (len(own), CLASSES), np.float32) for name in ("z", "more"))
    np.take(weights, buckets[0], axis=0, out=z, mode="clip")
    for k in range(1, FEATURES):
        np.take(weights, buckets[k], axis=0, out=more, mode="clip")
        z += more
    np.clip(z, -MOST, MOST, out=z)
    np.take(bias, own, axis=0, out=more, mode="clip")
    z += more
    return z


@dataclass
class Model:
    """Weights by hashed context and class, hashes of the top words in order, the ways to them, and digits of other words by kind."""

    weights: np.ndarray
    bias: np.ndarray
    known: np.ndarray
    starts: np.ndarray
    nodes: np.ndarray
    digits: np.ndarray
    depths: np.ndarray

    def lookup(self):
        """A function from hashes to places among the top words, and whether they are there."""
        if not len(self.known):
            return lambda h: (np.zeros(len(h), np.int64), np.zeros(len(h), bool))
        width = max(8, int(len(self.known)).bit_length() + 1)
        shift = np.uint64(64 - width)
        first = np.concatenate([[0], np.cumsum(np.bincount((self.known >> shift).astype(np.int64), minlength=1 << width))])
        padded = np.append(self.known, ~np.uint64(0))

        def places(h):
            at = first[(h >> shift).astype(np.int64)]
            behind = np.flatnonzero(padded[at] < h)
            while len(behind):
                at[behind] += 1
                behind = behind[padded[at[behind]] < h[behind]]
            hit = padded[at] == h
            hit &= at < len(self.known)
            return at, hit

        return places

    def ways(self, h: np.ndarray, kinds: np.ndarray, at: np.ndarray, hit: np.ndarray):
        """The ways to tokens, through classes of the tree and then through those of hashed digits: (tokens, levels).

        Tokens with long ways come first, so that the classes of a level, from a token's last class up, belong to the first of
        them: each level is (keys of the classes, their rows of ``bias``, parts).
        """
        thing = np.where(hit, at, len(self.known) + kinds)
        sizes, last, _ = self.steps_up
        tokens, many = _longest_first(sizes[thing])
        yield tokens, self._of_tree(last[thing[tokens]], many)
        tokens, many = _longest_first(np.where(hit, 0, self.depths[kinds]))
        yield tokens, self._of_digits(h[tokens], kinds[tokens].astype(np.uint64) << np.uint64(58), many)

    def _of_tree(self, step: np.ndarray, many: np.ndarray):
        up = self.steps_up[2]
        for n in many.tolist():
            step = step[:n]
            rows = (step >> BITS).astype(np.int64)
            yield np.take(self.keys, rows), rows, step & (CLASSES - 1)
            step = np.take(up, rows)

    def _of_digits(self, h: np.ndarray, marks: np.ndarray, many: np.ndarray):
        rows = np.full(len(h), len(self.bias) - 1)
        for level, n in enumerate(many.tolist()):
            low = np.uint64(2 * level)
            before = h[:n] & ((np.uint64(1) << low) - np.uint64(1))
            keys = mix(before ^ (seed(5) ^ (low << np.uint64(50))) ^ marks[:n])
            yield keys, rows[:n], h[:n] >> low & np.uint64(CLASSES - 1)

    def classes(self, h, kinds, at, hit, features: np.ndarray, room: Room):
        """All classes on the ways to tokens, in blocks: (tokens, rows of ``bias``, rows of weights by feature, parts)."""
        for a in range(0, len(h), TOKENS_AT_ONCE):
            here, size, n = slice(a, a + TOKENS_AT_ONCE), 2 * TOKENS_AT_ONCE, 0
            token, own, part = room("token", size), room("own", size), room("part", size, np.uint8)
            buckets = room("buckets", (FEATURES, size), np.uint64)
            for tokens, levels in self.ways(h[here], kinds[here], at[here], hit[here]):
                seen = np.take(features[:, here], tokens, axis=1)
                for keys, rows, parts in levels:
                    if n + len(keys) > size:
                        yield token[:n], own[:n], buckets[:, :n].view(np.int64), part[:n]
                        n = 0
                    block = slice(n, n + len(keys))
                    np.add(tokens[: len(keys)], a, out=token[block])
                    own[block], part[block] = rows, parts
                    hashed(seen[:, : len(keys)], keys, buckets[:, block])
                    n += len(keys)
            yield token[:n], own[:n], buckets[:, :n].view(np.int64), part[:n]

    @property
    def steps_up(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Lengths of the ways, their last steps, and the step before by class: ``CLASSES`` * class + part. Far smaller than the ways."""
        if not hasattr(self, "_up"):
            steps, sizes = self.nodes.astype(np.int64) * CLASSES + self.digits, np.diff(self.starts)
            last, up, after = np.zeros(len(sizes), np.int64), np.zeros(len(self.bias), np.int64), np.ones(len(steps), bool)
            last[sizes > 0] = steps[self.starts[1:][sizes > 0] - 1]
            after[self.starts[:-1][sizes > 0]] = False
            after = np.flatnonzero(after)
            up[self.nodes[after]] = steps[after - 1]
            self._up = sizes, last.astype(np.int32), up.astype(np.int32)
        return self._up

    @property
    def keys(self) -> np.ndarray:
        if not hasattr(self, "_keys"):
            self._keys = mix(np.arange(len(self.bias), dtype=np.uint64) + seed(6))
        return self._keys


def _steps(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each index as often as its size says, and 0, 1, 2... for it."""
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def _longest_first(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the sizes above 0, largest first, and how many sizes are above 0, 1, 2..."""
    many = len(sizes) - np.cumsum(np.bincount(sizes, minlength=1))[:-1]
    order = np.argsort((len(many) - sizes).astype(np.uint16), kind="stable")
    return order[: many[0] if len(many) else 0], many


def hashed(features: np.ndarray, keys: np.ndarray, out: np.ndarray) -> None:
    """The rows of weights of contexts and classes."""
    np.bitwise_xor(features, keys, out=out)
    out *= np.uint64(0x9E3779B97F4A7C15)
    out >>= np.uint64(65 - BUCKETS.bit_length())


def _pairs(sums: np.ndarray) -> np.ndarray:
    """The sums of the first two of the three parts, kept side by side as complex numbers, so that both are added at once."""
    return sums[:2].reshape(-1).view(np.complex128)


def add_errors(weights, bias, own, buckets, part, sums, room: Room) -> None:
    """Add the errors of all parts of the classes but the last to the sums over the rows of weights they come from."""
    z = _logits(weights, bias, own, buckets, room)
    np.exp(z, out=z)
    whole = z @ np.ones(CLASSES, np.float32)
    two, error = room("two", len(own), np.complex128), room("error", len(own), np.float64)
    for k, out in enumerate((two.real, two.imag, error)):
        np.divide(z[:, k], whole, out=out)
        out -= part == k
    pairs = _pairs(sums)
    for one in buckets:
        np.add.at(pairs, one, two)
        np.add.at(sums[2], one, error)


def gradient_step(weights, squares, sums) -> None:
    """A scaled gradient step by the sums of errors, in place; the sums begin anew."""
    pairs = _pairs(sums)
    for a in range(0, BUCKETS, ROWS_AT_ONCE):
        b = a + ROWS_AT_ONCE
        errors = [pairs.real[a:b], pairs.imag[a:b], sums[2, a:b]]
        slopes = [e.astype(np.float32) for e in (*errors, -(errors[0] + errors[1] + errors[2]))]  # errors of a class add up to 0
        for slope in slopes:
            squares[a:b] += slope * slope
        rate = RATE / np.sqrt(squares[a:b] + 1)
        for k, slope in enumerate(slopes):
            slope *= rate
            weights[a:b, k] -= slope
        pairs[a:b] = sums[2, a:b] = 0


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept, size = [], 0

    def merged(parts):
        h, c, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(h)
        h = h[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        return h[first], c[order[first]], np.add.reduceat(n[order], first)

    def out(parts):
        h, c, n = merged(parts)
        for a in range(0, len(h), 100_000):
            b = a + 100_000
            yield pa.record_batch([pa.array(h[a:b].view(np.int64)), pa.array(c[a:b]), pa.array(n[a:b])], ["h", "class", "n"])

    for batch in batches:
        for _, _, data, offsets in text_slices(batch.column(0)):
            h, c, _ = tokens_of(data, offsets)
            kept.append(merged([(h, c, np.ones(len(h), np.int64))]))
            size += len(kept[-1][0])
            if size > 3_000_000:
                kept = [merged(kept)]
                size = len(kept[0][0])
                if size > 1_500_000:  # mostly different words: pass them on
                    yield from out(kept)
                    kept, size = [], 0
    if kept:
        yield from out(kept)


def _trained(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        weights, places = model.weights.copy(), model.lookup()
        squares, seen, size = np.zeros(BUCKETS, np.float32), 0, FIRST_BATCH
        sums, room = np.zeros((CLASSES - 1, BUCKETS)), Room()
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                h, kinds, rows = tokens_of(data, offsets)
                features, (at, hit) = contexts(h, rows), places(h)
                a = 0
                while a < len(h):
                    b = a + size
                    for _, own, buckets, part in model.classes(h[a:b], kinds[a:b], at[a:b], hit[a:b], features[:, a:b], room):
                        add_errors(weights, model.bias, own, buckets, part, sums, room)
                    gradient_step(weights, squares, sums)
                    a, size = b, min(2 * size, MINIBATCH)
                seen += len(h)
        if seen:
            task = TaskContext.get().partitionId()
            pieces = np.split(np.column_stack([weights * squares[:, None], squares]), BLOCKS)
            data = [p.tobytes() for p in pieces]
            n = len(pieces)
            yield pa.record_batch(
                [pa.array(np.arange(n)), pa.array([task % 64] * n, pa.int64()), pa.array([seen] * n, pa.int64()), pa.array(data, pa.binary())],
                ["block", "share", "seen", "data"],
            )

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the arrays by block (at most ``BLOCKS`` of them), as they stream by."""
    totals, seen = {}, {}
    for batch in batches:
        for block, n, data in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
            values = np.frombuffer(data.as_buffer(), np.float32)
            totals[block] = totals[block] + values if block in totals else values.astype(np.float64)
            seen[block] = seen.get(block, 0) + n
    keys = list(totals)
    yield pa.record_batch(
        [pa.array(keys, pa.int64()), pa.array([0] * len(keys), pa.int64()), pa.array([seen[k] for k in keys], pa.int64()),
         pa.array([totals[k].astype(np.float32).tobytes() for k in keys], pa.binary())],
        ["block", "share", "seen", "data"],
    )


def _long_tasks(texts: DataFrame) -> DataFrame:
    """Texts in at most ``TASKS_PER_CORE`` tasks a core, as every task sends weights: those follow the cluster, not the input."""
    return texts.coalesce(TASKS_PER_CORE * texts.sparkSession.sparkContext.defaultParallelism)


def train(texts: DataFrame, counts: DataFrame) -> tuple[Model, int, int, np.ndarray, tuple[int, int] | None]:
    """The model, all training tokens, different ones, the counts of the top words and of the end, and the last top word (n, h)."""
    totals = counts.groupBy("class").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    tokens, different = sum(r["n"] for r in totals), sum(r["v"] for r in totals)
    top = counts.filter(F.col("class") != 0).orderBy(F.col("n").desc(), "h").limit(TOP_WORDS).toPandas()
    last = (int(top["n"].iloc[-1]), int(top["h"].iloc[-1])) if len(top) else None
    h, n, own = top["h"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64), top["class"].to_numpy(np.int64)
    mass, words = np.zeros(1 + SHAPES, np.int64), np.zeros(1 + SHAPES, np.int64)
    for r in totals:
        mass[r["class"]], words[r["class"]] = r["n"], r["v"]
    ended = mass[0]
    mass -= np.bincount(own, n, 1 + SHAPES).astype(np.int64)
    words -= np.bincount(own, minlength=1 + SHAPES)
    order = np.argsort(h)
    h, n = h[order], n[order]
    # Groups: the end, the most frequent words one by one, and the kinds.
    single = np.argsort(-n, kind="stable")[:SINGLES]
    group = np.concatenate([own[order], np.arange(1 + SHAPES)])
    group[single] = 1 + SHAPES + np.arange(len(single))
    starts, nodes, digits, bias = class_tree(np.concatenate([n, mass + words + 1]), group)
    # Classes of hashed digits begin with equal parts.
    bias = np.concatenate([bias, np.full((1, CLASSES), -np.log(CLASSES), np.float32)])
    depths = np.zeros(1 + SHAPES, np.int64)
    while (wide := (depths < 24) & (CLASSES**depths < words)).any():
        depths += wide
    depths[0] = 0
    model = Model(np.zeros((BUCKETS, CLASSES), np.float32), bias, h, starts, nodes, digits, depths)
    schema = "block bigint, share bigint, seen bigint, data binary"
    for _ in range(ROUNDS if tokens else 0):
        steps = _long_tasks(texts).mapInArrow(_trained(model), schema)
        whole = steps.repartition("block").mapInArrow(_summed, schema).collect()
        held = {r["block"]: np.frombuffer(bytes(r["data"]), np.float32) for r in whole}
        sums = np.concatenate([held[b].reshape(-1, CLASSES + 1) for b in range(BLOCKS)])
        weights = np.where(sums[:, -1:] > 0, sums[:, :-1] / np.maximum(sums[:, -1:], 1e-30), model.weights).astype(np.float32)
        model = replace(model, weights=weights)
    return model, tokens, different, np.append(n, ended), last


def _scored(model: Model, top_counts: np.ndarray):
    """Scores without the shares of words in last classes of hashed digits, and (hash, last class, times) of the words that need them."""
    logs = np.log10(top_counts + 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row, places, room = TaskContext.get().partitionId() << 33, model.lookup(), Room()
        for batch in batches:
            for first, stop, data, offsets in text_slices(batch.column(1)):
                count = stop - first
                h, kinds, rows = tokens_of(data, offsets)
                features, (at, hit) = contexts(h, rows), places(h)
                score = np.zeros(count)
                for token, own, buckets, part in model.classes(h, kinds, at, hit, features, room):
                    z = _logits(model.weights, model.bias, own, buckets, room)
                    chance = np.take(z.reshape(-1), np.arange(0, z.size, CLASSES) + part)
                    np.exp(z, out=z)
                    chance -= np.log(z @ np.ones(CLASSES, np.float32))
                    score += np.bincount(rows[token], chance, count)
                end = kinds == 0
                value = np.where(hit, logs[np.where(hit, at, 0)], np.where(end, logs[-1], 0.0))
                known, rare = hit | (end & (top_counts[-1] > 0)), ~hit & ~end
                yield pa.record_batch(
                    [
                        pa.array(row + np.arange(count)),
                        batch.column(0).slice(first, count),
                        pa.array(np.bincount(rows, minlength=count)),
                        pa.array(np.bincount(rows[known], minlength=count)),
                        pa.array(np.bincount(rows, value, count)),
                        pa.array(score / np.log(10)),
                        _lists(h[rare], kinds[rare], rows[rare], count, model.depths),
                    ],
                    ["row", "doc_id", "n_tokens", "known", "logs", "score", "rare"],
                )
                row += count

    return run


def _lists(h: np.ndarray, kinds: np.ndarray, rows: np.ndarray, count: int, depths: np.ndarray) -> pa.Array:
    """Different words by row, with their last classes and how often they are there; rows come in order."""
    order = np.lexsort((h, rows))
    h, kinds, rows = h[order], kinds[order], rows[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (rows[1:] != rows[:-1])]))
    fields = [h[first].view(np.int64), _last_class(h[first], kinds[first], depths).view(np.int64), np.diff(first, append=len(h))]
    words = pa.StructArray.from_arrays([pa.array(x) for x in fields], ["h", "leaf", "times"])
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows[first], np.arange(count + 1)), pa.int32()), words)


def _last_class(h: np.ndarray, kinds: np.ndarray, depths: np.ndarray) -> np.ndarray:
    """Number of the last class of words that aren't among the top words."""
    mask = (np.uint64(1) << (2 * depths[kinds]).astype(np.uint64)) - np.uint64(1)
    return ((h & mask) << np.uint64(5)) | kinds.astype(np.uint64)


def _last_classes(counts: DataFrame, last: tuple[int, int], depths: np.ndarray) -> DataFrame:
    """(leaf, total, words, held) of the last classes of words that aren't among the top words."""
    n, h = last
    rest = counts.filter((F.col("class") != 0) & ((F.col("n") < n) | ((F.col("n") == n) & (F.col("h") > h))))
    masks = F.array(*[F.lit((1 << 2 * int(d)) - 1).cast("bigint") for d in depths])
    leaf = F.shiftleft(F.col("h").bitwiseAND(F.get(masks, F.col("class").cast("int"))), 5).bitwiseOR(F.col("class"))
    # About one word each, as their number follows that of the words.
    held = F.collect_list(F.struct("h", "n"))
    return rest.groupBy(leaf.alias("leaf")).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("words"), held.alias("held"))


def held_out(doc_id: Column) -> Column:
    """Ids whose crc32 as text leaves 2 when divided by 7; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def language_model_scores(docs: DataFrame, train_on: Column | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    train_on = ~held_out(F.col("doc_id")) if train_on is None else train_on
    texts = slim.filter(train_on).select("text")
    counts = texts.mapInArrow(_counted, "h bigint, class bigint, n bigint").groupBy("h").agg(F.min("class").alias("class"), F.sum("n").alias("n"))
    counts = written(counts, "counts")
    model, tokens, different, n, last = train(texts, counts)
    kind = slim.schema["doc_id"].dataType.simpleString()
    schema = f"row bigint, doc_id {kind}, n_tokens bigint, known bigint, logs double, score double, rare array<struct<h: bigint, leaf: bigint, times: bigint>>"
    rows = written(slim.mapInArrow(_scored(model, n), schema), "scored")
    tail = rows.select("row", F.inline("rare"))
    leaves = _last_classes(counts, last or (0, 0), model.depths)
    times, own = F.col("times"), F.coalesce(F.get("held.n", F.array_position("held.h", F.col("h")).cast("int") - 1), F.lit(0))
    tail = tail.join(leaves, "leaf", "left").select("row", "times", own.alias("n"), (F.coalesce("total", F.lit(0)) + F.coalesce("words", F.lit(0)) + 1).alias("all"))
    log = F.log10(F.col("n") + F.lit(1.0))
    more = tail.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, times).otherwise(0)).alias("more_known"),
        F.sum(times * log).alias("more_logs"),
        F.sum(times * (log - F.log10(F.col("all").cast("double")))).alias("more_score"),
    )
    out = rows.drop("rare").join(more, "row", "left")
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    return out.select(
        F.col("doc_id").alias(doc_id),
        held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(float(np.log10(tokens + different + 1)))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )

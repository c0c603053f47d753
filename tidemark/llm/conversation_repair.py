"""Repair of conversations by the cheapest edits, over a grammar that all conversations share.

A row of a conversation is one symbol: the initial of its role (system, user, assistant, other) and whether it is cut off, or ``x``
where it has to go. Re-Pair replaces frequent pairs of symbols by new symbols, counted over the sequences of all conversations;
each rule has one min-plus transfer matrix: for two states of the pattern ``(s?(ua)+)?``, the least cost of getting from one to the
other along the rule's rows, and the audit (initials of the edits in order) as a rope that shares the ropes of the rule's two
halves. Matrices are evaluated bottom-up, once per rule, and a sequence is the product of the matrices of its symbols. The rules are
few (``MAX_RULES``, whatever the number of conversations; what no rule covers stays a plain symbol, with the same result).

Two audits of equal cost between the same two states over the same rows are never one the beginning of the other, as what follows would
be inserts, which cost; so the least of (cost, audit) carries over to products.

Long conversations: rows are cut into blocks of ``BLOCK``; blocks are evaluated on their own to a matrix, then one pass over the blocks
of a conversation multiplies them, and repaired rows are made block by block. Positions come from ``ordered.row_number``, which splits
hot keys. What a conversation has in one place is one small row per block, and its audit, which is one value of the result.

Results: null roles and texts count as one space; a null conversation id is a conversation; null turns come first. Rows with equal turn are
ordered by role and text. A role of another initial can be reroled or deleted. An empty table gives an empty result; further
columns aren't looked at.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from functools import lru_cache, partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import row_number
from tidemark.session import written

#: Rows of a conversation that are evaluated together; longer ones come in several blocks.
BLOCK = 4096
#: Rules of the grammar, and of one round: pairs of one round share no symbol.
MAX_RULES, ROUND_RULES = 192, 24
#: Sequences whose result a task remembers.
REMEMBERED = 20_000

#: Costs of the edits, and of a row that is kept or reroled although it is cut off.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
#: States: nothing yet, after a system row, after a user row, after an assistant row.
STATES = START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_ROLES = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = ("su", "ua", "au")
# Inside, keeping the system row has a letter of its own, which tells the state; in its place the order is that of K.
_KEPT_SYSTEM = "L"

BLANK = r"^[\x20\x09-\x0D]*\z"
CLOSED = r"[.!?][\x20\x09-\x0D]*\z"


# --- ropes and matrices: a rope is a string or (rope, rope, length); an entry is (cost, rope) or None ---


def _joined(a, b):
    if not a or not b:
        return a or b
    return (a, b, _length(a) + _length(b))


def _length(rope) -> int:
    return rope[2] if isinstance(rope, tuple) else len(rope)


def flat(rope) -> str:
    out, stack = [], [rope]
    while stack:
        top = stack.pop()
        if isinstance(top, tuple):
            stack += [top[1], top[0]]
        else:
            out.append(top)
    return "".join(out)


def before(a, b) -> bool:
    """Is rope ``a`` less than ``b``? What the two share at the same place is not opened."""
    x, y = [a], [b]
    while x and y:
        p, q = x.pop(), y.pop()
        if p is q:
            continue
        if isinstance(p, tuple) and (not isinstance(q, tuple) or p[2] >= q[2]):
            x += [p[1], p[0]]
            y.append(q)
        elif isinstance(q, tuple):
            y += [q[1], q[0]]
            x.append(p)
        else:
            n = min(len(p), len(q))
            if p[:n] != q[:n]:
                return p[:n] < q[:n]
            x += [p[n:]] * (len(p) > n)
            y += [q[n:]] * (len(q) > n)
    return bool(y)


def _better(new, old):
    return old if old is not None and (old[0] < new[0] or old[0] == new[0] and not before(new[1], old[1])) else new


def product(a, b):
    """Min-plus product of matrices (lists of rows); ``a`` may have fewer rows."""
    out = []
    for row in a:
        line = [None] * len(STATES)
        for k, first in enumerate(row):
            if first is None:
                continue
            for j, second in enumerate(b[k]):
                if second is not None and ((old := line[j]) is None or first[0] + second[0] <= old[0]):
                    line[j] = _better((first[0] + second[0], _joined(first[1], second[1])), old)
        out.append(line)
    return out


def _inserts():
    out = [[None] * len(STATES) for _ in STATES]
    for i in STATES:
        state, n = i, 0
        while out[i][state] is None:
            out[i][state] = (n * INSERT, "I" * n)
            state, n = _NEXT[state], n + 1
    return out


INSERTS = _inserts()


def symbol_matrix(symbol: str):
    """Inserts before a row, then its edit; capitals are rows that are cut off."""
    more, kind = CUT_OFF * symbol.isupper(), symbol.lower()
    edit = [[None] * len(STATES) for _ in STATES]
    for i in STATES:
        edit[i][i] = (DELETE, "D")
        if kind == "x":
            continue
        to = _NEXT[i]
        edit[i][to] = (KEEP + more, "K") if kind == _ROLES[to][0] else (REROLE + more, "R")
    if kind == "s":
        edit[START][SYSTEM] = (KEEP + more, _KEPT_SYSTEM)
    return product(INSERTS, edit)


def start_row():
    return [[(0, "") if j == START else None for j in STATES]]


def identity():
    return [[(0, "") if i == j else None for j in STATES] for i in STATES]


def accepted(row):
    """The cheapest way to an end from the entries of one row: nothing at all, or after an assistant row."""
    ends = product([row], INSERTS)[0]
    found = None
    for j in (START, ASSISTANT):
        if ends[j] is not None:
            found = _better(ends[j], found)
    return found


# --- grammar ---

SYMBOLS = "suaoSUAOx"
_FIRST_NEW = 0xE000


def squeezed(sequence: str, rules: list[str]) -> str:
    """The sequence with each rule's pair replaced, in the order of the rules."""
    for k, pair in enumerate(rules):
        sequence = sequence.replace(pair, chr(_FIRST_NEW + k))
    return sequence


def pairs_of(sequence: str) -> Counter:
    """How often each pair could be replaced; of a run of one symbol, every second place."""
    out, at, n = Counter(), 0, len(sequence)
    while at < n - 1:
        end = at + 1
        while end < n and sequence[end] == sequence[at]:
            end += 1
        if end - at > 1:
            out[sequence[at] * 2] += (end - at) // 2
        if end < n:
            out[sequence[end - 1 : end + 1]] += 1
        at = end
    return out


def _count_pairs(batches, rules: list[str]):
    held: Counter[str] = Counter()
    for batch in batches:
        for sequence, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for pair, times in pairs_of(squeezed(sequence, rules)).items():
                held[pair] += times * n
    yield pa.record_batch([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["pair", "n"])


def grammar(sequences: DataFrame) -> list[str]:
    """Re-Pair rules (the pair of each new symbol) for the table (symbols, n).

    Pairs are counted by all tasks and summed; at most the square of the symbols so far, a number that ``MAX_RULES`` bounds.
    """
    rules: list[str] = []
    while len(rules) < MAX_RULES:
        counted = sequences.mapInArrow(partial(_count_pairs, rules=rules), "pair string, n long")
        totals = counted.groupBy("pair").agg(F.sum("n").alias("n")).filter("n > 1")
        new, used = [], set()
        for pair, _ in totals.orderBy(F.desc("n"), "pair").limit(4 * ROUND_RULES).collect():
            if not used & set(pair) and len(new) < min(ROUND_RULES, MAX_RULES - len(rules)):
                new.append(pair)
                used |= set(pair)
        if not new:
            break
        rules += new
    return rules


def rule_matrices(rules: list[str]) -> dict:
    """Bottom-up: one matrix for each symbol and each rule."""
    out = {s: symbol_matrix(s) for s in SYMBOLS}
    for k, (left, right) in enumerate(rules):
        out[chr(_FIRST_NEW + k)] = product(out[left], out[right])
    return out


# --- tasks ---


def _evaluated(batches, rules: list[str]):
    """A block's matrix (one row for a first block), with its counts and its borders."""
    matrices = rule_matrices(rules)

    @lru_cache(REMEMBERED)
    def evaluate(sequence: str, first: bool):
        found = start_row() if first else identity()
        for symbol in squeezed(sequence, rules):
            found = product(found, matrices[symbol])
        return [[None if e is None else e[0] for e in row] for row in found], [["" if e is None else flat(e[1]) for e in row] for row in found]

    for batch in batches:
        columns: dict[str, list] = {name: [] for name in ("costs", "audits", "rows", "blank", "duplicate", "truncated", "illegal", "ends", "turns", "least", "most")}
        for block, symbols, initials, faults, turns in zip(*(batch.column(c).to_pylist() for c in ("block", "symbols", "initials", "faults", "turns")), strict=True):
            costs, audits = evaluate(symbols, block == 0)
            known = [t for t in turns if t is not None]
            legal = sum(initials.count(x) for x in _LEGAL)  # no two of them overlap with themselves
            values = (
                sum(costs, []),
                sum(audits, []),
                len(symbols),
                faults.count("b"),
                faults.count("d"),
                faults.count("t"),
                len(initials) - 1 - legal,
                initials[0] + initials[-1],
                len(set(known)),
                known[0] if known else None,
                known[-1] if known else None,
            )
            for name, value in zip(columns, values, strict=True):
                columns[name].append(value)
        kinds = {"costs": pa.list_(pa.int64()), "audits": pa.list_(pa.string()), "ends": pa.string()}
        arrays = [batch.column("conv"), batch.column("block"), *(pa.array(v, kinds.get(k, pa.int64())) for k, v in columns.items())]
        yield pa.record_batch(arrays, ["conv", "block", *columns])


def _rows(batches):
    for batch in batches:
        names = batch.schema.names
        for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            yield dict(zip(names, values, strict=True))


def _after(state: int, edit: str) -> int:
    if edit == "D":
        return state
    return SYSTEM if edit == _KEPT_SYSTEM else _NEXT[state]


class _Fold:
    """The verdict of one conversation out of its blocks in order."""

    COUNTS = ("blank", "duplicate", "truncated", "illegal")

    def __init__(self, conv):
        self.conv, self.row, self.sizes = conv, start_row()[0], []
        self.counts = dict.fromkeys(self.COUNTS, 0)
        self.last, self.least, self.most, self.turns = None, None, None, 0

    def add(self, block):
        entries = [None if c is None else (c, a) for c, a in zip(block["costs"], block["audits"], strict=True)]
        n = len(STATES)
        matrix = [entries[i : i + n] for i in range(0, len(entries), n)]
        self.row = matrix[0] if len(matrix) == 1 else product([self.row], matrix)[0]
        for name in self.COUNTS:
            self.counts[name] += block[name]
        if self.last is not None:
            self.counts["illegal"] += self.last + block["ends"][0] not in _LEGAL
        self.last = block["ends"][1]
        if block["least"] is not None:
            self.turns += block["turns"] - (self.most == block["least"])
            self.least = block["least"] if self.least is None else self.least
            self.most = block["most"]
        self.sizes.append(block["rows"])

    def verdicts(self):
        """The whole (block -1), then each block's part of the audit and the state it begins in."""
        cost, audit = accepted(self.row)
        audit = flat(audit)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        yield (self.conv, -1, START, audit.replace(_KEPT_SYSTEM, "K"), gaps, *self.counts.values(), cost)
        state, at = START, 0
        for block, size in enumerate(self.sizes):
            begin, left = at, size
            while left:  # inserts belong to the row that follows them, the last ones to the last block
                left -= audit[at] != "I"
                at += 1
            if block == len(self.sizes) - 1:
                at = len(audit)
            yield (self.conv, block, state, audit[begin:at], *[None] * 6)
            for edit in audit[begin:at]:
                state = _after(state, edit)


_VERDICT = ("block", "state", "audit", "gaps", *_Fold.COUNTS, "cost")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _verdict_schema(conv: pa.DataType) -> pa.Schema:
    kinds = [pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 6]
    return pa.schema([("conv", conv), *zip(_VERDICT, kinds, strict=True)])


def _folded(batches):
    """Verdicts of the conversations of a partition that is sorted by conversation and block."""
    nothing = object()
    schema, fold, out, last = None, None, [], nothing
    for batch in batches:
        schema = schema or _verdict_schema(batch.schema.field("conv").type)
        for row in _rows([batch]):
            if last is nothing or row["conv"] != last:
                out += fold.verdicts() if fold else ()
                last, fold = row["conv"], _Fold(row["conv"])
            if row["block"] >= 0:
                fold.add(row)
        if len(out) >= 1000:
            yield _batch(out, schema)
            out = []
    if fold:
        yield _batch([*out, *fold.verdicts()], schema)


def _applied(batches):
    """Repaired rows of the blocks of a partition that is sorted by conversation, block and position, each block's audit first."""
    audit, state, at, position, step = "", START, 0, 0, 0
    schema, out, size, conv = None, [], 0, None

    def inserts():
        nonlocal at, state, step
        while at < len(audit) and audit[at] == "I":
            state, at, step = _NEXT[state], at + 1, step + 1
            yield (conv, position, step, None, _ROLES[state], "", "I")

    for batch in batches:
        if schema is None:
            kinds = [("position", pa.int64()), ("step", pa.int32()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string())]
            schema = pa.schema([("conv", batch.schema.field("conv").type), *kinds])
        for row in _rows([batch]):
            if row["position"] < 0:
                out += inserts()  # those at the end of the block before
                conv, audit, state, at = row["conv"], row["audit"], row["state"], 0
                continue
            position, step = row["position"], 0
            out += inserts()
            edit, at = audit[at], at + 1
            state, step = _after(state, edit), step + 1
            if edit != "D":
                role = _ROLES[state] if edit == "R" else row["role"]
                out.append((conv, position, step, row["turn"], role, row["text"], "R" if edit == "R" else "K"))
                size += len(row["text"])
            if size > 1 << 22 or len(out) > 2000:
                yield _batch(out, schema)
                out, size = [], 0
    out += inserts()
    if out:
        yield _batch(out, schema)


def _digested(batches):
    """SHA-256 over the lines of each conversation, in order, beside its verdict (position -1), which comes first."""
    out, verdict, digest, first, schema = [], None, None, True, None
    names = ("conv", *_VERDICT[2:])
    for batch in batches:
        schema = schema or pa.schema([*((n, batch.schema.field(n).type) for n in names), ("repaired_sha256", pa.string())])
        for row in _rows([batch]):
            if row["position"] < 0:
                if verdict:
                    out.append((*verdict, digest.hexdigest()))
                verdict, digest, first = tuple(row[n] for n in names), hashlib.sha256(), True
                continue
            digest.update((row["line"] if first else "\n" + row["line"]).encode())
            first = False
        if len(out) > 1000:
            yield _batch(out, schema)
            out = []
    if verdict:
        yield _batch([*out, (*verdict, digest.hexdigest())], schema)


# --- operators ---


def numbered(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, turn, role, text, position, block), written: rows of each conversation in order, from 0."""
    plain = rows.select(
        F.col(conv_id).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("text"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]
    placed = row_number(plain, ["conv"], order, "position").withColumn("position", F.col("position") - 1)
    return written(placed.withColumn("block", F.floor(F.col("position") / BLOCK)), "rows")


def blocks_of(rows: DataFrame) -> DataFrame:
    """(conv, block, symbols, initials, faults, turns) of ``numbered`` rows, one row per block, written."""
    initial = F.substring("role", 1, 1)
    marked = rows.select(
        "conv",
        "block",
        "position",
        "turn",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        F.when(F.col("text").rlike(BLANK), "b").when(~F.col("text").rlike(CLOSED), "t").otherwise("-").alias("fault"),
        F.unhex(F.sha2(F.concat(F.char_length("role"), F.lit(":"), "role", "text"), 256)).alias("content"),
    )
    same = ["conv", "content"]
    repeated = marked.groupBy(*same).agg(F.min("position").alias("first"), F.count("*").alias("times")).filter("times > 1")
    repeated = repeated.select(F.col("conv").alias("c"), F.col("content").alias("t"), "first")
    joined = marked.join(repeated, F.col("conv").eqNullSafe(F.col("c")) & (F.col("content") == F.col("t")), "left")
    again = F.coalesce(F.col("position") > F.col("first"), F.lit(False))
    fault = F.when((F.col("fault") != "b") & again, "d").otherwise(F.col("fault"))
    joined = joined.select("conv", "block", "position", "turn", "initial", fault.alias("fault"))
    symbol = F.when(F.col("fault").isin("b", "d"), "x").when(F.col("fault") == "t", F.upper("initial")).otherwise(F.col("initial"))
    # At most BLOCK small values in a row.
    held = F.array_sort(F.collect_list(F.struct("position", symbol.alias("symbol"), "initial", "fault", "turn"))).alias("held")
    grouped = joined.groupBy("conv", "block").agg(held)
    texts = [F.array_join(F.col(f"held.{x}"), "").alias(y) for x, y in (("symbol", "symbols"), ("initial", "initials"), ("fault", "faults"))]
    return written(grouped.select("conv", "block", *texts, F.col("held.turn").alias("turns")), "blocks")


def verdicts(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """Of every conversation (block -1) and of every block: audit, the state it begins in, counts and cost; written.

    ``rows`` is a ``numbered`` table, ``conversations`` (conv) has every conversation that shall have a verdict.
    """
    blocks = blocks_of(rows)
    kind = blocks.schema["conv"].dataType.simpleString()
    rules = grammar(written(blocks.groupBy("symbols").agg(F.count("*").alias("n")), "sequences"))
    schema = f"conv {kind}, block long, costs array<long>, audits array<string>, rows long, blank long, duplicate long, truncated long, illegal long, ends string, turns long, least long, most long"
    evaluated = blocks.mapInArrow(partial(_evaluated, rules=rules), schema)
    heads = conversations.groupBy("conv").agg(F.lit(-1).cast("long").alias("block"))
    both = evaluated.unionByName(heads, allowMissingColumns=True)
    kinds = f"conv {kind}, block long, state int, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    return written(both.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(_folded, kinds), "verdicts")


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv, position, step, turn, role, text, edit) in order of position and step; inserted rows have no turn."""
    kind = rows.schema["conv"].dataType.simpleString()
    parts = found.filter("block >= 0").select("conv", "block", F.lit(-1).cast("long").alias("position"), "state", "audit")
    both = rows.select("conv", "block", "position", "turn", "role", "text").unionByName(parts, allowMissingColumns=True)
    placed = both.repartition("conv", "block").sortWithinPartitions("conv", "block", "position")
    return placed.mapInArrow(_applied, f"conv {kind}, position long, step int, turn long, role string, text string, edit string")


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations: (conv_id, position, step, turn, role, text, edit), where edit is K, R or I."""
    placed = numbered(rows, conv_id, turn, role, text)
    return repaired_rows(placed, verdicts(placed, placed.select("conv"))).withColumnRenamed("conv", conv_id)


def repair_report(
    rows: DataFrame,
    conversations: DataFrame | None = None,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per conversation: gaps, faults, cost, audit and the SHA-256 of its repaired ``role:text`` lines.

    ``conversations`` may name more conversations than have rows. A digest reads its conversation's lines one after the other, in the
    task that has them, and holds one at a time.
    """
    placed = numbered(rows, conv_id, turn, role, text)
    heads = (rows if conversations is None else conversations).select(F.col(conv_id).alias("conv"))
    found = verdicts(placed, heads)
    kind = placed.schema["conv"].dataType.simpleString()
    lines = repaired_rows(placed, found).select("conv", "position", "step", F.concat("role", F.lit(":"), "text").alias("line"))
    heads = found.filter("block < 0").select("conv", F.lit(-1).cast("long").alias("position"), F.lit(0).alias("step"), *_VERDICT[2:])
    both = lines.unionByName(heads, allowMissingColumns=True).repartition("conv").sortWithinPartitions("conv", "position", "step")
    schema = f"conv {kind}, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, repaired_sha256 string"
    found = both.mapInArrow(_digested, schema)
    return found.select(F.col("conv").alias(conv_id), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows damaged by rule, by the CRC-32 of ``conv_id:turn`` modulo 20 (nulls: one space).

    0 drops the row, 1 empties its text, 2 takes ``[.!?]`` out of it, 3 repeats the row, 4 makes it the user's.
    """
    plain = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_id, turn, role, text)]
    fault = (F.crc32(F.concat(plain[0], F.lit(":"), plain[1]).cast("binary")) % 20).alias("__fault")
    held = rows.select(F.col(conv_id), F.col(turn), plain[2].alias(role), plain[3].alias(text), fault)
    changed = F.when(F.col("__fault") == 1, "").when(F.col("__fault") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text))
    said = F.when(F.col("__fault") == 4, "user").otherwise(F.col(role))
    times = F.when(F.col("__fault") == 0, 0).when(F.col("__fault") == 3, 2).otherwise(1)
    return held.select(conv_id, turn, said.alias(role), changed.alias(text), F.explode(F.array_repeat(F.lit(0), times)).alias("__c")).drop("__c")

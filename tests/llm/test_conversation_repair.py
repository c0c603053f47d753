"""Conversation repair against a plain search over all edits."""

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import conversation_repair as cr

GOOD = re.compile(r"(s?(ua)+)?")


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        m = zlib.crc32(key.encode()) % 20
        text = "" if m == 1 else re.sub("[.!?]", "", text) if m == 2 else text
        out += [(conv, turn, "user" if m == 4 else role, text)] * (0 if m == 0 else 2 if m == 3 else 1)
    return out


def cheapest(rows, faults):
    """(cost, audit, lines): Dijkstra over (rows done, role initials so far), least cost first, then least audit."""
    heap = [(0, "", 0, "", ())]
    done = set()
    while heap:
        cost, audit, at, said, lines = heapq.heappop(heap)
        state = said[-1:] if len(said) < 2 else said[-1]
        if at == len(rows) and GOOD.fullmatch(said):
            return cost, audit, list(lines)
        if (at, state, audit) in done:
            continue
        done.add((at, state, audit))

        def go(more, edit, at, initial, line, cost=cost, audit=audit, said=said, lines=lines):
            if not initial or re.fullmatch("s?(ua)*u?", said + initial):
                heapq.heappush(heap, (cost + more, audit + edit, at, said + initial, (*lines, line) if line is not None else lines))

        if len(audit) < 2 * len(rows) + 3:
            for role in ("user", "assistant"):
                go(3, "I", at, role[0], f"{role}:")
        if at < len(rows):
            (_, _, role, text), fault = rows[at], faults[at]
            go(4, "D", at + 1, "", None)
            if fault not in "bd":
                more = 3 * (fault == "t")
                if role[:1] in ("s", "u", "a"):
                    go(more, "K", at + 1, role[0], f"{role}:{text}")
                for new in ("user", "assistant"):
                    go(3 + more, "R", at + 1, new[0], f"{new}:{text}")
    raise AssertionError


def plain(rows, ids):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = {}
    for conv in ids:
        own = sorted(by[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults, seen = [], set()
        for _, _, role, text in own:
            said = text.strip(" \t\n\v\f\r")
            faults.append("b" if not said else "d" if (role, text) in seen else "-" if said[-1] in ".!?" else "t")
            seen.add((role, text))
        turns = [r[1] for r in own if r[1] is not None]
        n = Counter(faults)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        first = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
        cost, audit, lines = cheapest(own, faults)
        out[conv] = (gaps, n["b"], n["d"], n["t"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, position int, block string, audit int"


def run(spark, rows, hurt_first=False, given_rows=None):
    table = spark.createDataFrame([(*r, "c", 1, "b", 2) for r in rows], SCHEMA)
    source = cr.damaged(table) if hurt_first else table
    found = cr.repair_report(source, table).collect()
    assert len(found) == len({r[0] for r in rows})
    return {r.conv_id: tuple(r)[1:] for r in found}


ROLES = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
SAID = ["Hi.", "Yes!", "no", "", " \n", "Hi. ", "What?", None]


def cases(n, turns=7):
    import random

    rng = random.Random(5)
    rows = []
    for conv in range(n):
        for t in range(rng.randint(0, turns)):
            rows.append((conv, rng.choice([t, t, t + 1, None]) if conv % 3 == 0 else t, rng.choice(ROLES), rng.choice(SAID)))
    return rows


@pytest.mark.parametrize("hurt_first", [False, True])
def test_random_conversations(spark, hurt_first):
    rows = cases(150) + [(None, 0, "user", "Hi."), (None, 1, "assistant", "Yes."), (None, 1, "assistant", "Yes.")]
    as_given = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    expected = plain(hurt(rows) if hurt_first else as_given, {r[0] for r in rows})
    found = run(spark, rows, hurt_first)
    assert found == expected


def test_long_conversation_in_blocks(spark, monkeypatch, setting):
    """Blocks of three rows, a hot conversation, few rules: the same as in one piece."""
    import random

    rng = random.Random(8)
    rows = [(1, t, rng.choice(["user", "assistant"]), f"{rng.choice(['Hi.', 'x', 'Yes.'])}{t // 3 if t % 5 else ''}.") for t in range(60)]
    rows += [(2, t, rng.choice(ROLES), rng.choice(SAID)) for t in range(16)]
    whole = run(spark, rows)
    monkeypatch.setattr(cr, "BLOCK", 3)
    monkeypatch.setattr(cr, "MAX_RULES", 3)
    setting("tidemark.hotGroupRows", 10)
    assert run(spark, rows) == whole
    table = spark.createDataFrame([(*r, "c", 1, "b", 2) for r in rows], SCHEMA)
    lines = defaultdict(list)
    for r in cr.repair(table).orderBy("conv_id", "position", "step").collect():
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, found in whole.items():
        assert hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() == found[-1]


def test_long_text_and_empty_table(spark):
    text = "word " * 300_000
    found = run(spark, [(1, 0, "user", text + "."), (1, 1, "assistant", text)])
    assert found[1][:7] == (0, 0, 0, 1, 0, 3, "KK")
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair_report(cr.damaged(empty), empty).collect() == [] and cr.repair(empty).collect() == []


def test_conversation_without_rows(spark):
    table = spark.createDataFrame([(1, 0, "user", "Hi.", "c", 1, "b", 2)], SCHEMA)
    row = cr.repair_report(table.limit(0), table).first()
    assert tuple(row) == (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


symbols = st.text("suaoSUAx", max_size=14)


@settings(deadline=None, max_examples=300)
@given(st.lists(symbols, min_size=1, max_size=6))
def test_rules_give_the_product_of_their_rows(sequences):
    """Grammar-compressed products are those of plain rows, audits included; squeezed sequences unfold to the rows."""
    rules = []
    for _ in range(6):
        counted = sum((cr.pairs_of(cr.squeezed(s, rules)) for s in sequences), Counter())
        if not counted:
            break
        rules.append(max(sorted(counted), key=counted.get))
    matrices = cr.rule_matrices(rules)

    def unfold(s):
        return "".join(unfold(rules[ord(c) - 0xE000]) if ord(c) >= 0xE000 else c for c in s)

    for s in sequences:
        assert unfold(cr.squeezed(s, rules)) == s
        fast, slow = cr.identity(), cr.identity()
        for c in cr.squeezed(s, rules):
            fast = cr.product(fast, matrices[c])
        for c in s:
            slow = cr.product(slow, cr.symbol_matrix(c))
        view = lambda m: [[None if e is None else (e[0], cr.flat(e[1])) for e in row] for row in m]
        assert view(fast) == view(slow)


@given(st.recursive(st.text("DIKR", min_size=1, max_size=3), lambda x: st.tuples(x, x).map(lambda p: cr._joined(*p))), st.text("DIKR", max_size=9))
def test_ropes(rope, other):
    assert cr.before(rope, other) == (cr.flat(rope) < other) and cr.before(other, rope) == (other < cr.flat(rope))
    assert not cr.before(rope, rope)


def test_pairs_that_can_be_replaced():
    for s in ("aaaa", "aaa", "aab", "abab", "", "a", "aabbb"):
        for pair, n in cr.pairs_of(s).items():
            assert s.count(pair) == n

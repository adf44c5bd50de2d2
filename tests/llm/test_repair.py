"""Repair of conversations against every edit script of short ones, and against a plain walk of long ones."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tidemark.llm import repair, repair_grammar

ROWS = "conv_id long, turn long, role string, text string, at string, stretch int"
FORM = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """Of rows in order: blank, duplicate, truncated or nothing."""
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen
                   else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def by_every_script(rows, most_inserts=4):
    """Cost, audit and lines of the best of all scripts."""
    marks, best = faults(rows), None
    ways = [[("D", None, 3)] if m in ("blank", "duplicate") else
            [("D", None, 3), ("K", role, m == "truncated"), ("R", "user", 2 + (m == "truncated")),
             ("R", "assistant", 2 + (m == "truncated"))] for (role, _), m in zip(rows, marks, strict=True)]
    for script in itertools.product(*ways):
        for n in range(most_inserts + 1):
            for places in itertools.combinations_with_replacement(range(len(rows) + 1), n):
                for roles in itertools.product(("user", "assistant"), repeat=n):
                    steps = []
                    for at in range(len(rows) + 1):
                        steps += [("I", r, "") for p, r in zip(places, roles, strict=True) if p == at]
                        if at < len(rows):
                            steps.append((script[at][0], script[at][1], rows[at][1]))
                    left = [(role, text) for letter, role, text in steps if letter != "D"]
                    if all(r for r, _ in left) and FORM.fullmatch("".join(r[0] for r, _ in left)):
                        found = (sum(w[2] for w in script) + 2 * n, "".join(s[0] for s in steps), left)
                        best = found if best is None or found[:2] < best[:2] else best
    return best


def by_states(rows):
    """The same by a walk over the four states."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    name, ways = {"u": "user", "a": "assistant"}, {0: (0, "", [])}

    def put(ways, state, way):
        if state not in ways or way[:2] < ways[state][:2]:
            ways[state] = way

    def inserted(ways):
        for _ in range(3):
            for state, (cost, audit, left) in list(ways.items()):
                for initial, end in after[state].items():
                    if initial != "s":
                        put(ways, end, (cost + 2, audit + "I", [*left, (name[initial], "")]))
        return ways

    for (role, text), mark in zip(rows, faults(rows), strict=True):
        new = {}
        for state, (cost, audit, left) in inserted(ways).items():
            put(new, state, (cost + 3, audit + "D", left))
            if mark not in ("blank", "duplicate"):
                for initial, end in after[state].items():
                    if role[:1] == initial:
                        put(new, end, (cost + (mark == "truncated"), audit + "K", [*left, (role, text)]))
                    elif initial != "s":
                        put(new, end, (cost + 2 + (mark == "truncated"), audit + "R", [*left, (name[initial], text)]))
        ways = new
    return min((w for s, w in inserted(ways).items() if s in (0, 3)), key=lambda w: w[:2])


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS).repartition(4)


def run(spark, rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, lines)}"""
    found = repair.repair(frame(spark, rows) if rows else frame(spark, [(1, 1, "user", "x")]).limit(0))
    lines = {}
    for r in sorted(found.rows.collect(), key=lambda r: (r.stretch, r.place)):
        lines.setdefault(r.conv_id, []).append((r.role, r.text))
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, lines.get(r.conv_id, []))
            for r in found.conversations.collect()}


def said(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]


def expected(rows, solve=by_states):
    """The same from plain rows (turn, role, text) of one conversation."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: ((r[0] is not None, r[0] or 0), r[1], r[2][:32], said(*r[1:])))
    turns = {t for t, _, _ in rows if t is not None}
    marks = faults([r[1:] for r in rows])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, lines = solve([r[1:] for r in rows])
    return ((max(turns) - min(turns) + 1 - len(turns)) if turns else 0, marks.count("blank"), marks.count("duplicate"),
            marks.count("truncated"), illegal, cost, audit, lines)


ROLES, TEXTS = ("user", "assistant", "system", "tool"), ("Done.", "Well", "", " \n", "So?", "Yes! ")


def test_every_script_of_short_conversations(spark):
    rng = random.Random(2)
    rows, wanted = [], {}
    for conv in range(60):
        mine = [(t, rng.choice(ROLES), rng.choice(TEXTS) + str(rng.choice(("", ".")))) for t in range(rng.randint(1, 3))]
        rows += [(conv, *r) for r in mine]
        wanted[conv] = expected(mine, by_every_script)
        assert wanted[conv] == expected(mine)
    assert run(spark, rows) == wanted


@pytest.mark.parametrize("bits", [10, 2])
def test_long_ones_ties_and_nulls(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "STRETCH_BITS", bits)
    rng = random.Random(4)
    mine = {}
    for conv in [None, *range(40)]:
        n = rng.choice((1, 2, 7, 30, 200)) if conv != 7 else 3_000
        mine[conv] = [(rng.choice((None, t, t, t, t + 3, t - 1)), rng.choice((*ROLES, None, "")),
                       rng.choice((*TEXTS, None, f"Number {rng.randint(0, 20)}.", f"No {t}", "z" * 40 + f"{t}.")))
                      for t in range(n)]
    mine[100] = [(1, "user", "Same.")] * 500 + [(2, "assistant", "Same.")] * 3
    mine[101] = [(i, "user", "") for i in range(50)]
    mine[102] = [(i, ("user", "assistant")[i % 2], f"Line {i}.") for i in range(400)]
    mine[103] = [(None, "system", "Be brief.")]
    # rows of one turn and role are in order of their first characters, then of a digest
    got = run(spark, [(c, *r) for c, rows in mine.items() for r in rows])
    assert got.keys() == mine.keys()
    for conv, rows in mine.items():
        assert got[conv] == expected(rows), conv


def test_no_rows(spark):
    assert run(spark, []) == {}


def test_grammar_shares_rules():
    rng = random.Random(1)
    sequences = [[rng.choice((1, 4, 0, 3)) for _ in range(rng.randint(1, 60))] for _ in range(200)] + [[3, 6] * 300, [2] * 77]
    grammar = repair_grammar.Grammar()
    short = grammar.compress([list(s) for s in sequences])
    rules = {new: pair for pair, new in grammar.rules.items()}

    def spelt(symbol):
        return [symbol] if symbol not in rules else spelt(rules[symbol][0]) + spelt(rules[symbol][1])

    assert [[t for s in q for t in spelt(s)] for q in short] == sequences
    assert sum(map(len, short)) < sum(map(len, sequences)) / 2
    assert max(map(len, short[-2:])) <= 8
    pairs = [p for q in short for p in itertools.pairwise(q) if p[0] != p[1]]
    assert len(pairs) == len(set(pairs))
    for sequence, matrix in zip(sequences, grammar.solve(sequences), strict=True):
        plain = repair_grammar.row_matrix(sequence[0])
        for symbol in sequence[1:]:
            plain = repair_grammar.product(plain, repair_grammar.row_matrix(symbol))
        assert [e and (e[0], repair_grammar.letters(e[1])) for e in matrix] == [
            e and (e[0], repair_grammar.letters(e[1])) for e in plain]


def test_damage_and_digest(spark):
    rows = [(c, t, r, x) for c in range(30) for t, (r, x) in enumerate(
        [("system", "Rules."), ("user", f"Why {c}?"), ("assistant", "Because. So!"), ("user", "Ah."), ("assistant", None)])]
    rows += [(None, None, None, None), (500, None, "user", "Hm."), (501, 4, "user", "A." * 9)]
    got = {r.conv_id: r for r in repair.digest(
        frame(spark, rows).select("conv_id"), repair.repair(repair.damaged(frame(spark, rows)))).collect()}
    mine = {}
    for c, t, r, x in rows:
        draw = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        kept = mine.setdefault(c, [])
        if draw:
            x = "" if draw == 1 else re.sub("[.!?]", "", x) if draw == 2 else x
            kept += [(t, "user" if draw == 4 else r, x)] * (2 if draw == 3 else 1)
    assert got.keys() == mine.keys()
    for conv, rows in mine.items():
        want = expected(rows) if rows else (0, 0, 0, 0, 0, 0, "", [])
        text = "\n".join(f"{r}:{x}" for r, x in want[-1])
        r = got[conv]
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == want[:-1]
        assert r.repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_null_and_empty_roles_are_others(spark):
    assert run(spark, [(1, 0, None, "A."), (1, 1, "", "B.")])[1][4:7] == (1, 4, "RR")

"""Conversation repair against brute force: every state after every row, by plain recursion."""

import hashlib
import random
import re
import zlib
from functools import cache
from itertools import product

import numpy as np
import pytest

from skillmill.llm import conversation_repair as cr
from skillmill.llm import queries
from skillmill.llm.common import ship, table

SF = "/root/testdata/sf0.001"
WHITE = " \t\n\x0b\x0c\r"


def damage(rows):
    """(turn, role, text) rows of one conversation after damage, in order."""
    out = []
    for conv, turn, role, text in rows:
        said = [" " if x is None else str(x) for x in (conv, turn, role, text)]
        lot = zlib.crc32(f"{said[0]}:{said[1]}".encode()) % 20
        role, text = said[2], said[3]
        if lot == 4:
            role = "user"
        if lot == 1:
            text = ""
        if lot == 2:
            text = re.sub("[.!?]", "", text)
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(lot, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))


def marks(rows):
    seen, out = set(), []
    for _, role, text in rows:
        left = text.strip(WHITE)
        out.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    found = marks(rows)
    fits = re.compile("(s?(ua)+)?")
    partial = re.compile("s?(ua)*u?")

    @cache
    def best(i, past):
        """(cost, audit, lines) from row i on, after the initials ``past`` (cut to what matters)."""
        ways = [(0, "", ())] if i == len(rows) and fits.fullmatch(past) else []

        def go(cost, letter, line, initials, at):
            if partial.fullmatch(initials) and len(initials) <= len(past) + 1:
                rest = best(at, initials if len(initials) < 4 else initials[:1].replace("a", "") + initials[-2:] if initials[0] == "s" else initials[-2:])
                ways.append((cost + rest[0], letter + rest[1], line + rest[2]))

        for role in ("user", "assistant"):
            # Never two rows missing more than the grammar can call for.
            if inserted[0] < 3:
                inserted[0] += 1
                go(5, "I", (f"{role}:",), past + role[0], i)
                inserted[0] -= 1
        if i < len(rows):
            _, role, text = rows[i]
            go(2, "D", (), past, i + 1)
            if found[i] in ("", "truncated"):
                extra = 5 if found[i] else 0
                go(extra, "K", (f"{role}:{text}",), past + (role[:1] or "?"), i + 1)
                for other in ("user", "assistant"):
                    go(extra + 1, "R", (f"{other}:{text}",), past + other[0], i + 1)
        return min(ways, default=(10**9, "", ()))

    inserted = [0]
    return best(0, "")


def simple(rows):
    """(cost, audit, lines): states walked from the last row back, by the rules as they are written."""
    found, roles = marks(rows), {"u": "user", "a": "assistant"}
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def with_inserts(ways):
        for _ in range(3):
            for state, initial in product(("", "s", "u", "a"), "ua"):
                if (state, initial) in after and after[state, initial] in ways:
                    cost, audit, lines = ways[after[state, initial]]
                    new = (cost + 5, "I" + audit, (f"{roles[initial]}:", *lines))
                    ways[state] = min(ways.get(state, new), new)
        return ways

    ways = with_inserts({"": (0, "", ()), "a": (0, "", ())})
    for (_, role, text), mark in zip(rows[::-1], found[::-1], strict=True):
        now = {}
        for state in ("", "s", "u", "a"):
            cost, audit, lines = ways[state]
            options = [(cost + 2, "D" + audit, lines)]
            if mark in ("", "truncated"):
                extra = 5 if mark else 0
                for letter, name, price in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if (state, name[:1]) in after:
                        cost, audit, lines = ways[after[state, name[:1]]]
                        options.append((cost + price + extra, letter + audit, (f"{name}:{text}", *lines)))
            now[state] = min(options)
        ways = with_inserts(now)
    return ways[""]


def result(conv, rows, walk=simple):
    rows = damage(rows)
    found, turns = marks(rows), {t for t, *_ in rows if t is not None}
    cost, audit, lines = walk(rows)
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return (
        conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(found.count(x) for x in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


def expected(rows, walk=simple):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    return sorted((result(c, held, walk) for c, held in convs.items()), key=str)


def got(frame):
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((tuple(r) for r in frame.select(names).collect()), key=str)


def made(draw, conv, n):
    roles = ["user", "assistant", "system", "tool", "", None, "u", "admin"]
    texts = ["Yes.", "Why?", "no", "  ", "", None, "Go on!", "well ", "a.\n", "é", "x" * 300 + "."]
    turns = [draw.choice([None, *range(n)]) if draw.random() < 0.3 else i for i in range(n)]
    return [(conv, t, draw.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], draw.choice(texts)) for t in turns]


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op12_prefix_doubling"](spark, SF)) == expected(rows)


def test_the_walk_is_that_of_all_edits():
    draw = random.Random(11)
    for conv in range(150):
        rows = damage(made(draw, conv, draw.randint(0, 5)))
        assert simple(rows)[:2] == brute(rows)[:2], rows


def test_many_short_and_odd_conversations(spark):
    draw = random.Random(1)
    rows = [r for conv in [*range(400), None, -5] for r in made(draw, conv, draw.randint(1, 9))]
    frame = ship(spark).createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, seg string")
    assert got(cr.damage_and_repair(frame)) == expected(rows)
    assert got(cr.damage_and_repair(frame.limit(0))) == []


@pytest.mark.parametrize("most", [3, 1_000])
def test_a_conversation_over_many_tasks_and_segments(spark, most):
    draw = random.Random(most)
    rows = made(draw, 7, 500) + [r for conv in range(60) for r in made(draw, conv + 10, draw.randint(1, 20))]
    rows += [(8, None, "user", "same")] * 150  # one turn, all alike
    frame = ship(spark).createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert got(cr.repair(cr.damaged(frame), most)) == expected(rows)


def test_ranks_by_doubled_lengths():
    # Audits "b a", "a" and "a b": nodes 0 -> 1 -> end, 2 -> end, 3 -> 4 -> end.
    first = np.array([2, 1, 1, 1, 2, 0])
    rank, pointers, length = cr.ranked(first, np.array([1, 5, 5, 4, 5, 5]))
    assert length.tolist() == [2, 1, 1, 2, 1, 0]
    assert rank[1] == rank[2] < rank[3] < rank[4] < rank[0] and rank[5] == 0
    assert pointers[-1].tolist().count(5) >= 4

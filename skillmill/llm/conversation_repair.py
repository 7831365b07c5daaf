"""Cheapest repair of the role order of conversations, with the least audit.

Each row is kept, given another role or deleted, and empty rows may be inserted, so that the initials
of the roles read ``(s?(ua)+)?``.  Nodes are (row, state): nothing yet, after ``s``, after ``u``, after
``a``.  The cost of the best end of every node follows from the last row back; arcs that keep to it are optimal
and carry the initial of their edit.

The least audit.  Optimal-arc nodes are ranked by the first letter of their audits, then by the first two, four,
eight and so on: the rank by twice as many letters is that of the pair of the node's rank and the rank of the node
that its doubled pointer leads to.  The state fixes the role of an inserted or rerolled row, so the arcs of a node carry
different letters and the rank of the first letter selects among them; the doubled pointers then give the node after
any number of letters, all at once.

Hot conversations.  Rows are dealt by ranges of (conversation, turn, ...), so a conversation that holds a third of all
rows lies in many tasks, in order.  Conversations that lie within one task and are not its first or last are
repaired there.  The others are cut into segments of bounded length: a segment is a matrix of costs from state to state; the costs
of the best end behind each segment follow from the matrices, the state in which each is entered from the optimal
arcs, and then every segment is repaired alone.  Only the digest of one conversation's repaired text, which has to read it
in order, streams through one task.

Defined results: null roles and texts are one blank; nulls of turn come first; rows of the same turn are ordered by role, by the
first 256 characters of the text and a hash of it; rows alike in all of these are interchangeable.  Rows of a null
conversation are one conversation.  A conversation of which no row is left has zeros and an empty audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skillmill.llm.common import partitions, stored

#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Letters of the edits in their order, and what a row says: initial (s, u, a, other) * 4 + fault.
LETTERS = "DIKR"
OK, BLANK, DUPLICATE, CUT = range(4)
#: States: nothing, s, u, a; the state after a user or assistant row that the state calls for.
NEXT = (2, 2, 3, 2)
AFTER = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}  # (state, initial): state
ENDS = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 40
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Rows of a segment at most, and rows repaired at once.
SEGMENT, AT_ONCE = 65_536, 20_000
SPACE = " \t\n\x0b\x0c\r"

RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
ROW = f"kind string, conv_id long, seg long, at long, turn long, code int, copies long, digest binary, role string, text string, {RESULT}"
ROW_NAMES = [x.split()[0] for x in ROW.split(", ")]
RESULT_NAMES = ["conv_id", *[x.split()[0] for x in RESULT.split(", ")]]
_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


class Steps:
    """What a row does to the costs behind it, remembered by (costs less their least, code)."""

    def __init__(self):
        self.vectors: dict[tuple[int, ...], int] = {}
        self.values: list[tuple[int, ...]] = []
        self.known: dict[tuple[int, int], tuple[int, int, int]] = {}
        #: Per record, state and letter: rows and states the optimal arc goes on, or -1.
        self.arcs: list[np.ndarray] = []

    def vector(self, costs) -> tuple[int, int]:
        least = min(costs)
        key = tuple(min(c - least, NEVER) for c in costs)
        if key not in self.vectors:
            self.vectors[key] = len(self.values)
            self.values.append(key)
        return self.vectors[key], least

    def step(self, behind: int, code: int) -> tuple[int, int, int]:
        """(number of the costs before the row, what all of them exceed it by, record of the arcs)."""
        if (behind, code) not in self.known:
            after = self.values[behind]
            initial, fault = divmod(code, 4)
            extra = TRUNCATED if fault == CUT else 0
            base, ways = [], []
            for state in range(4):
                way = {0: DELETE + after[state]}
                if fault in (OK, CUT):
                    way[3] = REROLE + extra + after[NEXT[state]]
                    if (state, initial) in AFTER:
                        way[2] = extra + after[AFTER[state, initial]]
                base.append(min(way.values()))
                ways.append(way)
            costs = []
            for state in range(4):
                one, two = NEXT[state], NEXT[NEXT[state]]
                costs.append(min(base[state], INSERT + base[one], 2 * INSERT + base[two]))
            arcs = np.full((4, 4), -1, dtype=np.int64)
            for state in range(4):
                ways[state][1] = INSERT + costs[NEXT[state]]
                for letter, cost in ways[state].items():
                    if cost == costs[state]:
                        to = (state, NEXT[state], AFTER.get((state, initial), 0), NEXT[state])[letter]
                        arcs[state, letter] = to if letter == 1 else 4 + to
            number, least = self.vector(costs)
            self.arcs.append(arcs)
            self.known[behind, code] = number, least, len(self.arcs) - 1
        return self.known[behind, code]

    def back(self, codes: bytes, behind) -> tuple[list[int], list[int]]:
        """(costs before the first row, record of each row)."""
        number, total = self.vector(behind)
        records = []
        for code in reversed(codes):
            number, more, record = self.step(number, code)
            total += more
            records.append(record)
        return [min(c + total, NEVER) for c in self.values[number]], records[::-1]

    def matrix(self, codes: bytes) -> list[int]:
        """Least costs from each state (row) to each state (column)."""
        columns = [self.back(codes, [0 if s == t else NEVER for s in range(4)])[0] for t in range(4)]
        return [columns[t][s] for s in range(4) for t in range(4)]


#: The arcs at the end of a conversation: after s and u rows are missing.
_LAST = np.full((4, 4), -1, dtype=np.int64)
_LAST[1, 1], _LAST[2, 1] = NEXT[1], NEXT[2]
_STEPS = Steps()


def ranked(first: np.ndarray, pointer: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(ranks by whole audits, pointers over 1, 2, 4, ... letters, letters of each audit).

    ``first`` ranks nodes by one letter, 0 where the audit has ended; ends point to themselves.
    """
    rank, length, pointers = first, (first > 0).astype(np.int64), [pointer]
    while True:
        jump = pointers[-1]
        # The rank by twice as many letters, made dense.
        _, doubled = np.unique(rank * (int(rank.max(initial=0)) + 1) + rank[jump], return_inverse=True)
        rank, length = doubled.reshape(-1), length + length[jump]
        if not first[jump].any():
            return rank, pointers, length
        pointers.append(jump[jump])


def repaired(items: list[tuple[bytes, tuple | None, int | None]]) -> list[tuple[int, bytes, np.ndarray, int]]:
    """(cost of the best end, letters, states, last state) of each (codes, costs behind or None at the true end, state entered).

    Letters are numbers into ``LETTERS``; the states are those before each edit.
    """
    costs, begins, records, groups = [], [], [], 0
    for codes, behind, _ in items:
        before, found = _STEPS.back(codes, ENDS if behind is None else behind)
        costs.append(before)
        begins.append(groups)
        records += [*found, -1 if behind is None else -2]
        groups += len(codes) + 1
    number = np.array(records, dtype=np.int64)
    # The last two tables, -2 and -1, are those of the end of a segment and of a conversation.
    arcs = np.stack([*_STEPS.arcs, np.full((4, 4), -1), _LAST])[number].reshape(groups * 4, 4)
    has = arcs >= 0
    ended = ~has.any(1)
    # Arcs of a node carry different letters, so the rank of the first letter selects one of them.
    letter = np.where(ended, 0, has.argmax(1))
    node = np.arange(groups * 4)
    pointer = np.where(ended, node, node // 4 * 4 + arcs[node, letter]).astype(np.int32)
    _, pointers, length = ranked(np.where(ended, 0, letter + 1), pointer)
    start = np.array([4 * b + (e or 0) for b, (_, _, e) in zip(begins, items, strict=True)], dtype=np.int64)
    steps = length[start]
    first = np.cumsum(steps) - steps
    at = np.repeat(start, steps)
    step = np.arange(len(at)) - np.repeat(first, steps)
    for k, jump in enumerate(pointers):
        at = np.where(step >> k & 1, jump[at], at)
    last = start.copy()
    for k, jump in enumerate(pointers):
        last = np.where(steps >> k & 1, jump[last], last)
    out = []
    for i in range(len(items)):
        way = at[first[i] : first[i] + steps[i]]
        out.append((costs[i][items[i][2] or 0], letter[way].astype(np.uint8).tobytes(), way % 4, int(last[i] % 4)))
    return out


def lines(letters: bytes, states: np.ndarray, rows: list[tuple[str, str]]) -> list[str]:
    """The repaired rows as ``role:text``."""
    out, i = [], 0
    for letter, state in zip(letters, states.tolist(), strict=True):
        if letter == 1:
            out.append("assistant:" if state == 2 else "user:")
            continue
        role, text = rows[i]
        i += 1
        if letter == 2:
            out.append(f"{role}:{text}")
        elif letter == 3:
            out.append(f"{'assistant' if state == 2 else 'user'}:{text}")
    return out


def audit(letters: bytes) -> str:
    return letters.translate(bytes.maketrans(bytes(range(4)), LETTERS.encode())).decode()


def fault(text: str) -> int:
    seen = text.rstrip(SPACE)
    return BLANK if not seen else OK if seen[-1] in ".!?" else CUT


def initial(role: str) -> int:
    at = "sua".find(role[:1]) if role else -1
    return at if at >= 0 else 3


def illegal(codes: bytes) -> int:
    return sum((a >> 2, b >> 2) not in LEGAL for a, b in zip(codes, codes[1:]))


def faults(codes: bytes) -> list[int]:
    return [sum(c & 3 == f for c in codes) for f in (BLANK, DUPLICATE, CUT)]


def whole(conversations: list[tuple[int | None, list[tuple]]]) -> Iterator[tuple]:
    """Results of conversations given as rows (turn, role, text, copies)."""
    items, held = [], []
    for conv, rows in conversations:
        codes, spread, turns, seen = bytearray(), [], set(), set()
        for turn, role, text, copies in rows:
            for _ in range(copies):
                found = fault(text)
                if found != BLANK and (role, text) in seen:
                    found = DUPLICATE
                seen.add((role, text))
                codes.append(initial(role) * 4 + found)
                spread.append((role, text))
                if turn is not None:
                    turns.add(turn)
        items.append((bytes(codes), None, 0))
        held.append((conv, spread, max(turns) - min(turns) + 1 - len(turns) if turns else 0))
    for (conv, spread, gaps), (codes, *_), (cost, letters, states, _) in zip(held, items, repaired(items), strict=True):
        text = "\n".join(lines(letters, states, spread))
        yield conv, gaps, *faults(codes), illegal(codes), cost, audit(letters), hashlib.sha256(text.encode()).hexdigest()


def first_pass(most: int):
    """Repairs the conversations that lie within a task; rows of the others are numbered and go on, ``most`` to a segment."""

    def out(rows: list[dict]) -> pa.RecordBatch:
        kinds = {x.split()[0]: _KINDS[x.split()[1]] for x in ROW.split(", ")}
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], kinds[c]) for c in ROW_NAMES], ROW_NAMES)

    def done(conversations):
        return out([{"kind": "done", **dict(zip(RESULT_NAMES, r, strict=True))} for r in whole(conversations)])

    def opened(conv, rows, part, piece):
        seen, held = set(), []
        for at, (turn, role, text, copies) in enumerate(rows):
            found, digest = fault(text), None
            if copies and found != BLANK:
                digest = xxhash.xxh3_128_digest(f"{len(role)} {role}{text}".encode())
                if digest in seen:
                    found, digest = DUPLICATE, None
                else:
                    seen.add(digest)
            held.append({
                "kind": "open", "conv_id": conv, "seg": (part << 31) + piece, "at": at, "turn": turn, "code": initial(role) * 4 + found,
                "copies": copies, "digest": digest, "role": role, "text": text,
            })
        return out(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        ready, size, none = [], 0, object()
        current, rows, piece, number = none, [], 0, 0
        for batch in batches:
            held = batch.to_pydict()
            for conv, *row in zip(*[held[c] for c in ("conv_id", "turn", "role", "text", "copies")], strict=True):
                if conv != current:
                    if current is not none:
                        if number == 0 or piece:
                            yield opened(current, rows, part, piece)
                        else:
                            ready.append((current, rows))
                            size += len(rows)
                        number += 1
                    current, rows, piece = conv, [], 0
                    if size >= AT_ONCE:
                        yield done(ready)
                        ready, size = [], 0
                rows.append(tuple(row))
                if len(rows) >= most:
                    yield opened(current, rows, part, piece)
                    rows, piece = [], piece + 1
        if current is not none and rows:
            yield opened(current, rows, part, piece)
        if ready:
            yield done(ready)

    return run


def segment(rows: pd.DataFrame) -> pd.DataFrame:
    """One row for a segment: its codes, costs from state to state, and its turns."""
    rows = rows.sort_values("at")
    left = rows[rows["copies"] > 0]
    codes = bytearray()
    for code, copies in zip(left["code"].tolist(), left["copies"].tolist(), strict=True):
        again = code if code & 3 == BLANK else code & 12 | DUPLICATE
        codes += bytes([code] + [again] * (copies - 1))
    turns = [int(t) for t in left["turn"] if t is not None]
    one = rows.iloc[0]
    return pd.DataFrame([{
        "conv_key": one["conv_key"], "conv_id": one["conv_id"], "seg": one["seg"], "codes": bytes(codes), "costs": _STEPS.matrix(bytes(codes)),
        "low": min(turns, default=None), "high": max(turns, default=None), "n_turns": len(set(turns)),
    }])


def costs_behind(rows: pd.DataFrame) -> pd.DataFrame:
    """Costs of the best end behind each segment of a conversation; null behind the last."""
    rows = rows.sort_values("seg")
    # Segments that are empty after the damage may lie at the end: the true end is behind the last one.
    behind, out = np.array(ENDS), []
    for costs in rows["costs"].tolist()[::-1]:
        out.append(behind.tolist())
        matrix = np.array(costs).reshape(4, 4)
        behind = np.minimum((matrix + behind).min(1), NEVER)
    return rows[["conv_key", "seg"]].assign(behind=out[::-1], last=[False] * (len(out) - 1) + [True])


def entered(rows: pd.DataFrame) -> pd.DataFrame:
    """The state in which each segment of a conversation is entered."""
    rows = rows.sort_values("seg")
    state, out = 0, []
    for exits in rows["exits"].tolist():
        out.append(state)
        state = int(exits[state])
    return rows[["conv_key", "seg"]].assign(entry=out)


def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pydict()
        out = []
        for codes, behind, last in zip(rows["codes"], rows["behind"], rows["last"], strict=True):
            out.append([0] * 4 if last else [r[3] for r in repaired([(codes, tuple(behind), s) for s in range(4)])])
        arrays = [batch.column("conv_key"), batch.column("seg"), pa.array(out, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["conv_key", "seg", "exits"])


PIECE = "conv_key string, conv_id long, seg long, codes binary, low long, high long, n_turns long, cost long, audit string, lines string, n_lines long"


def piece(plans: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
    """A repaired segment: letters and lines."""
    one = plans.iloc[0]
    behind = None if one["last"] else tuple(one["behind"])
    [(cost, letters, states, _)] = repaired([(bytes(one["codes"]), behind, int(one["entry"]))])
    rows = rows[rows["copies"] > 0].sort_values("at")
    spread = [(r, t) for r, t, n in zip(rows["role"], rows["text"], rows["copies"], strict=True) for _ in range(n)]
    text = lines(letters, states, spread)
    kept = one[["conv_key", "conv_id", "seg", "codes", "low", "high", "n_turns"]].to_dict()
    return pd.DataFrame([{**kept, "cost": cost, "audit": audit(letters), "lines": "\n".join(text), "n_lines": len(text)}])


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of conversations whose segments come in order."""

    def result(x):
        gaps = x["high"] - x["low"] + 1 - x["n_turns"] if x["low"] is not None else 0
        return x["conv_id"], gaps, *x["faults"], x["illegal"], x["cost"], "".join(x["audit"]), x["hash"].hexdigest()

    def out(rows):
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], RESULT_NAMES)

    now = None
    for batch in batches:
        ready = []
        for r in batch.to_pylist():
            if now is None or now["conv_key"] != r["conv_key"]:
                if now is not None:
                    ready.append(result(now))
                now = {
                    "conv_key": r["conv_key"], "conv_id": r["conv_id"], "low": None, "high": None, "n_turns": 0, "faults": [0, 0, 0], "illegal": 0,
                    "cost": r["cost"], "audit": [], "hash": hashlib.sha256(), "lines": 0, "tail": b"",
                }
            if r["low"] is not None:
                # Turns come in order, so only the one at the border can be in both segments.
                now["n_turns"] += r["n_turns"] - (now["high"] == r["low"])
                now["low"], now["high"] = r["low"] if now["low"] is None else now["low"], r["high"]
            codes = r["codes"]
            now["faults"] = [a + b for a, b in zip(now["faults"], faults(codes), strict=True)]
            now["illegal"] += illegal(now["tail"] + codes)
            now["tail"] = codes[-1:] or now["tail"]
            now["audit"].append(r["audit"])
            if r["n_lines"]:
                now["hash"].update((("\n" if now["lines"] else "") + r["lines"]).encode())
                now["lines"] += r["n_lines"]
        if ready:
            yield out(ready)
    if now is not None:
        yield out([result(now)])


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by a hash of conversation and turn; ``copies`` is 0 where a row is dropped."""

    def said(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    lot = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), said("role").alias("role"), said("text").alias("text"),
        lot.alias("lot"),
    )
    text = F.when(F.col("lot").isin(0, 1), "").when(F.col("lot") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id", "turn",
        F.when(F.col("lot") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("lot") == 0, 0).when(F.col("lot") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def repair(rows: DataFrame, most: int = SEGMENT) -> DataFrame:
    """Results per conversation of rows (conv_id, turn, role, text, copies); rows of 0 copies only name their conversation.

    Segments hold at most ``most`` of these rows.
    """
    spark = rows.sparkSession
    ordered = rows.withColumn("head", F.substring("text", 1, 256)).withColumn("hash", F.xxhash64("text"))
    keys = ["conv_id", "turn", "role", "head", "hash"]
    # Rows alike in all keys may lie in several tasks, as they are interchangeable.
    dealt = ordered.withColumn("lot", F.xxhash64(F.monotonically_increasing_id()))
    ranges = dealt.repartitionByRange(partitions(spark), *keys, "lot").sortWithinPartitions(*keys).drop("head", "hash", "lot")
    found = stored(ranges.mapInArrow(first_pass(most), ROW), "first-pass")
    done = found.where("kind = 'done'").select(*RESULT_NAMES)

    conv_key = F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv_key")
    opened = found.where("kind = 'open'").select(conv_key, "conv_id", "seg", "at", "turn", "code", "copies", "digest", "role", "text")
    # Turns as text, as pandas has no whole numbers beside nulls.
    narrow = opened.drop("role", "text").withColumn("turn", F.col("turn").cast("string"))
    earlier = F.row_number().over(Window.partitionBy("conv_key", "digest").orderBy("seg")) > 1
    again = F.col("code").bitwiseAND(12) + F.lit(DUPLICATE)
    first = narrow.where("digest is not null").withColumn("code", F.when(earlier, again).otherwise(F.col("code")))
    known = first.unionByName(narrow.where("digest is null")).drop("digest")
    segments = stored(
        known.groupBy("conv_key", "seg").applyInPandas(
            segment, "conv_key string, conv_id long, seg long, codes binary, costs array<long>, low long, high long, n_turns long"
        ),
        "segments",
    )
    behind = segments.select("conv_key", "seg", "costs").groupBy("conv_key").applyInPandas(
        costs_behind, "conv_key string, seg long, behind array<long>, last boolean"
    )
    plans = stored(segments.drop("costs").join(behind, ["conv_key", "seg"]), "plans")
    left = plans.select("conv_key", "seg", "codes", "behind", "last").mapInArrow(exits, "conv_key string, seg long, exits array<long>")
    entries = left.groupBy("conv_key").applyInPandas(entered, "conv_key string, seg long, entry int")
    full = plans.join(entries, ["conv_key", "seg"])
    texts = opened.select("conv_key", "seg", "at", "role", "text", "copies")
    pieces = full.groupBy("conv_key", "seg").cogroup(texts.groupBy("conv_key", "seg")).applyInPandas(piece, PIECE)
    streamed = pieces.repartition(partitions(spark), "conv_key").sortWithinPartitions("conv_key", "seg")
    return done.unionByName(streamed.mapInArrow(gathered, f"conv_id long, {RESULT}"))


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation after :func:`damaged`."""
    return repair(damaged(conversations))

"""Edit-aware token counts.

A document is kept as its pre-tokens in a segment tree: leaves hold up to some pre-tokens
with their text, inner nodes the sums of characters and tokens below them.  An edit finds
its place by the sums, encodes anew from the last boundary that it cannot have moved until
the boundaries agree with the old ones again, and updates the sums above the leaves it
touched.  The rest of the text is not read again.

An edit replaces the characters ``start`` to ``stop`` of the text as the edits before it
left it.  Places beyond the text are taken as its end and a stop before the start as the start.

Defined results: a null text is empty; null edits or fields change nothing (a null
replacement is an empty one); a row without edits has its plain count.
"""

from __future__ import annotations

import base64
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillmill.llm.common import ChunkCoder, blocks

EDITS = "array<struct<start:long,stop:long,replacement:string>>"
#: Pre-tokens of a leaf when it is built.
LEAF = 32
#: Characters a match may look at beyond its end.
LOOK = 2
_COUNTERS: dict[tuple[str, str], "Counter"] = {}


class Counter:
    """Splits texts into pre-tokens and counts the tokens of each."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(entry): int(rank) for entry, rank in map(bytes.split, file)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.coder = ChunkCoder(self.counted, pattern, tuple)

    def counted(self, tokens: list[str]) -> list[tuple[str, int]]:
        encode = self.encoding.encode_ordinary
        return [(t, len(encode(t))) for t in tokens]

    def split(self, texts: list[str | None]) -> list[list[tuple[str, int]]]:
        """The pre-tokens of each text with their counts."""
        return [[x for piece in found for x in piece] for found in self.coder.encode(texts)]


def counter(path: str, pattern: str) -> Counter:
    if (path, pattern) not in _COUNTERS:
        _COUNTERS[path, pattern] = Counter(path, pattern)
    return _COUNTERS[path, pattern]


class TokenTree:
    """A document's pre-tokens under a segment tree of (characters, tokens)."""

    def __init__(self, tokens: list[tuple[str, int]], split: Callable):
        self.split = split
        self.leaves = [tokens[i : i + LEAF] for i in range(0, len(tokens), LEAF)] or [[]]
        self.base = 1
        while self.base < len(self.leaves):
            self.base *= 2
        self.chars, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        self.encoded = 0
        for i, leaf in enumerate(self.leaves):
            self.chars[self.base + i] = sum(len(t) for t, _ in leaf)
            self.tokens[self.base + i] = sum(n for _, n in leaf)
        for node in range(self.base - 1, 0, -1):
            self.sum(node)

    def sum(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def update(self, leaves: range) -> None:
        """New sums above some leaves."""
        for i in leaves:
            self.chars[self.base + i] = sum(len(t) for t, _ in self.leaves[i])
            self.tokens[self.base + i] = sum(n for _, n in self.leaves[i])
        low, high = self.base + leaves.start, self.base + leaves.stop - 1
        while low > 1:
            low, high = low // 2, high // 2
            for node in range(low, high + 1):
                self.sum(node)

    def find(self, place: int) -> tuple[int, int]:
        """(leaf that holds the character, where the leaf begins); the last leaf for the end."""
        node, begin = 1, 0
        while node < self.base:
            node *= 2
            if begin + self.chars[node] <= place:
                begin += self.chars[node]
                node += 1
        leaf = min(node - self.base, len(self.leaves) - 1)
        if node - self.base != leaf:
            begin = self.chars[1] - self.chars[self.base + leaf]
        return leaf, begin

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def text(self) -> str:
        return "".join(t for leaf in self.leaves for t, _ in leaf)

    def edit(self, start: int, stop: int, replacement: str) -> None:
        start = min(max(0, start), self.n_chars)
        stop = min(max(start, stop), self.n_chars)
        # Pre-tokens that end LOOK characters before the edit cannot change.
        first, begin = self.find(max(0, start - LOOK))
        while first and begin > start - LOOK:
            first -= 1
            begin -= self.chars[self.base + first]
        keep, at = 0, begin
        for token, _ in self.leaves[first]:
            if at + len(token) > start - LOOK:
                break
            at += len(token)
            keep += 1
        last, _ = self.find(stop)
        while True:
            old = [x for i in range(first, last + 1) for x in self.leaves[i]]
            text = "".join(t for t, _ in old[keep:])
            to_end = last == len(self.leaves) - 1
            new = text[: start - at] + replacement + text[stop - at :]
            moved = len(replacement) - (stop - start)
            bounds, place = {}, 0
            for i, (token, _) in enumerate(old[keep:]):
                bounds[place] = i
                place += len(token)
            found, place, resume = [], 0, None
            for match in self.split.pattern.finditer(new):
                # An old boundary behind the edit: from here on the matches are the old ones.
                if match.start() >= start - at + len(replacement) and match.start() - moved in bounds:
                    resume = bounds[match.start() - moved]
                    break
                if not to_end and match.end() > len(new) - LOOK:
                    place = None
                    break
                found.append(match.group())
                place = match.end()
            if resume is None and not to_end and place is not None and place <= len(new):
                place = None
            if place is None and resume is None:
                last = min(len(self.leaves) - 1, 2 * last - first + 1)
                continue
            break
        self.encoded += len(found)
        tail = old[keep + resume :] if resume is not None else []
        self.leaves[first] = old[:keep] + self.split.counted(found) + tail
        for i in range(first + 1, last + 1):
            self.leaves[i] = []
        self.update(range(first, last + 1))


def counts(docs: DataFrame, edits: Column, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_edits, n_tokens_after, n_chars_after, n_pre_tokens, n_encoded_again) of every row.

    ``edits`` is an array column of (start, stop, replacement), applied in order.
    """
    names = ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_pre_tokens", "n_encoded_again"]

    def run(batches):
        split = counter(path, pattern)
        for block in blocks(batches, 1_000_000):
            rows = []
            for doc, tokens, changes in zip(block["doc_id"], split.split(block["text"]), block["edits"], strict=True):
                tree = TokenTree(tokens, split)
                before, done = tree.n_tokens, 0
                for change in changes or []:
                    if change is not None and change["start"] is not None and change["stop"] is not None:
                        tree.edit(change["start"], change["stop"], change["replacement"] or "")
                        done += 1
                rows.append((doc, before, done, tree.n_tokens, tree.n_chars, len(tokens), tree.encoded))
            arrays = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    held = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), edits.cast(EDITS).alias("edits"))
    return held.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def with_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with the column ``edits``, gathered in order from rows (id, edit_no, start, stop, replacement)."""
    rows = edits.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.array_sort(F.collect_list(F.struct("edit_no", "start", "stop", "replacement"))).alias("__edits")
    )
    ordered = F.transform("__edits", lambda e: F.struct(e["start"].alias("start"), e["stop"].alias("stop"), e["replacement"].alias("replacement")))
    return docs.drop("edits").join(rows, id_col, "left").withColumn("edits", ordered).drop("__edits")

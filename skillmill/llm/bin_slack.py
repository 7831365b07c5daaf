"""Best-fit packing by minimum bin slack.

Each document's token ids are cut into pieces of the capacity; only its first piece may be
shorter.  A full piece is a sequence of its own.  How many pieces there are of each length
is a table of at most ``capacity`` numbers, and all that packing needs to know:

* a bin begins with the longest piece left; a subset-sum table over the lengths left,
  kept as bitsets, finds the fullest combination for the rest of it;
* the combination is taken as often as the numbers allow and removed, which leaves fewer
  lengths, so a few thousand combinations pack any number of pieces.

Pieces are then numbered within their length, in hash slices so that no task holds all
pieces of a common length, and the number says which bin and place a piece gets.

Defined results: null and empty texts have the end token alone; repeated rows are packed
each for itself.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillmill.llm.common import PATTERN, blocks, partitions, spelling, stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_ENCODERS: dict[str, "Encoder"] = {}


class Encoder:
    """Texts to the ids of a byte-level BPE file of the ``tokenizers`` library, as unsigned 32-bit integers.

    Where every merge makes a piece of a higher id than the merges before it, the ids are ranks, and
    ``tiktoken`` gives the same ids in a third of the time.  Texts that hold a special token, and other
    vocabularies, go through the library itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = self.by_rank(path)

    def by_rank(self, path: str):
        """The vocabulary for ``tiktoken``; None where its ids are no ranks."""
        import tiktoken

        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        with open(path, encoding="utf-8") as file:
            merges = json.load(file)["model"]["merges"]
        made = [vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        inverse = {c: b for b, c in enumerate(spelling())}
        single = [vocabulary.get(c) for c in inverse]
        if made != sorted(set(made)) or None in single or max(single) > min(made, default=len(vocabulary)):
            return None
        if len(vocabulary) - len(merges) - len(single) not in (0, len(self.special)):
            return None
        pieces = {x: i for x, i in vocabulary.items() if x not in self.special}
        ranks = {bytes(inverse[c] for c in x): i for x, i in pieces.items()}
        return tiktoken.Encoding("ids", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        return [self.ids(t) if t else b"" for t in texts]

    def ids(self, text: str) -> bytes:
        if self.ranked is None or any(s in text for s in self.special):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            found = self.ranked.encode_ordinary(text)
        return array("I", found).tobytes()


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of the pieces of a document's ids."""
    total = len(ids) // 4
    begin, piece = 0, 0
    while begin < total:
        end = begin + ((total - 1) % capacity + 1 if piece == 0 else capacity)
        yield piece, begin, end - begin, zlib.crc32(ids[4 * begin : 4 * end])
        begin, piece = end, piece + 1


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """The pieces of every document (doc_id, text)."""
    last = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        encode = encoder(vocabulary)
        for block in blocks(batches, 2_000_000):
            rows = []
            for doc, ids in zip(block["doc_id"], encode(block["text"]), strict=True):
                rows += [(doc, *p) for p in cut(ids + last, capacity)]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, [x.split()[0] for x in PIECES.split(", ")])

    return docs.mapInArrow(run, PIECES)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``room``, long ones preferred."""
    mask = (1 << (room + 1)) - 1
    lengths = [x for x in sorted(counts) if x <= room]
    steps, reach = [], 1
    for x in lengths:
        # All sums with up to `copies` of x: shifts by 1, 2, 4, ... copies.
        copies, part = min(counts[x], room // x), 1
        steps.append(reach)
        while copies > 0:
            take = min(part, copies)
            reach |= (reach << (take * x)) & mask
            copies -= take
            part *= 2
    at = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for x, before in zip(reversed(lengths), reversed(steps), strict=True):
        most = min(counts[x], at // x)
        for copies in range(most, -1, -1):
            if before >> (at - copies * x) & 1:
                if copies:
                    taken[x] = copies
                at -= copies * x
                break
    return taken


def combinations(histogram: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """(lengths of a bin, how many such bins) until every piece is packed."""
    left = {x: n for x, n in histogram.items() if n > 0}
    while left:
        longest = max(left)
        left[longest] -= 1
        chosen = fullest({x: n for x, n in left.items() if n}, capacity - longest)
        left[longest] += 1
        chosen[longest] = chosen.get(longest, 0) + 1
        times = min(left[x] // k for x, k in chosen.items())
        for x, k in chosen.items():
            left[x] -= times * k
            if not left[x]:
                del left[x]
        yield chosen, times


def places(histogram: dict[int, int], capacity: int) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Maps lengths and numbers within the length to sequence ids and offsets."""
    by: dict[int, list[tuple[int, int, int, int]]] = {x: [] for x in histogram}
    used = dict.fromkeys(histogram, 0)
    sequence = 0
    for chosen, times in combinations(histogram, capacity):
        offset = 0
        for x in sorted(chosen, reverse=True):
            by[x].append((used[x], times, sequence, offset))
            used[x] += times * chosen[x]
            offset += x * chosen[x]
        sequence += times
    tables = {x: np.array(v, dtype=np.int64) for x, v in by.items()}

    def place(length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ids, offsets = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for x in np.unique(length):
            rows = np.flatnonzero(length == x)
            table = tables[int(x)]
            found = table[np.searchsorted(table[:, 0], number[rows], side="right") - 1]
            within = number[rows] - found[:, 0]
            ids[rows] = found[:, 2] + within % found[:, 1]
            offsets[rows] = found[:, 3] + within // found[:, 1] * x
        return ids, offsets

    return place


def packed(docs: DataFrame, vocabulary: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    cut_ = stored(pieces(texts, vocabulary, capacity, end_id), "pieces")
    slices = 4 * partitions(spark)
    sliced = cut_.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(slices)))
    counts = stored(sliced.groupBy("length", "slice").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    place = places(histogram, capacity)
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    numbered = sliced.withColumn("own", F.row_number().over(own)).join(offsets, ["length", "slice"]).select(
        *[x.split()[0] for x in PIECES.split(", ")], (F.col("before") + F.col("own") - 1).alias("number")
    )

    def run(batches):
        for batch in batches:
            ids, at = place(*[batch.column(c).to_numpy() for c in ("length", "number")])
            names = [x.split()[0] for x in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(ids), pa.array(at)], [*names, "sequence_id", "offset"])

    return numbered.mapInArrow(run, f"{PIECES}, sequence_id long, offset long")

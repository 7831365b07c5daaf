"""Importance resampling towards a target distribution.

Features are the runs of one and two consecutive words, hashed into a fixed number of buckets.
Two counts over all rows, of the corpus and of the target texts, give each bucket a gain, the floored
thousandfold log ratio of its smoothed shares.  A document's weight is the floored mean
gain of its features, read from one array, and its score adds a Gumbel draw that follows from its
id alone; the highest scores are a sample without replacement by weight.

The order comes from a distributed radix sort, least significant digit first.  Every pass is a stable
counting sort: rows are counted by digit and block of positions, the counts become global
offsets (of the smaller digits, then of the blocks before), and offset and number within the block make a row's new
position.  No task holds more than a block of rows, and only the offsets of at most ``2 ** DIGIT``
digits meet in one place.  After the last pass the position is the rank.

Defined results: a null or empty text, or one without words, has no features and weight 0; a row without an id has no
score and is never drawn; rows that repeat an id are documents of their own, and where their scores are equal the one with fewer
features, then the lower weight, is first.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skillmill.llm.common import blocks, partitions, stored

BUCKETS = 10_000
#: Bits of a digit of the radix sort.
DIGIT = 12
#: Longest word whose bigrams are hashed by tables, and characters of the words a table keeps.
LONGEST, MOST = 48, 16_000_000

#: A to Z become small, everything of ASCII but letters and digits a blank.
_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def _shifts() -> np.ndarray:
    """``[n, k, v]``: what the checksum ``v << 8 * k`` becomes when ``n`` zero bytes follow."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
    now = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    out = [now]
    for _ in range(LONGEST + 1):
        now = (now >> np.uint32(8)) ^ byte[now & np.uint32(255)]
        out.append(now)
    return np.stack(out)


class Features:
    """Buckets of the one- and two-word features of texts."""

    def __init__(self, buckets: int, most: int = MOST):
        self.buckets, self.most, self.shifts = buckets, most, _shifts()
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, tuple[int, int, int]] = {}
        self.held = 0

    def rows(self, words: list[bytes]) -> np.ndarray:
        """(checksum, checksum behind a blank, length with the blank) of each word."""
        found = list(map(self.known.get, words))
        if None in found:
            made = {w: (zlib.crc32(w), zlib.crc32(b" " + w), len(w) + 1) for w, row in zip(words, found, strict=True) if row is None}
            found = [made[w] if row is None else row for w, row in zip(words, found, strict=True)]
            size = sum(map(len, made))
            if self.held + size > self.most:
                self.clear()
            if size <= self.most:
                self.known.update(made)
                self.held += size
        return np.array(found, dtype=np.uint32).reshape(-1, 3)

    def of(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words of each text, bucket of every word, bucket of every word pair); a pair that
        would join two texts has bucket -1."""
        words = [(t or "").encode("utf-8", "replace").translate(_WORDS).split() for t in texts]
        number = np.array([len(w) for w in words], dtype=np.int64)
        flat = list(chain.from_iterable(words))
        if not flat:
            return number, np.empty(0, np.int64), np.empty(0, np.int64)
        row = self.rows(flat)
        first, second, length = row[:-1, 0], row[1:, 1], row[1:, 2]
        short = np.minimum(length, LONGEST + 1)
        pair = second.copy()
        for k in range(4):
            pair ^= self.shifts[short, k, (first >> np.uint32(8 * k)) & np.uint32(255)]
        for i in np.flatnonzero(length > LONGEST + 1):
            pair[i] = zlib.crc32(b" " + flat[i + 1], int(first[i]))
        pairs = (pair % self.buckets).astype(np.int64)
        ends = np.cumsum(number)[:-1]
        pairs[ends[(ends > 0) & (ends < len(flat))] - 1] = -1
        return number, (row[:, 0] % self.buckets).astype(np.int64), pairs


_FEATURES: dict[int, Features] = {}


def features(buckets: int) -> Features:
    if buckets not in _FEATURES:
        _FEATURES[buckets] = Features(buckets)
    return _FEATURES[buckets]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all features of the column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, dtype=np.int64)
        for block in blocks(batches):
            _, ones, twos = features(buckets).of(block["text"])
            held += np.bincount(ones, minlength=buckets) + np.bincount(twos[twos >= 0], minlength=buckets)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(held[at])], ["bucket", "n"])

    return texts.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandfold log ratio of the smoothed shares of each bucket."""
    k, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + k) / ((s + 1) * (t_all + k)))) for s, t in pairs], dtype=np.int64)


def draw(seed: int, doc: int) -> int:
    """A thousandfold Gumbel draw, floored, that follows from the id."""
    h = int(hashlib.sha256(f"{seed}:{doc}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        padded = np.append(gain, 0)  # bucket -1
        for block in blocks(batches):
            ids = block["doc_id"]
            words, ones, twos = features(len(gain)).of(block["text"])
            upto = [np.concatenate([[0], np.cumsum(padded[x])]) for x in (ones, np.append(twos, -1)[: len(ones)])]
            end = np.cumsum(words)
            total = sum(u[end] - u[end - words] for u in upto)
            number = words + np.maximum(words - 1, 0)
            weight = np.where(number > 0, total // np.maximum(number, 1), 0)
            score = [None if d is None else int(w) + draw(seed, d) for d, w in zip(ids, weight, strict=True)]
            columns = [ids, words, number, weight, score]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "n_words", "n_features", "weight", "score"]
            )

    return docs.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def counting_pass(rows: DataFrame, digit: Column, block: Column) -> DataFrame:
    """``rows`` with the positions ``pos`` of a stable sort by ``digit``."""
    dealt = rows.withColumn("digit", digit).withColumn("block", block)
    counts = dealt.groupBy("digit", "block").agg(F.count("*").alias("n"))
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))
    smaller = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    first = totals.select("digit", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("first"))
    before = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(first, "digit").select(
        "digit", "block", (F.col("first") + F.col("before")).alias("offset")
    )
    own = Window.partitionBy("digit", "block").orderBy("pos")
    numbered = dealt.withColumn("own", F.row_number().over(own)).join(offsets, ["digit", "block"])
    return numbered.withColumn("pos", F.col("offset") + F.col("own") - 1).select(*rows.columns)


def radix_sorted(rows: DataFrame, keys: list[tuple[str, bool]], ties: list[str], bits: int = DIGIT) -> tuple[DataFrame, int]:
    """(``rows`` with the column ``pos``, their place from 0 by ``keys``, and their number).

    ``keys`` are (column of whole numbers without nulls, whether the largest is first), the most significant
    first.  The last key and ``ties`` order rows that agree in all keys.
    """
    spark = rows.sparkSession
    last = keys[-1][0]
    begun = rows.repartition(partitions(spark), last).sortWithinPartitions(last, *ties)
    held = stored(begun.withColumn("pos", F.monotonically_increasing_id()), "radix")
    limits = held.agg(
        F.count("*").alias("n"),
        *[f(k).alias(f"{name}{i}") for i, (k, _) in enumerate(keys) for name, f in (("lo", F.min), ("hi", F.max))],
    ).first()
    if not limits["n"]:
        return held, 0
    # The first positions carry the partition in their upper bits; later ones are dense.
    block = F.shiftright("pos", 33)
    size = -(-limits["n"] // (4 * partitions(spark)))
    for i, (key, largest_first) in reversed(list(enumerate(keys))):
        lo, hi = limits[f"lo{i}"], limits[f"hi{i}"]
        if hi - lo < 1 << 63:
            value, width = F.lit(hi) - F.col(key) if largest_first else F.col(key) - F.lit(lo), (hi - lo).bit_length()
        else:
            sign = -(1 << 63)
            value, width = F.col(key).bitwiseXOR(F.lit(~sign if largest_first else sign)), 64
        for shift in range(0, width, bits):
            digit = F.shiftrightunsigned(value, shift).bitwiseAND((1 << bits) - 1)
            held = stored(counting_pass(held, digit, block), "radix")
            block = F.expr(f"pos div {size}")
    if all(limits[f"lo{i}"] == limits[f"hi{i}"] for i in range(len(keys))):
        held = stored(counting_pass(held, F.lit(0), block), "radix")
    return held, limits["n"]


def resampled(
    docs: DataFrame, target: DataFrame, seed: int = 7, percent: int = 25, least_words: int = 20, buckets: int = BUCKETS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per row; ``rank`` counts the drawn ones from 1.

    ``target`` has a column ``text``.  Of the documents with an id and ``least_words`` words or more, ``percent`` of a hundred are drawn.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    sides = []
    for side in (texts, target):
        held = np.zeros(buckets, dtype=np.int64)
        # One row a bucket, whatever the rows of the tables.
        for row in bucket_counts(side, buckets).collect():
            held[row.bucket] = row.n
        sides.append(held)
    found = stored(scored(texts, gains(*sides), seed), "scored")
    fit = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    columns = ["doc_id", "n_features", "weight", "score"]
    order, n = radix_sorted(found.where(fit).select(*columns), [("score", True), ("doc_id", False)], ["n_features", "weight"])
    drawn = order.select(*columns, F.when(F.col("pos") < n * percent // 100, F.col("pos") + 1).alias("rank"))
    others = found.where(~F.coalesce(fit, F.lit(False))).select(*columns, F.lit(None).cast("long").alias("rank"))
    return drawn.unionByName(others)

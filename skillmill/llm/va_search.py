"""Exact top-k search with a vector-approximation file.

Components are whole numbers, floor(scale * x).  Each is also kept as a cell number of a few
bits on a grid over its dimension; that is the approximation file.  A query scans the
cells only: a vector's inner product lies within a margin, fixed by the query, of that of its
cell's centre.

The file is scanned twice, and exact vectors are read after each scan: first the most
promising vectors of a query, whose scores leave fewer of the others; then all whose upper
bound reaches the k-th exact score.  What has a lower one cannot be in the result, so the
result is certain.

A scan deals the file into slices and the queries into groups; each pair of them is one part,
whose blocks meet in one task.  Nothing of the file, the queries or the pairs is broadcast.

Defined results: rows with a null id or vector or a null or non-finite component take no
part; zero and empty vectors do; a vector shorter than another has zeros there; equal
vectors are searched once.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import groupby
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skillmill.llm.common import stored
from skillmill.llm.vectors import BLOCK, common_width, different, expanded, matrix, unpacked, usable

#: Bytes of a group of queries, which a task holds, and of a slice, which passes by.
MOST_ASKED, MOST_FILE = 16_000_000, 64_000_000
PAIR = "q1 long, q2 long, k1 long, k2 long"


def grid(vectors: DataFrame, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(least value, width of a cell) of every dimension, over all vectors."""
    rows = vectors.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.min("x").alias("least"), F.max("x").alias("most")).orderBy("d").collect()
    least, most = np.array([r.least for r in rows]), np.array([r.most for r in rows])
    width = np.ceil((most - least + 1) / (1 << bits)) if rows else np.array([])
    # Short vectors have zeros in the dimensions they lack.
    return np.minimum(least, 0.0), np.maximum(width, np.ceil((np.maximum(most, 0.0) - np.minimum(least, 0.0) + 1) / (1 << bits)))


def cells(least: np.ndarray, width: np.ndarray, kind: type) -> Callable[[np.ndarray], np.ndarray]:
    """The approximation file's rows: a cell number per component."""

    def convert(x: np.ndarray) -> np.ndarray:
        n = x.shape[1]
        full = np.zeros((len(x), len(least)))
        full[:, :n] = x
        return ((full - least) // width).astype(kind)

    return convert


def cuts(vectors: int, queries: int, vector_bytes: int, query_bytes: int, parts: int) -> tuple[int, int]:
    """(slices, groups): about ``parts`` pairs of them where there are blocks for so many, dealt so that few bytes are copied."""
    file, asked = vectors * vector_bytes, queries * query_bytes
    slices = math.ceil(math.sqrt(parts * file / max(1, asked)))
    slices = max(1, math.ceil(file / MOST_FILE), min(slices, math.ceil(vectors / BLOCK)))
    return slices, max(1, math.ceil(asked / MOST_ASKED), min(math.ceil(parts / slices), math.ceil(queries / BLOCK)))


def dealt(rows: DataFrame, deal: str, n: int, convert: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Rows (k1, k2, v, kth) as blocks (``deal``, x_keys, x_vectors, kth), packed where they lie and dealt out in turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        turn = None

        def out() -> pa.RecordBatch:
            values = matrix([r[2] for r in held])
            values = convert(values) if convert else values
            packed = np.array([r[:2] for r in held], dtype=np.int64), values, np.array([r[3] for r in held])
            columns = [pa.array([turn % n], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in packed]]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, [deal, "x_keys", "x_vectors", "kth"])

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in ("k1", "k2", "v", "kth")], strict=True):
                turn = row[0] if turn is None else turn
                held.append(row)
                if len(held) >= BLOCK:
                    yield out()
                    turn += 1
        if held:
            yield out()

    return rows.select("k1", "k2", "v", "kth").mapInArrow(run, f"{deal} long, x_keys binary, x_vectors binary, kth binary")


def scan(file: DataFrame, asked: DataFrame, slices: int, groups: int, visit: Callable, schema: str) -> DataFrame:
    """What ``visit`` makes of the blocks of each part: first those of its queries, then those of its slice."""

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<long>"))

    both = asked.withColumn("slice", every(slices)).withColumn("of_file", F.lit(False)).unionByName(
        file.withColumn("group", every(groups)).withColumn("of_file", F.lit(True))
    )
    parts = both.withColumn("part", F.col("slice") * groups + F.col("group")).drop("slice", "group")
    tasks = max(file.sparkSession.sparkContext.defaultParallelism, slices * groups)
    return parts.repartition(tasks, "part").sortWithinPartitions("part", "of_file").mapInArrow(visit, schema)


def margin(q: np.ndarray, width: np.ndarray) -> np.ndarray:
    """How far a product with a query may be from that with the centre of a cell."""
    n = min(q.shape[1], len(width))
    return np.abs(q[:, :n]) @ ((width[:n] - 1) / 2)


def met(batches: Iterator[pa.RecordBatch], least: np.ndarray, width: np.ndarray, kind: type) -> Iterator[tuple]:
    """(part, place in the group, block of queries, keys of a block of the file, products with its centres)."""
    part, asked = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            if row["part"] != part:
                part, asked = row["part"], []
            if not row["of_file"]:
                keys, q = unpacked(row, "x")
                asked.append({"keys": keys, "q": q, "kth": np.frombuffer(row["kth"]), "margin": margin(q, width)})
                continue
            keys, cell = unpacked(row, "x", kind)
            centres = least + cell * width + (width - 1) / 2
            for place, block in enumerate(asked):
                q, x = common_width(block["q"], centres)
                yield part, place, block, keys, q @ x.T


def batch_of(asked: np.ndarray, keys: np.ndarray, *more: np.ndarray) -> pa.RecordBatch:
    columns = [asked[:, 0], asked[:, 1], keys[:, 0], keys[:, 1], *more]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q1", "q2", "k1", "k2", *["centre"] * len(more)])


class Highest:
    """Of each query the ``k`` highest products with centres so far, and the vectors that have them."""

    def __init__(self, queries: int, k: int):
        self.k, self.scores, self.keys = k, np.full((queries, k), -np.inf), np.zeros((queries, k, 2), dtype=np.int64)

    def add(self, keys: np.ndarray, centre: np.ndarray) -> None:
        hit = np.flatnonzero(centre.max(axis=1) > self.scores.min(axis=1))
        both = np.concatenate([self.scores[hit], centre[hit]], axis=1)
        top = np.argpartition(both, both.shape[1] - self.k, axis=1)[:, -self.k :]
        own = np.take_along_axis(self.keys[hit], np.minimum(top, self.k - 1)[:, :, None], axis=1)
        self.keys[hit] = np.where((top < self.k)[:, :, None], own, keys[np.maximum(top - self.k, 0)])
        self.scores[hit] = np.take_along_axis(both, top, axis=1)


def promising(least: np.ndarray, width: np.ndarray, kind: type, k: int):
    """Of each query and slice the ``k`` vectors with the highest products of centres; the margin is the same for all."""

    def run(batches):
        for _, tiles in groupby(met(batches, least, width, kind), lambda tile: tile[0]):
            best: dict[int, tuple[Any, Highest]] = {}
            for _, place, block, keys, centre in tiles:
                best.setdefault(place, (block["keys"], Highest(len(block["keys"]), k)))[1].add(keys, centre)
            for asked, highest in best.values():
                i, j = np.nonzero(highest.scores > -np.inf)
                yield batch_of(asked[i], highest.keys[i, j], highest.scores[i, j])

    return run


def possible(least: np.ndarray, width: np.ndarray, kind: type):
    """The vectors whose upper bound reaches the k-th exact score of a query."""

    def run(batches):
        for _, _, block, keys, centre in met(batches, least, width, kind):
            i, j = np.nonzero(centre >= (block["kth"] - block["margin"])[:, None])
            if len(i):
                yield batch_of(block["keys"][i], keys[j])

    return run


def narrowest(least: np.ndarray, width: np.ndarray, bits: int) -> str:
    """The narrowest type that holds every whole number on the grid."""
    most = max(np.abs(least).max(initial=0), np.abs(least + width * (1 << bits)).max(initial=0))
    return "smallint" if most < 1 << 15 else "int" if most < 1 << 31 else "double"


def exact(pairs: DataFrame, vectors: DataFrame, asked: DataFrame) -> DataFrame:
    """The pairs with their inner products, read from the exact vectors.

    The joins are hinted: by the size of its file, which is a small part of what it takes in memory, Spark would broadcast a side with vectors.
    """
    own = asked.select("q1", "q2", F.col("v").alias("q"))
    read = pairs.join(vectors.select("k1", "k2", "v").hint("merge"), ["k1", "k2"]).join(own.hint("merge"), ["q1", "q2"])
    products = F.zip_with("q", "v", lambda a, b: F.coalesce(a * b, F.lit(0.0)))
    score = F.aggregate(products, F.lit(0).cast("long"), lambda total, x: total + x.cast("long"))
    return read.select("q1", "q2", "k1", "k2", score.alias("score"))


def search(
    df: DataFrame, queries: DataFrame, k: int, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", bits: int = 6
) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query row the ``k`` highest inner products among all other rows of ``df``."""
    spark = df.sparkSession

    def whole(rows: DataFrame) -> DataFrame:
        # Floating point on purpose: these whole numbers and their sums are exact, and products of matrices are fast.
        return rows.withColumn("v", F.transform("v", lambda x: F.floor(x * F.lit(scale)).cast("double")))

    vectors = stored(different(whole(usable(df, id_col, vector_col, zero=True)), k + 1), "vectors")
    rows = whole(usable(queries, id_col, vector_col, zero=True))
    asked = stored(
        rows.select(F.xxhash64("v").alias("q1"), F.xxhash64(F.lit(1), "v").alias("q2"), "v").groupBy("q1", "q2").agg(F.first("v").alias("v")), "asked"
    )
    least, width = grid(vectors, bits)
    kind = np.uint8 if bits <= 8 else np.uint16
    numbers = max(1, len(least))
    slices, groups = cuts(
        vectors.count(), asked.count(), 24 + numbers * np.dtype(kind).itemsize, 24 + 8 * numbers, 4 * spark.sparkContext.defaultParallelism
    )
    none = F.lit(float("-inf"))
    # The vectors of the pairs are shuffled twice; narrow numbers take a part of what doubles take.
    read = vectors.withColumn("v", F.col("v").cast(f"array<{narrowest(least, width, bits)}>"))
    file = dealt(vectors.withColumn("kth", none), "slice", slices, cells(least, width, kind))

    def blocks(rows: DataFrame) -> DataFrame:
        return dealt(rows.withColumnsRenamed({"q1": "k1", "q2": "k2"}), "group", groups)

    # The k + 1 most promising of different vectors: one may be the query's own.
    found = scan(file, blocks(asked.withColumn("kth", none)), slices, groups, promising(least, width, kind, k + 1), f"{PAIR}, centre double")
    by_bound = Window.partitionBy("q1", "q2").orderBy(F.desc("centre"), "k1", "k2")
    first = found.withColumn("nth", F.row_number().over(by_bound)).where(F.col("nth") <= k + 1)
    first = stored(exact(first.select("q1", "q2", "k1", "k2"), read, asked), "first")
    kth = first.groupBy("q1", "q2").agg(F.min("score").alias("score"), F.count("*").alias("n"))
    kth = kth.select("q1", "q2", F.when(F.col("n") > k, F.col("score").cast("double")).otherwise(none).alias("kth"))
    bounded = asked.join(kth.hint("merge"), ["q1", "q2"])
    pairs = scan(file, blocks(bounded), slices, groups, possible(least, width, kind), PAIR)
    return expanded(exact(pairs, read, asked), vectors.hint("merge"), rows, k)

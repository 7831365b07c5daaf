"""Vectors shared by the searches: usable rows, different vectors, packed blocks, top-k."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors of a packed block.
BLOCK = 1_024


def usable(df: DataFrame, id_col: str, vector_col: str, zero: bool) -> DataFrame:
    """(vec_id, v): rows with an id and a vector of finite components; ``zero`` keeps zero vectors."""
    v = F.col(vector_col).cast("array<double>")
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(finite)
    return rows if zero else rows.where(F.exists("v", lambda x: x != 0))


def different(rows: DataFrame, most: int) -> DataFrame:
    """(k1, k2, v, ids): each different vector with the smallest ids that have it, at most ``most``.

    More of them could not be among the nearest of any query.  The window limits each
    vector's rows in every task before they are shuffled.
    """
    v = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))  # one zero
    keyed = rows.withColumn("v", v).withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit(1), "v"))
    first = keyed.withColumn("nth", F.row_number().over(Window.partitionBy("k1", "k2").orderBy("vec_id"))).where(F.col("nth") <= most)
    return first.groupBy("k1", "k2").agg(F.first("v").alias("v"), F.array_sort(F.collect_list("vec_id")).alias("ids"))


def matrix(values: list, size: int | None = None) -> np.ndarray:
    """Rows of numbers; short ones are filled with zeros."""
    size = size or max(map(len, values), default=0)
    if all(len(v) == size for v in values):
        return np.array(values, dtype=np.float64).reshape(len(values), size)
    out = np.zeros((len(values), size))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def packed(rows: DataFrame, deal: list[str], convert: Callable[[np.ndarray], np.ndarray] | None = None) -> DataFrame:
    """Rows (``deal``, k1, k2, v) as blocks (``deal``, n, keys, vectors), dealt out by ``deal``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def out(group: tuple) -> pa.RecordBatch:
            rows_ = held.pop(group)
            keys = np.array([r[:2] for r in rows_], dtype=np.int64)
            values = matrix([r[2] for r in rows_])
            values = convert(values) if convert else values
            columns = [*[pa.array([g], pa.int64()) for g in group], pa.array([len(rows_)], pa.int64())]
            columns += [pa.array([x.tobytes()], pa.binary()) for x in (keys, values)]
            return pa.RecordBatch.from_arrays(columns, [*deal, "n", "keys", "vectors"])

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in (*deal, "k1", "k2", "v")], strict=True):
                group = row[: len(deal)]
                held.setdefault(group, []).append(row[len(deal) :])
                if len(held[group]) >= BLOCK:
                    yield out(group)
        for group in list(held):
            yield out(group)

    kinds = ", ".join(f"{d} long" for d in deal)
    columns = [F.col(d).cast("long").alias(d) for d in deal]
    return rows.select(*columns, "k1", "k2", "v").repartition(*deal).mapInArrow(run, f"{kinds}, n long, keys binary, vectors binary")


def side(blocks: DataFrame, name: str, deal: list[str]) -> DataFrame:
    return blocks.select(*deal, *[F.col(c).alias(f"{name}_{c}") for c in ("n", "keys", "vectors")])


def unpacked(row: dict, name: str, kind=np.float64) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(row[f"{name}_keys"], np.int64).reshape(-1, 2)
    return keys, np.frombuffer(row[f"{name}_vectors"], kind).reshape(len(keys), -1)


def common_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without the components that only one has: there the other is zero."""
    width = min(a.shape[1], b.shape[1])
    return a[:, :width], b[:, :width]


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Of each row, which columns reach the row's ``k``-th largest value."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, dtype=bool)
    kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    return scores >= kth[:, None]


def expanded(found: DataFrame, vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): found pairs of vectors, (q1, q2, k1, k2, score), put on the rows that have them.

    Per different query vector the best ``k`` + 1 rows are kept, one of which may be the query itself.
    """
    ids = vectors.select("k1", "k2", F.explode("ids").alias("vec_id"))
    rows = found.join(ids, ["k1", "k2"])
    order = Window.partitionBy("q1", "q2").orderBy(F.desc("score"), "vec_id")
    near = rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).groupBy("q1", "q2").agg(
        F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near")
    )
    asked = queries.select(F.col("vec_id").alias("query_id"), F.xxhash64("v").alias("q1"), F.xxhash64(F.lit(1), "v").alias("q2"))
    others = F.filter("near", lambda x: x["vec_id"] != F.col("query_id"))
    return (
        asked.join(near, ["q1", "q2"]).select("query_id", F.posexplode(F.slice(others, 1, k)).alias("pos", "x"))
        .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
    )


def normal_zero(v: Column | str = "v") -> Column:
    return F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))

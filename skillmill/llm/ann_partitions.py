"""Approximate nearest neighbours by learned partitions.

On a bounded sample a neighbour graph is built and cut in halves again and again, each cut
balanced and improved by swapping vertices that have more neighbours across it.  A small
network learns, for a vector, how its neighbours spread over the parts.  Every vector is filed
under its most probable part; a query is sent to its most probable parts and what lies
there is ranked again by exact inner products.

How many parts a query visits is set on the sample: the fewest with which the sample's own
queries find ``aim`` of their true neighbours, so the recall holds on vectors that cluster badly, too.

Defined results: rows with a null id or vector, a zero vector or a null or non-finite component
take no part; a vector shorter than another has zeros there; equal vectors are searched
once and share their results; with no usable rows the result is empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillmill.llm.common import partitions, stored
from skillmill.llm.vectors import best, common_width, different, expanded, matrix, normal_zero, packed, side, unpacked, usable


def neighbours(x: np.ndarray, k: int, of: np.ndarray | None = None) -> np.ndarray:
    """The ``k`` other rows of ``x`` with the largest inner product, for each row or the rows ``of``."""
    of = np.arange(len(x)) if of is None else of
    k = min(k, len(x) - 1)
    out = np.zeros((len(of), k), dtype=np.int64)
    for begin in range(0, len(of), 512):
        rows = of[begin : begin + 512]
        scores = x[rows] @ x.T
        scores[np.arange(len(rows)), rows] = -np.inf
        out[begin : begin + 512] = np.argpartition(-scores, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_halves(x: np.ndarray, graph: np.ndarray, members: np.ndarray, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Which of the members belong to the second half."""
    inside = np.full(len(x), -1)
    inside[members] = np.arange(len(members))
    near = inside[graph[members]]
    centred = x[members] - x[members].mean(0)
    direction = rng.standard_normal(x.shape[1])
    for _ in range(8):
        direction = centred.T @ (centred @ direction)
        direction /= np.linalg.norm(direction) + 1e-12
    half = np.zeros(len(members), dtype=bool)
    half[np.argsort(centred @ direction, kind="stable")[len(members) // 2 :]] = True
    linked = near >= 0
    for _ in range(rounds):
        across = np.zeros(len(members))
        other = linked & (half[np.where(linked, near, 0)] != half[:, None])
        toward = other.sum(1) * 2.0 - linked.sum(1)
        # Links pull on both their ends.
        np.add.at(across, near[linked], np.where(other[linked], 1.0, -1.0))
        gain = toward + across
        left, right = (np.flatnonzero(half == side) for side in (False, True))
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        n = min(len(left), len(right))
        swap = int((gain[left[:n]] + gain[right[:n]] > 0).sum()) // 2
        if not swap:
            break
        half[left[:swap]], half[right[:swap]] = True, False
    return half


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Part of each row; ``parts`` is a power of two and the parts differ by a row at most per cut."""
    part = np.zeros(len(x), dtype=np.int64)
    groups = [np.arange(len(x))]
    while len(groups) < parts:
        split = []
        for members in groups:
            half = balanced_halves(x, graph, members, rng)
            split += [members[~half], members[half]]
        groups = split
    for i, members in enumerate(groups):
        part[members] = i
    return part


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def probabilities(model: dict, x: np.ndarray) -> np.ndarray:
    x = x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-12)
    return softmax(np.maximum(x @ model["w1"] + model["b1"], 0) @ model["w2"] + model["b2"])


def learn(x: np.ndarray, target: np.ndarray, rng: np.random.Generator, hidden: int = 96, epochs: int = 40) -> dict:
    """A network of one hidden layer that gives the spread of a vector's neighbours, by Adam."""
    x = x / (np.linalg.norm(x, axis=1, keepdims=True) + 1e-12)
    m = {
        "w1": rng.standard_normal((x.shape[1], hidden)) * np.sqrt(2.0), "b1": np.zeros(hidden),
        "w2": rng.standard_normal((hidden, target.shape[1])) * np.sqrt(1.0 / hidden), "b2": np.zeros(target.shape[1]),
    }
    first, second, step = {k: 0.0 for k in m}, {k: 0.0 for k in m}, 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            a = x[rows]
            h = np.maximum(a @ m["w1"] + m["b1"], 0)
            d = (softmax(h @ m["w2"] + m["b2"]) - target[rows]) / len(rows)
            back = (d @ m["w2"].T) * (h > 0)
            grads = {"w2": h.T @ d, "b2": d.sum(0), "w1": a.T @ back, "b1": back.sum(0)}
            step += 1
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                m[k] = m[k] - 0.005 * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return m


def fit(x: np.ndarray, k: int, parts: int, aim: float, seed: int = 7) -> dict:
    """Partition and router learned on the sample ``x``, and how many parts a query visits."""
    rng = np.random.default_rng(seed)
    while parts > 1 and len(x) < 4 * parts:
        parts //= 2
    if parts < 2:
        return {"parts": 1, "visits": 1}
    graph = neighbours(x, 2 * k)
    part = balanced_parts(x, graph, parts, rng)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1.0)
    target[np.arange(len(x)), part] += graph.shape[1] / 4
    model = learn(x, target / target.sum(1, keepdims=True), rng)
    filed = probabilities(model, x).argmax(1)
    asked = rng.choice(len(x), min(1_000, len(x)), replace=False)
    order = np.argsort(-probabilities(model, x[asked]), axis=1)
    place = np.argsort(order, axis=1)
    true = filed[neighbours(x, k, asked)]
    reached = np.take_along_axis(place, true, axis=1)
    visits = next((v for v in range(1, parts) if (reached < v).mean() >= aim), parts)
    return model | {"parts": parts, "visits": visits}


def routed(vectors: DataFrame, model: dict, visits: int, sizes: np.ndarray | None = None, least: int = 0) -> DataFrame:
    """(k1, k2, v, part): each vector with its ``visits`` most probable parts.

    With the ``sizes`` of the parts more are visited, in the order of the router, until they hold ``least`` vectors.
    """

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            number = np.ones(batch.num_rows, dtype=np.int64)
            order = np.zeros((batch.num_rows, 1), dtype=np.int64)
            if model["parts"] > 1:
                x = matrix(batch.column("v").to_pylist(), len(model["w1"]))
                order = np.argsort(-probabilities(model, x), axis=1, kind="stable")
                number[:] = visits
                if sizes is not None:
                    short = (np.cumsum(sizes[order], axis=1) < least).sum(1)
                    number = np.minimum(np.maximum(number, short + 1), model["parts"])
            rows = np.repeat(np.arange(batch.num_rows), number)
            top = order[np.arange(order.shape[1]) < number[:, None]]
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [*[taken.column(c) for c in ("k1", "k2", "v")], pa.array(top, pa.int64())], ["k1", "k2", "v", "part"]
            )

    return vectors.select("k1", "k2", "v").mapInArrow(run, "k1 long, k2 long, v array<double>, part long")


def nearest(k: int):
    """Maps pairs of a query block and a block of rows to the rows that may be among the nearest."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                asked, q = unpacked(row, "q")
                keys, x = unpacked(row, "x")
                a, b = common_width(q, x)
                scores = a @ b.T
                i, j = np.nonzero(best(scores, k))
                columns = [asked[i, 0], asked[i, 1], keys[j, 0], keys[j, 1], scores[i, j]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["q1", "q2", "k1", "k2", "score"])

    return run


def search(
    df: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
    sample: int = 8_192, parts: int = 32, aim: float = 0.94, salts: int = 4,
) -> DataFrame:
    """(query_id, rank, vec_id, score): of each query row the ``k`` nearest found among all other rows of ``df``.

    ``sample`` bounds the different vectors the partition is fitted on, those of smallest hash.
    """
    vectors = stored(different(usable(df, id_col, vector_col, zero=False), k + 1), "vectors")
    asked = usable(queries, id_col, vector_col, zero=False).withColumn("v", normal_zero())
    rows = vectors.select("v").orderBy("k1", "k2").limit(sample).collect()
    model = fit(matrix([r.v for r in rows]), k, parts, aim)
    filed = routed(vectors, model, 1).withColumn("salt", F.pmod("k1", F.lit(salts)))
    unique = asked.select(F.xxhash64("v").alias("k1"), F.xxhash64(F.lit(1), "v").alias("k2"), "v").groupBy("k1", "k2").agg(F.first("v").alias("v"))
    sizes = np.zeros(model["parts"], dtype=np.int64)
    # One row a part.
    for row in filed.groupBy("part").count().collect():
        sizes[row["part"]] = row["count"]
    sent = routed(unique, model, model["visits"], sizes, k + 1)
    # Every slice of a part sees the part's queries; a slice bounds what one task compares.
    sent = sent.withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(salts)])))
    pairs = side(packed(sent, ["part", "salt"]), "q", ["part", "salt"]).join(side(packed(filed, ["part", "salt"]), "x", ["part", "salt"]), ["part", "salt"])
    # The different vectors hold k + 1 ids each at most, so k + 1 of them always suffice.
    found = pairs.repartition(partitions(df.sparkSession)).mapInArrow(nearest(k + 1), "q1 long, q2 long, k1 long, k2 long, score double")
    return expanded(found, vectors, asked, k)

"""Labelled samples, folds and logistic calibration for the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillmill.llm.common import stored


def fold(id_col: str, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % of


def sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int) -> tuple[DataFrame, float]:
    """(label, text), and the share of label 1 among all training rows: at most ``per_class`` training rows of each class, those of smallest hash.

    Near copies count once: of the documents with the same smallest hash of three
    words and the same label one stays.  An id labelled several times has its largest label; null
    labels, ids and texts take no part.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    )
    # The hashes decide alike at any size; only the ids of both sides are joined before the cut.
    ids = docs.where(train & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"))
    known = stored(ids.join(marked, "doc_id").distinct(), "labelled")
    share = known.agg(F.avg("label")).first()[0] or 0.0
    chosen = None
    for value in (0, 1):
        part = known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.union(part)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    found = chosen.join(texts, "doc_id").where("text is not null")
    words = found.withColumn("words", F.split(F.lower("text"), " "))
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0)))
    key = F.array_min(F.transform(starts, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(3)])))
    return words.groupBy("label", key.alias("key")).agg(F.min_by("text", "doc_id").alias("text")).select("label", "text"), share


def logistic(features: np.ndarray, label: np.ndarray, ridge: float = 1e-3, steps: int = 60) -> np.ndarray:
    """Weights (the last is the constant) of a ridge logistic regression, by Newton steps.

    Both classes weigh the same, so 0.5 is the point between them whatever their shares.
    """
    x = np.column_stack([features, np.ones(len(features))])
    share = label.mean() if len(label) else 0.5
    if not len(label) or share in (0.0, 1.0):
        return np.zeros(x.shape[1])
    weight = np.where(label == 1, 0.5 / share, 0.5 / (1 - share)) / len(label)
    w = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    penalty[-1, -1] = 1e-9
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - label)) + penalty @ w
        hessian = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + penalty
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def probability(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    z = features @ weights[:-1] + weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

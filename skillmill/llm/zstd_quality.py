"""Quality by compression: which of two zstandard dictionaries shortens a text more.

One dictionary is built from labelled good text and one from labelled bad text.
A text's main feature is (size with the bad dictionary - size with the good one) / size
without any.  Text that repeats itself is short with either, so the size without a dictionary /
length is the second.  A logistic curve fitted on other labelled texts makes them a score.

The dictionaries and the curve are fitted on at most ``per_class`` labelled documents of
each class, up to ``most_chars`` characters of each; every text is scored whole.

Defined results: null or empty text has the features 0 and 1; without labels of both classes every score is
0.5; the score depends on nothing but the text.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillmill.llm.common import blocks
from skillmill.llm.labelled import logistic, probability, sample

DICTIONARY = 112_640
LEVEL = 3
#: Bytes compressed at a time: in longer ones a text repeats itself more than its dictionary.
PIECE = 1_024


def dictionary(texts: list[bytes]) -> bytes:
    """Trained on the texts; the texts themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY, texts).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(texts)[-DICTIONARY:]


def measure(good: bytes, bad: bytes) -> Callable[[str | None], tuple[float, float]]:
    """The normalised difference of compressed sizes, and the size without a dictionary, normalised."""
    plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
    with_good, with_bad = (
        zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_dict_id=False)
        for d in (good, bad)
    )

    def difference(text: str | None) -> tuple[float, float]:
        data = (text or "").encode("utf-8", "replace")
        sizes = [0, 0, 0]
        for i in range(0, len(data), PIECE):
            for k, c in enumerate((plain, with_good, with_bad)):
                sizes[k] += len(c.compress(data[i : i + PIECE]))
        return ((sizes[2] - sizes[1]) / sizes[0], min(1.0, sizes[0] / len(data))) if data else (0.0, 1.0)

    return difference


def fit(rows: list[tuple[int, str]], share: float, most_chars: int = 20_000) -> dict | None:
    """Dictionaries from every second row of each class, the curve from the others.

    ``share`` of the labelled documents are good; the curve is moved there from even classes.
    """
    by = {k: [t[:most_chars] for label, t in rows if label == k] for k in (0, 1)}
    if min(map(len, by.values())) < 2:
        return None
    good, bad = (dictionary([t.encode("utf-8", "replace") for t in by[k][::2]]) for k in (1, 0))
    difference = measure(good, bad)
    x, y = zip(*[(difference(t), k) for k in (0, 1) for t in by[k][1::2]], strict=True)
    weights = logistic(np.array(x), np.array(y))
    weights[-1] += np.log(share / (1 - share))
    return {"good": good, "bad": bad, "weights": weights}


def scored(docs: DataFrame, model: dict | None) -> DataFrame:
    """``docs`` (doc_id, text) with the text replaced by its score."""

    def run(batches):
        difference = measure(model["good"], model["bad"]) if model else None
        for block in blocks(batches):
            if model:
                x = np.array([difference(t) for t in block["text"]]).reshape(-1, 2)
                score = probability(model["weights"], x)
            else:
                score = np.full(len(block["text"]), 0.5)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block["doc_id"], pa.int64()), pa.array(score, pa.float64())], ["doc_id", "score"]
            )

    return docs.mapInArrow(run, "doc_id long, score double")


def quality(docs: DataFrame, labels: DataFrame, train: Column, per_class: int = 2_000, cut: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every row; a higher score makes label 1 likelier."""
    chosen, share = sample(docs, labels, "quality", train, per_class)
    rows = sorted([(r.label, r.text) for r in chosen.collect()], key=lambda r: (r[0], len(r[1]), r[1]))
    model = fit(rows, share) if 0 < share < 1 else None
    found = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")), model)
    return found.withColumn("predicted", (F.col("score") >= cut).cast("int"))

"""Helpers shared by the operators: tables, work tables, text chunks, components."""

from __future__ import annotations

import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, islice
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package's code to the executors, once a session."""
    context = spark.sparkContext
    if not getattr(context, "_skillmill_shipped", False):
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(), "skillmill_code")
        root, name = os.path.split(package)
        context.addPyFile(shutil.make_archive(archive, "zip", root, name))
        context._skillmill_shipped = True
    return spark


def work_folder(spark: SparkSession) -> str:
    """The folder all executors share.  A local session that names none gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    held = context.getCheckpointDir()
    if held:
        return held
    if not re.match(r"local(\[|$)", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="skillmill-"))
    return context.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{work_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame) -> DataFrame:
    """``df`` in an eighth of the shuffle partitions, but no fewer than there are cores.

    For rows of a few numbers each: their tasks take longer to start than to run, and many small files seem too large to broadcast.
    """
    spark = df.sparkSession
    return df.coalesce(max(spark.sparkContext.defaultParallelism, partitions(spark) // 8))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it from being one of the columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def blocks(batches: Iterator[pa.RecordBatch], most_chars: int = 4_000_000, text: str = "text") -> Iterator[dict]:
    """Columns of the batches as lists, cut where the texts of a block get too long."""
    for batch in batches:
        held: dict[str, list] = batch.to_pydict()
        size = begin = 0
        for i, value in enumerate(held[text]):
            size += len(value or "")
            if size >= most_chars:
                yield {k: v[begin : i + 1] for k, v in held.items()}
                size, begin = 0, i + 1
        if begin < batch.num_rows:
            yield {k: v[begin:] for k, v in held.items()}


class Memo:
    """What ``make`` gives for strings; keeps so many and then begins anew, so memory is bounded."""

    def __init__(self, make: Callable[[list[str]], list], most: int = 700_000):
        self.make, self.most, self.known = make, most, {}

    def all(self, keys: list[str]) -> list:
        """What each of the keys stands for; ``make`` gives no None."""
        found = list(map(self.known.get, keys))
        if None in found:
            new = list({k for k, v in zip(keys, found, strict=True) if v is None})
            if len(self.known) + len(new) > self.most:
                self.known = {}
                new = list(set(keys))
            self.known.update(zip(new, self.make(new), strict=True))
            found = list(map(self.known.get, keys))
        return found


class ChunkCoder:
    """Encodes texts by ``make``, which maps pre-tokens to what stands for their ids.

    Texts are cut at single blanks; each different piece of a block is split and encoded once.
    """

    def __init__(self, make: Callable[[list[str]], list], pattern: str, merged: Callable[[list], Any] = b"".join):
        import regex

        self.find = regex.compile(pattern).findall
        self.make, self.merged = make, merged
        self.after_blank = Memo(lambda parts: self.split([" " + p for p in parts]))

    def split(self, parts: list[str]) -> list:
        tokens = [self.find(p) for p in parts]
        made = iter(self.make(list(chain.from_iterable(tokens))))
        return [self.merged(list(islice(made, len(t)))) for t in tokens]

    def encode(self, texts: list[str | None]) -> list[list]:
        """For each text, what its pieces have, in order."""
        cuts = [cut_at_blanks(t or "") for t in texts]
        heads = self.split([head for head, _ in cuts])
        found = iter(self.after_blank.all(list(chain.from_iterable(rest for _, rest in cuts))))
        return [[head, *islice(found, len(rest))] for head, (_, rest) in zip(heads, cuts, strict=True)]


#: The pattern of the byte-level vocabularies, fixed by them.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def spelling() -> list[str]:
    """A printable character for each byte: itself where it is one, else from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    table = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


#: White space other than the blank and the line feed.
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
_CUT = re.compile(r"(?<=\S) (?=\S)")


def cut_at_blanks(text: str) -> tuple[str, list[str]]:
    """The text up to its first single blank, and what follows each single blank, without it.

    A blank between two characters that are no white space always begins a match of the
    byte-level pattern, so ``head`` and each of ``" " + rest`` can be encoded alone.
    """
    odd = text[:1] == " " or text[-1:] == " " or "  " in text or " \n" in text or "\n " in text
    if odd or any(c in text for c in _OTHER_SPACE):
        parts = _CUT.split(text)
    else:
        parts = text.split(" ")
    return parts[0], parts[1:]


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node reachable over ``edges`` (u, v), for every node of an edge.

    Every node hooks to its smallest neighbour and the edges are drawn between
    what the nodes hooked to, until none is left.  Each round is written to the
    shared folder; nothing is gathered on the driver.
    """
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    live = stored(narrow(both.where("u <> v").distinct()), name)
    labels = None
    while not live.isEmpty():
        least = live.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("least"))
        hook = stored(narrow(least.select("node", F.least("node", "least").alias("root"))), name)
        if labels is None:
            labels = hook.select("node", F.col("root").alias("component"))
        else:
            step = hook.select(F.col("node").alias("component"), "root")
            labels = labels.join(step, "component", "left").select(
                "node", F.coalesce("root", "component").alias("component")
            )
        labels = stored(narrow(labels), name)
        left = hook.select(F.col("node").alias("u"), F.col("root").alias("a"))
        right = hook.select(F.col("node").alias("v"), F.col("root").alias("b"))
        between = live.join(left, "u").join(right, "v").where("a <> b")
        live = stored(narrow(between.select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()), name)
    if labels is None:
        return live.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return labels

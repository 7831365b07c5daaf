"""Keyed upserts without a MERGE-capable store."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first_writer: Sequence[str] = (),
    keep_order: bool = False,
) -> DataFrame:
    """One row per key: the last one by ``order``.

    ``first_writer`` columns keep the value of the first row instead.  ``order``
    must tell the rows of a key apart, or only tie rows that are equal.  Both ends are
    top-1 windows, which become a group limit before the shuffle, so a key that fills a
    third of the input still ships one row per map task; the first rows carry
    the keys and the first-writer columns alone.  Rows that lack a key column have no first writer and are left out then.
    """
    columns = [c for c in df.columns if c in keys or keep_order or c not in order]

    def top(rows: DataFrame, ordering: Sequence[Column]) -> DataFrame:
        ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)))
        return ranked.filter(F.col("_rank") == 1).drop("_rank")

    last = top(df, [F.col(c).desc() for c in order])
    if not first_writer:
        return last.select(*columns)
    narrow = list(dict.fromkeys([*keys, *first_writer, *order]))
    first = top(df.select(*narrow), [F.col(c).asc() for c in order]).select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *[F.col(c).alias(f"_first_{c}") for c in first_writer]
    )
    # Plain equality lets the join use the shuffles of the two windows.
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_key_{k}") for k in keys])
    return last.join(first, same).select(
        *[F.col(f"_first_{c}").alias(c) if c in first_writer else F.col(c) for c in columns]
    )


def upsert(
    existing: DataFrame | None,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first_writer: Sequence[str] = (),
) -> DataFrame:
    """Insert or replace by key; ``first_writer`` columns are never replaced.

    Rows already there are unique by key, so only the batch is reduced: the rest
    is an anti join, which needs no shuffle of the old rows when the batch is small.
    """
    batch = latest_per_key(incoming, keys, order, first_writer)
    if existing is None:
        return batch
    kept = existing.join(incoming.select(*keys).distinct(), list(keys), "left_anti")
    if first_writer:
        before = existing.select(
            *keys, F.struct(*first_writer).alias("_before")
        )
        batch = batch.join(before, list(keys), "left").select(
            *[
                F.when(F.col("_before").isNotNull(), F.col(f"_before.{c}"))
                .otherwise(F.col(c))
                .alias(c)
                if c in first_writer
                else F.col(c)
                for c in batch.columns
            ]
        )
    return kept.unionByName(batch)


def new_members(names: DataFrame, existing: DataFrame | None, column: str = "name") -> DataFrame:
    """Distinct non-blank names that a dimension does not hold yet."""
    fresh = names.filter(F.col(column).isNotNull() & (F.col(column) != "")).select(column).distinct()
    if existing is None:
        return fresh
    return fresh.join(existing.select(column), column, "left_anti")

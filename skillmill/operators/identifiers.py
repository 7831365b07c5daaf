"""Surrogate ids that cannot clash.

An id is the hash of its natural key, so tables need no join to get it.  Where two keys share a
hash, one keeps it and the others get another: those few are the exceptions, which are stored with the
tables and looked up by every table that carries the id, in this and in later runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillmill.operators import lookup

#: Columns of the stored exceptions.
SCHEMA = "id_name string, natural string, id long"


def clashes(rows: DataFrame) -> DataFrame:
    """(id) of the ids that several keys of (natural, id) hold."""
    return rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1).select("id")


def settle(rows: DataFrame, held: DataFrame | None = None, rounds: int = 64) -> DataFrame | None:
    """(natural, id) of the keys that need another id than they have in ``rows``; None where all differ.

    A key that ``held`` names with the same id keeps it, else the smallest does.  The losers take the hash of their key and a
    number, which goes up until no two ids are equal.  Only clashing keys are ever moved.
    """
    moved: DataFrame | None = None
    for number in range(1, rounds + 1):
        shared = clashes(rows)
        if shared.isEmpty():
            return moved
        meeting = rows.join(shared, "id")
        if held is None:
            ranked = meeting.withColumn("late", F.lit(False))
        else:
            known = held.select("natural", "id", F.lit(False).alias("late"))
            ranked = meeting.join(known, ["natural", "id"], "left").withColumn("late", F.coalesce("late", F.lit(True)))
        winner = ranked.groupBy("id").agg(F.min(F.struct("late", "natural"))["natural"].alias("winner"))
        losers = meeting.join(winner, "id").filter(F.col("natural") != F.col("winner")).select(
            "natural", lookup.surrogate_id(F.col("natural"), F.lit(number)).alias("id")
        )
        moved = losers if moved is None else moved.join(losers, "natural", "left_anti").unionByName(losers)
        rows = renamed(rows, losers)
    raise ValueError(f"ids still clash after {rounds} rounds")


def renamed(rows: DataFrame, exceptions: DataFrame) -> DataFrame:
    """``rows`` of (natural, id) with the ids of the exceptions."""
    other = exceptions.select("natural", F.col("id").alias("other"))
    return rows.join(other, "natural", "left").select("natural", F.coalesce("other", "id").alias("id"))

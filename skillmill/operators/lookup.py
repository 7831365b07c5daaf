"""Lookups, identity resolution and unmatched rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDENTITY = ("email", "upn", "external_user_id")


def surrogate_id(*keys: Column) -> Column:
    """Stable 64-bit id of a natural key: no sequence and the same in every run.

    Joins use the natural keys, so an id collision can never mix up rows; the
    uniqueness check reports one before anything is published.
    """
    return F.xxhash64(*keys)


def lookup(facts: DataFrame, table: DataFrame, key: str, how: str = "left") -> DataFrame:
    """N:1 equi join on ``key`` that adds the other columns of ``table``.

    ``table`` holds one row per key.  Its key is renamed through an expression, so
    a table grouped by the same key is shuffled once more just below the join.
    That small extra shuffle is what lets adaptive execution split a hot key of
    ``facts``; Spark broadcasts ``table`` instead where its size is under the limit.
    """
    keyed = table.withColumn("_key", F.concat(F.col(key).cast("string"), F.lit(""))).drop(key)
    return facts.join(keyed, F.col(key).cast("string") == F.col("_key"), how).drop("_key")


def known_only(facts: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose parent exists."""
    return facts.join(parents.select(key), key, "left_semi")


def unmatched(facts: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Rows whose parent is missing, a null key included."""
    return facts.join(parents.select(key), key, "left_anti")


def unmatched_counts(facts: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Missing parents with the number of rows that point at them.

    Rows are counted per key before the join, so a hot key crosses the shuffle as
    one row per map task.
    """
    counted = facts.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(parents.select(key), key, "left_anti")


def _filled(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def _tiers(columns: Sequence[str]) -> Column:
    """(tier, key) for every identifier that is filled; the first two ignore case."""
    email, upn, external = (F.col(c) for c in columns)
    keys = F.array(
        F.struct(F.lit(1).alias("tier"), F.lower(email).alias("key")),
        F.struct(F.lit(2).alias("tier"), F.lower(upn).alias("key")),
        F.struct(F.lit(3).alias("tier"), external.alias("key")),
    )
    return F.filter(keys, lambda k: _filled(k["key"]))


def _triple(columns: Sequence[str]) -> Column:
    """The identifiers as one text, each with its length in front so that none run together."""
    parts = []
    for name in columns:
        value = F.coalesce(F.col(name), F.lit(""))
        parts += [F.length(value).cast("string"), value]
    return F.concat_ws(":", *parts)


def identity_keys(users: DataFrame, user_key: str, columns: Sequence[str] = IDENTITY) -> DataFrame:
    """(key, user) for every identifier in use, the smallest user where several share one."""
    return (
        users.select(F.col(user_key), F.explode(_tiers(columns)).alias("k"))
        .groupBy("k.tier", "k.key")
        .agg(F.min(user_key).alias(user_key))
        .select(_tier_key(F.col("tier"), F.col("key")).alias("_identifier"), user_key)
    )


def _tier_key(tier: Column, key: Column) -> Column:
    return F.concat(tier.cast("string"), F.lit(":"), key)


def resolve_identity(
    facts: DataFrame,
    users: DataFrame,
    user_key: str,
    columns: Sequence[str] = IDENTITY,
    how: str = "inner",
) -> DataFrame:
    """Adds the user found by e-mail, else by principal name, else by external id.

    Only distinct identifier triples are resolved, in one join on (tier, key) in
    place of three joins of all facts; blank identifiers make no key, so they
    cannot pile up in one task.  The facts are joined once, on the whole triple.
    """
    named = facts.withColumn("_who", F.when(F.size(_tiers(columns)) > 0, _triple(columns)))
    triples = named.filter(F.col("_who").isNotNull()).select("_who", *columns).distinct()
    tried = triples.select("_who", F.explode(_tiers(columns)).alias("k")).select(
        "_who", "k.tier", _tier_key(F.col("k.tier"), F.col("k.key")).alias("_identifier")
    )
    found = (
        lookup(tried, identity_keys(users, user_key, columns), "_identifier", "inner")
        .groupBy("_who")
        .agg(F.min_by(user_key, "tier").alias(user_key))
    )
    if how == "inner":
        named = named.filter(F.col("_who").isNotNull())
    return lookup(named, found, "_who", how).drop("_who")

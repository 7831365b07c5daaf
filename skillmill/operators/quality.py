"""Constraint checks.  Each gives rows (table_name, check_name, column_name, violations)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillmill import model


def _finding(table: str, check: str, column: str | Column, violations: Column) -> list[Column]:
    name = F.lit(column) if isinstance(column, str) else column
    return [
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        name.alias("column_name"),
        F.coalesce(violations, F.lit(0)).cast("long").alias("violations"),
    ]


def not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Nulls per required column, all counted in one pass."""
    counted = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column_name"),
                    F.count(F.when(F.col(c).isNull(), 1)).alias("n"),
                )
                for c in columns
            ]
        ).alias("a")
    )
    return counted.select(F.explode("a").alias("x")).select(
        *_finding(table, "not_null", F.col("x.column_name"), F.col("x.n"))
    )


def unique(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row.  Copies are counted map-side before the shuffle."""
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("n")).select(
        *_finding(table, "unique", ", ".join(key), F.col("n"))
    )


def foreign_key(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Rows that point at no parent; a null points nowhere and is allowed."""
    pointed = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    lost = pointed.join(
        parent.select(F.col(parent_column).alias("_key")), "_key", "left_anti"
    )
    return lost.agg(F.sum("_n").alias("n")).select(
        *_finding(table, "foreign_key", column, F.col("n"))
    )


def in_range(df: DataFrame, table: str, column: str, low: int, high: int) -> DataFrame:
    """Values outside ``low`` to ``high``; null is not checked here."""
    return df.agg(F.count(F.when(~F.col(column).between(low, high), 1)).alias("n")).select(
        *_finding(table, "range", column, F.col("n"))
    )


def cascade(children: DataFrame, surviving_parents: DataFrame, key: str) -> DataFrame:
    """Child rows left once the rows of deleted parents go with them."""
    return children.join(surviving_parents.select(key), key, "left_semi")


def restrict(children: DataFrame, deleted_parents: DataFrame, key: str) -> DataFrame:
    """Deleted parents that children still point at, with the number of rows: none may be left."""
    pointed = children.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return pointed.join(deleted_parents.select(key), key, "left_semi")


def stack(findings: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, findings)


def row_checks(table: model.Table) -> list[Column]:
    """Aggregates that count the rows of a table against its definition, named ``check:column``.

    They can be observed while the table is written, so they need no scan of their own.  Keys and
    references need no check there: an upsert leaves one row a key, parents are joined before, and
    dimensions are made of the names in the tables.
    """
    wrong = {"not_null": lambda c: F.col(c).isNull(), "range": lambda c: ~F.col(c).between(0, 100)}
    return [F.count(F.when(wrong[kind](c), 1)).alias(f"{kind}:{c}") for kind, c in _row_check_names(table)]


def broken(table: str, counts: Mapping[str, int]) -> list[tuple[str, str, str, int]]:
    """(table, check, column, violations) of the row checks that found something."""
    return [(table, *name.split(":", 1), n) for name, n in sorted(counts.items()) if n]


def check_rows(df: DataFrame, table: model.Table) -> DataFrame:
    """All row checks of a stored table in one aggregate."""
    names = [f"{kind}:{column}" for kind, column in _row_check_names(table)]
    counted = df.agg(*row_checks(table)).select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(n.split(":", 1)[0]).alias("check"), F.lit(n.split(":", 1)[1]).alias("column"), F.col(f"`{n}`").alias("n"))
                    for n in names
                ]
            )
        ).alias("x")
    )
    return counted.select(
        F.lit(table.name).alias("table_name"), F.col("x.check").alias("check_name"), F.col("x.column").alias("column_name"),
        F.col("x.n").cast("long").alias("violations"),
    )


def _row_check_names(table: model.Table) -> list[tuple[str, str]]:
    made = [i for i, natural in model.ids(table).items() if natural in table.required]
    return [
        *[("not_null", c) for c in (*made, *table.required)],
        *[("range", f.name) for f in table.fields if f.kind == "percent"],
    ]


def check_tables(
    tables: Mapping[str, DataFrame], parents_of: Mapping[str, tuple[str, str]]
) -> list[DataFrame]:
    """An audit of stored tables against all that their definitions ask for, one result per table.

    ``parents_of`` maps a table to its parent table and the key they share.
    """
    results = []
    for table in model.TABLES:
        if table.name not in tables:
            continue
        df = tables[table.name]
        findings = [check_rows(df, table), unique(df, table.name, table.key)]
        if table.name in ("users", "cvs"):
            findings.append(unique(df, table.name, [model.id_column(table.key[0])]))
        if table.name in parents_of:
            parent, key = parents_of[table.name]
            findings.append(foreign_key(df, table.name, key, tables[parent], key))
        for field in table.dimensions:
            if field.dimension in tables:
                findings.append(
                    foreign_key(df, table.name, field.name, tables[field.dimension], "name")
                )
        results.append(stack(findings))
    for name in model.DIMENSIONS:
        if name in tables:
            df = tables[name]
            results.append(
                stack([not_null(df, name, ["name"]), unique(df, name, ["name"]), unique(df, name, [model.id_column(name)])])
            )
    return results

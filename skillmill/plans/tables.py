"""Typed rows to target tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillmill import model
from skillmill.model import Table
from skillmill.operators.lookup import known_only, lookup, surrogate_id
from skillmill.operators.upsert import new_members, upsert
from skillmill.plans.transform import REJECT
from skillmill.sources.reports import FILE_ORDER, MALFORMED


def _parent_key(table: Table) -> str:
    return model.USER_KEY if table.parent == "users" else model.CV_KEY


def _storable(table: Table, rows: DataFrame) -> DataFrame:
    """Rows of a technology without a name are left out, as for an unknown CV."""
    if table is model.CV_TECHNOLOGY:
        return rows.filter(F.col("technology").isNotNull())
    return rows


def with_ids(table: Table, rows: DataFrame, exceptions: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Stored layout: the surrogate ids are made from the natural keys.

    That needs no join but for ids that have ``exceptions``: (natural, id) by id column, the few keys
    whose hash another key holds.
    """
    exceptions = exceptions or {}
    made, named = [], rows
    for name, natural in model.ids(table).items():
        value = surrogate_id(F.col(natural))
        if name in exceptions:
            other = exceptions[name].select(F.col("natural").alias(natural), F.col("id").alias(f"_{name}"))
            named = lookup(named, other, natural)
            value = F.coalesce(F.col(f"_{name}"), value)
        made.append(F.when(F.col(natural).isNotNull(), value).alias(name))
    return named.select(*made, *[f.name for f in table.fields])


def build(
    table: Table,
    rows: DataFrame,
    parents: DataFrame | None = None,
    existing: DataFrame | None = None,
    order: Sequence[str] = FILE_ORDER,
    exceptions: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """The table after the typed rows are upserted into ``existing``.

    ``parents`` is None where every row is known to have its parent.  A table with
    first-writer columns must not see rows of unknown parents at all; for the
    others the rows are reduced to one per key first, so fewer meet the join.
    """
    good = _storable(table, rows.filter(F.col(REJECT).isNull()).drop(REJECT, MALFORMED))
    if existing is not None:
        existing = existing.select(*[f.name for f in table.fields])
    early = bool(table.first_writer)
    if parents is not None and early:
        good = known_only(good, parents, _parent_key(table))
    result = upsert(existing, good, table.key, order, table.first_writer)
    if parents is not None and not early:
        result = known_only(result, parents, _parent_key(table))
    return with_ids(table, result, exceptions)


def unstorable(table: Table, rows: DataFrame, order: Sequence[str] = FILE_ORDER) -> DataFrame:
    """(table_name, parent, problem, row) and the row order for rows that cannot be stored.

    Malformed records are not among them: :func:`malformed` tells of those, whatever their parent cell holds.
    """
    bad = _storable(table, rows).filter(F.col(REJECT).isNotNull() & F.col(MALFORMED).isNull())
    return bad.select(
        F.lit(table.name).alias("table_name"),
        (F.col(_parent_key(table)) if table.parent else F.lit(None)).cast("string").alias("parent"),
        F.col(REJECT).alias("problem"),
        F.to_json(F.struct(*[f.name for f in table.fields])).alias("row"),
        *order,
    )


def rejects(
    table: Table, rows: DataFrame, parents: DataFrame | None = None, order: Sequence[str] = FILE_ORDER
) -> DataFrame:
    """(table_name, problem, row) and the row order for rows of known parents that cannot be stored."""
    bad = unstorable(table, rows, order)
    if parents is not None:
        bad = known_only(bad, parents.select(F.col(_parent_key(table)).alias("parent")), "parent")
    return bad.drop("parent")


def malformed(table: Table, rows: DataFrame) -> DataFrame:
    """(table_name, problem, row) and the file order of the malformed records among typed rows.

    ``row`` is the text of the record, or its cells where the text is not known.
    """
    bad = rows.filter(F.col(MALFORMED).isNotNull())
    cells = F.to_json(F.struct(*[f.name for f in table.fields]))
    return bad.select(
        F.lit(table.name).alias("table_name"),
        F.col(f"{MALFORMED}.problem").alias("problem"),
        F.coalesce(F.col(f"{MALFORMED}.record"), cells).alias("row"),
        *FILE_ORDER,
    )


def placed(rejected: DataFrame, scans: DataFrame) -> DataFrame:
    """Rejects with the number of their record in its file block, counted from 1, in place of the row order.

    ``scans`` are (table_name, _file, _block, _row) of all rows of the scans that the rejects come from.
    """
    first = scans.groupBy("table_name", "_file", "_block").agg(F.min("_row").alias("_first"))
    return rejected.join(first, ["table_name", "_file", "_block"]).select(
        "table_name", "problem", "row", F.col("_file").alias("file"), F.col("_block").alias("block"),
        (F.col("_row") - F.col("_first") + 1).alias("record"),
    )


def pointers(table: Table, rows: DataFrame) -> DataFrame:
    """(table_name, parent) of every well-formed row."""
    good = rows.filter(F.col(MALFORMED).isNull())
    return good.select(F.lit(table.name).alias("table_name"), F.col(_parent_key(table)).alias("parent"))


def missing_parents(pointing: DataFrame, parents: DataFrame) -> DataFrame:
    """(table_name, parent, rows) of :func:`pointers` of any tables whose parent is not among ``parents`` (parent)."""
    counted = pointing.groupBy("table_name", "parent").agg(F.count(F.lit(1)).alias("rows"))
    return counted.join(parents, "parent", "left_anti").select("table_name", "parent", "rows")


def named(table: Table, rows: DataFrame, parents: DataFrame | None = None) -> DataFrame:
    """The dimension names that typed rows bring in, rows replaced by later ones included.

    Rows of unknown CVs count for technologies only.  Each name is kept once per
    parent before the parents are looked up.
    """
    names = [f.name for f in table.dimensions]
    good = rows.filter(F.col(REJECT).isNull())
    if parents is None or table is model.CV_TECHNOLOGY:
        return good.select(*names)
    key = _parent_key(table)
    return known_only(good.select(key, *names).distinct(), parents, key).select(*names)


def new_names(name: str, tables: Mapping[str, DataFrame], existing: DataFrame | None = None) -> DataFrame:
    """The names (name) that ``tables`` bring in and a dimension does not hold yet."""
    used = [
        tables[t.name].select(F.col(f.name).alias("name"))
        for t in model.TABLES
        for f in t.dimensions
        if f.dimension == name and t.name in tables
    ]
    return new_members(reduce(DataFrame.unionByName, used), existing)


def dimension(
    name: str, tables: Mapping[str, DataFrame], existing: DataFrame | None = None,
    exceptions: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Members of a dimension that ``tables`` name, added to those it already holds."""
    members = new_names(name, tables, existing)
    if existing is not None:
        members = existing.select("name").unionByName(members)
    return dimension_ids(name, members, exceptions)


def dimension_ids(name: str, members: DataFrame, exceptions: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Members of a dimension with their ids."""
    column = model.id_column(name)
    value = surrogate_id(F.col("name"))
    if exceptions and column in exceptions:
        other = exceptions[column].select(F.col("natural").alias("name"), F.col("id").alias("_id"))
        members = lookup(members, other, "name")
        value = F.coalesce(F.col("_id"), value)
    return members.select(value.alias(column), "name")

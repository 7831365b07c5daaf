"""Raw reports to typed rows of the target tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillmill import model
from skillmill.functions import dates, numbers, text
from skillmill.model import Field, Table
from skillmill.operators.lookup import lookup, resolve_identity
from skillmill.operators.upsert import latest_per_key
from skillmill.sources.reports import FILE_ORDER, MALFORMED, MALFORMED_TYPE

USER_REPORT = "user_report.csv"
USAGE_REPORT = "usage_report.csv"
NATIONALITY = "Nationality (#{lang})"

# Kinds whose conversion can fail.
_LOSSY = ("int", "raw_bool", "date", "percent")

# Names of the columns of a typed row whose cell cannot be stored.
REJECT = "_reject"


def column(df: DataFrame, headers: Sequence[str], strict: bool = False) -> Column | None:
    """The first of ``headers`` that the report has, by exact text; None where it has none."""
    for header in headers[:1] if strict else headers:
        if header in df.columns:
            return F.col(f"`{header}`")
    return None


def _value(field: Field, cell: Column | None, strict_dates: bool, this_year: int) -> Column:
    if cell is None:
        return {
            "multilang": text.empty_map(),
            "json_text": F.lit("{}"),
            "percent": F.lit(0),
        }.get(field.kind, F.lit(None))
    if field.dimension:
        return F.nullif(cell, F.lit(""))
    convert: dict[str, Callable[[Column], Column]] = {
        "text": lambda c: c.cast("string"),
        "clean_text": lambda c: text.normalise(c, None),
        "json_text": text.json_string,
        "int": numbers.whole_number,
        "lenient_int": numbers.lenient_int,
        "percent": numbers.percent,
        "bool": text.parse_boolean,
        "raw_bool": text.database_boolean,
        "date": lambda c: dates.iso_date(c, strict_dates, this_year),
        "multilang": text.multilang_map,
    }
    return convert[field.kind](cell)


def typed_rows(
    df: DataFrame,
    table: Table,
    order: Sequence[str] = FILE_ORDER,
    strict_headers: bool = False,
    strict_dates: bool = False,
    this_year: int = dates.THIS_YEAR,
    given: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Target columns of ``table`` from a raw report, with the reject list, what is malformed and the row order.

    A field without a column in the report gets its empty value.  ``given``
    replaces the conversion of single fields.  The parent key is not checked
    here: rows without a known parent are dropped, not rejected.
    """
    given = given or {}
    kinds = {f.name: f.dataType for f in model.schema(table).fields}
    parent_key = {"users": model.USER_KEY, "cvs": model.CV_KEY}.get(table.parent)
    values, present, problems = [], [], []
    for field in table.fields:
        cell = column(df, field.headers, strict_headers)
        value = given.get(field.name)
        if value is None:
            value = _value(field, cell, strict_dates, this_year)
        values.append(value.cast(kinds[field.name]).alias(field.name))
        lost = F.col(field.name).isNull()
        if field.required and field.name != parent_key:
            problems.append((field.name, lost))
        elif cell is not None and field.kind in _LOSSY and field.name not in given:
            present.append(cell.isNotNull().alias(f"_has_{field.name}"))
            problems.append((field.name, F.col(f"_has_{field.name}") & lost))
    reject = F.concat_ws(", ", *[F.when(bad, F.lit(name)) for name, bad in problems])
    # A filter on the reject list must not be pushed below the conversions: that
    # would run all of them twice.  The optimizer keeps filters above a projection
    # with a column such as the partition id, so the reject list depends on it.
    malformed = F.col(MALFORMED) if MALFORMED in df.columns else F.lit(None).cast(MALFORMED_TYPE)
    converted = df.select(*values, *present, malformed.alias(MALFORMED), F.spark_partition_id().alias("_part"), *order)
    problem = F.coalesce(F.col(f"{MALFORMED}.problem"), F.nullif(reject, F.lit("")))
    rejected = F.when(F.col("_part") >= 0, problem).alias(REJECT)
    return converted.select(*[f.name for f in table.fields], rejected, MALFORMED, *order)


def well_formed(report: DataFrame) -> DataFrame:
    """The records of a report that could be read as its header says."""
    return report.filter(F.col(MALFORMED).isNull()) if MALFORMED in report.columns else report


def require_users(reports: Mapping[str, DataFrame]) -> DataFrame:
    """The user report, checked before anything is written."""
    users = reports.get(USER_REPORT)
    if users is None or users.isEmpty():
        raise ValueError("the user report has no rows")
    if column(users, ("CV Partner User ID",)) is None:
        raise ValueError("the user report has no user id column")
    return users


def with_nationality(
    users: DataFrame, usage: DataFrame | None, order: Sequence[str] = FILE_ORDER
) -> DataFrame:
    """Users with the nationality map of their last usage row, an empty map where there is none."""
    name = "nationality_multilang"
    user_id = "CV Partner User ID"
    if usage is None or NATIONALITY not in usage.columns or user_id not in usage.columns:
        return users.withColumn(name, text.empty_map())
    last = latest_per_key(
        well_formed(usage).filter(F.col(f"`{user_id}`").isNotNull()).select(user_id, NATIONALITY, *order),
        [user_id],
        order,
    )
    nationality = last.select(user_id, text.multilang_map(F.col(f"`{NATIONALITY}`")).alias(name))
    return lookup(users, nationality, user_id).withColumn(
        name, F.coalesce(F.col(name), text.empty_map())
    )


def user_rows(
    users: DataFrame, usage: DataFrame | None, order: Sequence[str] = FILE_ORDER, **options
) -> DataFrame:
    rows = with_nationality(users, usage, order)
    given = {"nationality_multilang": F.col("nationality_multilang")}
    return typed_rows(rows, model.USERS, order, given=given, **options)


def cv_rows(users: DataFrame, order: Sequence[str] = FILE_ORDER, **options) -> DataFrame:
    return typed_rows(users, model.CVS, order, **options)


def _resolved(df: DataFrame, users: DataFrame) -> DataFrame:
    """Report rows with the user they belong to; rows of nobody are left out."""
    return resolve_identity(_with_identity(df), users, model.USER_KEY)


def _with_identity(df: DataFrame) -> DataFrame:
    named = well_formed(df)
    for field in model.IDENTITY_FIELDS:
        cell = column(df, field.headers)
        named = named.withColumn(
            field.name, F.lit(None).cast("string") if cell is None else cell
        )
    return named


def unresolved_people(df: DataFrame, users: DataFrame, table: Table) -> DataFrame:
    """(table_name, parent, rows) for report rows that name nobody known.

    ``parent`` is the first identifier of the row, null where it has none.  Rows are counted
    per identifiers before the people are looked up, so one that fills a third of the report
    meets the join as a single row.
    """
    names = [f.name for f in model.IDENTITY_FIELDS]
    counted = _with_identity(df).groupBy(*names).agg(F.count(F.lit(1)).alias("rows"))
    left = resolve_identity(counted, users, model.USER_KEY, how="left")
    first = F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names])
    return (
        left.filter(F.col(model.USER_KEY).isNull())
        .groupBy(first.alias("parent"))
        .agg(F.sum("rows").alias("rows"))
        .select(F.lit(table.name).alias("table_name"), "parent", "rows")
    )


def clearance_rows(
    df: DataFrame,
    users: DataFrame,
    order: Sequence[str] = FILE_ORDER,
    strict_dates: bool = False,
    this_year: int = dates.THIS_YEAR,
    defaults: model.Defaults = model.DEFAULTS,
) -> DataFrame:
    """Clearances by person.  A start that is missing or no date counts as the default start."""

    def day(header: str) -> Column:
        cell = column(df, (header,))
        none = F.lit(None).cast("date")
        return none if cell is None else dates.iso_date(cell, strict_dates, this_year)

    start = F.coalesce(day("Valid From"), F.lit(dt.date.fromisoformat(defaults.start)))
    name = column(df, ("Clearance",))
    given = {
        model.USER_KEY: F.col(model.USER_KEY),
        "clearance": F.lit(defaults.clearance)
        if name is None
        else text.normalise(name, defaults.clearance),
        "valid_from": start,
        "valid_to": dates.open_ended(start, day("Valid To")),
    }
    return typed_rows(_resolved(df, users), model.USER_CLEARANCE, order, given=given)


def availability_rows(
    df: DataFrame,
    users: DataFrame,
    run_time: dt.datetime,
    order: Sequence[str] = FILE_ORDER,
    strict_dates: bool = False,
    this_year: int = dates.THIS_YEAR,
    defaults: model.Defaults = model.DEFAULTS,
) -> DataFrame:
    source = column(df, ("Source",))
    given = {
        model.USER_KEY: F.col(model.USER_KEY),
        "source": F.lit(defaults.source)
        if source is None
        else text.normalise(source, defaults.source),
        "updated_at": F.lit(run_time).cast("timestamp"),
    }
    return typed_rows(
        _resolved(df, users),
        model.USER_AVAILABILITY,
        order,
        strict_dates=strict_dates,
        this_year=this_year,
        given=given,
    )

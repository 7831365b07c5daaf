"""Rows derived from the tables: calendars, section summaries, ladders, export layouts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillmill import model
from skillmill.functions.career import career_ladder
from skillmill.functions.numbers import clamp_percent
from skillmill.functions.text import map_pick
from skillmill.operators.lookup import lookup


def availability_calendar(
    users: DataFrame,
    key: str,
    weekday_percent: Column,
    start: dt.date,
    days: int = 60,
) -> DataFrame:
    """One row per person and day: weekends are free, weekdays carry the person's percentage."""
    first = F.lit(start)
    spread = users.select(
        key,
        weekday_percent.alias("_percent"),
        F.explode(F.sequence(first, F.date_add(first, days - 1))).alias("date"),
    )
    return spread.select(
        key,
        "date",
        F.when(F.weekday("date") >= 5, F.lit(100))
        .otherwise(clamp_percent(F.col("_percent")))
        .alias("percent_available"),
    )


def positions_from_title(
    cvs: DataFrame, title: Column, start_year: Column, keep: Sequence[str] = (model.CV_KEY,)
) -> DataFrame:
    """One row per rung of the ladder to ``title``, a year each from ``start_year``."""
    rungs = cvs.select(
        *keep, start_year.alias("_start"), F.posexplode(career_ladder(title)).alias("_at", "name")
    )
    return rungs.select(
        *keep,
        (F.col("_at") + 1).alias("rung"),
        "name",
        (F.col("_start") + F.col("_at")).alias("year_from"),
        (F.col("_start") + F.col("_at") + 1).alias("year_to"),
    )


def section_summary(
    sections: Mapping[str, DataFrame],
    key: str = model.CV_KEY,
    updated: str = "updated_by_owner",
    cvs: DataFrame | None = None,
) -> DataFrame:
    """Per CV: rows of each section and the last day its owner changed one.

    With ``cvs`` every CV has a row, those without section rows with counts of 0.

    The sections are stacked and reduced in one aggregate, in place of an outer
    join per section.
    """
    stacked = None
    for name, df in sections.items():
        day = F.col(updated) if updated in df.columns else F.lit(None)
        part = df.select(key, F.lit(name).alias("_section"), day.cast("date").alias("_day"))
        stacked = part if stacked is None else stacked.unionByName(part)
    columns = []
    for name in sections:
        here = F.col("_section") == name
        columns += [
            F.count(F.when(here, 1)).cast("int").alias(f"{name}_count"),
            F.max(F.when(here, F.col("_day"))).alias(f"{name}_updated"),
        ]
    found = stacked.groupBy(key).agg(*columns)
    if cvs is None:
        return found
    every = cvs.select(key).distinct().join(found, key, "left")
    return every.fillna(0, subset=[f"{name}_count" for name in sections])


def with_headers(df: DataFrame, table: model.Table) -> DataFrame:
    """A stored table under the headers it is delivered with, every value as text."""
    columns = []
    for field in table.fields:
        if not field.headers:
            continue
        value = F.col(field.name)
        if field.kind == "multilang":
            written = F.transform(
                F.map_entries(value), lambda e: F.concat(e["key"], F.lit(":"), e["value"])
            )
            value = F.array_join(written, "|")
        elif field.kind == "json_text":
            value = F.get_json_object(value, "$")
        columns.append(value.cast("string").alias(field.headers[-1]))
    if table is model.USERS:
        columns.append(map_pick(F.col("name_multilang")).alias("Name"))
    return df.select(*columns)


def report_layout(users: DataFrame, cvs: DataFrame, section: DataFrame | None = None) -> DataFrame:
    """Export rows: the base columns of user and CV in front of the section columns.

    All inputs carry report headers; a base column that neither side has is blank.
    A section column with a base header, such as ``Name``, holds the section's value in
    both places, the second under the header a reader gives a repeated one.
    """
    user_id, cv_id = "CV Partner User ID", "CV Partner CV ID"
    cv_columns = [c for c in model.BASE_HEADERS if c in cvs.columns]
    people = users.select(
        user_id,
        *[c for c in model.BASE_HEADERS if c in users.columns and c not in cv_columns and c != user_id],
    )
    base = lookup(cvs.select(*cv_columns), people, f"{user_id}", "inner")
    rest: list[str] = []
    if section is not None:
        own = [c for c in section.columns if c != cv_id]
        rest = [c for c in own if c not in model.BASE_HEADERS]
        repeated = [c for c in own if c in model.BASE_HEADERS]
        if repeated:
            rest += [f"{c}.1" for c in repeated]
        renamed = section.select(
            cv_id, *[F.col(f"`{c}`").alias(f"{c}.1" if c in repeated else c) for c in own]
        )
        base = lookup(renamed, base, cv_id, "inner")
    shown = {c: f"{c}.1" if f"{c}.1" in rest else c for c in model.BASE_HEADERS}
    return base.select(
        *[
            F.col(f"`{shown[c]}`").alias(c) if c in base.columns else F.lit(None).cast("string").alias(c)
            for c in model.BASE_HEADERS
        ],
        *[F.col(f"`{c}`") for c in rest],
    )

"""The search profile: one row per CV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillmill import model
from skillmill.functions.text import map_pick
from skillmill.operators.lookup import lookup, surrogate_id


def latest_availability(availability: DataFrame, key: str = model.USER_KEY) -> DataFrame:
    """Newest day and its percentage per person; (person, date) is unique.

    Both aggregates keep fixed-width state, so this is one hash aggregate with a
    map-side part, where a window would ship and sort every day of every person.
    """
    return availability.groupBy(key).agg(
        F.max("date").alias("latest_availability_date"),
        F.max_by("percent_available", "date").alias("latest_percent_available"),
    )


def highest_clearance(
    clearances: DataFrame, key: str = model.USER_KEY, collation: str | None = None
) -> DataFrame:
    """Last clearance name in text order, expired ones included."""
    name = F.col("clearance")
    if collation:
        name = F.collate(name, collation)
    return clearances.groupBy(key).agg(F.max(name).cast("string").alias("clearance"))


def skills(technologies: DataFrame, key: str = model.CV_KEY) -> DataFrame:
    """Ordered list of technologies and longest experience per CV; (CV, technology) is unique."""
    return technologies.groupBy(key).agg(
        F.expr("listagg(technology, ', ') WITHIN GROUP (ORDER BY technology)").alias(
            "technologies"
        ),
        F.max("years_experience").alias("max_years_experience"),
    )


def search_profile(
    users: DataFrame,
    cvs: DataFrame,
    technologies: DataFrame,
    clearances: DataFrame,
    availability: DataFrame,
    collation: str | None = None,
) -> DataFrame:
    """One row per CV.

    Every branch is reduced to one row per person or CV before it is joined, so
    technologies and clearances never multiply each other.  The person side is
    put together first and looked up once from the CVs.
    """
    def own_id(df: DataFrame, key: str) -> Column:
        # Stored tables know their ids; others have them made.
        name = model.id_column(key)
        return (F.col(name) if name in df.columns else surrogate_id(F.col(key))).alias(name)

    people = (
        users.select(
            own_id(users, model.USER_KEY), model.USER_KEY, map_pick(F.col("name_multilang")).alias("user_name"), "country"
        )
        .join(highest_clearance(clearances, collation=collation), model.USER_KEY, "left")
        .join(latest_availability(availability), model.USER_KEY, "left")
    )
    resumes = cvs.select(
        own_id(cvs, model.CV_KEY),
        model.CV_KEY,
        model.USER_KEY,
        map_pick(F.col("title_multilang")).alias("cv_title"),
        "sfia_level",
        "cpd_label",
    )
    return (
        lookup(resumes, people, model.USER_KEY, "inner")
        .join(skills(technologies), model.CV_KEY, "left")
        .select(
            "user_id",
            model.USER_KEY,
            "user_name",
            "cv_id",
            model.CV_KEY,
            "cv_title",
            "sfia_level",
            "cpd_label",
            "country",
            "technologies",
            "max_years_experience",
            "clearance",
            "latest_availability_date",
            "latest_percent_available",
        )
    )


def numeric_subset(profile: DataFrame) -> DataFrame:
    """Profiles of people whose id is a number."""
    return profile.filter(F.col(model.USER_KEY).rlike("^[0-9]+$"))


def is_cleared_and_available(clearance: str = "SC", percent: int = 50) -> Column:
    return (F.col("clearance") == clearance) & (F.col("latest_percent_available") >= percent)

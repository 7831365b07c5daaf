"""Headline figures of a load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skillmill.plans.profile import is_cleared_and_available


def top_skills(technologies: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most held technologies (name, cnt); names break ties."""
    return (
        technologies.groupBy(F.col("technology").alias("name"))
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), "name")
        .limit(n)
    )


def row_counts(users: DataFrame, cvs: DataFrame) -> DataFrame:
    return _count("users", users).unionByName(_count("cvs", cvs))


def cleared_and_available(profile: DataFrame) -> DataFrame:
    return _count("sc_available", profile.filter(is_cleared_and_available()))


def mean_availability(availability: DataFrame) -> DataFrame:
    mean = F.coalesce(F.avg("percent_available"), F.lit(0.0))
    return availability.agg(mean.alias("value")).select(F.lit("mean_availability").alias("metric"), "value")


def _count(metric: str, df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
        F.lit(metric).alias("metric"), "value"
    )


def headline_figures(
    users: DataFrame,
    cvs: DataFrame,
    technologies: DataFrame,
    profile: DataFrame,
    availability: DataFrame,
) -> DataFrame:
    """All figures as (metric, value); one row per top skill, named ``top_skill:<name>``."""
    skills = top_skills(technologies).select(
        F.concat(F.lit("top_skill:"), "name").alias("metric"), F.col("cnt").cast("double").alias("value")
    )
    return (
        row_counts(users, cvs)
        .unionByName(skills)
        .unionByName(cleared_and_available(profile))
        .unionByName(mean_availability(availability))
    )

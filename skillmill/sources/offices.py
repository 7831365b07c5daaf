"""Office ids from landed country documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTRY_SCHEMA = "code string, offices array<struct<_id: string, name: string>>"


def flatten_offices(countries: DataFrame) -> DataFrame:
    """One row (office_id) per office that has an id."""
    return (
        countries.select(F.explode("offices").alias("office"))
        .select(F.col("office._id").alias("office_id"))
        .filter(F.col("office_id").isNotNull() & (F.col("office_id") != ""))
    )


def office_ids(
    spark: SparkSession, path: str | None, configured: Sequence[str] = ()
) -> DataFrame:
    """Configured ids where given, else those in the landed JSON document."""
    if configured:
        return spark.createDataFrame([(i,) for i in configured], "office_id string")
    countries = spark.read.schema(COUNTRY_SCHEMA).option("multiLine", True).json(path)
    return flatten_offices(countries)

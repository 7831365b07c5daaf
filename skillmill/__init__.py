"""skillmill: people, CV and skills reporting on Spark DataFrames."""

from skillmill.session import get_spark

__all__ = ["get_spark"]

"""Quarterly snapshot selection and report completeness."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillmill.sources.paths import child_names, join_path

# Fixed value: a snapshot folder name starts with a quarter and a year.
SNAPSHOT_PATTERN = r"^Q([1-4])(\d{4})"

# The reports the people system delivers.
DELIVERED_REPORTS = (
    "user_report",
    "usage_report",
    "project_experiences",
    "certifications",
    "courses",
    "languages",
    "technologies",
    "key_qualifications",
    "educations",
    "work_experiences",
    "positions",
    "blogs",
    "cv_roles",
)

# Reports that come from other systems.
OTHER_REPORTS = ("sc_clearance", "availability_report")


def quarter_of(folder: Column) -> Column:
    """(year, quarter) in a folder name, null where the name is no snapshot."""

    def number(group: int) -> Column:
        return F.regexp_extract(folder, SNAPSHOT_PATTERN, group).cast("int")

    return F.when(
        folder.rlike(SNAPSHOT_PATTERN),
        F.struct(number(2).alias("year"), number(1).alias("quarter")),
    )


def latest_snapshot(folders: DataFrame, column: str = "folder") -> DataFrame:
    """The newest snapshot as one row (folder, year, quarter); names break ties."""
    return (
        folders.select(quarter_of(F.col(column)).alias("q"), F.col(column).alias("folder"))
        .filter(F.col("q").isNotNull())
        .agg(F.max(F.struct("q.year", "q.quarter", "folder")).alias("m"))
        .filter(F.col("m").isNotNull())
        .select("m.folder", "m.year", "m.quarter")
    )


def find_latest_snapshot(spark: SparkSession, base: str) -> str:
    names = child_names(spark, base, dirs_only=True)
    found = latest_snapshot(spark.createDataFrame([(n,) for n in names], "folder string")).first()
    if found is None:
        raise FileNotFoundError(f"no quarterly snapshot folder in {base}")
    return join_path(base, found["folder"])


def missing_reports(
    found: DataFrame, snapshot: str = "snapshot", report: str = "report",
    expected: tuple[str, ...] = DELIVERED_REPORTS, snapshots: DataFrame | None = None,
) -> DataFrame:
    """(snapshot, report) pairs expected but not found.

    ``snapshots`` names the snapshots there are; one without any file then lacks all reports.  Without it only
    snapshots with a file are known.  A snapshot keeps at most the expected names, so its set stays small however
    many files it holds.
    """
    wanted = F.array(*[F.lit(r) for r in expected])
    files = found.select(snapshot, report)
    if snapshots is not None:
        # A snapshot is a row of its own with no report, so it needs no join.
        files = files.unionByName(snapshots.select(snapshot, F.lit(None).cast("string").alias(report)))
    return (
        files.groupBy(snapshot)
        .agg(F.collect_set(F.when(F.col(report).isin(*expected), F.col(report))).alias("_have"))
        .select(snapshot, F.explode(F.array_except(wanted, "_have")).alias(report))
    )


def landed_files(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """(snapshots there are, (snapshot, report) of their files) below ``base``."""
    folders = [n for n in child_names(spark, base, dirs_only=True) if re.match(SNAPSHOT_PATTERN, n)]
    files = [(f, n.removesuffix(".csv")) for f in folders for n in child_names(spark, join_path(base, f)) if n.endswith(".csv")]
    return (
        spark.createDataFrame([(f,) for f in folders], "snapshot string"),
        spark.createDataFrame(files, "snapshot string, report string"),
    )

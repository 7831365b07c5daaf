"""Versioned Parquet tables that are published all at once.

A run writes its tables under ``v=<run>/`` and then one manifest that names the
paths of every table.  Spark commits the manifest as its last step, so readers see
the previous version until then and a failed run leaves nothing behind that is read.

A table is one path, or one path a part.  A run writes only the parts it changes and names the
others where an earlier run has left them, so history is not copied from version to version.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillmill.sources.paths import child_names, exists, join_path, qualified, remove

_MANIFEST_SCHEMA = "run string, table_name string, part string, path string"
_PART = "part"

#: The part of a table that has no parts, or the empty file that tells the columns of one that has.
WHOLE = ""

Paths = Mapping[str, Mapping[str, str]]


class Warehouse:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root

    def _manifest(self) -> DataFrame | None:
        path = join_path(self.root, "manifest")
        if not exists(self.spark, path):
            return None
        return self.spark.read.schema(_MANIFEST_SCHEMA).json(path)

    def current_run(self) -> str | None:
        manifest = self._manifest()
        return None if manifest is None else manifest.agg(F.max("run")).first()[0]

    def paths(self) -> dict[str, dict[str, str]]:
        """Paths by table and part of the published version, empty before the first one."""
        run = self.current_run()
        if run is None:
            return {}
        # One row per table and part of one run: bounded by the data model and the calendar.
        found: dict[str, dict[str, str]] = {}
        for row in self._manifest().filter(F.col("run") == run).collect():
            found.setdefault(row["table_name"], {})[row["part"] or WHOLE] = row["path"]
        return found

    def read(self, paths: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*paths)

    def table(self, name: str) -> DataFrame | None:
        """A published table, or None."""
        parts = self.paths().get(name)
        return None if parts is None else self.read(list(parts.values()))

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(list(parts.values())) for name, parts in self.paths().items()}

    def stage(self, run: str, name: str, df: DataFrame) -> DataFrame:
        """Writes a table of an unpublished version and reads it back, which cuts its lineage."""
        path = self.staged_path(run, name)
        df.write.mode("overwrite").parquet(path)
        return self.read([path], df.schema)

    def stage_parts(self, run: str, name: str, df: DataFrame, part: Column) -> dict[str, str]:
        """Writes the rows by ``part``; gives the path of each part that has rows."""
        path = self.staged_path(run, name)
        # Spark deals the rows out by part, and splits parts that are large.
        dealt = df.withColumn(_PART, part.cast("string")).hint("rebalance", _PART)
        dealt.write.mode("overwrite").partitionBy(_PART).parquet(path)
        found = child_names(self.spark, path, dirs_only=True)
        return {n.removeprefix(f"{_PART}="): join_path(path, n) for n in found if n.startswith(f"{_PART}=")}

    def staged_path(self, run: str, name: str) -> str:
        return join_path(self.root, f"v={run}", name)

    def publish(self, run: str, paths: Paths) -> None:
        """Makes ``paths`` the current version; versions are ordered by name."""
        current = self.current_run()
        if current is not None and run <= current:
            raise ValueError(f"version {run} is not newer than {current}")
        rows = [(run, name, part, path) for name, parts in sorted(paths.items()) for part, path in sorted(parts.items())]
        manifest = self.spark.createDataFrame(rows, _MANIFEST_SCHEMA).coalesce(1)
        manifest.write.mode("error").json(join_path(self.root, "manifest", f"published={run}"))

    def discard(self, run: str) -> None:
        """Removes what a run has staged that was not published."""
        if run != self.current_run():
            remove(self.spark, join_path(self.root, f"v={run}"))

    def clear(self, keep: int) -> list[str]:
        """Removes what no manifest of the last ``keep`` versions names; gives what was removed.

        That is the working tables of published runs, tables and parts that later versions have replaced,
        and older manifests.  Runs newer than the published one may be at work and stay as they are.
        """
        current = self.current_run()
        if keep < 1 or current is None:
            return []
        manifests = join_path(self.root, "manifest")
        published = [n for n in child_names(self.spark, manifests, dirs_only=True) if n.startswith("published=")]
        old, kept = published[:-keep], [n.removeprefix("published=") for n in published[-keep:]]
        # One row per table and part of the versions kept.
        rows = self._manifest().filter(F.col("run").isin(*kept)).select("path").distinct().collect()
        named = {qualified(self.spark, row["path"]) for row in rows}
        # Manifests go first: a reader then never finds one whose tables are gone.
        removed = [join_path(manifests, n) for n in old]
        for folder in child_names(self.spark, self.root, dirs_only=True):
            if folder.startswith("v=") and folder.removeprefix("v=") <= current:
                removed += self._unnamed(join_path(self.root, folder), named)
        for path in removed:
            remove(self.spark, path)
        return removed

    def _unnamed(self, folder: str, named: set[str]) -> list[str]:
        """The highest folders at or below ``folder`` that hold nothing named."""
        here = qualified(self.spark, folder)
        if here in named:
            return []
        if not any(path.startswith(f"{here}/") for path in named):
            return [folder]
        below = child_names(self.spark, folder, dirs_only=True)
        return [path for name in below for path in self._unnamed(join_path(folder, name), named)]


def write_report(df: DataFrame, path: str) -> None:
    """A report as CSV part files, each with the header; nulls are blank cells, blanks in cells stay."""
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    for side in ("ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"):
        writer = writer.option(side, False)
    writer.option("emptyValue", "").csv(path)

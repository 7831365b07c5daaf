"""The whole job: newest snapshot to published tables, profile and figures."""

from __future__ import annotations

import argparse
import datetime as dt
import logging
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skillmill import model
from skillmill.operators.identifiers import SCHEMA as EXCEPTIONS_SCHEMA
from skillmill.operators.identifiers import settle
from skillmill.operators.lookup import known_only
from skillmill.operators.quality import broken, row_checks
from skillmill.plans import kpi, profile, tables, transform
from skillmill.plans.export import export_snapshot
from skillmill.session import get_spark
from skillmill.sources.reports import FILE_ORDER, extract, malformed_records
from skillmill.sources.snapshots import DELIVERED_REPORTS, OTHER_REPORTS
from skillmill.sources.warehouse import WHOLE, Warehouse

log = logging.getLogger(__name__)

# Tables that do not need each other are written at the same time, so that a
# small one does not leave the cluster idle.
PARALLEL_TABLES = 8

PROFILE = "cv_search_profile_mv"
FIGURES = "kpi"
EXCEPTIONS = "id_exceptions"
_REJECT_SCHEMA = "table_name string, problem string, row string, file string, block long, record long"
_SKIPPED_SCHEMA = "table_name string, parent string, rows long"


class LoadError(RuntimeError):
    """The load was stopped and nothing was published."""


@dataclass
class RunResult:
    run: str
    snapshot: str
    paths: dict[str, dict[str, str]]
    rejected: int
    figures: dict[str, float] = field(default_factory=dict)


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _retained() -> tuple[str, ...]:
    """Tables that carry over from one version to the next."""
    kept = [t for t in model.TABLES if t.retained]
    return (*[t.name for t in kept], *[f.dimension for t in kept for f in t.dimensions])


class Load:
    """The tables of a new version: what is staged, where it lies, and what was set aside."""

    def __init__(
        self, spark: SparkSession, warehouse: Warehouse, run: str, run_time: dt.datetime,
        strict_headers: bool = False, strict_dates: bool = False, defaults: model.Defaults = model.DEFAULTS,
    ) -> None:
        self.spark, self.warehouse, self.run, self.run_time = spark, warehouse, run, run_time
        self.spelling = {"strict_dates": strict_dates, "this_year": run_time.year}
        self.options = {"strict_headers": strict_headers, **self.spelling}
        self.defaults = defaults
        self.published = warehouse.paths()
        self.done: dict[str, DataFrame] = {}
        self.paths: dict[str, dict[str, str]] = {}
        self.scans: dict[str, DataFrame] = {}
        self.malformed: list[DataFrame] = []
        self.typed: dict[str, list[tuple[model.Table, DataFrame]]] = {}
        self.nobody: list[DataFrame] = []
        self.naming: dict[str, DataFrame] = {}
        self.findings: list[tuple[str, str, str, int]] = []
        self.exceptions: dict[str, DataFrame] = {}
        if EXCEPTIONS in self.published:
            known = self.before(EXCEPTIONS)
            # One row per id column: bounded by the model.
            for row in known.select("id_name").distinct().collect():
                self.exceptions[row["id_name"]] = known.filter(F.col("id_name") == row["id_name"]).select("natural", "id")

    def before(self, name: str) -> DataFrame | None:
        parts = self.published.get(name)
        return None if parts is None else self.warehouse.read(list(parts.values()))

    def keep(self, name: str, df: DataFrame, at: str | None = None) -> DataFrame:
        """Stages a table as one path."""
        at = at or name
        self.done[name] = self.warehouse.stage(self.run, at, df)
        self.paths[name] = {WHOLE: self.warehouse.staged_path(self.run, at)}
        return self.done[name]

    def carry(self, name: str) -> None:
        """Names a table where the version of before has it."""
        self.paths[name] = dict(self.published[name])
        self.done[name] = self.before(name)

    def observed(self, table: model.Table, built: DataFrame) -> tuple[DataFrame, Observation]:
        seen = Observation()
        return built.observe(seen, *row_checks(table)), seen

    def store(self, table: model.Table, rows: DataFrame, parents: DataFrame | None, scan: DataFrame | None = None) -> None:
        # Typed rows are written once: the reports are parsed a single time, and
        # the table, its rejects and an upsert that reads the batch twice share them.
        typed = self.warehouse.stage(self.run, f"rows/{table.name}", rows)
        if table.retained:
            self.store_history(table, typed)
        else:
            built, seen = self.observed(table, tables.build(table, typed, parents, exceptions=self.exceptions))
            self.keep(table.name, built)
            self.findings += broken(table.name, seen.get)
        if scan is not None:
            # Only records that could be read got as far as finding their person.
            self.malformed.append(malformed_records(scan, table.name))
        elif table is not model.CVS:  # users and CVs come from the same report
            self.malformed.append(tables.malformed(table, typed))
        self.scans[table.name] = typed if scan is None else scan
        parent = "" if parents is None else table.parent
        self.typed.setdefault(parent, []).append((table, typed))
        if table.dimensions:
            self.naming[table.name] = tables.named(table, typed, parents)

    def store_history(self, table: model.Table, typed: DataFrame) -> None:
        """Rewrites the periods that the batch touches; the others stay where they are.

        The day is part of the key, so a row can only replace one of its own period.
        """
        name, (day, length) = table.name, table.period
        part = F.date_format(day, {"year": "yyyy", "month": "yyyy-MM"}[length])
        good = typed.filter(F.col(transform.REJECT).isNull())
        # One row per period: bounded by the calendar.
        touched = [row["part"] for row in good.select(part.alias("part")).distinct().collect()]
        held = self.published.get(name, {})
        old = [held[p] for p in touched if p in held]
        existing = self.warehouse.read(old) if old else None
        built = tables.build(table, typed, None, existing, exceptions=self.exceptions)
        parts = dict(held)
        if touched:
            built, seen = self.observed(table, built)
            parts |= self.warehouse.stage_parts(self.run, name, built, part)
            self.findings += broken(name, seen.get)
        if WHOLE not in parts:
            columns = f"{name}.columns"
            self.warehouse.stage(self.run, columns, _empty(self.spark, model.schema(table)))
            parts[WHOLE] = self.warehouse.staged_path(self.run, columns)
        self.paths[name] = parts
        self.done[name] = self.warehouse.read(list(parts.values()), model.schema(table))

    def store_report(self, table: model.Table, report: DataFrame | None) -> None:
        users, cvs = self.done["users"], self.done["cvs"]
        if report is None:
            if table.name in self.published and table.retained:
                self.carry(table.name)
            elif table.retained:
                self.store_history(table, transform.typed_rows(_no_rows(self.spark), table))
            else:
                self.keep(table.name, _empty(self.spark, model.schema(table)))
        elif table.retained:
            # Finding the person reads the rows twice, so the report is parsed first.
            raw = self.warehouse.stage(self.run, f"raw/{table.name}", report)
            if table is model.USER_CLEARANCE:
                rows = transform.clearance_rows(raw, users, defaults=self.defaults, **self.spelling)
            else:
                rows = transform.availability_rows(raw, users, self.run_time, defaults=self.defaults, **self.spelling)
            self.store(table, rows, None, raw)
            self.nobody.append(transform.unresolved_people(raw, users, table))
        else:
            self.store(table, transform.typed_rows(report, table, **self.options), cvs)

    def store_dimension(self, name: str) -> None:
        existing = self.before(name) if name in _retained() else None
        used = any(f.dimension == name for t in self.naming for f in model.BY_NAME[t].dimensions)
        if existing is not None and (not used or tables.new_names(name, self.naming, existing).isEmpty()):
            self.carry(name)
        elif used:
            self.keep(name, tables.dimension(name, self.naming, existing, self.exceptions))
        else:
            self.keep(name, _empty(self.spark, model.dimension_schema(name)))

    def settle_ids(self) -> None:
        """Gives keys whose ids clash other ids, in the tables that hold them and for later runs.

        One count per id column and owner; tables are written again only where there are clashes.
        """
        owners = [(model.id_column(k), n, k) for n, k in (("users", model.USER_KEY), ("cvs", model.CV_KEY))]
        owners += [(model.id_column(d), d, "name") for d in model.DIMENSIONS]

        def rows(df: DataFrame, id_name: str, natural: str) -> DataFrame:
            return df.select(F.col(natural).alias("natural"), F.col(id_name).alias("id"))

        def moved(owner: tuple[str, str, str]) -> DataFrame | None:
            id_name, name, natural = owner
            before = self.before(name)
            mine = rows(self.done[name], id_name, natural)
            if id_name in self.exceptions:
                # Ids given away earlier stay taken, also where their key is not in this version.
                gone = self.exceptions[id_name].join(mine, "natural", "left_anti").select("natural", "id")
                mine = mine.unionByName(gone)
            return settle(mine, None if before is None else rows(before, id_name, natural))

        with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
            found = {o: m for o, m in zip(owners, pool.map(moved, owners)) if m is not None}
        known = [df.select(F.lit(n).alias("id_name"), "natural", "id") for n, df in self.exceptions.items()]
        for (id_name, name, _), exceptions in found.items():
            log.warning("ids of %s clash and were given anew", name)
            stored = self.warehouse.stage(self.run, f"rows/exceptions/{id_name}", exceptions)
            if id_name in self.exceptions:
                earlier = self.exceptions[id_name].join(stored, "natural", "left_anti")
                stored = earlier.unionByName(stored)
                known = [k for k in known if k.filter(F.col("id_name") == id_name).isEmpty()]
            self.exceptions[id_name] = stored
            known.append(stored.select(F.lit(id_name).alias("id_name"), "natural", "id"))
        if not found:
            if EXCEPTIONS in self.published:
                self.carry(EXCEPTIONS)
            else:
                self.keep(EXCEPTIONS, _empty(self.spark, EXCEPTIONS_SCHEMA))
            return
        self.keep(EXCEPTIONS, reduce(DataFrame.unionByName, known))
        changed = {id_name for id_name, *_ in found}
        for table in model.TABLES:
            if changed & set(model.ids(table)):
                self.renumber(table)
        for id_name, name, natural in owners:
            if natural == "name" and id_name in changed:
                self.keep(name, tables.dimension_ids(name, self.done[name].select("name"), self.exceptions), f"{name}.ids")

    def renumber(self, table: model.Table) -> None:
        """Writes the ids of a staged table anew; parts of earlier runs name no key that lost its id."""
        if not table.retained:
            self.keep(table.name, tables.with_ids(table, self.done[table.name], self.exceptions), f"{table.name}.ids")
            return
        mine = f"{self.warehouse.staged_path(self.run, table.name)}/"
        fresh = [path for path in self.paths[table.name].values() if path.startswith(mine)]
        if fresh:
            day, length = table.period
            part = F.date_format(day, {"year": "yyyy", "month": "yyyy-MM"}[length])
            rows = tables.with_ids(table, self.warehouse.read(fresh, model.schema(table)), self.exceptions)
            parts = self.paths[table.name] | self.warehouse.stage_parts(self.run, f"{table.name}.ids", rows, part)
            self.paths[table.name] = parts
            self.done[table.name] = self.warehouse.read(list(parts.values()), model.schema(table))

    def from_reports(self, reports: Mapping[str, DataFrame]) -> None:
        user_report = transform.require_users(reports)
        usage = reports.get(transform.USAGE_REPORT)
        if usage is not None:
            usage = self.warehouse.stage(self.run, "raw/usage", usage)
            self.malformed.append(malformed_records(usage, "usage_report"))
            self.scans["usage_report"] = usage
        self.store(model.USERS, transform.user_rows(user_report, usage, **self.options), None)
        self.store(model.CVS, transform.cv_rows(user_report, **self.options), self.done["users"])
        others = (*model.SECTIONS, *[t for t in model.TABLES if t.retained])
        with ThreadPoolExecutor(PARALLEL_TABLES) as pool:
            list(pool.map(lambda t: self.store_report(t, reports.get(t.report)), others))
            list(pool.map(self.store_dimension, model.DIMENSIONS))
        self.settle_ids()
        self.set_aside()

    def set_aside(self) -> None:
        """Stages the rows that cannot be stored and the counts of those whose parent is unknown.

        The rows of all tables are put together before they are joined, so the joins are as many as there are parents.
        """
        bad, lost = list(self.malformed), list(self.nobody)
        for parent, typed in self.typed.items():
            rows = reduce(DataFrame.unionByName, [tables.unstorable(t, df) for t, df in typed])
            if parent:
                key = {"users": model.USER_KEY, "cvs": model.CV_KEY}[parent]
                known = self.done[parent].select(F.col(key).alias("parent"))
                rows = known_only(rows, known, "parent")
                pointing = reduce(DataFrame.unionByName, [tables.pointers(t, df) for t, df in typed])
                lost.append(tables.missing_parents(pointing, known))
            bad.append(rows.drop("parent"))
        scans = [df.select(F.lit(n).alias("table_name"), *FILE_ORDER) for n, df in self.scans.items()]
        placed = tables.placed(reduce(DataFrame.unionByName, bad), reduce(DataFrame.unionByName, scans))
        self.keep("rejects", placed.to(_schema(_REJECT_SCHEMA)))
        self.keep("skipped", reduce(DataFrame.unionByName, lost, _empty(self.spark, _schema(_SKIPPED_SCHEMA))))


def _schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


def _no_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"{', '.join(f'{c} {t}' for c, t in zip(FILE_ORDER, ('string', 'long', 'long')))}")


def load(
    spark: SparkSession,
    reports: Mapping[str, DataFrame],
    warehouse: Warehouse,
    run: str,
    run_time: dt.datetime,
    on_violation: str = "fail",
    strict_headers: bool = False,
    strict_dates: bool = False,
    defaults: model.Defaults = model.DEFAULTS,
) -> tuple[Load, int]:
    """Stages every table of a new version; gives what is staged and the number of rejected rows."""
    if on_violation not in ("fail", "quarantine"):
        raise ValueError(f"on_violation is 'fail' or 'quarantine', not {on_violation!r}")
    staged = Load(spark, warehouse, run, run_time, strict_headers, strict_dates, defaults)
    staged.from_reports(reports)
    rejects = staged.done["rejects"]
    count = rejects.count()
    if count and on_violation == "fail":
        # One row per table and column: bounded by the model.
        column = F.explode(F.split("problem", ", ")).alias("column")
        problems = sorted(rejects.select("table_name", column).groupBy("table_name", "column").count().collect())
        raise LoadError(f"{count} rows cannot be stored: {[tuple(p) for p in problems]}")
    if staged.findings:
        raise LoadError(f"checks failed: {staged.findings}")
    return staged, count


def parents_of() -> dict[str, tuple[str, str]]:
    """Parent table and shared key per table; retained tables may outlive their people."""
    keys = {"users": model.USER_KEY, "cvs": model.CV_KEY}
    return {
        t.name: (t.parent, keys[t.parent]) for t in model.TABLES if t.parent and not t.retained
    }


def refresh_profile(done: Mapping[str, DataFrame], collation: str | None = None) -> DataFrame:
    return profile.search_profile(
        done["users"],
        done["cvs"],
        done["cv_technology"],
        done["user_clearance"],
        done["user_availability"],
        collation,
    )


def run_snapshot(
    spark: SparkSession,
    reports_dir: str,
    warehouse_dir: str,
    run_time: dt.datetime,
    snapshot: str | None = None,
    refresh: bool = True,
    on_violation: str = "fail",
    strict_headers: bool = False,
    strict_dates: bool = False,
    multi_line: bool = True,
    collation: str | None = None,
    keep_versions: int = 2,
    defaults: model.Defaults = model.DEFAULTS,
) -> RunResult:
    """Reads the newest (or the named) snapshot and publishes a new version of all tables.

    ``run_time`` names the version and stamps the rows.  A failure before the end
    leaves the published version as it was and removes what was staged; only the profile and the
    figures may fail without stopping the run, and the profile of before then stays.  Afterwards what the last
    ``keep_versions`` versions do not name is removed; 0 keeps everything.
    """
    run = run_time.strftime("%Y%m%dT%H%M%S%f")
    warehouse = Warehouse(spark, warehouse_dir)
    if run <= (warehouse.current_run() or ""):
        raise ValueError(f"run {run} is not newer than the published version")
    folder, reports = extract(spark, reports_dir, snapshot, multi_line)
    missing = [n for n in (*DELIVERED_REPORTS, *OTHER_REPORTS) if f"{n}.csv" not in reports]
    if missing:
        log.warning("reports missing from %s: %s", folder, ", ".join(missing))
    try:
        staged, rejected = load(
            spark, reports, warehouse, run, run_time, on_violation, strict_headers, strict_dates, defaults
        )
        figures = summarise(staged, refresh, collation)
        warehouse.publish(run, staged.paths)
    except BaseException:
        warehouse.discard(run)
        raise
    if keep_versions:
        warehouse.clear(keep_versions)
    return RunResult(run, folder, staged.paths, rejected, figures)


def summarise(staged: Load, refresh: bool, collation: str | None) -> dict[str, float]:
    """Stages the profile and the figures; either may fail without stopping the run."""
    done = staged.done
    if refresh:
        try:
            staged.keep(PROFILE, refresh_profile(done, collation))
        except Exception as error:
            log.warning("could not refresh the profile: %s", error)
    if PROFILE not in staged.paths and PROFILE in staged.published:
        staged.carry(PROFILE)
    elif PROFILE not in staged.paths:
        # The first run without a refresh: the profile is there, and empty.
        staged.keep(PROFILE, refresh_profile(done, collation).limit(0))
    try:
        found = staged.keep(
            FIGURES,
            kpi.headline_figures(
                done["users"], done["cvs"], done["cv_technology"], done[PROFILE], done["user_availability"]
            ),
        )
        figures = {row["metric"]: row["value"] for row in found.collect()}
        log.info("figures: %s", figures)
        return figures
    except Exception as error:
        log.warning("could not compute the figures: %s", error)
        staged.paths.pop(FIGURES, None)
        return {}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load the newest report snapshot.")
    parser.add_argument("reports_dir")
    parser.add_argument("warehouse_dir")
    parser.add_argument("--snapshot", help="folder name to load in place of the newest quarter")
    parser.add_argument("--skip-refresh", action="store_true", help="keep the profile of before")
    parser.add_argument("--quarantine", action="store_true", help="set bad rows aside, do not stop")
    parser.add_argument("--strict-headers", action="store_true")
    parser.add_argument("--strict-dates", action="store_true")
    parser.add_argument("--export", help="folder for the published tables, written back as reports")
    parser.add_argument("--keep-versions", type=int, default=2, help="versions that stay readable, 0 for all")
    for name in ("source", "clearance", "start"):
        parser.add_argument(f"--default-{name}", default=getattr(model.DEFAULTS, name))
    parser.add_argument("--single-line", action="store_true", help="no cell holds a line break")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO)
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = get_spark()
    result = run_snapshot(
        spark,
        args.reports_dir,
        args.warehouse_dir,
        run_time=dt.datetime.now(dt.timezone.utc),
        snapshot=args.snapshot,
        refresh=not args.skip_refresh,
        on_violation="quarantine" if args.quarantine else "fail",
        strict_headers=args.strict_headers,
        strict_dates=args.strict_dates,
        multi_line=not args.single_line,
        keep_versions=args.keep_versions,
        defaults=model.Defaults(args.default_source, args.default_clearance, args.default_start),
    )
    log.info("published %s from %s", result.run, result.snapshot)
    if args.export:
        log.info("exported %s", ", ".join(export_snapshot(spark, args.warehouse_dir, args.export)))
    spark.stop()


if __name__ == "__main__":
    main()

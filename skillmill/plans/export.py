"""The published tables written back as reports, under the headers they are delivered with."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillmill import model
from skillmill.functions.text import map_pick, unique_headers
from skillmill.model import BASE_HEADERS
from skillmill.operators.lookup import lookup
from skillmill.plans import derive
from skillmill.sources.paths import join_path
from skillmill.sources.warehouse import Warehouse

_SECTION = ("Nationality", "CV Partner section ID", "External unique ID", "Updated", "Updated by owner")
_PERIOD = ("Month from", "Year from", "Month to", "Year to")

# The columns of each delivered report behind the base columns.
REPORT_HEADERS = {
    "user_report": (
        "User created at", "CV Last updated by owner", "CV Last updated", "Years of education",
        "Years since first work experience", "Access roles", "Has profile image", "Owns a reference project",
        "Read and understood privacy notice", "SFIA Level", "CPD Level", "CPD Band", "CPD Label",
    ),
    "usage_report": (
        "Nationality (#{lang})", "Owner last removed or added a section", "Owner last updated CV", "Last updated CV",
        "Summary Of Qualifications", "Owner last updated Qualifications",
        "Project Experiences", "Unique roles", "Owner last updated Project Experiences",
        "Highlighted roles", "Owner last updated Highlighted roles",
        "Skill categories", "Owner last updated Skill categories",
        "Educations", "Years of education", "Owner last updated Educations",
        "Work experiences", "Years since first work experience", "Owner last updated Work experiences",
        "Certifications", "Owner last updated Certifications", "Courses", "Owner last updated Courses",
        "Presentations", "Owner last updated Presentations", "Recommendations", "Owner last updated Recommendations",
        "Positions", "Owner last updated Positions", "Mentoring", "Owner last updated Mentoring",
        "Publications", "Owner last updated Publications", "Honors and awards", "Owner last updated Honors and awards",
        "Languages", "Owner last updated Languages", "Owner last updated Unique roles",
    ),
    "project_experiences": (
        *_SECTION, *_PERIOD, "Customer (#{lang})", "Customer (int)", "Customer Anonymized (#{lang})", "Customer Anonymized (int)",
        "Description (#{lang})", "Description (int)", "Long description (#{lang})", "Long description (int)",
        "Industry (#{lang})", "Industry (int)", "Project type (#{lang})", "Project type (int)", "Percent allocated",
        "Project extent (individual hours)", "Project extent (hours)", "Project extent total (hours)", "Project extent",
        "Project extent (currency)", "Project extent total", "Project extent total (currency)", "Project area",
        "Project area (unit)", "Highlighted",
    ),
    "certifications": (*_SECTION, "Month", "Year", "Month expire", "Year expire"),
    "courses": (
        *_SECTION, "Month", "Year", "Name", "Organiser", "Long description", "Highlighted",
        "Is official masterdata (in #{lang})", "Attachments",
    ),
    "languages": (*_SECTION, "Highlighted", "Is official masterdata (in #{lang})", "Language", "Level"),
    "technologies": (
        "Nationality", "CV Partner skill ID", "CV Partner skill category ID", "Skill name", "Year experience",
        "Proficiency (0-5)", "Is official masterdata (in #{lang})",
    ),
    "key_qualifications": (*_SECTION, "Label", "Summary of Qualifications", "Short description"),
    "educations": (*_SECTION, *_PERIOD, "Highlighted", "Attachments", "Place of study", "Degree", "Description"),
    "work_experiences": (*_SECTION, *_PERIOD, "Highlighted", "Employer", "Description", "Long Description"),
    "positions": (*_SECTION, "Year from", "Year to", "Highlighted", "Name", "Description"),
    "blogs": (*_SECTION, "Name", "Description", "Highlighted"),
    "cv_roles": ("Nationality", "Updated", "Updated by owner", "Name", "Description", "Highlighted"),
}

# The label of the usage report that counts each table.
USAGE_LABELS = {
    "Project Experiences": "project_experience",
    "Unique roles": "cv_role",
    "Educations": "education",
    "Work experiences": "work_experience",
    "Certifications": "certification",
    "Courses": "course",
    "Positions": "position",
    "Publications": "blog_publication",
    "Languages": "cv_language",
}

USER_ID, CV_ID = "CV Partner User ID", "CV Partner CV ID"


def usage(cvs: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per CV, under the headers of the usage report: rows of each section and the last day its owner changed one.

    Sections that no table holds are counted as 0; days that are not known are blank.
    """
    roles = tables["cv_role"]
    sections = {table: tables[table] for table in USAGE_LABELS.values()}
    sections["highlighted_role"] = roles.filter(F.col("highlighted"))
    sections["key_qualification"] = tables["key_qualification"]
    found = derive.section_summary(sections, cvs=cvs)
    days = [F.col(f"{name}_updated") for name in sections]
    own = cvs.select(
        model.CV_KEY, "cv_last_updated_by_owner", "cv_last_updated", "years_of_education",
        "years_since_first_work_experience",
    )
    joined = lookup(found, own, model.CV_KEY, "inner")
    labelled = {**USAGE_LABELS, "Highlighted roles": "highlighted_role"}
    empty = ("Skill categories", "Presentations", "Recommendations", "Mentoring", "Honors and awards")
    columns = {
        "Owner last removed or added a section": F.greatest(*days),
        "Owner last updated CV": F.col("cv_last_updated_by_owner"),
        "Last updated CV": F.col("cv_last_updated"),
        "Owner last updated Qualifications": F.col("key_qualification_updated"),
        "Years of education": F.col("years_of_education"),
        "Years since first work experience": F.col("years_since_first_work_experience"),
    }
    for label, name in labelled.items():
        columns[label] = F.col(f"{name}_count")
        columns[f"Owner last updated {label}"] = F.col(f"{name}_updated")
    for label in empty:
        columns[label] = F.lit(0)
    return joined.select(F.col(model.CV_KEY).alias(CV_ID), *[v.cast("string").alias(c) for c, v in columns.items()])


def people(users: DataFrame, cvs: DataFrame) -> DataFrame:
    """A row per CV with all columns of its user and its own, under delivered headers."""
    persons = derive.with_headers(users, model.USERS).withColumn(
        "Nationality (#{lang})", F.col("nationality_multilang")
    ).drop("nationality_multilang")
    mine = derive.with_headers(cvs, model.CVS)
    base = lookup(mine, persons, USER_ID, "inner")
    return base.withColumn("Nationality", map_pick(F.expr("str_to_map(`Nationality (#{lang})`, '[|]', ':')")))


def layout(base: DataFrame, headers: Sequence[str], section: DataFrame | None) -> DataFrame:
    """A text column per header, in order, under unique names; a header without a source is blank.

    A header that the section shares with the base, such as ``Name``, holds the section's value in both places.
    """
    names = unique_headers([*BASE_HEADERS, *headers])
    if section is None:
        rows, own = base, {}
    else:
        own = {c: f"_{i}" for i, c in enumerate(section.columns) if c != CV_ID}
        renamed = section.select(CV_ID, *[F.col(f"`{c}`").alias(n) for c, n in own.items()])
        rows = lookup(renamed, base, CV_ID, "inner")

    def value(header: str) -> Column:
        if header in own:
            return F.col(own[header])
        return F.col(f"`{header}`") if header in base.columns else F.lit(None)

    return rows.select(*[value(h).cast("string").alias(n) for h, n in zip((*BASE_HEADERS, *headers), names, strict=True)])


def report_rows(tables: Mapping[str, DataFrame]) -> dict[str, tuple[tuple[str, ...], DataFrame]]:
    """(headers, rows) of every delivered report."""
    base = people(tables["users"], tables["cvs"])
    found = {}
    for name, headers in REPORT_HEADERS.items():
        if name == "user_report":
            section = None
        elif name == "usage_report":
            section = usage(tables["cvs"], tables)
        else:
            table = next(t for t in model.SECTIONS if t.report == f"{name}.csv")
            section = derive.with_headers(tables[table.name], table)
        found[name] = ((*BASE_HEADERS, *headers), layout(base, headers, section))
    return found


def write_lines(df: DataFrame, headers: Sequence[str], path: str) -> None:
    """Rows as CSV part files under ``headers``, which may repeat.

    Every part begins with the header.  Null and empty cells are blank; blanks in cells stay.
    """
    spark = df.sparkSession
    options = {"escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    cells = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns)])
    titles = F.struct(*[F.lit(h).alias(f"c{i}") for i, h in enumerate(headers)])
    lines = df.select(F.to_csv(cells, options).alias("line"), F.monotonically_increasing_id().alias("_row"))
    # The lower bits of the id count the rows of a task, and a task writes one file.
    first = F.col("_row").bitwiseAND((1 << 33) - 1) == 0
    title = F.to_csv(titles, options)
    parted = lines.select(F.explode(F.when(first, F.array(title, F.col("line"))).otherwise(F.array("line"))).alias("value"))
    if df.isEmpty():
        parted = spark.range(0, 1, 1, 1).select(title.alias("value"))
    parted.write.mode("overwrite").option("maxRecordsPerFile", 0).text(path)


def export_reports(warehouse: Warehouse, folder: str) -> list[str]:
    """Writes every delivered report of the published version below ``folder``; gives their names."""
    tables = warehouse.tables()
    found = report_rows(tables)
    for name, (headers, rows) in found.items():
        write_lines(rows, headers, join_path(folder, f"{name}.csv"))
    return list(found)


def export_snapshot(spark: SparkSession, warehouse_dir: str, folder: str) -> list[str]:
    return export_reports(Warehouse(spark, warehouse_dir), folder)

"""Report headers and target tables, as data.

Header texts and table and column names are fixed values: they are the format of
the files that come in and of the tables that others query.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Kinds of field: how a cell becomes a value (see plans.tables.typed_value).
_TYPES = {
    "text": T.StringType(),
    "clean_text": T.StringType(),
    "json_text": T.StringType(),
    "int": T.IntegerType(),
    "lenient_int": T.IntegerType(),
    "percent": T.IntegerType(),
    "bool": T.BooleanType(),
    "raw_bool": T.BooleanType(),
    "date": T.DateType(),
    "multilang": T.MapType(T.StringType(), T.StringType()),
    "id": T.LongType(),
    "timestamp": T.TimestampType(),
}


@dataclass(frozen=True)
class Field:
    """A target column and the headers it may come from; the first is the strict one."""

    name: str
    headers: tuple[str, ...]
    kind: str = "text"
    required: bool = False
    dimension: str | None = None


@dataclass(frozen=True)
class Table:
    name: str
    report: str
    key: tuple[str, ...]
    fields: tuple[Field, ...]
    parent: str | None = None  # "users" or "cvs"
    first_writer: tuple[str, ...] = ()
    # A table that carries over from version to version: the day in its key and the
    # length of the period that one part of it covers.
    period: tuple[str, str] | None = None

    @property
    def retained(self) -> bool:
        return self.period is not None

    @property
    def dimensions(self) -> tuple[Field, ...]:
        return tuple(f for f in self.fields if f.dimension)

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(f.name for f in self.fields if f.required)


def _f(name: str, *headers: str, kind: str = "text", **more) -> Field:
    return Field(name, headers, kind, **more)


USER_KEY = "cv_partner_user_id"
CV_KEY = "cv_partner_cv_id"
SECTION_KEY = "cv_partner_section_id"

USER_REF = _f(USER_KEY, "CV Partner User ID", required=True)
CV_REF = _f(CV_KEY, "CV Partner CV ID", required=True)

_SECTION = (
    _f(SECTION_KEY, "CV Partner section ID", required=True),
    _f("external_unique_id", "External unique ID"),
)
_MONTHS = (
    _f("month_from", "Month from", kind="int"),
    _f("year_from", "Year from", kind="int"),
    _f("month_to", "Month to", kind="int"),
    _f("year_to", "Year to", kind="int"),
)
_HIGHLIGHTED = _f("highlighted", "Highlighted", kind="raw_bool")
_HIGHLIGHTED_LOOSE = _f("highlighted", "Highlighted", kind="bool")
_CHANGED = (
    _f("updated", "Updated", kind="date"),
    _f("updated_by_owner", "Updated by owner", kind="date"),
)
_MASTERDATA = _f("is_official_masterdata", "Is official masterdata (in #{lang})", kind="json_text")
_DESCRIPTION = _f("description", "Description")
IDENTITY_FIELDS = (
    _f("email", "Email"),
    _f("upn", "UPN"),
    _f("external_user_id", "External User ID"),
)

USERS = Table(
    "users",
    "user_report.csv",
    (USER_KEY,),
    (
        USER_REF,
        _f("name_multilang", "Name (multilang)", kind="multilang", required=True),
        _f("nationality_multilang", "nationality_multilang", kind="multilang"),
        *IDENTITY_FIELDS,
        _f("phone_number", "Phone Number"),
        _f("landline", "Landline"),
        _f("birth_year", "Birth Year", kind="int"),
        _f("department", "Department"),
        _f("country", "Country"),
        _f("user_created_at", "User created at", kind="date"),
    ),
)

CVS = Table(
    "cvs",
    "user_report.csv",
    (CV_KEY,),
    (
        CV_REF,
        USER_REF,
        _f("title_multilang", "Title (#{lang})", kind="multilang"),
        _f("years_of_education", "Years of education", kind="int"),
        _f("years_since_first_work_experience", "Years since first work experience", kind="int"),
        _f("has_profile_image", "Has profile image", kind="bool"),
        _f("owns_reference_project", "Owns a reference project", kind="bool"),
        _f("read_privacy_notice", "Read and understood privacy notice", kind="bool"),
        _f("cv_last_updated_by_owner", "CV Last updated by owner", kind="date"),
        _f("cv_last_updated", "CV Last updated", kind="date"),
        _f("sfia_level", "SFIA Level", kind="lenient_int"),
        _f("cpd_level", "CPD Level", kind="lenient_int"),
        _f("cpd_band", "CPD Band"),
        _f("cpd_label", "CPD Label"),
    ),
    parent="users",
    first_writer=(USER_KEY,),
)


def _section(name: str, report: str, *fields: Field, key: tuple[str, ...] = (SECTION_KEY,)) -> Table:
    return Table(name, report, (CV_KEY, *key), (CV_REF, *fields), parent="cvs")


CV_TECHNOLOGY = _section(
    "cv_technology",
    "technologies.csv",
    _f("technology", "Skill name", required=True, dimension="dim_technology"),
    _f("years_experience", "Year experience", kind="int"),
    _f("proficiency", "Proficiency (0-5)", kind="int"),
    _MASTERDATA,
    key=("technology",),
)

CV_LANGUAGE = _section(
    "cv_language",
    "languages.csv",
    _f("language", "Language", required=True, dimension="dim_language"),
    _f("level", "Level"),
    _HIGHLIGHTED_LOOSE,
    _MASTERDATA,
    *_CHANGED,
    key=("language",),
)

PROJECT_EXPERIENCE = _section(
    "project_experience",
    "project_experiences.csv",
    *_SECTION,
    *_MONTHS,
    _f("customer_int", "Customer (int)"),
    _f("customer_multilang", "Customer (#{lang})", kind="json_text"),
    _f("customer_anon_int", "Customer anonymous (int)", "Customer Anonymized (int)"),
    _f(
        "customer_anon_multilang",
        "Customer anonymous (#{lang})",
        "Customer Anonymized (#{lang})",
        kind="json_text",
    ),
    _f("description_int", "Description (int)"),
    _f("description_multilang", "Description (#{lang})", kind="json_text"),
    _f("long_description_int", "Long description (int)"),
    _f("long_description_multilang", "Long description (#{lang})", kind="json_text"),
    _f("industry", "Industry", "Industry (int)", dimension="dim_industry"),
    _f("project_type", "Project type", "Project type (int)", dimension="dim_project_type"),
    _f("percent_allocated", "Percent allocated", kind="int"),
    _f(
        "extent_individual_hours",
        "Extent individual hours",
        "Project extent (individual hours)",
        kind="int",
    ),
    _f("extent_hours", "Extent hours", "Project extent (hours)", kind="int"),
    _f("extent_total_hours", "Extent total hours", "Project extent total (hours)", kind="int"),
    _f("extent_unit", "Extent unit", "Project extent"),
    _f("extent_currency", "Extent currency", "Project extent (currency)"),
    _f("extent_total", "Extent total", "Project extent total", kind="int"),
    _f("extent_total_currency", "Extent total currency", "Project extent total (currency)"),
    _f("project_area", "Project area", kind="int"),
    _f("project_area_unit", "Project area unit", "Project area (unit)"),
    _HIGHLIGHTED_LOOSE,
    *_CHANGED,
)

WORK_EXPERIENCE = _section(
    "work_experience",
    "work_experiences.csv",
    *_SECTION,
    *_MONTHS,
    _HIGHLIGHTED,
    _f("employer", "Employer"),
    _DESCRIPTION,
    _f("long_description", "Long description", "Long Description"),
    *_CHANGED,
)

CERTIFICATION = _section(
    "certification",
    "certifications.csv",
    *_SECTION,
    _f("month", "Month", kind="int"),
    _f("year", "Year", kind="int"),
    _f("month_expire", "Month expire", kind="int"),
    _f("year_expire", "Year expire", kind="int"),
    *_CHANGED,
)

COURSE = _section(
    "course",
    "courses.csv",
    *_SECTION,
    _f("month", "Month", kind="int"),
    _f("year", "Year", kind="int"),
    _f("name", "Name"),
    _f("organiser", "Organiser"),
    _f("long_description", "Long description"),
    _HIGHLIGHTED_LOOSE,
    _MASTERDATA,
    _f("attachments", "Attachments", kind="clean_text"),
    *_CHANGED,
)

EDUCATION = _section(
    "education",
    "educations.csv",
    *_SECTION,
    *_MONTHS,
    _HIGHLIGHTED,
    _f("attachments", "Attachments"),
    _f("place_of_study", "Place of study"),
    _f("degree", "Degree"),
    _DESCRIPTION,
    *_CHANGED,
)

POSITION = _section(
    "position",
    "positions.csv",
    *_SECTION,
    _f("year_from", "Year from", kind="int"),
    _f("year_to", "Year to", kind="int"),
    _HIGHLIGHTED,
    _f("name", "Name"),
    _DESCRIPTION,
    *_CHANGED,
)

BLOG_PUBLICATION = _section(
    "blog_publication",
    "blogs.csv",
    *_SECTION,
    _f("name", "Name"),
    _DESCRIPTION,
    _HIGHLIGHTED,
    *_CHANGED,
)

CV_ROLE = _section(
    "cv_role",
    "cv_roles.csv",
    _f("name", "Name", required=True),
    _DESCRIPTION,
    _HIGHLIGHTED,
    *_CHANGED,
    key=("name",),
)

KEY_QUALIFICATION = _section(
    "key_qualification",
    "key_qualifications.csv",
    *_SECTION,
    _f("label", "Label"),
    _f("summary", "Summary of Qualifications"),
    _f("short_description", "Short description"),
    *_CHANGED,
)

USER_CLEARANCE = Table(
    "user_clearance",
    "sc_clearance.csv",
    (USER_KEY, "clearance", "valid_from"),
    (
        _f(USER_KEY, required=True),
        _f("clearance", "Clearance", kind="clean_text", required=True, dimension="dim_clearance"),
        _f("valid_from", "Valid From", kind="date", required=True),
        _f("valid_to", "Valid To", kind="date"),
        _f("verified_by", "Verified By", kind="clean_text"),
        _f("notes", "Notes", kind="clean_text"),
    ),
    parent="users",
    period=("valid_from", "year"),
)

USER_AVAILABILITY = Table(
    "user_availability",
    "availability_report.csv",
    (USER_KEY, "date"),
    (
        _f(USER_KEY, required=True),
        _f("date", "Date", kind="date", required=True),
        _f("percent_available", "Percent Available", kind="percent", required=True),
        _f("source", "Source", kind="clean_text"),
        _f("updated_at", kind="timestamp", required=True),
    ),
    parent="users",
    period=("date", "month"),
)

SECTIONS = (
    CV_TECHNOLOGY,
    CV_LANGUAGE,
    PROJECT_EXPERIENCE,
    WORK_EXPERIENCE,
    CERTIFICATION,
    COURSE,
    EDUCATION,
    POSITION,
    BLOG_PUBLICATION,
    CV_ROLE,
    KEY_QUALIFICATION,
)
TABLES = (USERS, CVS, *SECTIONS, USER_CLEARANCE, USER_AVAILABILITY)
DIMENSIONS = (
    "dim_technology",
    "dim_language",
    "dim_industry",
    "dim_project_type",
    "dim_clearance",
)
BY_NAME = {t.name: t for t in TABLES}

@dataclass(frozen=True)
class Defaults:
    """What stands in for a missing source, clearance and start date."""

    # Fixed values.
    source: str = "Fake generator"
    clearance: str = "None"
    start: str = "1900-01-01"


DEFAULTS = Defaults()

# The columns that every exported report row starts with.
BASE_HEADERS = (
    "Name",
    "Name (multilang)",
    "Title (#{lang})",
    "Email",
    "UPN",
    "External User ID",
    "CV Partner User ID",
    "CV Partner CV ID",
    "Phone Number",
    "Landline",
    "Birth Year",
    "Department",
    "Country",
)


def id_column(dimension_or_key: str) -> str:
    """Surrogate id column that goes with a dimension table or a natural key."""
    return {USER_KEY: "user_id", CV_KEY: "cv_id"}.get(
        dimension_or_key, dimension_or_key.removeprefix("dim_") + "_id"
    )


def schema(table: Table) -> T.StructType:
    """Stored columns: surrogate ids first, then the natural columns."""
    fields = [T.StructField(i, T.LongType()) for i in ids(table)]
    fields += [T.StructField(f.name, _TYPES[f.kind]) for f in table.fields]
    return T.StructType(fields)


def ids(table: Table) -> dict[str, str]:
    """Surrogate id column to the natural column it is made from."""
    natural = {id_column(f.name): f.name for f in table.fields if f.name in (USER_KEY, CV_KEY)}
    return {**natural, **{id_column(f.dimension): f.name for f in table.dimensions}}


def dimension_schema(dimension: str) -> T.StructType:
    return T.StructType(
        [T.StructField(id_column(dimension), T.LongType()), T.StructField("name", T.StringType())]
    )

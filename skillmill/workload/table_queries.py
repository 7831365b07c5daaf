"""Queries for joins, upserts, table loads, checks, profile and figures."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillmill import model
from skillmill.functions import text
from skillmill.operators import lookup, quality, upsert
from skillmill.plans import derive, kpi, profile, tables, transform
from skillmill.workload import sources
from skillmill.workload.sources import LINE_ORDER, email_of, read, say, spelling, word

USER_ID, CV_ID, SECTION_ID = "CV Partner User ID", "CV Partner CV ID", "CV Partner section ID"
FIRST_RUN = dt.datetime(2024, 6, 1, 12)
SECOND_RUN = dt.datetime(2024, 7, 1, 12)


def _natural(table: model.Table, df: DataFrame) -> DataFrame:
    """The natural columns; surrogate ids are a matter of this library."""
    return df.select(*[f.name for f in table.fields])


# --- profile and figures --------------------------------------------------------


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.search_profile(
        sources.people(spark, sf_dir),
        sources.resumes(spark, sf_dir),
        sources.technologies(spark, sf_dir),
        sources.clearances(spark, sf_dir),
        sources.availability(spark, sf_dir),
    )


def search_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir).drop("user_id", "cv_id")


def profile_numeric_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of one segment get an id that is no number, so they drop out."""
    customer = read(spark, sf_dir, "customer").select(
        word("c_custkey").alias("_id"), (F.col("c_mktsegment") == "BUILDING").alias("_tag")
    )

    def tagged(df: DataFrame) -> DataFrame:
        key = F.col(model.USER_KEY)
        joined = df.join(customer, key == F.col("_id")).withColumn(
            model.USER_KEY, F.when(F.col("_tag"), say("b", key)).otherwise(key)
        )
        return joined.drop("_id", "_tag")

    result = profile.search_profile(
        tagged(sources.people(spark, sf_dir)),
        tagged(sources.resumes(spark, sf_dir)),
        sources.technologies(spark, sf_dir),
        tagged(sources.clearances(spark, sf_dir)),
        tagged(sources.availability(spark, sf_dir)),
    )
    return profile.numeric_subset(result).drop("user_id", "cv_id")


def latest_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.latest_availability(sources.availability(spark, sf_dir))


def top_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The figure only counts rows, so the keys of the table are enough.
    held = sources.skill_rows(spark, sf_dir).select(*model.CV_TECHNOLOGY.key).distinct()
    return kpi.top_skills(held)


def kpi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.row_counts(sources.people(spark, sf_dir), sources.resumes(spark, sf_dir))


def _named_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search profile, one row per CV, with the clearances named as the figures expect them."""
    named = sources.clearances(spark, sf_dir).withColumn(
        "clearance", F.when(F.col("clearance") == "purchase", "SC").otherwise("None")
    )
    return profile.search_profile(
        sources.people(spark, sf_dir),
        sources.resumes(spark, sf_dir),
        sources.technologies(spark, sf_dir),
        named,
        sources.availability(spark, sf_dir),
    )


def kpi_available(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.cleared_and_available(_named_profile(spark, sf_dir))


def kpi_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.mean_availability(sources.availability(spark, sf_dir))


def kpi_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kpi.headline_figures(
        sources.people(spark, sf_dir),
        sources.resumes(spark, sf_dir),
        sources.technologies(spark, sf_dir),
        _named_profile(spark, sf_dir),
        sources.availability(spark, sf_dir),
    )


# --- lookups --------------------------------------------------------------------


def nationality_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = read(spark, sf_dir, "customer").select(word("c_custkey").alias(USER_ID))
    usage = read(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") != "P", word("o_custkey")).alias(USER_ID),
        say("int:", F.col("o_orderpriority"), "|no:", F.col("o_orderstatus")).alias(
            transform.NATIONALITY
        ),
        "o_orderdate",
        "o_orderkey",
    )
    found = transform.with_nationality(users, usage, ["o_orderdate", "o_orderkey"])
    nationality = F.col("nationality_multilang")
    return found.select(
        F.col(USER_ID).alias(model.USER_KEY),
        text.map_pick(nationality).alias("nationality"),
        text.map_pick(nationality, "no").alias("nationality_no"),
        F.size(nationality).alias("languages"),
    )


def _identified_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that name their person by e-mail, by a shared name, by external id or not at all."""
    user = F.col("user_id")
    return read(spark, sf_dir, "events").select(
        "event_id",
        spelling(
            "user_id", F.upper(email_of(user)), say("nobody", user, "@example.org"), "", None
        ).alias("email"),
        spelling("user_id", None, say("TEAM", F.pmod(user, F.lit(30))), "no team", "").alias("upn"),
        spelling("event_id", say("ext_", user), say("EXT_", user), None).alias("external_user_id"),
    )


def identity_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup.resolve_identity(
        _identified_events(spark, sf_dir), sources.people(spark, sf_dir), model.USER_KEY
    )
    return found.select("event_id", model.USER_KEY)


def identity_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lookup.resolve_identity(
        _identified_events(spark, sf_dir), sources.people(spark, sf_dir), model.USER_KEY, how="left"
    )
    return found.filter(F.col(model.USER_KEY).isNull()).select("event_id")


def cv_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return lookup.known_only(documents, read(spark, sf_dir, "labels"), "doc_id")


def unmatched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return lookup.unmatched(documents, read(spark, sf_dir, "labels"), "doc_id")


def unmatched_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"))
    return lookup.unmatched_counts(events, read(spark, sf_dir, "labels"), "doc_id")


def dim_technology(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = {"cv_technology": sources.skill_rows(spark, sf_dir)}
    return tables.dimension("dim_technology", used).select("name")


def dim_new_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in use that the dimension of the earlier lines did not hold."""
    lines = sources.lines_with_part(spark, sf_dir)
    name = say(F.col("p_brand"), "/", F.col("l_partkey"), "/", F.col("l_linenumber"))
    earlier = lines.filter(F.year("l_shipdate") < 1997).select(name.alias("name")).distinct()
    used = lines.select(F.when(F.col("l_returnflag") == "A", "").otherwise(name).alias("name"))
    return upsert.new_members(used, earlier)


def dim_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines per product type, a blank type resolving to nothing."""
    types = read(spark, sf_dir, "part").groupBy(F.col("p_type").alias("name")).agg(
        F.count(F.lit(1)).alias("parts")
    )
    lines = sources.lines_with_part(spark, sf_dir).select(
        F.nullif(
            F.when(F.col("l_returnflag") == "A", "").otherwise(F.col("p_type")), F.lit("")
        ).alias("name")
    )
    return (
        lookup.lookup(lines, types, "name")
        .groupBy("name", "parts")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def report_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read(spark, sf_dir, "customer").select(
        word("c_custkey").alias(USER_ID),
        F.col("c_name").alias("Name"),
        say("int:", F.col("c_name")).alias("Name (multilang)"),
        email_of(F.col("c_custkey")).alias("Email"),
        F.col("c_mktsegment").alias("Department"),
    )
    orders = read(spark, sf_dir, "orders").select(
        word("o_orderkey").alias(CV_ID),
        word("o_custkey").alias(USER_ID),
        say("int:", F.col("o_orderpriority")).alias("Title (#{lang})"),
    )
    lines = read(spark, sf_dir, "lineitem").select(
        word("l_orderkey").alias(CV_ID),
        word("l_linenumber").alias(SECTION_ID),
        say("part ", F.col("l_partkey")).alias("Name"),
        F.col("l_quantity").cast("int").alias("Percent allocated"),
    )
    rows = derive.report_layout(customer, orders, lines)
    names = {
        "Name": "name",
        "Name (multilang)": "name_multilang",
        "Title (#{lang})": "title",
        "Email": "email",
        "UPN": "upn",
        USER_ID: "user_key",
        CV_ID: "cv_key",
        "Department": "department",
        "Country": "country",
        SECTION_ID: "section_key",
        "Percent allocated": "percent_allocated",
        "Name.1": "section_name",
    }
    return rows.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()])


def section_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders are CVs, and so are customers, whose sections are empty."""
    lines = read(spark, sf_dir, "lineitem").select(
        word("l_orderkey").alias(model.CV_KEY), F.to_date("l_shipdate").alias("updated_by_owner")
    )
    orders = read(spark, sf_dir, "orders").select(
        word("o_orderkey").alias(model.CV_KEY), F.to_date("o_orderdate").alias("updated_by_owner")
    )
    skills = sources.technologies(spark, sf_dir).select(model.CV_KEY)
    blank = read(spark, sf_dir, "customer").select(say("c", F.col("c_custkey")).alias(model.CV_KEY))
    cvs = sources.resumes(spark, sf_dir).select(model.CV_KEY).unionByName(blank)
    return derive.section_summary({"work_experience": lines, "position": orders, "cv_technology": skills}, cvs=cvs)


# --- upserts and table loads ----------------------------------------------------


def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.technologies(spark, sf_dir)


def upsert_immutable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The supplier of an order's first line stays, everything else is taken from its last."""
    lines = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_suppkey").alias("owner"), F.col("l_tax").alias("tax"), *LINE_ORDER
    )
    return upsert.latest_per_key(lines, ["l_orderkey"], LINE_ORDER, first_writer=["owner"])


def upsert_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Morning rows are stored first; afternoon rows then replace those of the same day."""
    rows = sources.availability_events(spark, sf_dir)

    def batch(which, run: dt.datetime) -> DataFrame:
        return rows.filter(which).drop("hour").withColumn("updated_at", F.lit(run.date()))

    keys = model.USER_AVAILABILITY.key
    stored = upsert.upsert(None, batch(F.col("hour") < 12, FIRST_RUN), keys, ["event_id"])
    return upsert.upsert(stored, batch(F.col("hour") >= 12, SECOND_RUN), keys, ["event_id"])


def upsert_first_writer_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders stored by one year keep their first clerk when later years replace the rest."""
    rows = read(spark, sf_dir, "orders").select(
        "o_custkey",
        F.col("o_orderpriority").alias("first_priority"),
        F.col("o_orderstatus").alias("status"),
        "o_orderkey",
        F.year("o_orderdate").alias("year"),
    )
    old = rows.filter("year < 1995").drop("year")
    new = rows.filter("year >= 1995").drop("year")
    keys, order, first = ["o_custkey"], ["o_orderkey"], ["first_priority"]
    return upsert.upsert(upsert.upsert(None, old, keys, order, first), new, keys, order, first)


def _load(
    table: model.Table, report: DataFrame, parents: DataFrame | None, order: tuple[str, ...]
) -> DataFrame:
    rows = transform.typed_rows(report, table, order)
    return _natural(table, tables.build(table, rows, parents, order=order))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a label stand for the known CVs."""
    return read(spark, sf_dir, "labels").select(word("doc_id").alias(model.CV_KEY))


def _ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that are not pending stand for the known CVs."""
    orders = read(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    return orders.select(word("o_orderkey").alias(model.CV_KEY))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").select(word("c_custkey").alias(model.CV_KEY))


def users_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order comes in; a customer keeps what the last order says."""
    orders = read(spark, sf_dir, "orders")
    customer = read(spark, sf_dir, "customer")
    nation = read(spark, sf_dir, "nation")
    report = orders.join(customer, orders.o_custkey == customer.c_custkey).join(
        nation, customer.c_nationkey == nation.n_nationkey
    ).select(
        word("c_custkey").alias(USER_ID),
        say("int:", F.col("c_name"), "|no: ", F.col("o_orderpriority")).alias("Name (multilang)"),
        email_of(F.col("c_custkey")).alias("Email"),
        F.when(F.col("o_orderstatus") != "P", say("upn", F.col("o_orderkey"))).alias("UPN"),
        say("+", F.col("c_nationkey") + 1950).alias("Birth Year"),
        F.col("c_mktsegment").alias("Department"),
        F.col("n_name").alias("Country"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("User created at"),
        "o_orderkey",
    )
    usage = customer.select(
        word("c_custkey").alias(USER_ID),
        say("int:", F.col("c_nationkey")).alias(transform.NATIONALITY),
        F.col("c_custkey").alias("o_orderkey"),
    )
    rows = transform.user_rows(report, usage, ["o_orderkey"])
    built = tables.build(model.USERS, rows, order=["o_orderkey"])
    return built.select(
        model.USER_KEY,
        text.json_object(F.col("name_multilang")).alias("name_json"),
        text.json_object(F.col("nationality_multilang")).alias("nationality_json"),
        "email", "upn", "external_user_id", "phone_number", "birth_year", "department",
        "country", "user_created_at",
    )


def cvs_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line comes in; rows of unknown people are skipped, the first known one owns the CV."""
    report = read(spark, sf_dir, "lineitem").select(
        word("l_orderkey").alias(CV_ID),
        word("l_partkey").alias(USER_ID),
        say("int: ", F.col("l_returnflag"), F.col("l_linestatus")).alias("Title (#{lang})"),
        word(F.col("l_quantity").cast("int")).alias("Years of education"),
        word("l_quantity").alias("Years since first work experience"),
        spelling("l_linenumber", "yes", "no", None, "TRUE ").alias("Has profile image"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("CV Last updated"),
        spelling("l_linenumber", "3", "3.0", "x", None, "5").alias("SFIA Level"),
        say("CPD", F.col("l_linenumber")).alias("CPD Label"),
        *LINE_ORDER,
    )
    people = read(spark, sf_dir, "customer").select(word("c_custkey").alias(model.USER_KEY))
    rows = transform.cv_rows(report, LINE_ORDER)
    built = tables.build(model.CVS, rows, people, order=LINE_ORDER)
    return built.select(
        model.CV_KEY, model.USER_KEY,
        text.map_pick(F.col("title_multilang")).alias("cv_title"),
        "years_of_education", "years_since_first_work_experience", "has_profile_image",
        "owns_reference_project", "cv_last_updated", "sfia_level", "cpd_level", "cpd_label",
    )


def technologies_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = sources.lines_with_part(spark, sf_dir).select(
        word("l_orderkey").alias(CV_ID),
        F.when(F.col("l_returnflag") != "N", F.col("p_brand")).alias("Skill name"),
        word("l_quantity").alias("Year experience"),
        word(F.col("l_linenumber") % 6).alias("Proficiency (0-5)"),
        say('{"int":"', F.col("l_linestatus"), '"}').alias("Is official masterdata (in #{lang})"),
        *LINE_ORDER,
    )
    return _load(model.CV_TECHNOLOGY, report, _ordered(spark, sf_dir), LINE_ORDER)


def languages_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = read(spark, sf_dir, "documents").select(
        word("doc_id").alias(CV_ID),
        F.col("lang").alias("Language"),
        F.col("source").alias("Level"),
        spelling("n_chars", "yes", "no", None).alias("Highlighted"),
        "doc_id",
    )
    return _load(model.CV_LANGUAGE, report, _labelled(spark, sf_dir), ("doc_id",))


def project_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both header spellings are used for the fields that have two."""
    day = F.col("l_shipdate")
    report = sources.lines_with_part(spark, sf_dir).select(
        word("l_orderkey").alias(CV_ID),
        word("l_linenumber").alias(SECTION_ID),
        word(F.month(day)).alias("Month from"),
        word(F.year(day)).alias("Year from"),
        say("Part ", F.col("l_partkey")).alias("Customer (int)"),
        say("int:Part ", F.col("l_partkey")).alias("Customer (#{lang})"),
        F.col("p_name").alias("Customer Anonymized (int)"),
        F.col("p_type").alias("Industry (int)"),
        F.when(F.col("l_returnflag") != "A", F.col("p_brand")).alias("Project type"),
        word(F.col("l_quantity")).alias("Percent allocated"),
        word("p_size").alias("Project extent (hours)"),
        F.col("l_linestatus").alias("Project extent"),
        spelling("l_suppkey", "true", "N", None).alias("Highlighted"),
        F.date_format(day, "yyyy-MM-dd").alias("Updated"),
        F.date_format(day, "MM/dd/yyyy").alias("Updated by owner"),
        *LINE_ORDER,
    )
    return _load(model.PROJECT_EXPERIENCE, report, _ordered(spark, sf_dir), LINE_ORDER)


def section_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("l_shipdate")
    report = read(spark, sf_dir, "lineitem").select(
        word("l_orderkey").alias(CV_ID),
        word("l_linenumber").alias(SECTION_ID),
        say("x", F.col("l_suppkey")).alias("External unique ID"),
        word(F.month(day)).alias("Month from"),
        word(F.year(day)).alias("Year from"),
        spelling("l_suppkey", "true", "off", None).alias("Highlighted"),
        say("Supplier ", F.col("l_suppkey")).alias("Employer"),
        say("price ", F.col("l_partkey")).alias("Long Description"),
        F.date_format(day, "yyyy-MM-dd").alias("Updated"),
        *LINE_ORDER,
    )
    return _load(model.WORK_EXPERIENCE, report, _ordered(spark, sf_dir), LINE_ORDER)


def certification_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = read(spark, sf_dir, "events").select(
        word("user_id").alias(CV_ID),
        F.col("event_type").alias(SECTION_ID),
        word("event_id").alias("External unique ID"),
        word(F.month("ts")).alias("Month"),
        word(F.year("ts")).alias("Year"),
        word(F.col("value")).alias("Month expire"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("Updated"),
        "event_id",
    )
    return _load(model.CERTIFICATION, report, _labelled(spark, sf_dir), ("event_id",))


def course_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = read(spark, sf_dir, "events").select(
        word("user_id").alias(CV_ID),
        text.json_field(F.col("props"), "k").alias(SECTION_ID),
        word(F.year("ts")).alias("Year"),
        F.col("event_type").alias("Name"),
        spelling("event_id", " file.pdf ", "  ", None).alias("Attachments"),
        spelling("event_id", "1", "nope", None, "Y").alias("Highlighted"),
        F.col("props").alias("Is official masterdata (in #{lang})"),
        "event_id",
    )
    return _load(model.COURSE, report, _labelled(spark, sf_dir), ("event_id",))


def education_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = read(spark, sf_dir, "orders").select(
        word("o_custkey").alias(CV_ID),
        F.col("o_orderpriority").alias(SECTION_ID),
        word(F.year("o_orderdate")).alias("Year from"),
        word(F.year("o_orderdate") + 4).alias("Year to"),
        F.col("o_orderstatus").alias("Place of study"),
        say("order ", F.col("o_orderkey")).alias("Degree"),
        F.when(F.col("o_orderstatus") != "F", "t").alias("Highlighted"),
        F.date_format("o_orderdate", "dd.MM.yyyy").alias("Updated by owner"),
        "o_orderkey",
    )
    return _load(model.EDUCATION, report, _customers(spark, sf_dir), ("o_orderkey",))


def position_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = read(spark, sf_dir, "orders").select(
        word("o_custkey").alias(CV_ID),
        word(F.year("o_orderdate")).alias(SECTION_ID),
        word(F.year("o_orderdate")).alias("Year from"),
        F.col("o_orderpriority").alias("Name"),
        say("order ", F.col("o_orderkey")).alias("Description"),
        "o_orderkey",
    )
    return _load(model.POSITION, report, _customers(spark, sf_dir), ("o_orderkey",))


def blog_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = read(spark, sf_dir, "pages").select(
        word("page_id").alias(CV_ID),
        F.col("url").alias(SECTION_ID),
        F.col("url").alias("Name"),
        F.col("html").alias("Description"),
        "page_id",
    )
    return _load(model.BLOG_PUBLICATION, report, _labelled(spark, sf_dir), ("page_id",))


def section_role(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = read(spark, sf_dir, "conversations").select(
        word("conv_id").alias(CV_ID),
        F.col("role").alias("Name"),
        F.col("text").alias("Description"),
        "turn",
    )
    return _load(model.CV_ROLE, report, _labelled(spark, sf_dir), ("turn",))


def key_qualification_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = read(spark, sf_dir, "documents").select(
        word("doc_id").alias(CV_ID),
        say("kq-", F.col("doc_id")).alias(SECTION_ID),
        F.col("source").alias("Label"),
        F.col("text").alias("Summary of Qualifications"),
        F.col("lang").alias("Short description"),
        "doc_id",
    )
    return _load(model.KEY_QUALIFICATION, report, _labelled(spark, sf_dir), ("doc_id",))


def _clearance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, day = F.col("user_id"), F.to_date("ts")
    return read(spark, sf_dir, "events").select(
        spelling("event_id", email_of(user), F.upper(email_of(user)), None).alias("Email"),
        F.when(F.col("event_type") != "click", say("ext_", user)).alias("External User ID"),
        spelling("event_id", say(" ", F.col("event_type")), F.col("event_type"), " ", None).alias(
            "Clearance"
        ),
        spelling(
            "event_id", F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "dd/MM/yyyy"), "soon",
            None, F.date_format(day, "d MMM yyyy"),
        ).alias("Valid From"),
        spelling(
            "event_id", F.date_format(F.date_add(day, 9), "yyyy-MM-dd"),
            F.date_format(F.date_sub(day, 9), "yyyy-MM-dd"), None,
        ).alias("Valid To"),
        spelling("user_id", " HR ", "", None).alias("Verified By"),
        say("event ", F.col("event_id")).alias("Notes"),
        "event_id",
    )


def clearance_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transform.clearance_rows(
        _clearance_report(spark, sf_dir), sources.people(spark, sf_dir), ["event_id"]
    )
    built = tables.build(model.USER_CLEARANCE, rows, order=["event_id"])
    return _natural(model.USER_CLEARANCE, built)


def availability_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, day = F.col("user_id"), F.to_date("ts")
    report = read(spark, sf_dir, "events").select(
        spelling("event_id", email_of(user), say("x", email_of(user)), "").alias("Email"),
        spelling("user_id", say("team", user), None).alias("UPN"),
        say("ext_", user).alias("External User ID"),
        spelling(
            "event_id", F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "dd-MM-yyyy")
        ).alias("Date"),
        F.when(F.col("event_type") != "error", word(F.col("value") - 50)).alias("Percent Available"),
        spelling("event_id", "Manual", " ", None, F.col("event_type")).alias("Source"),
        "event_id",
    )
    rows = transform.availability_rows(
        report, sources.people(spark, sf_dir), FIRST_RUN, ["event_id"]
    )
    built = tables.build(model.USER_AVAILABILITY, rows, order=["event_id"])
    return built.select(
        model.USER_KEY, "date", "percent_available", "source",
        F.to_date("updated_at").alias("updated_at"),
    )


def section_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a year, date or section id that cannot be stored, counted by problem."""
    report = read(spark, sf_dir, "orders").select(
        word("o_custkey").alias(CV_ID),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias(SECTION_ID),
        spelling("o_orderkey", "2020", "soon", None, "2021.0").alias("Year from"),
        spelling("o_orderkey", "2020-01-01", "2020-01-01", "2020-13-01").alias("Updated"),
        "o_orderkey",
    )
    rows = transform.typed_rows(report, model.POSITION, ["o_orderkey"])
    bad = tables.rejects(model.POSITION, rows, _labelled(spark, sf_dir), ["o_orderkey"])
    return bad.groupBy("table_name", "problem").agg(F.count(F.lit(1)).alias("rows"))


# --- checks ---------------------------------------------------------------------


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "lang")
    joined = documents.join(read(spark, sf_dir, "labels"), "doc_id", "left")
    return quality.not_null(joined, "labelled", ["doc_id", "lang", "quality", "toxic"])


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    orders = read(spark, sf_dir, "orders")
    return quality.stack(
        [
            quality.unique(lines, "lineitem", ["l_orderkey", "l_linenumber"]),
            quality.unique(orders, "orders", ["o_orderkey"]),
        ]
    )


def dq_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels")
    customer = read(spark, sf_dir, "customer")
    return quality.stack(
        [
            quality.foreign_key(
                read(spark, sf_dir, "documents"), "documents", "doc_id", labels, "doc_id"
            ),
            quality.foreign_key(
                read(spark, sf_dir, "events"), "events", "user_id", labels, "doc_id"
            ),
            quality.foreign_key(
                read(spark, sf_dir, "orders"), "orders", "o_custkey", customer, "c_custkey"
            ),
        ]
    )


def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.in_range(read(spark, sf_dir, "events"), "events", "value", 0, 100)


def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines left once pending orders are deleted."""
    lines = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_quantity"
    )
    kept = read(spark, sf_dir, "orders").filter(F.col("o_orderstatus") != "P")
    return (
        quality.cascade(lines, kept, "o_orderkey")
        .groupBy("l_returnflag")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    )


def restrict_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending orders that lines still point at."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    deleted = read(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
    return quality.restrict(lines, deleted, "o_orderkey")


QUERIES = {
    "profile": search_profile,
    **{
        f.__name__: f
        for f in (
            profile_numeric_subset, latest_availability, top_skills, kpi_counts, kpi_available,
            kpi_mean, kpi_report, nationality_lookup, identity_resolve, identity_unresolved,
            cv_resolve, unmatched_rows, unmatched_counts, dim_technology, dim_new_members,
            dim_lookup, report_layout, section_summary, upsert_last_wins, upsert_immutable,
            upsert_incremental, upsert_first_writer_kept, users_load, cvs_load,
            technologies_load, languages_load, project_load, section_work, certification_load,
            course_load, education_load, position_load, blog_load, section_role,
            key_qualification_load, clearance_load, availability_load, section_rejects,
            dq_not_null, dq_unique, dq_fk, dq_range, cascade_delete, restrict_delete,
        )
    },
}

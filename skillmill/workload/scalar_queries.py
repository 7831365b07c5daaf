"""Queries for the column functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillmill.functions import career, dates, numbers, text
from skillmill.operators.upsert import latest_per_key
from skillmill.plans import derive
from skillmill.sources import offices, snapshots
from skillmill.workload.sources import read, say, spelling, word


def multilang_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = say("int:", F.col("c_name"), "|no:", F.col("c_mktsegment"))
    parsed = text.multilang_map(name)
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        text.map_pick(parsed).alias("int_name"),
        text.map_pick(parsed, "no").alias("no_name"),
        text.map_pick(parsed, "sv").alias("sv_name"),
        text.multilang_pick(name).alias("direct_name"),
    )


def _dirty_name():
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    return spelling(
        "c_custkey",
        say(" int : ", name, " |no:", segment),
        say("int:", name, "|int:", segment),
        say("junk|int:", name, ":", segment, "|"),
        say("int:|no: ", segment),
        say(":", name, "|sv:", segment, "||"),
        say("no:", segment, "|int:", name, "|no:  ", name, "\t"),
        "   ",
        None,
        say(name, segment),
    )


def multilang_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", _dirty_name().alias("t"))
    parsed = rows.select("c_custkey", text.multilang_map(F.col("t")).alias("m"))
    return parsed.select(
        "c_custkey",
        text.map_pick(F.col("m")).alias("int_text"),
        text.map_pick(F.col("m"), "no").alias("no_text"),
        text.map_pick(F.col("m"), "sv").alias("sv_text"),
        F.size("m").alias("codes"),
    )


def lang_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "customer").select("c_custkey", _dirty_name().alias("t"))
    return rows.select(
        "c_custkey",
        text.lang_value(F.col("t")).alias("int_value"),
        text.lang_value(F.col("t"), "sv").alias("sv_value"),
    )


def _date_text():
    day = F.col("o_orderdate")
    return spelling(
        "o_orderkey",
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "dd/MM/yyyy"),
        F.date_format(day, "MM/dd/yyyy"),
        F.date_format(day, "dd.MM.yyyy"),
        F.date_format(day, "yyyyMMdd"),
        say(F.date_format(day, "yyyy-MM-dd"), " 10:30:00"),
        say(F.date_format(day, "yyyy"), "-02-30"),
        "soon",
        "  ",
        None,
        say(" ", F.date_format(day, "dd-MM-yyyy"), " "),
        F.date_format(day, "d MMM yyyy"),
        F.date_format(day, "yyyy/MM/dd"),
    )


def date_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "orders")
        .select("o_orderkey", _date_text().alias("t"))
        .select("o_orderkey", dates.iso_date(F.col("t")).alias("day"))
    )


def date_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read(spark, sf_dir, "orders")
        .select("o_orderkey", _date_text().alias("t"))
        .select(
            "o_orderkey", dates.date_or_default(F.col("t"), dt.date(1900, 1, 1)).alias("day")
        )
    )


def validity_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.to_date("o_orderdate")
    end = F.when(
        F.col("o_orderstatus") != "P",
        F.date_add(start, (F.pmod(F.col("o_custkey"), F.lit(61)) - 30).cast("int")),
    )
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", start.alias("valid_from"), dates.open_ended(start, end).alias("valid_to")
    )


def int_lenient(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_custkey")
    cell = spelling(
        "o_orderkey", word(n), say(" ", n, " "), say("+", n), say("-", n), say(n, ".0"),
        say(n, "x"), "", None,
    )
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        numbers.lenient_int(cell).alias("lenient"),
        numbers.whole_number(cell).alias("whole"),
    )


def int_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.when(F.col("o_orderstatus") != "P", say("+", F.col("o_custkey")))
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", numbers.strict_int(cell).alias("number")
    )


def percent_clamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = F.when(F.col("event_type") != "error", word(F.col("value") - 50))
    return read(spark, sf_dir, "events").select(
        "event_id", numbers.percent(cell).alias("percent_available")
    )


def bool_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = spelling(
        "o_orderkey", "true", " YES ", "1", "T", "y", "no", "False", "1.0", "", None,
        F.col("o_orderstatus"),
    )
    return read(spark, sf_dir, "orders").select(
        "o_orderkey",
        text.parse_boolean(cell).alias("flag"),
        text.database_boolean(cell).alias("stored"),
    )


def string_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = spelling(
        "doc_id", say("  ", F.col("source"), "\t"), F.col("text"), " \n ", "", None, F.col("lang")
    )
    return read(spark, sf_dir, "documents").select(
        "doc_id",
        text.normalise(cell).alias("or_empty"),
        text.normalise(cell, None).alias("or_null"),
        text.normalise(cell, "Fake generator").alias("or_default"),
    )


def null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = spelling(
        "c_custkey", F.col("c_name"), "NA", "None", "n/a", "NaN", "", " NA", "none",
        F.col("c_mktsegment"), "#N/A", "-1.#IND", "null",
    )
    return read(spark, sf_dir, "customer").select(
        "c_custkey", text.null_tokens(cell).alias("cell")
    )


def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        "event_id",
        text.json_field(F.col("props"), "k").cast("int").alias("k"),
        text.json_field(F.col("props"), "int").alias("missing"),
    )


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = say("int:", F.col("c_name"), "|no:", F.col("c_mktsegment"))
    quoted = say('say "', F.col("c_name"), '" \\ ', F.col("c_mktsegment"))
    return read(spark, sf_dir, "customer").select(
        "c_custkey",
        text.json_object(text.multilang_map(name)).alias("name_json"),
        text.json_string(quoted).alias("text_json"),
    )


def quarter_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = dates.quarter_label(F.to_date("o_orderdate"))
    return (
        read(spark, sf_dir, "orders")
        .groupBy(label.alias("label"))
        .agg(F.count(F.lit(1)).alias("orders"))
    )


def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = dates.quarter_label(F.to_date("o_orderdate"))
    year = F.year("o_orderdate")
    folders = read(spark, sf_dir, "orders").select(
        spelling(
            "o_orderkey", label, say(label, "_old"), say("Q5", year), say("old", label), "QTEST"
        ).alias("folder")
    )
    return snapshots.latest_snapshot(folders)


def cpd_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.pmod(F.col("o_custkey"), F.lit(9)).cast("int")
    return (
        read(spark, sf_dir, "orders")
        .select("o_orderkey", F.when(F.col("o_orderstatus") != "P", level).alias("sfia"))
        .select(
            "o_orderkey",
            "sfia",
            career.cpd_level(F.col("sfia")).alias("cpd_level"),
            career.cpd_band(F.col("sfia")).alias("cpd_band"),
            career.cpd_label(F.col("sfia")).alias("cpd_label"),
        )
    )


def role_sfia(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = spelling(
        "o_custkey", "Associate", "Consultant", "Senior", "Principal", "Lead", "Head",
        "Director", F.col("o_orderpriority"), None,
    )
    return (
        read(spark, sf_dir, "orders")
        .select("o_orderkey", role.alias("role"))
        .select("o_orderkey", "role", career.role_level(F.col("role")).alias("sfia"))
    )


def leadership_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = spelling(
        "p_partkey", "Head of AWS", "Head of  Azure ", "Head of MS Apps", "Head of Microsoft Apps",
        "Head of Data", "Head of Data Engineering", say("Head of ", F.col("p_type")),
        say("Director of ", F.col("p_brand")), F.col("p_name"), None, "Head of Quality",
    )
    return read(spark, sf_dir, "part").select(
        "p_partkey", career.leadership_title(title).alias("title")
    )


def career_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    family = F.col("p_type")
    title = spelling(
        "p_partkey", say("Associate ", family), say("Consultant ", family),
        say(" Senior ", family), say("Principal ", family), say("Lead ", family),
        say("Head of ", family), say("Director of ", family), F.col("p_name"),
        say(family, " Head"), say("Director ", family, " of"),
    )
    return derive.positions_from_title(
        read(spark, sf_dir, "part"), title, F.col("p_size") + 2000, keep=("p_partkey",)
    )


def country_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = spelling("c_nationkey", "gb", "ie", "us", "au", "in", "es", "si", "GB", "no", None)
    return read(spark, sf_dir, "customer").select(
        "c_custkey", career.country_name(iso).alias("country")
    )


def calendar_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive.availability_calendar(
        read(spark, sf_dir, "customer"),
        "c_custkey",
        F.col("c_acctbal") / 50,
        dt.date(2024, 2, 20),
        days=20,
    )


def report_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events are files of the snapshot of their person and quarter; every customer has a first snapshot, with files or not."""
    names = snapshots.DELIVERED_REPORTS
    landed = read(spark, sf_dir, "events").select(
        say("u", F.col("user_id"), "_", dates.quarter_label(F.to_date("ts"))).alias("snapshot"),
        spelling(F.expr("event_id div 3"), *names, "notes").alias("report"),
    )
    first = dates.quarter_label(F.lit(dt.date(2024, 1, 1)))
    folders = read(spark, sf_dir, "customer").select(say("u", F.col("c_custkey"), "_", first).alias("snapshot"))
    return snapshots.missing_reports(landed, snapshots=folders)


def office_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("s_suppkey")
    document = say(
        '{"code":"', F.col("s_nationkey"), '","offices":[{"_id":"off-', key, '-a","name":"',
        F.col("s_name"), '"},{"_id":""},{"name":"no id"},{"_id":"off-', key, '-b"}]}',
    )
    countries = read(spark, sf_dir, "supplier").select(
        F.from_json(document, offices.COUNTRY_SCHEMA).alias("c")
    )
    return offices.flatten_offices(countries.select("c.*"))


def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last row per customer over the orders, newest day first."""
    rows = read(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderkey"
    )
    return latest_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], keep_order=True).select(
        "o_custkey", "o_orderkey", "o_orderstatus"
    )


QUERIES = {
    f.__name__: f
    for f in (
        multilang_pick, multilang_dirty, lang_fallback, date_normalise, date_default,
        validity_repair, int_lenient, int_strict, percent_clamp, bool_parse, string_normalise,
        null_tokens, json_extract, json_encode, quarter_label, latest_snapshot, cpd_enrich,
        role_sfia, leadership_title, career_ladder, country_name, calendar_spine,
        report_completeness, office_ids, latest_status,
    )
}

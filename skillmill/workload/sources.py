"""People, CVs, skills, clearances and availability read out of the star-schema tables.

Whole tables are always used.  The remainders below only choose how a cell is
spelled, never which rows take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skillmill import model
from skillmill.functions import career, numbers, text
from skillmill.operators.upsert import latest_per_key

# Orders the rows of one line-item key; rows equal in all of these are copies.
LINE_ORDER = (
    "l_linenumber",
    "l_quantity",
    "l_extendedprice",
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_discount",
    "l_tax",
    "l_returnflag",
)

# Orders the skill rows: years and proficiency follow from these, so ties are copies.
SKILL_ORDER = ("l_linenumber", "l_quantity")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def say(*parts: Column | str) -> Column:
    """Text put together from columns and literal texts."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def spelling(number: Column | str, *forms: Column | str | None) -> Column:
    """The form chosen by ``number``, counting round."""
    number = F.col(number) if isinstance(number, str) else number
    values = [f if isinstance(f, Column) else F.lit(f).cast("string") for f in forms]
    at = F.pmod(number, F.lit(len(values))).cast("int")
    result = F.when(at == 0, values[0])
    for i, value in enumerate(values[1:], 1):
        result = result.when(at == i, value)
    return result


def email_of(user: Column) -> Column:
    return say("customer#", F.lpad(user.cast("string"), 9, "0"), "@example.org")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """users: one row per customer."""
    customer = read(spark, sf_dir, "customer")
    nation = read(spark, sf_dir, "nation")
    name = say("int:", F.col("c_name"), "|no:", F.col("c_mktsegment"))
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        word("c_custkey").alias(model.USER_KEY),
        text.multilang_map(name).alias("name_multilang"),
        say(F.lower("c_name"), "@example.org").alias("email"),
        say("team", F.col("c_nationkey")).alias("upn"),
        say("ext_", F.col("c_custkey")).alias("external_user_id"),
        F.col("n_name").alias("country"),
    )


def resumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cvs: one row per order."""
    sfia = F.left("o_orderpriority", F.lit(1)).cast("int") + 1
    return read(spark, sf_dir, "orders").select(
        word("o_orderkey").alias(model.CV_KEY),
        word("o_custkey").alias(model.USER_KEY),
        text.multilang_map(say("int:", F.col("o_orderpriority"))).alias("title_multilang"),
        sfia.alias("sfia_level"),
        career.cpd_label(sfia).alias("cpd_label"),
    )


def lines_with_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    part = read(spark, sf_dir, "part")
    return lines.join(part, lines.l_partkey == part.p_partkey)


def skill_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Technologies as they come in: a CV may name one several times."""
    return lines_with_part(spark, sf_dir).select(
        word("l_orderkey").alias(model.CV_KEY),
        F.col("p_brand").alias("technology"),
        F.col("l_quantity").cast("int").alias("years_experience"),
        (F.col("l_linenumber") % 6).alias("proficiency"),
        *SKILL_ORDER,
    )


def technologies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cv_technology: the last row of each CV and technology."""
    return latest_per_key(skill_rows(spark, sf_dir), model.CV_TECHNOLOGY.key, SKILL_ORDER)


def clearances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_clearance: each person, clearance and start once."""
    return read(spark, sf_dir, "events").select(
        word("user_id").alias(model.USER_KEY),
        F.col("event_type").alias("clearance"),
        F.to_date("ts").alias("valid_from"),
    ).distinct()


def availability_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select(
        word("user_id").alias(model.USER_KEY),
        F.to_date("ts").alias("date"),
        numbers.clamp_percent(F.col("value")).alias("percent_available"),
        "event_id",
        F.hour("ts").alias("hour"),
    )


def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_availability: the last row of each person and day."""
    return latest_per_key(
        availability_events(spark, sf_dir).drop("hour"), model.USER_AVAILABILITY.key, ["event_id"]
    )

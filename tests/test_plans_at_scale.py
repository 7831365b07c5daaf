"""What the plans look like when nothing is small enough to broadcast."""

import contextlib

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from skillmill import model
from skillmill.operators import lookup
from skillmill.operators.upsert import latest_per_key
from skillmill.plans import derive, profile

SF = "/root/testdata/sf0.001"


@contextlib.contextmanager
def conf(spark, **values):
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}
EAGER_SPLIT = {
    **NO_BROADCAST,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20000",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10000",
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__shuffle__partitions": "16",
}


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, tmp_path, n=60000):
    """Rows of which a third belong to one key, written out as several files."""
    i = F.col("id")
    df = spark.range(n).select(
        F.when(i % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), i % 997)).alias("k"),
        F.concat(F.lit("c"), i).alias("c"),
        F.sha2(i.cast("string"), 256).alias("v"),
        i.alias("n"),
    )
    df.repartition(8).write.parquet(str(tmp_path / "skewed"))
    return spark.read.parquet(str(tmp_path / "skewed"))


def test_hot_key_of_a_lookup_is_split(spark, tmp_path):
    facts = skewed(spark, tmp_path)
    table = facts.groupBy("k").agg(F.max("n").alias("top"))
    with conf(spark, **EAGER_SPLIT):
        joined = lookup.lookup(facts, table, "k", "inner")
        assert "skew=true" in final_plan(joined.select("c", "v", "top"))
        assert joined.count() == facts.count()


def test_hot_person_of_the_profile_is_split(spark, tmp_path):
    facts = skewed(spark, tmp_path)
    cvs = facts.select(
        F.col("c").alias(model.CV_KEY),
        F.col("k").alias(model.USER_KEY),
        F.create_map(F.lit("int"), F.col("v")).alias("title_multilang"),
        F.lit(3).alias("sfia_level"),
        F.col("v").alias("cpd_label"),
    )
    users = facts.select(F.col("k").alias(model.USER_KEY)).distinct().select(
        model.USER_KEY,
        F.create_map(F.lit("int"), F.col(model.USER_KEY)).alias("name_multilang"),
        F.lit("UK").alias("country"),
    )
    technologies = facts.select(
        F.col("c").alias(model.CV_KEY), F.lit("Go").alias("technology"), F.lit(1).alias("years_experience")
    )
    clearances = users.select(model.USER_KEY, F.lit("SC").alias("clearance"))
    availability = users.select(
        model.USER_KEY, F.current_date().alias("date"), F.lit(50).alias("percent_available")
    )
    with conf(spark, **EAGER_SPLIT):
        found = profile.search_profile(users, cvs, technologies, clearances, availability)
        assert "skew=true" in final_plan(found)
        assert found.count() == facts.count()


def test_hot_parent_of_a_section_is_split(spark, tmp_path):
    facts = skewed(spark, tmp_path)
    parents = spark.range(997).select(F.concat(F.lit("k"), "id").alias("k")).unionByName(
        spark.createDataFrame([("hot",)], "k string")
    )
    with conf(spark, **EAGER_SPLIT):
        kept = lookup.known_only(latest_per_key(facts, ["k", "c"], ["n"]), parents, "k")
        assert "skew=true" in final_plan(kept)
        assert kept.count() == facts.count()


def test_last_row_per_key_is_reduced_before_the_shuffle(spark, tmp_path):
    facts = skewed(spark, tmp_path)
    with conf(spark, **NO_BROADCAST):
        newest = latest_per_key(facts, ["k"], ["n"])
        text = plan(newest)
        assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
        first = latest_per_key(facts, ["k"], ["n"], first_writer=["c"])
        assert plan(first).count("WindowGroupLimit") == 4 and plan(first).count("Exchange") == 2
        assert "SortAggregate" not in plan(first)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_no_cross_join_no_python_and_no_single_task(spark, name):
    with conf(spark, **NO_BROADCAST):
        text = plan(driver.queries()[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython",
                "BatchEvalPython", "MapInPandas"):
        assert bad not in text, bad
    # A single partition is only ever the end of a global aggregate or a top-k.
    for line in text.splitlines():
        if "SinglePartition" in line:
            assert name in (
                "latest_snapshot", "kpi_counts", "kpi_available", "kpi_mean", "kpi_report",
                "dq_not_null", "dq_unique", "dq_fk", "dq_range",
            ), line


def test_scans_read_only_what_is_needed(spark):
    text = plan(driver.queries()["top_skills"](spark, SF))
    scan = next(line for line in text.splitlines() if "lineitem" in line)
    assert "ReadSchema" in scan or "FileScan" in scan
    assert "l_extendedprice" not in scan and "l_tax" not in scan
    pushed = plan(driver.queries()["cascade_delete"](spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderstatus), Not(EqualTo(o_orderstatus,P))" in pushed


def test_hot_person_of_the_facts_is_split(spark, tmp_path):
    facts = skewed(spark, tmp_path).select(
        F.concat("k", F.lit("@x.org")).alias("email"),
        F.lit(None).cast("string").alias("upn"),
        F.lit("").alias("external_user_id"),
        "c",
        "v",
    )
    users = facts.select("email").distinct().select(
        F.upper("email").alias(model.USER_KEY),
        F.upper("email").alias("email"),
        F.lit(None).cast("string").alias("upn"),
        F.lit(None).cast("string").alias("external_user_id"),
    )
    with conf(spark, **EAGER_SPLIT):
        found = lookup.resolve_identity(facts, users, model.USER_KEY)
        assert "skew=true" in final_plan(found)
        assert found.count() == facts.count()


def test_export_keeps_a_hot_cv_apart(spark, tmp_path):
    section = skewed(spark, tmp_path).select(
        F.col("k").alias("CV Partner CV ID"), F.col("c").alias("CV Partner section ID"), F.col("v").alias("Label")
    )
    cvs = section.select("CV Partner CV ID").distinct().withColumn(
        "CV Partner User ID", F.concat(F.lit("u"), F.col("CV Partner CV ID"))
    )
    users = cvs.select("CV Partner User ID").distinct().withColumn("Email", F.lit("a@x.org"))
    with conf(spark, **EAGER_SPLIT):
        found = derive.report_layout(users, cvs, section)
        assert "skew=true" in final_plan(found)
        assert found.count() == section.count()

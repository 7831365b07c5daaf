import datetime as dt

import pytest
from pyspark.sql import functions as F

from skillmill import model
from skillmill.operators import lookup, quality
from skillmill.operators.upsert import latest_per_key, new_members, upsert
from skillmill.plans import derive, kpi, profile, tables, transform

ORDER = ("n",)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# --- upsert ---------------------------------------------------------------------


def test_last_row_wins_even_with_a_null(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", 1), ("a", None, "y", 3), ("a", 5, "z", 2), ("b", 7, None, 1)],
        "k string, v int, w string, n int",
    )
    assert rows(latest_per_key(df, ["k"], ORDER), "k", "v", "w") == [("a", None, "y"), ("b", 7, None)]
    kept = latest_per_key(df, ["k"], ORDER, keep_order=True)
    assert kept.columns == ["k", "v", "w", "n"]


def test_first_writer_columns_stay(spark):
    schema = "k string, owner string, v int, n int"
    first = spark.createDataFrame([("a", "u1", 1, 1), ("a", "u2", 2, 2), ("c", None, 1, 3)], schema)
    stored = upsert(None, first, ["k"], ORDER, ["owner"])
    assert rows(stored, "k", "owner", "v") == [("a", "u1", 2), ("c", None, 1)]
    second = spark.createDataFrame([("a", "u3", 9, 1), ("b", "u4", 4, 1), ("c", "u9", 5, 1)], schema)
    after = upsert(stored, second, ["k"], ORDER, ["owner"])
    assert rows(after, "k", "owner", "v") == [("a", "u1", 9), ("b", "u4", 4), ("c", None, 5)]


def test_upsert_against_a_plain_loop(spark):
    import random

    rng = random.Random(7)
    first = [(rng.randrange(30), rng.randrange(9), i) for i in range(200)]
    second = [(rng.randrange(40), rng.randrange(9), i) for i in range(150)]
    expected = {}
    for k, v, _ in first + second:
        expected[k] = v
    schema = "k int, v int, n int"
    stored = upsert(None, spark.createDataFrame(first, schema), ["k"], ORDER)
    after = upsert(stored, spark.createDataFrame(second, schema), ["k"], ORDER)
    assert {r["k"]: r["v"] for r in after.collect()} == expected
    # Loading the same batch again changes nothing.
    again = upsert(after, spark.createDataFrame(second, schema), ["k"], ORDER)
    assert {r["k"]: r["v"] for r in again.collect()} == expected and again.count() == len(expected)


def test_new_members(spark):
    names = spark.createDataFrame([("a",), ("a",), ("",), (None,), ("b",), (" ",)], "name string")
    known = spark.createDataFrame([("b",)], "name string")
    assert rows(new_members(names, known), "name") == [(" ",), ("a",)]


# --- lookups --------------------------------------------------------------------


def test_identity_order(spark):
    users = spark.createDataFrame(
        [("1", "a@x.org", "ann", "e1"), ("2", "b@x.org", "ann", "e2"), ("3", None, "", "E3")],
        f"{model.USER_KEY} string, email string, upn string, external_user_id string",
    )
    facts = spark.createDataFrame(
        [
            (1, "A@X.org", "zoe", "e2"),  # e-mail first, in any case
            (2, "nobody@x.org", "ANN", "e2"),  # unmatched e-mail falls through; smallest user
            (3, "", None, "e2"),
            (4, None, "", "e3"),  # external ids keep their case
            (5, None, None, None),
            (6, None, None, "E3"),
        ],
        "i int, email string, upn string, external_user_id string",
    )
    found = lookup.resolve_identity(facts, users, model.USER_KEY)
    assert rows(found, "i", model.USER_KEY) == [(1, "1"), (2, "1"), (3, "2"), (6, "3")]
    left = lookup.resolve_identity(facts, users, model.USER_KEY, how="left")
    assert rows(left.filter(F.col(model.USER_KEY).isNull()), "i") == [(4,), (5,)]
    assert left.count() == 6 and left.columns == facts.columns + [model.USER_KEY]


def test_unmatched_rows_and_counts(spark):
    facts = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, i int")
    parents = spark.createDataFrame([("a",)], "k string")
    assert rows(lookup.known_only(facts, parents, "k"), "i") == [(1,)]
    assert rows(lookup.unmatched(facts, parents, "k"), "i") == [(2,), (3,), (4,)]
    assert rows(lookup.unmatched_counts(facts, parents, "k"), "k", "rows") == [("b", 2), (None, 1)]


# --- typed rows and tables --------------------------------------------------------


def report(spark, names, data):
    schema = ", ".join(f"`{n}` string" for n in names) + ", n int"
    return spark.createDataFrame([(*r, i) for i, r in enumerate(data)], schema)


def test_unknown_cv_is_skipped_and_bad_cells_are_named(spark):
    df = report(
        spark,
        ["CV Partner CV ID", "CV Partner section ID", "Year from", "Updated", "Highlighted"],
        [
            ("keep", "s1", "2020", "2024-01-01", "yes"),
            ("skip", "s1", "2020", None, None),
            ("keep", "s1", "2021", "01/02/2024", "off"),
            ("keep", "s2", "soon", "2024-02-30", "maybe"),
            ("skip", None, "soon", None, None),
            ("keep", None, "2020", None, None),
        ],
    )
    cvs = spark.createDataFrame([("keep",)], f"{model.CV_KEY} string")
    typed = transform.typed_rows(df, model.POSITION, ORDER)
    built = tables.build(model.POSITION, typed, cvs, order=ORDER)
    assert built.schema.fieldNames() == model.schema(model.POSITION).fieldNames()
    assert [f.dataType for f in built.schema] == [f.dataType for f in model.schema(model.POSITION)]
    assert rows(built, model.CV_KEY, "year_from", "updated", "highlighted") == [
        ("keep", 2021, dt.date(2024, 2, 1), False)
    ]
    bad = tables.rejects(model.POSITION, typed, cvs, ORDER)
    assert rows(bad, "problem") == [
        ("cv_partner_section_id",), ("year_from, highlighted, updated",),
    ]
    lost = tables.missing_parents(tables.pointers(model.POSITION, typed), cvs.withColumnRenamed(model.CV_KEY, "parent"))
    assert rows(lost, "table_name", "parent", "rows") == [("position", "skip", 2)]


def test_cv_belongs_to_its_first_known_person(spark):
    df = report(
        spark,
        ["CV Partner CV ID", "CV Partner User ID", "Years of education"],
        [("c", "ghost", "1"), ("c", "u1", "2"), ("c", "u2", "3"), ("c", "ghost", "4")],
    )
    users = spark.createDataFrame([("u1",), ("u2",)], f"{model.USER_KEY} string")
    built = tables.build(model.CVS, transform.cv_rows(df, ORDER), users, order=ORDER)
    assert rows(built, model.USER_KEY, "years_of_education") == [("u1", 3)]


def test_technology_without_a_name_is_left_out(spark):
    df = report(
        spark,
        ["CV Partner CV ID", "Skill name", "Year experience"],
        [("c", None, "1"), ("c", "", "1"), ("c", "Go", "2"), ("c", "Go", "3")],
    )
    cvs = spark.createDataFrame([("c",)], f"{model.CV_KEY} string")
    typed = transform.typed_rows(df, model.CV_TECHNOLOGY, ORDER)
    built = tables.build(model.CV_TECHNOLOGY, typed, cvs, order=ORDER)
    assert rows(built, "technology", "years_experience", "is_official_masterdata") == [("Go", 3, "{}")]
    assert tables.rejects(model.CV_TECHNOLOGY, typed, cvs, ORDER).count() == 0
    dimension = tables.dimension("dim_technology", {"cv_technology": built})
    joined = built.join(dimension, "technology_id")
    assert rows(joined, "name") == [("Go",)]


def test_clearance_defaults_and_repair(spark):
    users = spark.createDataFrame(
        [("1", "a@x.org", None, None)],
        f"{model.USER_KEY} string, email string, upn string, external_user_id string",
    )
    df = report(
        spark,
        ["Email", "Clearance", "Valid From", "Valid To", "Verified By"],
        [
            ("a@x.org", " SC ", "02/01/2024", "2023-01-01", "  "),
            ("a@x.org", None, "never", None, " HR"),
            ("z@x.org", "SC", "2024-01-01", None, None),
        ],
    )
    built = tables.build(
        model.USER_CLEARANCE, transform.clearance_rows(df, users, ORDER), order=ORDER
    )
    assert rows(built, "clearance", "valid_from", "valid_to", "verified_by", "notes") == [
        ("None", dt.date(1900, 1, 1), None, "HR", None),
        ("SC", dt.date(2024, 1, 2), None, None, None),
    ]


def test_availability_clamp_and_default(spark):
    users = spark.createDataFrame(
        [("1", "a@x.org", "ann", None)],
        f"{model.USER_KEY} string, email string, upn string, external_user_id string",
    )
    df = report(
        spark,
        ["UPN", "Date", "Percent Available", "Source"],
        [("ann", "2024-01-01", "150", None), ("Ann", "2024-01-02", None, "x"), ("ann", "", "5", "x")],
    )
    now = dt.datetime(2024, 5, 1, 8)
    typed = transform.availability_rows(df, users, now, ORDER)
    built = tables.build(model.USER_AVAILABILITY, typed, order=ORDER)
    assert rows(built, "date", "percent_available", "source") == [
        (dt.date(2024, 1, 1), 100, "Fake generator"), (dt.date(2024, 1, 2), 0, "x"),
    ]
    assert rows(tables.rejects(model.USER_AVAILABILITY, typed, order=ORDER), "problem") == [("date",)]


def test_nationality_of_the_last_usage_row(spark):
    users = report(spark, ["CV Partner User ID"], [("1",), ("2",), ("1",)])
    usage = report(
        spark,
        ["CV Partner User ID", "Nationality (#{lang})"],
        [("1", "int:UK"), ("1", None), ("2", "int:NO|no:Norge"), (None, "int:X")],
    )
    found = transform.with_nationality(users, usage, ORDER)
    assert [(r[0], r["nationality_multilang"]) for r in found.orderBy("n").collect()] == [
        ("1", {}), ("2", {"int": "NO", "no": "Norge"}), ("1", {}),
    ]


def test_missing_columns_give_empty_values(spark):
    users = report(spark, ["CV Partner User ID", "CV Partner CV ID"], [("1", "c1")])
    user = tables.build(model.USERS, transform.user_rows(users, None, ORDER), order=ORDER).first()
    assert user["name_multilang"] == {} and user["nationality_multilang"] == {}
    assert user["birth_year"] is None and user["user_id"] is not None
    cv = tables.build(model.CVS, transform.cv_rows(users, ORDER), order=ORDER).first()
    assert cv["title_multilang"] == {} and cv["sfia_level"] is None


def test_user_report_is_checked(spark):
    empty = report(spark, ["CV Partner User ID"], [])
    for reports in ({}, {transform.USER_REPORT: empty}):
        with pytest.raises(ValueError, match="no rows"):
            transform.require_users(reports)


# --- profile and figures ------------------------------------------------------------


def profile_inputs(spark):
    users = spark.createDataFrame(
        [("1", {"int": "Ann"}, "UK"), ("x2", {"no": "Bo"}, None)],
        f"{model.USER_KEY} string, name_multilang map<string,string>, country string",
    )
    cvs = spark.createDataFrame(
        [("c1", "1", {"int": "Dev"}, 4, "CPD3E"), ("c2", "1", {}, None, None), ("c3", "x2", {}, 2, "l")],
        f"{model.CV_KEY} string, {model.USER_KEY} string, title_multilang map<string,string>, "
        "sfia_level int, cpd_label string",
    )
    technologies = spark.createDataFrame(
        [("c1", "SQL", 3), ("c1", "Go", 9), ("c1", "dbt", None), ("c3", "Go", 1)],
        f"{model.CV_KEY} string, technology string, years_experience int",
    )
    clearances = spark.createDataFrame(
        [("1", "NPPV2"), ("1", "None"), ("x2", "SC")], f"{model.USER_KEY} string, clearance string"
    )
    day = dt.date(2024, 1, 1)
    availability = spark.createDataFrame(
        [("1", day, 10), ("1", dt.date(2030, 1, 1), 60), ("x2", day, 40)],
        f"{model.USER_KEY} string, date date, percent_available int",
    )
    return users, cvs, technologies, clearances, availability


def test_profile_values(spark):
    found = profile.search_profile(*profile_inputs(spark))
    columns = [
        model.CV_KEY, "user_name", "cv_title", "technologies", "max_years_experience", "clearance",
        "latest_availability_date", "latest_percent_available",
    ]
    assert rows(found, *columns) == [
        ("c1", "Ann", "Dev", "Go, SQL, dbt", 9, "None", dt.date(2030, 1, 1), 60),
        ("c2", "Ann", None, None, None, "None", dt.date(2030, 1, 1), 60),
        ("c3", None, None, "Go", 1, "SC", dt.date(2024, 1, 1), 40),
    ]
    assert rows(profile.numeric_subset(found), model.CV_KEY) == [("c1",), ("c2",)]
    assert len(found.columns) == 14


def test_clearance_order_may_follow_a_collation(spark):
    clearances = profile_inputs(spark)[3]
    found = profile.highest_clearance(clearances, collation="UNICODE")
    assert rows(found, model.USER_KEY, "clearance") == [("1", "NPPV2"), ("x2", "SC")]


def test_figures(spark):
    users, cvs, technologies, clearances, availability = profile_inputs(spark)
    found = profile.search_profile(users, cvs, technologies, clearances, availability)
    figures = kpi.headline_figures(users, cvs, technologies, found, availability)
    assert {r["metric"]: r["value"] for r in figures.collect()} == {
        "users": 2.0, "cvs": 3.0, "top_skill:Go": 2.0, "top_skill:SQL": 1.0, "top_skill:dbt": 1.0,
        "sc_available": 0.0, "mean_availability": 110 / 3,
    }
    nothing = kpi.mean_availability(availability.filter("false"))
    assert rows(nothing, "value") == [(0.0,)]


# --- derived rows -------------------------------------------------------------------


def test_calendar(spark):
    people = spark.createDataFrame([("a", 130.0), ("b", 20.5)], "k string, p double")
    found = derive.availability_calendar(people, "k", F.col("p"), dt.date(2024, 3, 1), 4)
    assert rows(found, "k", "date", "percent_available") == [
        (k, dt.date(2024, 3, d), 100 if d in (2, 3) or k == "a" else 20)
        for k in "ab"
        for d in (1, 2, 3, 4)
    ]


def test_report_layout_has_the_section_name_in_both_places(spark):
    users = spark.createDataFrame(
        [("1", "Ann", "a@x.org")], "`CV Partner User ID` string, Name string, Email string"
    )
    cvs = spark.createDataFrame(
        [("c1", "1", "int:Dev")],
        "`CV Partner CV ID` string, `CV Partner User ID` string, `Title (#{lang})` string",
    )
    section = spark.createDataFrame([("c1", "Tech Lead")], "`CV Partner CV ID` string, Name string")
    found = derive.report_layout(users, cvs, section)
    assert found.columns == [*model.BASE_HEADERS, "Name.1"]
    row = found.first()
    assert (row["Name"], row["Name.1"], row["CV Partner CV ID"], row["Country"]) == (
        "Tech Lead", "Tech Lead", "c1", None,
    )


def test_section_summary_has_a_row_for_every_cv(spark):
    cvs = spark.createDataFrame([("a",), ("b",)], "cv_id string")
    work = spark.createDataFrame([("a", dt.date(2024, 1, 2))], "cv_id string, updated_by_owner date")
    found = derive.section_summary({"work": work}, "cv_id", cvs=cvs)
    assert rows(found, "cv_id", "work_count", "work_updated") == [("a", 1, dt.date(2024, 1, 2)), ("b", 0, None)]


# --- checks -------------------------------------------------------------------------


def test_checks(spark):
    child = spark.createDataFrame([("a", 1), ("a", None), ("z", 101), (None, 5)], "k string, v int")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    findings = quality.stack(
        [
            quality.not_null(child, "child", ["k", "v"]),
            quality.unique(child, "child", ["k"]),
            quality.foreign_key(child, "child", "k", parent, "k"),
            quality.in_range(child, "child", "v", 0, 100),
        ]
    )
    assert {(r[1], r[2]): r[3] for r in findings.collect()} == {
        ("not_null", "k"): 1, ("not_null", "v"): 1, ("unique", "k"): 1, ("foreign_key", "k"): 1,
        ("range", "v"): 1,
    }
    survivors = parent.filter("k = 'b'")
    assert quality.cascade(child, survivors, "k").count() == 0
    assert rows(quality.restrict(child, parent.filter("k = 'a'"), "k"), "k", "rows") == [("a", 2)]

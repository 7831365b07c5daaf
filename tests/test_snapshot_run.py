import datetime as dt
import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from skillmill import model
from skillmill.operators import lookup
from skillmill.operators.quality import broken, check_rows, check_tables, row_checks
from skillmill.plans import tables
from skillmill.plans.export import export_snapshot, write_lines
from skillmill.plans.snapshot_run import PROFILE, LoadError, parents_of, run_snapshot
from skillmill.sources.reports import read_report
from skillmill.sources.snapshots import DELIVERED_REPORTS
from skillmill.sources.warehouse import Warehouse, write_report
from tests.fixture_reports import REPORTS, write_snapshot

T1 = dt.datetime(2024, 5, 1, 12, 0, 0)
T2 = dt.datetime(2024, 8, 1, 12, 0, 0)
T3 = dt.datetime(2024, 9, 1, 12, 0, 0)
T4 = dt.datetime(2024, 10, 1, 12, 0, 0)


def run(spark, reports, warehouse, when=T1, **options):
    return run_snapshot(spark, str(reports), str(warehouse), when, **options)


def rows(spark, warehouse, table):
    return [r.asDict() for r in Warehouse(spark, str(warehouse)).table(table).collect()]


def test_single_person_snapshot(spark, tmp_path):
    write_snapshot(tmp_path / "in")
    result = run(spark, tmp_path / "in", tmp_path / "out")
    profile = rows(spark, tmp_path / "out", PROFILE)
    assert len(profile) == 1
    shown = {k: v for k, v in profile[0].items() if k not in ("user_id", "cv_id")}
    assert shown == {
        "cv_partner_user_id": "1",
        "user_name": "Mira Holt",
        "cv_partner_cv_id": "c-77",
        "cv_title": "Rail Surveyor",
        "sfia_level": 5,
        "cpd_label": "CPD3L",
        "country": "UK",
        "technologies": "Levelling",
        "max_years_experience": 6,
        "clearance": "SC",
        "latest_availability_date": dt.date(2024, 4, 1),
        "latest_percent_available": 65,
    }
    assert result.figures == {
        "users": 1.0,
        "cvs": 1.0,
        "top_skill:Levelling": 1.0,
        "sc_available": 1.0,
        "mean_availability": 65.0,
    }
    user = rows(spark, tmp_path / "out", "users")[0]
    assert user["birth_year"] == 1979
    assert user["name_multilang"] == {"int": "Mira Holt", "no": "Mira"}
    assert user["nationality_multilang"] == {"int": "UK"}
    # The certificate names a CV that does not exist.
    assert rows(spark, tmp_path / "out", "certification") == []
    assert rows(spark, tmp_path / "out", "skipped") == [
        {"table_name": "certification", "parent": "1", "rows": 1}
    ]
    for table in model.SECTIONS:
        if table.name != "certification":
            assert len(rows(spark, tmp_path / "out", table.name)) == 1, table.name
    assert rows(spark, tmp_path / "out", "key_qualification")[0]["short_description"] == "Levelling"
    project = rows(spark, tmp_path / "out", "project_experience")[0]
    assert project["industry"] == "Transport"
    assert project["extent_hours"] == 96
    assert project["customer_multilang"] == '"{\\"int\\":\\"Norrland Rail\\"}"'
    assert rows(spark, tmp_path / "out", "dim_industry")[0]["name"] == "Transport"

    # Exported under the delivered headers, the reports load to the same tables again.
    names = export_snapshot(spark, str(tmp_path / "out"), str(tmp_path / "again" / "Q12024"))
    assert sorted(names) == sorted(DELIVERED_REPORTS)
    for name in names:
        parts = [p.read_text(encoding="utf-8") for p in (tmp_path / "again" / "Q12024" / f"{name}.csv").glob("part-*")]
        assert any(parts)
        for header in [text.split("\n", 1)[0] for text in parts if text]:
            assert header.startswith("Name,Name (multilang),Title (#{lang}),") and ".1" not in header
    run(spark, tmp_path / "again", tmp_path / "second")
    first, second = (Warehouse(spark, str(tmp_path / x)).tables() for x in ("out", "second"))
    for table in (model.USERS, model.CVS, *model.SECTIONS):
        mine, theirs = (sorted(str(r.asDict()) for r in t[table.name].collect()) for t in (first, second))
        assert mine == theirs, table.name
    usage = read_report(spark, str(tmp_path / "again" / "Q12024" / "usage_report.csv")).first().asDict()
    counts = {k: usage[k] for k in ("Project Experiences", "Unique roles", "Highlighted roles", "Positions", "Certifications", "Mentoring")}
    assert counts == {"Project Experiences": "1", "Unique roles": "1", "Highlighted roles": "1", "Positions": "1", "Certifications": "0", "Mentoring": "0"}
    assert usage["Owner last updated Positions"] == "2024-02-19" and usage["Owner last updated Certifications"] is None
    positions = read_report(spark, str(tmp_path / "again" / "Q12024" / "positions.csv")).first()
    assert positions["Name"] == positions["Name.1"] == "Crew Head"
    with pytest.raises(ValueError, match="not newer"):
        run(spark, tmp_path / "in", tmp_path / "out")


def test_strict_headers_leave_renamed_columns_empty(spark, tmp_path):
    write_snapshot(tmp_path / "in")
    run(spark, tmp_path / "in", tmp_path / "out", strict_headers=True)
    project = rows(spark, tmp_path / "out", "project_experience")[0]
    assert project["industry"] is None and project["extent_hours"] is None
    assert project["customer_anon_multilang"] == "{}"
    assert rows(spark, tmp_path / "out", "dim_industry") == []


def test_refresh_and_retention(spark, tmp_path):
    write_snapshot(tmp_path / "in")
    run(spark, tmp_path / "in", tmp_path / "out")
    second = {
        "availability_report.csv": (
            "Email,Date,Percent Available,Source\n"
            "mira@holt.example,2024-04-01,30,Manual\n"
            "MIRA@holt.example,2024-07-01,150,\n"
            "ghost@none.example,2024-07-01,10,\n"
            "ghost@none.example,2024-07-02,10,\n"
        ),
        "sc_clearance.csv": "Email,Clearance,Valid From,Valid To\nmira@holt.example,,,\n,SC,,\n",
        "technologies.csv": (
            "CV Partner CV ID,Skill name,Year experience,Proficiency (0-5)\n"
            "c-77,SQL,7,3\nnobody,Perl,1,1\n"
        ),
        "project_experiences.csv": (
            "CV Partner CV ID,CV Partner section ID,Industry (int)\n"
            "c-77,p1,Bank\nc-77,p1,Health\nnobody,p1,Space\n"
        ),
    }
    write_snapshot(tmp_path / "in", "Q22024", second)
    result = run(spark, tmp_path / "in", tmp_path / "out", T2)
    assert result.snapshot.endswith("Q22024")
    availability = {
        r["date"].isoformat(): (r["percent_available"], r["source"])
        for r in rows(spark, tmp_path / "out", "user_availability")
    }
    assert availability == {
        "2024-04-01": (30, "Manual"),
        "2024-07-01": (100, "Fake generator"),
    }
    # Rows that name nobody are counted, those without any identifier under null.
    people = [r for r in rows(spark, tmp_path / "out", "skipped") if r["table_name"].startswith("user_")]
    assert sorted(people, key=lambda r: r["table_name"]) == [
        {"table_name": "user_availability", "parent": "ghost@none.example", "rows": 2},
        {"table_name": "user_clearance", "parent": None, "rows": 1},
    ]
    clearances = {(r["clearance"], r["valid_from"].isoformat()) for r in rows(spark, tmp_path / "out", "user_clearance")}
    assert clearances == {("SC", "2023-01-01"), ("None", "1900-01-01")}
    assert {r["name"] for r in rows(spark, tmp_path / "out", "dim_clearance")} == {"SC", "None"}
    # A dimension holds every name that came in for a known CV; for technologies also the others.
    names = {
        d: {r["name"] for r in rows(spark, tmp_path / "out", d)}
        for d in ("dim_technology", "dim_industry", "dim_project_type")
    }
    assert names == {
        "dim_technology": {"SQL", "Perl"}, "dim_industry": {"Bank", "Health"}, "dim_project_type": set(),
    }
    assert [r["industry"] for r in rows(spark, tmp_path / "out", "project_experience")] == ["Health"]
    # Technologies are rebuilt, not added to.
    assert [r["technology"] for r in rows(spark, tmp_path / "out", "cv_technology")] == ["SQL"]
    profile = rows(spark, tmp_path / "out", PROFILE)[0]
    assert (profile["technologies"], profile["latest_percent_available"]) == ("SQL", 100)


def test_skipped_refresh_keeps_the_old_profile(spark, tmp_path):
    write_snapshot(tmp_path / "in")
    run(spark, tmp_path / "in", tmp_path / "out")
    changed = {"technologies.csv": "CV Partner CV ID,Skill name,Year experience,Proficiency (0-5)\nc-77,SQL,7,3\n"}
    write_snapshot(tmp_path / "in", "Q22024", changed)
    run(spark, tmp_path / "in", tmp_path / "out", T2, refresh=False)
    assert rows(spark, tmp_path / "out", PROFILE)[0]["technologies"] == "Levelling"
    assert rows(spark, tmp_path / "out", "cv_technology")[0]["technology"] == "SQL"


def test_bad_rows_stop_the_run_or_are_set_aside(spark, tmp_path):
    bad = {
        "positions.csv": (
            "CV Partner CV ID,CV Partner section ID,Year from,Name\n"
            "c-77,p1,2020,Good\nc-77,p2,soon,Bad year\nc-77,,2021,No section\nnobody,p3,soon,Other\n"
        )
    }
    write_snapshot(tmp_path / "in", replace=bad)
    with pytest.raises(LoadError, match="2 rows"):
        run(spark, tmp_path / "in", tmp_path / "out")
    assert Warehouse(spark, str(tmp_path / "out")).paths() == {}
    result = run(spark, tmp_path / "in", tmp_path / "out", T2, on_violation="quarantine")
    assert result.rejected == 2
    assert [r["name"] for r in rows(spark, tmp_path / "out", "position")] == ["Good"]
    problems = {r["problem"] for r in rows(spark, tmp_path / "out", "rejects")}
    assert problems == {"year_from", "cv_partner_section_id"}


def test_malformed_records_are_rejected_with_their_place(spark, tmp_path):
    bad = {
        "positions.csv": "CV Partner CV ID,CV Partner section ID,Name\nc-77,p1,Good\nc-77,p2,Too,long\nnobody,p3,also,long\n",
        "blogs.csv": 'CV Partner CV ID,CV Partner section ID,Name\nc-77,b1,Good\nc-77,b2,"open\nc-77,b3,lost\n',
        "sc_clearance.csv": "Email,Clearance,Valid From\nmira@holt.example,SC,2023-01-01\nmira@holt.example,SC,2024-01-01,x\n",
        "usage_report.csv": "CV Partner User ID,Nationality (#{lang})\n1,int:UK\n1,int:NO,x\n",
    }
    write_snapshot(tmp_path / "in", replace=bad)
    with pytest.raises(LoadError, match="too many cells"):
        run(spark, tmp_path / "in", tmp_path / "out")
    run(spark, tmp_path / "in", tmp_path / "out", T2, on_violation="quarantine")
    found = {(r["table_name"], r["problem"], r["file"].rsplit("/", 1)[1], r["record"]) for r in rows(spark, tmp_path / "out", "rejects")}
    assert found == {
        ("position", "too many cells", "positions.csv", 2), ("position", "too many cells", "positions.csv", 3),
        ("blog_publication", "open quote", "blogs.csv", 2), ("user_clearance", "too many cells", "sc_clearance.csv", 2),
        ("usage_report", "too many cells", "usage_report.csv", 2),
    }
    assert {r["row"] for r in rows(spark, tmp_path / "out", "rejects") if r["table_name"] == "position"} == {"c-77,p2,Too,long", "nobody,p3,also,long"}
    assert [r["name"] for r in rows(spark, tmp_path / "out", "position")] == ["Good"]
    assert rows(spark, tmp_path / "out", "users")[0]["nationality_multilang"] == {"int": "UK"}
    assert {(r["table_name"], r["parent"]) for r in rows(spark, tmp_path / "out", "skipped")} == {("certification", "1")}


def folders(path):
    return {os.path.relpath(d, path) for d, _, _ in os.walk(path)}


def test_history_is_kept_by_period_and_versions_are_cleared(spark, tmp_path):
    out = tmp_path / "out"
    head = "Email,Date,Percent Available,Source\n"
    first = {"availability_report.csv": head + "mira@holt.example,2024-04-01,65,\nmira@holt.example,2024-05-01,10,\n"}
    write_snapshot(tmp_path / "in", replace=first)
    one = run(spark, tmp_path / "in", out)
    assert set(one.paths["user_availability"]) == {"", "2024-04", "2024-05"}
    assert set(one.paths["user_clearance"]) == {"", "2023"}

    # Without the reports, history and its names stay where they are.
    write_snapshot(tmp_path / "in", "Q22024", first, leave_out=("availability_report.csv", "sc_clearance.csv"))
    two = run(spark, tmp_path / "in", out, T2)
    for name in ("user_availability", "user_clearance", "dim_clearance", "id_exceptions"):
        assert two.paths[name] == one.paths[name]
    assert len(rows(spark, out, "user_availability")) == 2

    # A failed run leaves nothing behind.
    before = folders(out)
    write_snapshot(tmp_path / "in", "Q32024", {"positions.csv": "CV Partner CV ID,CV Partner section ID\nc-77,p1,x\n"})
    with pytest.raises(LoadError):
        run(spark, tmp_path / "in", out, T3)
    assert folders(out) == before

    # A new month and a changed one are written; the other stays, as do the paths that are still named.
    third = {"availability_report.csv": head + "mira@holt.example,2024-05-01,20,Later\nmira@holt.example,2024-06-01,30,\n"}
    write_snapshot(tmp_path / "in", "Q42024", third)
    three = run(spark, tmp_path / "in", out, T4, keep_versions=1, defaults=model.Defaults(source="Nobody"))
    parts = three.paths["user_availability"]
    assert parts["2024-04"] == one.paths["user_availability"]["2024-04"]
    assert parts["2024-05"] != one.paths["user_availability"]["2024-05"]
    found = {(r["date"].isoformat(), r["percent_available"], r["source"]) for r in rows(spark, out, "user_availability")}
    assert found == {("2024-04-01", 65, "Fake generator"), ("2024-05-01", 20, "Later"), ("2024-06-01", 30, "Nobody")}
    held = folders(out)
    v1, v2, v4 = (f"v={t:%Y%m%dT%H%M%S%f}" for t in (T1, T2, T4))
    assert f"{v1}/user_availability/part=2024-04" in held and f"{v1}/user_availability/part=2024-05" not in held
    assert f"{v1}/users" not in held and v2 not in held and f"{v4}/users" in held
    assert not any(f.split("/")[1:2] in (["rows"], ["raw"]) for f in held)
    assert [f for f in held if f.startswith("manifest/")] == [f"manifest/published={T4:%Y%m%dT%H%M%S%f}"]
    # Every table of the version left can be read, and passes the full audit.
    tables_ = Warehouse(spark, str(out)).tables()
    assert all(df.count() >= 0 for df in tables_.values())
    for check in check_tables(tables_, parents_of()):
        assert check.filter("violations > 0").collect() == []


def test_clashing_ids_are_told_apart_and_stay(spark, tmp_path, monkeypatch):
    def few(*keys):
        return F.pmod(F.xxhash64(*keys), F.lit(3 if len(keys) == 1 else 1000)).cast("long")

    monkeypatch.setattr(tables, "surrogate_id", few)
    monkeypatch.setattr(lookup, "surrogate_id", few)
    skills = ["SQL", "Perl", "Go", "Lisp", "Ada"]
    head = "CV Partner CV ID,Skill name\n"
    write_snapshot(tmp_path / "in", replace={"technologies.csv": head + "".join(f"c-77,{x}\n" for x in skills)})
    run(spark, tmp_path / "in", tmp_path / "out")
    first = {r["name"]: r["technology_id"] for r in rows(spark, tmp_path / "out", "dim_technology")}
    assert set(first) == set(skills) and len(set(first.values())) == 5
    assert {r["technology"]: r["technology_id"] for r in rows(spark, tmp_path / "out", "cv_technology")} == first
    # A later run adds names; those that were there keep their ids.
    more = [*skills[::-1], "C", "Java"]
    write_snapshot(tmp_path / "in", "Q22024", {"technologies.csv": head + "".join(f"c-77,{x}\n" for x in more)})
    run(spark, tmp_path / "in", tmp_path / "out", T2)
    second = {r["name"]: r["technology_id"] for r in rows(spark, tmp_path / "out", "dim_technology")}
    assert {k: second[k] for k in first} == first and len(set(second.values())) == 7
    assert {r["technology"]: r["technology_id"] for r in rows(spark, tmp_path / "out", "cv_technology")} == second


def test_row_checks_find_what_the_definition_forbids(spark):
    table = model.USER_AVAILABILITY
    good = [1, "1", dt.date(2024, 1, 1), 50, "x", T1]
    bad = [[None, None, dt.date(2024, 1, 2), 101, "x", T1], [1, "1", dt.date(2024, 1, 3), None, "x", None], [1, "1", dt.date(2024, 1, 4), -1, None, T1]]
    df = spark.createDataFrame([good, *bad], model.schema(table))
    found = {(r["check_name"], r["column_name"]): r["violations"] for r in check_rows(df, table).collect()}
    assert {k: n for k, n in found.items() if n} == {
        ("not_null", "user_id"): 1, ("not_null", "cv_partner_user_id"): 1, ("not_null", "percent_available"): 1,
        ("not_null", "updated_at"): 1, ("range", "percent_available"): 2,
    }
    seen = Observation()
    df.observe(seen, *row_checks(table)).write.format("noop").mode("overwrite").save()
    assert {tuple(x[1:3]): x[3] for x in broken(table.name, seen.get)} == {k: n for k, n in found.items() if n}


def test_users_are_required(spark, tmp_path):
    write_snapshot(tmp_path / "none", leave_out=("user_report.csv",))
    with pytest.raises(ValueError, match="no rows"):
        run(spark, tmp_path / "none", tmp_path / "out")
    write_snapshot(tmp_path / "noid", replace={"user_report.csv": "Email\na@b.c\n"})
    with pytest.raises(ValueError, match="user id column"):
        run(spark, tmp_path / "noid", tmp_path / "out")


def test_missing_reports_give_empty_tables(spark, tmp_path):
    others = [n for n in REPORTS if n != "user_report.csv"]
    write_snapshot(tmp_path / "in", leave_out=others)
    result = run(spark, tmp_path / "in", tmp_path / "out")
    assert result.figures["users"] == 1.0 and result.figures["mean_availability"] == 0.0
    profile = rows(spark, tmp_path / "out", PROFILE)[0]
    assert profile["technologies"] is None and profile["clearance"] is None
    assert rows(spark, tmp_path / "out", "users")[0]["nationality_multilang"] == {}


def test_first_run_without_a_profile(spark, tmp_path):
    write_snapshot(tmp_path / "in")
    result = run(spark, tmp_path / "in", tmp_path / "out", refresh=False)
    assert rows(spark, tmp_path / "out", PROFILE) == []
    assert result.figures["users"] == 1.0 and result.figures["cvs"] == 1.0


def test_written_reports_keep_the_blanks_of_cells(spark, tmp_path):
    cells = [" NA ", "\ty", "a \"b\"", "line\nbreak", "  x  "]
    df = spark.createDataFrame(list(enumerate(cells)), "no int, cell string")
    write_report(df, str(tmp_path / "cells.csv"))
    again = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "cells.csv"))
    assert [r["cell"] for r in again.orderBy("no").collect()] == cells


def test_lines_under_a_header_that_repeats(spark, tmp_path):
    cells = [" x ", 'a "b", c', "line\nbreak", None, "", ",", '"', "é\t"]
    df = spark.createDataFrame([(str(i), c, c) for i, c in enumerate(cells)], "no string, a string, b string").repartition(3)
    write_lines(df, ("No", "Name", "Name"), str(tmp_path / "r.csv"))
    again = read_report(spark, str(tmp_path / "r.csv"))
    found = {r["No"]: (r["Name"], r["Name.1"]) for r in again.collect()}
    assert found == {str(i): (c or None, c or None) for i, c in enumerate(cells)}
    assert again.filter("_malformed is not null").isEmpty()
    write_lines(df.limit(0), ("No", "Name", "Name"), str(tmp_path / "none.csv"))
    empty = read_report(spark, str(tmp_path / "none.csv"))
    assert empty.columns[:3] == ["No", "Name", "Name.1"] and empty.isEmpty()

import gzip
import json
import os

import pytest

from skillmill.sources import offices, reports, snapshots
from skillmill.sources.warehouse import write_report
from tests.fixture_reports import write_snapshot


def put(folder, name, content):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(content)
    return path


def test_newest_quarter(spark, tmp_path):
    for name in ("Q12024", "Q42023", "notes", "Q52030", "QTEST", "Q12024_old"):
        os.makedirs(tmp_path / name)
    put(tmp_path, "Q42029", "a file, no folder")
    assert snapshots.find_latest_snapshot(spark, str(tmp_path)).endswith("/Q12024_old")
    os.makedirs(tmp_path / "Q22024")
    assert snapshots.find_latest_snapshot(spark, str(tmp_path)).endswith("/Q22024")


def test_no_quarter(spark, tmp_path):
    os.makedirs(tmp_path / "notes")
    with pytest.raises(FileNotFoundError):
        snapshots.find_latest_snapshot(spark, str(tmp_path))


def test_named_snapshot(spark, tmp_path):
    base = write_snapshot(tmp_path, "QREAL_20240501_120000")
    folder, found = reports.extract(spark, base, "QREAL_20240501_120000")
    assert folder.endswith("QREAL_20240501_120000") and len(found) == 15


def test_unreadable_reports_are_left_out(spark, tmp_path):
    put(tmp_path, "empty.csv", "")
    put(tmp_path, "good.csv", "a,b\n1,2\n")
    put(tmp_path, "note.txt", "a\n1\n")
    put(tmp_path / "deeper", "inner.csv", "a\n1\n")
    assert list(reports.read_reports(spark, str(tmp_path))) == ["good.csv"]


def test_dialect(spark, tmp_path):
    path = put(
        tmp_path,
        "r.csv",
        '﻿Name,Text,Name\n001,"say ""hi"", line\nbreak",x\n NA ,NA,None\n,"",  \n',
    )
    df = reports.read_report(spark, path)
    assert df.columns == ["Name", "Text", "Name.1", reports.MALFORMED, *reports.FILE_ORDER]
    rows = df.orderBy(*reports.FILE_ORDER).select("Name", "Text", "`Name.1`").collect()
    assert [tuple(r) for r in rows] == [
        ("001", 'say "hi", line\nbreak', "x"),
        (" NA ", None, None),
        (None, None, "  "),
    ]


def malformed(df):
    """(first cell, problem) in file order."""
    return [(r[0], r[reports.MALFORMED] and r[reports.MALFORMED]["problem"]) for r in df.orderBy(*reports.FILE_ORDER).collect()]


@pytest.mark.parametrize("multi_line", [True, False])
def test_malformed_records_are_marked(spark, tmp_path, multi_line):
    text = (
        'id,note,last\n1,"a, ""b""",x\n2,b,c,d\n3,b,c,\n4,short\n\n   \n5,5" pipe,x\n6,"ok"x,y\n7,,\n'
    )
    path = put(tmp_path, "cells.csv", text)
    found = reports.read_report(spark, path, multi_line)
    assert malformed(found) == [
        ("1", None), ("2", reports.TOO_LONG), ("3", reports.TOO_LONG), ("4", None), ("5", None), ("6", None), ("7", None),
    ]
    long = found.filter("id = '2'").first()
    assert long[reports.MALFORMED]["record"] == "2,b,c,d"
    with open(tmp_path / "bytes.csv", "wb") as f:
        f.write(b"id,note\n1,\xff\xfe\n2,\xc3\xa9\n")
    assert malformed(reports.read_report(spark, str(tmp_path / "bytes.csv"), multi_line)) == [("1", reports.BAD_BYTES), ("2", None)]


@pytest.mark.parametrize(
    "text,expected",
    [
        ('1,x,"open\n2,b,c\n3,d,e\n', [("1", True)]),
        ('1,x,"open\n2,b,c\n3,d,e', [("1", True)]),
        ('1,x,"open', [("1", True)]),
        ('1,"open,x\n2,b,c\n', [("1", True)]),
        ('1,x,"open\n2,b,"c"\n3,d,e\n', [("1", True), ("3", False)]),
        ('1,x,"closed\n2,b,c"\n3,d,"e, f"\n', [("1", False), ("3", False)]),
        ('1,x,"closed\n2,b,c\n"\n', [("1", False)]),
        ('1,x,"""said"" he\nand left"\n2,b,"c"', [("1", False), ("2", False)]),
    ],
)
def test_open_quotes(spark, tmp_path, text, expected):
    path = put(tmp_path / "a b+é%41", "r.csv", "id,note,last\n" + text)
    assert malformed(reports.read_report(spark, path)) == [(i, reports.OPEN_QUOTE if bad else None) for i, bad in expected]


def test_open_quotes_in_lines(spark, tmp_path):
    path = put(tmp_path, "r.csv", 'id,note,last\n1,x,"open\n2,b,c\n3,"a, b",c\n4,"open,c\n')
    found = malformed(reports.read_report(spark, path, multi_line=False))
    assert found == [("1", reports.OPEN_QUOTE), ("2", None), ("3", None), ("4", reports.OPEN_QUOTE)]


@pytest.mark.parametrize("multi_line", [True, False])
def test_parts_with_other_headers(spark, tmp_path, multi_line):
    folder = tmp_path / "r.csv"
    put(folder, "part-0.csv", "id,Name,Name\n1,a,b\n")
    put(folder, "part-1.csv", "Name,id\nc,2\n")
    put(folder, "part-2.csv", "\n\nid,more,Name,Name\n3,m,d,e\n")
    put(folder, "part-3.csv", "")
    put(folder, "_SUCCESS", "x")
    put(folder, "part-4.csv", '"id","Name","Name"\n4,f,g\n')
    found = reports.read_report(spark, str(folder), multi_line)
    rows = found.orderBy(*reports.FILE_ORDER).select("id", "Name", "`Name.1`", "more", reports.MALFORMED).collect()
    assert [tuple(r) for r in rows] == [
        ("1", "a", "b", None, None), ("2", "c", None, None, None), ("3", "d", "e", "m", None), ("4", "f", "g", None, None),
    ]


def test_a_header_with_line_breaks_and_compressed_parts(spark, tmp_path):
    path = put(tmp_path, "r.csv", 'id,"two\nlines"\n1,x\n')
    assert reports.read_report(spark, path).select("id", "`two\nlines`").first()[1] == "x"
    os.makedirs(tmp_path / "z.csv")
    with gzip.open(tmp_path / "z.csv" / "part-0.csv.gz", "wb") as f:
        f.write(b"id,note\n1,x\n2,y,z\n")
    assert malformed(reports.read_report(spark, str(tmp_path / "z.csv"))) == [("1", None), ("2", reports.TOO_LONG)]


def test_read_errors_stop_the_load(spark, tmp_path):
    os.makedirs(tmp_path / "z.csv")
    put(tmp_path / "z.csv", "part-0.csv.gz", "no gzip at all")
    with pytest.raises(Exception):
        reports.read_reports(spark, str(tmp_path))


@pytest.mark.parametrize("multi_line", [True, False])
def test_file_order_holds_over_parts_and_splits(spark, tmp_path, multi_line):
    """Rows keep their order in a folder of parts, also where single files are split."""
    folder = tmp_path / "r.csv"
    for part in range(3):
        lines = "".join(f"{part * 2000 + i},{'x' * 40}\n" for i in range(2000))
        put(folder, f"part-{part:05d}.csv", "id,pad\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = reports.read_report(spark, str(folder), multi_line)
        assert multi_line or df.rdd.getNumPartitions() > 3
        found = [int(r["id"]) for r in df.orderBy(*reports.FILE_ORDER).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == list(range(6000))


def test_report_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", 'q "x", y', None), ("b", "line\nbreak", "z")], "Name string, Text string, `Name.1` string"
    )
    write_report(df, str(tmp_path / "out.csv"))
    back = reports.read_report(spark, str(tmp_path / "out.csv"))
    assert back.columns[:3] == df.columns
    assert {tuple(r) for r in back.select("Name", "Text", "`Name.1`").collect()} == {
        tuple(r) for r in df.collect()
    }


def test_offices(spark, tmp_path):
    document = [
        {"code": "no", "offices": [{"_id": "off1"}, {"_id": "off2", "name": "Oslo"}, {"name": "none"}]},
        {"code": "uk", "offices": [{"_id": "off3"}, {"_id": ""}]},
        {"code": "us"},
    ]
    path = put(tmp_path, "countries.json", json.dumps(document))
    found = offices.office_ids(spark, path)
    assert sorted(r["office_id"] for r in found.collect()) == ["off1", "off2", "off3"]
    assert [r[0] for r in offices.office_ids(spark, None, ["x"]).collect()] == ["x"]


def test_missing_reports(spark):
    names = [n for n in snapshots.DELIVERED_REPORTS if n != "blogs"]
    found = spark.createDataFrame(
        [("Q1", n) for n in names] + [("Q1", "extra"), ("Q2", "other")], "snapshot string, report string"
    )
    missing = [tuple(r) for r in snapshots.missing_reports(found).collect()]
    folders = spark.createDataFrame([("Q1",), ("Q3",)], "snapshot string")
    every = [tuple(r) for r in snapshots.missing_reports(found, snapshots=folders).collect()]
    assert sorted(every) == sorted([*missing, *[("Q3", n) for n in snapshots.DELIVERED_REPORTS]])
    assert ("Q1", "blogs") in missing and len(missing) == 1 + 13

"""Compares every query with its SQL.  Usage: python tests/oracle_check.py [sf_dir] [query ...]"""

import datetime as dt
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as driver  # noqa: E402


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def kind(type_name):
    name = type_name.lower()
    for word, label in (
        ("bigint", "long"), ("long", "long"), ("smallint", "short"), ("int", "int"),
        ("double", "double"), ("varchar", "string"), ("string", "string"),
        ("bool", "boolean"), ("timestamp", "timestamp"), ("date", "date"),
    ):
        if word in name:
            return label
    return name


def plain(value):
    if isinstance(value, float):
        return round(value, 9) if math.isfinite(value) else str(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def sort_key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def compare(spark, con, sf_dir, name):
    """Message about the first difference, or None."""
    df = driver.queries()[name](spark, sf_dir)
    names = sorted(df.columns)
    mine_types = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    mine = sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=sort_key)
    cursor = con.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    types = {d[0]: kind(str(d[1])) for d in cursor.description}
    if sorted(columns) != names:
        return f"columns {names} against {sorted(columns)}"
    order = [columns.index(c) for c in names]
    theirs = sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=sort_key)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{names}: {a} against {b}"
    if mine_types != types:
        wrong = {c: (mine_types[c], types[c]) for c in names if mine_types[c] != types[c]}
        return f"types {wrong}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    # A plain session on purpose: results must not depend on the library's settings.
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "10g")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    missing = set(driver.queries()) ^ set(driver.oracle_sql())
    print("without SQL:", sorted(missing))
    bad = 0
    for query in sys.argv[2:] or driver.oracle_sql():
        begin = time.time()
        try:
            difference = compare(spark, con, sf, query)
        except Exception as error:
            difference = f"error {str(error)[:1500]}"
        bad += difference is not None
        print(query, "ok" if difference is None else "DIFF " + difference[:900], round(time.time() - begin, 2), flush=True)
    print("differences:", bad)
    spark.stop()

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skillmill.functions import career, dates, numbers, text


def apply(spark, values, expression, type_name="string"):
    """Results of one expression over a list of cells, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, c {type_name}")
    rows = df.select("i", expression(F.col("c")).alias("r")).collect()
    return [r["r"] for r in sorted(rows, key=lambda r: r["i"])]


# --- specifications in plain Python, used only here ------------------------------


def multilang_spec(cell):
    result = {}
    for part in (cell or "").split("|"):
        code, colon, words = part.partition(":")
        if colon and code.strip() and words.strip():
            result[code.strip()] = words.strip()
    return result


# --- multilingual text -------------------------------------------------------------

CELLS = [
    "int:Mira Holt|no:Mira", "int:a:b", " int : x ", "int:|no:y", ":x", "plain", "", "   ", None,
    "int:a|int:b", "no:a|int:b|no:c", "|||", "int:a|", "int: a　", "a:b", "a:", "::",
]


def test_multilang_cases(spark):
    assert apply(spark, CELLS, text.multilang_map) == [multilang_spec(c) for c in CELLS]


def test_pick_agrees_with_the_map(spark):
    both = apply(
        spark,
        CELLS,
        lambda c: F.array(text.multilang_pick(c), text.map_pick(text.multilang_map(c))),
    )
    assert all(a == b for a, b in both)
    assert [a for a, _ in both] == [multilang_spec(c).get("int") for c in CELLS]


def test_language_fallback_cases(spark):
    assert apply(spark, CELLS, lambda c: text.lang_value(c, "no")) == [
        "Mira", "a:b", " x ", "y", "x", "", "", "", "", "b", "c", "", "a", "\xa0a\u3000", "b", "", ":",
    ]


cell = st.one_of(st.none(), st.text(alphabet="into:| ab\t ", max_size=14))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(cell, min_size=40, max_size=80))
def test_multilang_property(spark, cells):
    assert apply(spark, cells, text.multilang_map) == [multilang_spec(c) for c in cells]


# --- text, booleans, numbers, JSON -------------------------------------------------


def test_booleans(spark):
    cells = ["yes", "No", " TRUE ", "1", "t", "Y", "1.0", "", "on", None]
    assert apply(spark, cells, text.parse_boolean) == [
        True, False, True, True, True, True, False, False, False, None,
    ]
    assert apply(spark, cells, text.database_boolean) == [
        True, False, True, True, True, True, None, None, True, None,
    ]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text(alphabet="tTrueyYs1 \t ", max_size=6)), min_size=30))
def test_boolean_property(spark, cells):
    words = ("true", "1", "t", "yes", "y")
    expected = [None if c is None else c.strip().lower() in words for c in cells]
    assert apply(spark, cells, text.parse_boolean) == expected


def test_normalise(spark):
    cells = ["  hi ", "", " \n", None, "　x "]
    assert apply(spark, cells, text.normalise) == ["hi", "", "", "", "x"]
    assert apply(spark, cells, lambda c: text.normalise(c, "d")) == ["hi", "d", "d", "d", "x"]
    assert apply(spark, cells, lambda c: text.normalise(c, None)) == ["hi", None, None, None, "x"]


def test_null_tokens(spark):
    assert apply(spark, ["NA", "None", " NA", "none", "", "x", None], text.null_tokens) == [
        None, None, " NA", "none", None, "x", None,
    ]


def test_integers(spark):
    cells = ["+1985", " 5 ", "4.0", "4.9", "-3.7", "1e3", "99999999999", "x", "", None, ".5"]
    assert apply(spark, cells, numbers.lenient_int) == [
        1985, 5, None, None, None, None, None, None, None, None, None,
    ]
    assert apply(spark, cells, numbers.whole_number) == [
        1985, 5, 4, 4, -3, 1000, None, None, None, None, 0,
    ]


def test_strict_integer_stops(spark):
    assert apply(spark, ["7", None], numbers.strict_int) == [7, None]
    with pytest.raises(Exception, match="not a whole number: junk"):
        apply(spark, ["7", "junk"], numbers.strict_int)


def test_percent(spark):
    assert apply(spark, ["150", None, "99.9", "-0.5", "80", "many"], numbers.percent) == [
        100, 0, 99, 0, 80, None,
    ]


def test_json(spark):
    cells = ['say "hi"', "back\\slash", "line\nbreak", "ø", None]
    encoded = apply(spark, cells, text.json_string)
    import json

    assert [None if e is None else json.loads(e) for e in encoded] == cells
    assert apply(spark, ['{"int": "Yes"}', "{}", None], lambda c: text.json_field(c, "int")) == [
        "Yes", None, None,
    ]


def test_unique_headers():
    names = ["﻿Name", "Email", "Name", "Name", None, "name"]
    assert text.unique_headers(names) == ["Name", "Email", "Name.1", "Name.2", "Unnamed: 4", "name.3"]


# --- dates ---------------------------------------------------------------------------

#: What each cell reads as.
DATES = {
    '2024-01-02': [
        '2024-01-02', '2024-1-2', '2024-01-02T03:04:05Z', '20240102', '2024-01-02 23:00:00+05:00',
        '2024-01-02 03:04', ' 2024-01-02 ', '2024-01-02T03:04:05.123456',
    ],
    None: [
        '2024-13-01', '2024-02-30', '31/31/2024', 'hello', '12345', '29/02/2023', '2/30/2024',
        '2024-06-31', '0001-01-01', '1677-01-01', '2300-01-01', '01/02/1600', '-', '13/13/2024',
        '0/1/2024', '2024-00-10', '2024-10-00', '31/04/2024', '2024-01-02 junk',
        '2024-01-02T25:00:00', '1 Foo 2024', '', '   ', None,
    ],
    '2024-01-01': [
        '2024-01', '2024', '2024/01', '01/2024',
    ],
    '2024-02-01': [
        '01/02/2024', '1/2/2024', '01-02-2024', '01.02.2024', '1.2.2024', '01/02/24', '1-2-24',
        '01.02.24', '02/2024', '01/02/2024 10:30', '01/02/2024 10:30:15', '01 02 2024',
    ],
    '2024-12-31': [
        '12/31/2024', '31/12/2024', '12-31-2024', '12.31.2024',
    ],
    '2024-01-05': [
        '5-Jan-2024', '05-Jan-24', '2024-Jan-05', '2024-jan-05', '5 Jan 2024', '05 January 2024',
        'Jan 5, 2024', 'January 5 2024', '5 jan 2024', 'Mon, 5 Jan 2024', '5th Jan 2024',
    ],
    '1700-05-06': [
        '1700-05-06',
    ],
    '2199-12-31': [
        '2199-12-31',
    ],
    '2024-02-29': [
        '29/02/2024',
    ],
    '2024-09-03': [
        '3 Sept 2024',
    ],
}
YEAR_FIRST = ["2024/01/02", "2024/1/2", "2024.01.02", "2024/13/02", "2024 01 02"]


def test_dates(spark):
    cells = [(cell, day and dt.date.fromisoformat(day)) for day, cells in DATES.items() for cell in cells]
    found = apply(spark, [cell for cell, _ in cells], dates.iso_date)
    assert [(c, f, d) for (c, d), f in zip(cells, found) if f != d] == []


def test_short_years_fall_near_the_given_year(spark):
    def near(year):
        return apply(spark, ["01/02/80", "29-02-00"], lambda c: dates.iso_date(c, this_year=year))

    assert near(2024) == [dt.date(1980, 2, 1), dt.date(2000, 2, 29)]
    assert near(2035) == [dt.date(2080, 2, 1), dt.date(2000, 2, 29)]


def test_year_first_dates(spark):
    strict = apply(spark, YEAR_FIRST, lambda c: dates.iso_date(c, strict_dates=True))
    assert strict[:3] == [dt.date(2024, 2, 1)] * 3
    assert apply(spark, YEAR_FIRST, dates.iso_date) == [dt.date(2024, 1, 2)] * 3 + [
        None, dt.date(2024, 1, 2),
    ]


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.dates(dt.date(1990, 1, 1), dt.date(2060, 1, 1)),
            st.sampled_from(
                ["%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%d.%m.%Y", "%Y%m%d", "%d %B %Y", "%b %d, %Y"]
            ),
        ),
        min_size=60,
        max_size=120,
    )
)
def test_date_property(spark, samples):
    """A formatted day reads as itself; with the month first only if it cannot be a day first."""
    cells = [d.strftime(form) for d, form in samples]
    expected = [
        dt.date(d.year, d.day, d.month) if form == "%m/%d/%Y" and d.day <= 12 else d
        for d, form in samples
    ]
    assert apply(spark, cells, dates.iso_date) == expected


def test_date_defaults_and_repair(spark):
    default = dt.date(1900, 1, 1)
    cells = ["", None, "junk", "2024-05-06"]
    assert apply(spark, cells, lambda c: dates.date_or_default(c, default)) == [
        default, default, None, dt.date(2024, 5, 6),
    ]
    day = dt.date(2024, 1, 2)
    df = spark.createDataFrame(
        [(1, day, dt.date(2023, 1, 1)), (2, day, day), (3, day, None), (4, None, day)],
        "i int, a date, b date",
    )
    rows = df.select("i", dates.open_ended(F.col("a"), F.col("b")).alias("r")).orderBy("i")
    assert [r["r"] for r in rows.collect()] == [None, day, None, day]


def test_quarter_label(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 6, 30), dt.date(2025, 12, 31)]
    assert apply(spark, days, dates.quarter_label, "date") == ["Q12024", "Q22024", "Q42025"]


# --- career --------------------------------------------------------------------------


def test_levels(spark):
    levels = [0, 2, 3, 4, 5, 6, 9, None]
    assert apply(spark, levels, career.cpd_label, "int") == [
        "CPD1E", "CPD1E", "CPD2L", "CPD3E", "CPD3L", "CPD4E", "CPD4E", None,
    ]
    assert apply(spark, levels, career.cpd_level, "int") == [1, 1, 2, 3, 3, 4, 4, None]
    assert apply(spark, levels, career.cpd_band, "int") == ["E", "E", "L", "E", "L", "E", "E", None]
    assert apply(spark, ["Lead", "Boss", None], career.role_level) == [6, 4, 4]
    assert apply(spark, ["gb", "GB", None], career.country_name) == [
        "United Kingdom", "Unknown", "Unknown",
    ]


def test_leadership_titles(spark):
    cells = ["Head of MS Apps", "Head of  AWS ", "Head of Design", "Head of Data Engineering", "Lead", None]
    assert apply(spark, cells, career.leadership_title) == [
        "Head of Microsoft Apps Engineering", "Head of AWS Engineering", "Head of Design",
        "Head of Data Engineering", "Lead", None,
    ]


def test_ladders(spark):
    ladders = {
        "Lead Data Engineer": ["Senior Data Engineer", "Principal Data Engineer", "Lead Data Engineer"],
        "Associate Analyst": ["Associate Analyst"],
        "Senior Analyst": ["Associate Analyst", "Consultant Analyst", "Senior Analyst"],
        "Head of Design": ["Senior Design", "Principal Design", "Lead Design", "Head of Design"],
        "Director of Design": ["Senior Design", "Principal Design", "Lead Design", "Head of Design", "Director of Design"],
        "Painter": ["Consultant Painter", "Senior Painter", "Principal Painter"],
        "Design Head": ["Senior Design", "Principal Design", "Lead Design", "Head of Design"],
        " Principal  Data Architect ": ["Consultant Data Architect", "Senior Data Architect", "Principal Data Architect"],
        "Leadership Lead": ["Senior ership Lead", "Principal ership Lead", "Lead ership Lead"],
        "Director Design of things": ["Senior Design  things", "Principal Design  things", "Lead Design  things", "Head of Design  things", "Director of Design  things"],
    }
    assert apply(spark, list(ladders), career.career_ladder) == list(ladders.values())
    assert apply(spark, ["Lead Data Engineer", None], career.career_ladder) == [
        ["Senior Data Engineer", "Principal Data Engineer", "Lead Data Engineer"], None,
    ]

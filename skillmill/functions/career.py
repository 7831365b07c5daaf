"""Career rules: levels, titles, ladders and countries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skillmill.functions.text import let, strip

# Development level, band and label per responsibility level; lower levels
# count as the first and higher ones as the last.
CPD_RULES = {
    2: (1, "E", "CPD1E"),
    3: (2, "L", "CPD2L"),
    4: (3, "E", "CPD3E"),
    5: (3, "L", "CPD3L"),
    6: (4, "E", "CPD4E"),
}

# Responsibility level per job level; any other job level counts as 4.
ROLE_LEVELS = {
    "Associate": 2,
    "Consultant": 3,
    "Senior": 4,
    "Principal": 5,
    "Lead": 6,
    "Head": 6,
    "Director": 6,
}
DEFAULT_ROLE_LEVEL = 4

# Functions whose head carries "Engineering" in the title.
ENGINEERING_FUNCTIONS = ("AWS", "Azure", "Quality", "MS Apps", "Microsoft Apps", "Data")

# Country names per two-letter code.
COUNTRIES = {
    "gb": "United Kingdom",
    "ie": "Ireland",
    "us": "USA",
    "au": "Australia",
    "in": "India",
    "es": "Spain",
    "si": "Slovenia",
}
UNKNOWN_COUNTRY = "Unknown"

# Job levels from junior to senior, then the two leadership levels.
CORE_LEVELS = ("Associate", "Consultant", "Senior", "Principal", "Lead")
LEADERSHIP_LEVELS = ("Head", "Director")

_HEAD = "Head of "
_DIRECTOR = "Director of "


def _literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _cpd(sfia: Column, part: int) -> Column:
    first, last = min(CPD_RULES), max(CPD_RULES)
    values = F.array(*[F.lit(CPD_RULES[level][part]) for level in range(first, last + 1)])
    position = F.greatest(F.lit(first), F.least(F.lit(last), sfia)) - (first - 1)
    return F.when(sfia.isNotNull(), F.element_at(values, position.cast("int")))


def cpd_level(sfia: Column) -> Column:
    return _cpd(sfia, 0)


def cpd_band(sfia: Column) -> Column:
    return _cpd(sfia, 1)


def cpd_label(sfia: Column) -> Column:
    return _cpd(sfia, 2)


def role_level(level: Column) -> Column:
    return F.coalesce(
        F.try_element_at(_literal_map(ROLE_LEVELS), level), F.lit(DEFAULT_ROLE_LEVEL)
    )


def country_name(iso: Column) -> Column:
    return F.coalesce(F.try_element_at(_literal_map(COUNTRIES), iso), F.lit(UNKNOWN_COUNTRY))


def _after(title: Column, prefix: str) -> Column:
    return strip(title.substr(F.lit(len(prefix) + 1), F.length(title)))


def leadership_title(title: Column) -> Column:
    """"Head of X" gains "Engineering" for the engineering functions."""
    named = _after(title, _HEAD)
    base = F.when(named == "MS Apps", F.lit("Microsoft Apps")).otherwise(named)
    return F.when(
        title.startswith(_HEAD) & base.isin(*ENGINEERING_FUNCTIONS),
        F.concat(F.lit(_HEAD), base, F.lit(" Engineering")),
    ).otherwise(title)


def _without_first(text: Column, word: Column) -> Column:
    """The text with the first occurrence of ``word`` cut out, stripped."""
    at = F.position(word, text)
    cut = F.concat(
        text.substr(F.lit(1), at - 1), text.substr(at + F.length(word), F.length(text))
    )
    return strip(F.when(at > 0, cut).otherwise(text))


def career_ladder(title: Column) -> Column:
    """Titles held on the way up, in order, the given title's rung last."""
    climb = _strings(["Senior ", "Principal ", "Lead ", _HEAD])
    climb_further = _strings(["Senior ", "Principal ", "Lead ", _HEAD, _DIRECTOR])
    known = _strings(CORE_LEVELS + LEADERSHIP_LEVELS)
    core = _strings(CORE_LEVELS)

    def rungs(prefixes: Column, family: Column) -> Column:
        return F.transform(prefixes, lambda prefix: F.concat(prefix, family))

    def by_level(t: Column, level: Column) -> Column:
        family = _without_first(t, level)
        led = _without_first(family, F.lit("of"))
        at = F.array_position(core, level).cast("int")
        start = F.greatest(F.lit(1), at - 2)
        window = F.transform(F.slice(core, start, at - start + 1), lambda x: F.concat(x, F.lit(" ")))
        return (
            F.when(level == "Head", rungs(climb, led))
            .when(level == "Director", rungs(climb_further, led))
            .otherwise(rungs(window, family))
        )

    def ladder(t: Column) -> Column:
        levels = F.filter(F.split(t, r"\s+"), lambda word: F.array_contains(known, word))
        level = F.try_element_at(levels, F.lit(1))
        return (
            F.when(t.startswith(_HEAD), rungs(climb, _after(t, _HEAD)))
            .when(t.startswith(_DIRECTOR), rungs(climb_further, _after(t, _DIRECTOR)))
            .when(
                level.isNull(), rungs(_strings(["Consultant ", "Senior ", "Principal "]), t)
            )
            .otherwise(by_level(t, level))
        )

    return F.when(title.isNotNull(), let(strip(title), ladder))

"""Text, boolean and JSON expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space when a cell is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Cell texts a CSV reader treats as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Texts read as true once stripped and lower-cased.
TRUE_WORDS = ("true", "1", "t", "yes", "y")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def null_tokens(c: Column) -> Column:
    """Missing-value texts become null; any other text is kept untouched."""
    return F.when(~c.isin(*NULL_TOKENS), c)


def normalise(c: Column, default: str | None = "") -> Column:
    """Stripped text, or ``default`` where nothing is left."""
    return F.coalesce(blank_to_null(c), F.lit(default).cast("string"))


def parse_boolean(c: Column) -> Column:
    """Null stays null, the true words are true and any other text is false."""
    return F.when(c.isNotNull(), F.lower(strip(c)).isin(*TRUE_WORDS))


def database_boolean(c: Column) -> Column:
    """The spellings a SQL database accepts for a boolean; anything else is null."""
    word = F.lower(strip(c))
    return F.when(word == "on", F.lit(True)).when(word == "off", F.lit(False)).otherwise(
        word.try_cast("boolean")
    )


def json_string(c: Column) -> Column:
    """The text as a JSON string scalar, quotes and escapes included."""
    wrapped = F.to_json(F.struct(c.alias("v")))
    return F.when(c.isNotNull(), wrapped.substr(F.lit(6), F.length(wrapped) - 6))


def json_object(c: Column) -> Column:
    """A multilingual map as JSON object text."""
    return F.to_json(c)


def json_field(c: Column, field: str) -> Column:
    """One field of a JSON object held as text; null where it is absent."""
    return F.get_json_object(c, f"$.{field}")


# --- multilingual text, written code:text|code:text ---------------------------


def _after_colon(c: Column) -> Column:
    return c.substr(F.instr(c, ":") + 1, F.length(c))


def _pairs(c: Column, clean: Callable[[Column], Column]) -> Column:
    with_colon = F.filter(F.split(c, r"\|"), lambda part: part.contains(":"))
    return F.transform(
        with_colon,
        lambda part: F.struct(
            clean(F.substring_index(part, ":", 1)).alias("code"),
            clean(_after_colon(part)).alias("text"),
        ),
    )


def _last_text(pairs: Column, code: Column) -> Column:
    return F.try_element_at(F.filter(pairs, lambda p: p["code"] == code), F.lit(-1))["text"]


def _translations(c: Column) -> Column:
    return F.filter(_pairs(c, strip), lambda p: (p["code"] != "") & (p["text"] != ""))


def multilang_map(c: Column) -> Column:
    """Map of language code to text; the last of a repeated code wins, null gives an empty map."""

    def to_map(pairs: Column) -> Column:
        codes = F.array_distinct(F.transform(pairs, lambda p: p["code"]))
        return F.map_from_arrays(codes, F.transform(codes, lambda code: _last_text(pairs, code)))

    code, words = strip(F.substring_index(c, ":", 1)), strip(_after_colon(c))
    single = F.when(c.contains(":") & (code != "") & (words != ""), F.create_map(code, words))
    # A single language, the usual case, needs no arrays.
    several = F.when(c.contains("|"), let(_translations(c), to_map)).otherwise(single)
    return F.coalesce(several, empty_map())


def empty_map() -> Column:
    return F.create_map().cast("map<string,string>")


def multilang_pick(c: Column, code: str = "int") -> Column:
    """One language straight from the text, without building the map."""
    return _last_text(_translations(c), F.lit(code))


def map_pick(c: Column, code: str = "int") -> Column:
    """One language from a parsed map; null where the code is absent."""
    return F.try_element_at(c, F.lit(code))


def lang_value(c: Column, code: str = "int") -> Column:
    """Requested language, else the first one written, else empty text.  Nothing is trimmed."""

    def pick(pairs: Column) -> Column:
        first_code = F.try_element_at(pairs, F.lit(1))["code"]
        return F.coalesce(_last_text(pairs, F.lit(code)), _last_text(pairs, first_code))

    return F.coalesce(let(_pairs(c, lambda part: part), pick), F.lit(""))


# --- headers ------------------------------------------------------------------


def unique_headers(names: Iterable[str | None]) -> list[str]:
    """Header texts made unique the way a data frame reader does: Name, Name.1, Name.2.

    Spark resolves columns without regard to case, so headers that differ in case
    only count as equal here.
    """
    taken: set[str] = set()
    result = []
    for position, raw in enumerate(names):
        base = (raw or "").removeprefix("\ufeff") or f"Unnamed: {position}"
        name, n = base, 0
        while name.lower() in taken:
            n += 1
            name = f"{base}.{n}"
        taken.add(name.lower())
        result.append(name)
    return result

r"""Surrogates for personal data, with DataFrame functions only.

Entities are found by patterns; each different value of a type gets one replacement, drawn
from a keyed hash of type and value, wherever and however it is written.  So a person, number
or address that occurs again, in the same text or another, has the same surrogate.

* Numbers keep their punctuation and length, phones their country code, cards their first
  digit, IBANs their country, private IPv4 addresses their network, IPv6 addresses their first group.
* Letters stay letters of their case, hexadecimal digits hexadecimal digits.
* Mail addresses keep the form of the part before the sign; a domain has one surrogate domain.
  Domains and surnames are values of their own: addresses and full names are built of their surrogates.
* Names keep their title; given names come from a list of the title's gender and the name's
  script, surnames are built from syllables of the script.  A surname alone and the same surname
  after a given name have the same surrogate.

Collision checks: two values of a type never share a surrogate, and no surrogate is a value
that occurs in the texts.  Values that lose such a check are drawn again.

Defined results: null and empty texts and texts without entities stay as they are; equal
texts are treated alike whatever their ids, so null and repeated ids need no rule; other
columns pass through, but for ``n_entities``, which is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skillmill.llm.common import stored, unused

# Titles, with the gender they tell; written here for the languages of the texts.
TITLES = {
    "m": ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "г-н", "господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "г-жа", "госпожа"],
    "n": ["Dr", "Prof", "Professor", "Mx"],
}
GIVEN = {
    ("m", "latin"): ["Adam", "Bruno", "Caspar", "Daniel", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Leon", "Martin", "Noah", "Oscar", "Paul", "Simon"],
    ("f", "latin"): ["Alma", "Beate", "Clara", "Diana", "Elena", "Flora", "Greta", "Helene", "Irene", "Julia", "Laura", "Marie", "Nora", "Olga", "Paula", "Sofia"],
    ("n", "latin"): ["Alex", "Kim", "Robin", "Sasha", "Toni", "Jules", "Dominique", "Charlie"],
    ("m", "cyrillic"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл"],
    ("f", "cyrillic"): ["Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Ксения", "Мария"],
    ("n", "cyrillic"): ["Саша", "Женя", "Валя", "Шура"],
}
SYLLABLES = {
    "latin": "bar bel bor dal den dor fal fen gar hal hol kal ker lan lem lor mar mel mor nal nor ral rem ros sal sen tal tor val ver vin wel".split(),
    "cyrillic": "бар бел бор вал вер гор дал дор зар кал кор лан лор мал мир нар нов пал рад рем ров сал сев сол тар тол фед хар цар чер шел яр".split(),
}

_LETTERS = r"[\p{L}\p{N}._%+\-]"
_NAME = r"\p{Lu}[\p{L}'’\-]+"
_TITLE = "|".join(t for titles in TITLES.values() for t in sorted(titles, key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Eight groups, or fewer round a double colon, the first then of three or four digits and some digit decimal.
_IP6 = rf"(?:(?:{_HEX}:){{7}}{_HEX}|(?=[A-Fa-f:]*\d)[0-9A-Fa-f]{{3,4}}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)"
#: National numbers: three, three and four digits, or a leading zero and nine to fourteen digits in groups.
_NATIONAL = (
    r"(?:(?:1[ .\-])?[2-9]\d{2}(?:-\d{3}-\d{4}|\.\d{3}\.\d{4}| \d{3}[ \-]\d{4})"
    r"|(?=\d(?:[ /\-]?\d){8,13}(?![ /\-]?\d))(?:0\d{2,4}[/\-]\d{3,8}(?:[ \-]\d{2,5}){0,2}|0\d{1,4}(?: \d{2,8}){1,4}))"
)
_CARD = r"(?:(?:\d{4}[ \-]?){3}\d{4}|3[47]\d{2}[ \-]?\d{6}[ \-]?\d{5})"
_KEYWORD = r"(?i:passwords?|passwd|pwd|secret|token|api[_ \-]?key)"
#: Types in the order in which they claim a place; a pattern matches a whole entity.
PATTERNS = {
    "email": rf"(?<!{_LETTERS}){_LETTERS}++@[\p{{L}}\p{{N}}\-]++(?:\.[\p{{L}}\p{{N}}\-]++)+",
    "phone": r"\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)"
    rf"|(?<![\p{{L}}\d.,+\-]){_NATIONAL}(?![\p{{L}}\d]|[.\-]\d)",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "ip6": rf"(?<![\p{{L}}\d:.]){_IP6}(?![\p{{L}}\d:])",
    "card": rf"(?<![\p{{L}}\d]){_CARD}(?![\p{{L}}\d])",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "iban": r"(?<![\p{L}\d])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\d])",
    "key": r"(?<![\p{L}\d])AKIA[0-9A-Z]{16}(?![\p{L}\d])",
    "secret": rf"(?<={_KEYWORD}[\"']? ?[=:] ?[\"']?)[^\s\"']{{8,}}+"
    r"|(?<![\p{L}\d])(?=[a-f]{0,64}\d)[0-9a-f]{32,64}(?![\p{L}\d])",
    "person": rf"(?<![\p{{L}}\d])(?:{_TITLE})\.? {_NAME}(?: {_NAME})?",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
ROUNDS = 64
#: Attempts after which a value may leave the range it was drawn from for a wider one.
WIDER = 6


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def may_hold(text: Column) -> Column:
    """A quick test that no text with an entity fails."""
    return text.rlike("[0-9@]") | text.rlike(_KEYWORD) | any_of([text.contains(f"{t} ") | text.contains(f"{t}. ") for ts in TITLES.values() for t in ts])


def kind(raw: Column) -> Column:
    """The first type whose pattern could have found the entity, judged by its own characters."""
    chain = (
        F.when(raw.rlike(rf"^{_LETTERS}++@"), "email")
        .when(raw.rlike(r"^(?:\+\d|\(\d)[\d ().\-]+$"), "phone")
        .when(raw.rlike(rf"^(?:{_OCTET}\.){{3}}{_OCTET}$"), "ip")
        .when(raw.rlike(rf"^{_IP6}$"), "ip6")
        .when(raw.rlike(rf"^{_CARD}$"), "card")
        .when(raw.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(raw.rlike(rf"^{_NATIONAL}$"), "phone")
        .when(raw.rlike(r"^AKIA[0-9A-Z]{16}$"), "key")
        .when(raw.rlike(r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?$"), "iban")
        .when(raw.rlike(rf"^(?:{_TITLE})\.? {_NAME}"), "person")
    )
    return chain.otherwise("secret")


def digest(key: str, *parts: Column) -> Column:
    """128 hexadecimal digits from the key and the parts."""
    message = F.concat_ws("\u0001", *parts)
    inner = [F.sha2(F.concat(F.lit(f"{key}{i}"), message), 256) for i in (1, 2)]
    return F.concat(*[F.sha2(F.concat(F.lit(f"{key}#{i}"), x), 256) for i, x in enumerate(inner)])


def number(hexes: Column, at: Column | int, of: int) -> Column:
    """A number below ``of`` from four hexadecimal digits of a digest, taken round."""
    at = F.lit(at) if isinstance(at, int) else at
    four = F.substring(hexes, F.pmod(at, F.lit(31)) * 4 + 1, F.lit(4))
    return F.pmod(F.conv(four, 16, 10).cast("int") + F.floor(at / 31).cast("int") * 7, F.lit(of))


def chosen(values: list[str], i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), i + 1)


def same_form(text: Column, hexes: Column, kept: Column, hexadecimal: bool = False) -> Column:
    """The text with its letters and digits drawn anew by class, all but the first ``kept`` characters."""

    def drawn(c: Column, i: Column) -> Column:
        lower, upper, digits = (F.lit(x) for x in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"))
        letter = [F.substring(a, number(hexes, i, n) + 1, F.lit(1)) for a, n in ((lower, 26), (upper, 26), (digits, 10))]
        low = F.substring(F.lit("abcdef"), number(hexes, i, 6) + 1, F.lit(1)) if hexadecimal else letter[0]
        return (
            F.when(i < kept, c).when(c.rlike(r"\d"), letter[2]).when(c.rlike(r"\p{Lu}"), letter[1])
            .when(c.rlike(r"\p{L}"), low).otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), drawn), "")


def value_of(type_: Column, raw: Column) -> Column:
    """What an entity stands for, however it is written."""
    compact = F.regexp_replace(raw, r"[^\p{L}\p{N}]", "")
    name = F.lower(F.regexp_replace(raw, rf"^(?:{_TITLE})\.? ", ""))
    # Eight groups of four digits, whichever zeros are left out.
    sides = F.split(F.lower(raw), "::")
    left, right = (F.filter(F.split(F.coalesce(F.get(sides, F.lit(i)), F.lit("")), ":"), lambda g: g != "") for i in (0, 1))
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - F.size(left) - F.size(right), F.lit(0)))
    groups = F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.lpad(g, 4, "0")), ":")
    return F.when(type_ == "email", F.lower(raw)).when(type_ == "ip6", groups).when(type_.isin("phone", "card", "ssn", "iban"), compact).when(
        type_ == "person", name
    ).otherwise(raw)


def script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def by_script(script_: Column, make) -> Column:
    return F.when(script_ == "cyrillic", make("cyrillic")).otherwise(make("latin"))


def surname(hexes: Column, script_: Column, attempt: Column) -> Column:
    """Three syllables, and one more for each attempt before, so that there are enough for any number of surnames."""
    size = F.lit(3) + F.least(attempt, F.lit(9))

    def make(s: str) -> Column:
        syllables = F.array(*[chosen(SYLLABLES[s], number(hexes, i, len(SYLLABLES[s]))) for i in range(12)])
        return F.initcap(F.array_join(F.slice(syllables, 1, size), ""))

    return by_script(script_, make)


def longer(hexes: Column, attempt: Column) -> Column:
    """Letters that follow a short form once its own length gives no new values."""
    letters = F.array(*[chosen(list("abcdefghijklmnopqrstuvwxyz"), number(hexes, 12 + i, 26)) for i in range(12)])
    return F.array_join(F.slice(letters, 1, F.floor(F.least(attempt, F.lit(48)) / 4).cast("int")), "")


def more_digits(hexes: Column, attempt: Column) -> Column:
    """Digits that follow a number once its own length gives no new values."""
    digits = F.array(*[number(hexes, 40 + i, 10).cast("string") for i in range(12)])
    size = F.floor((F.least(attempt, F.lit(59)) - F.lit(2 * WIDER)) / 4).cast("int") + 1
    return F.when(attempt >= 2 * WIDER, F.array_join(F.slice(digits, 1, size), "")).otherwise("")


def drawn(key: str, type_: Column, value: Column, gender: Column, part: Column, attempt: Column) -> Column:
    """The surrogate of a value, in the form of the value; ``part`` is that of its domain or surname."""
    hexes = digest(key, type_, value, attempt.cast("string"))
    # Nine digits of a phone, or the last seven, leave the country code; a card keeps its issuer's digit.
    kept = (
        F.when(type_ == "phone", F.greatest(F.length(value) - 9, value.startswith("0").cast("int"))).when(type_ == "card", F.lit(1))
        .when(type_ == "iban", F.lit(2)).when(type_ == "key", F.lit(4)).otherwise(F.lit(0))
    )
    plain = same_form(value, hexes, kept)
    numeric = F.concat(plain, more_digits(hexes, attempt))
    local = F.substring_index(value, "@", 1)
    mail = F.concat(same_form(local, hexes, F.lit(0)), longer(hexes, attempt), F.lit("@"), part)
    top = F.substring_index(value, ".", -1)
    host = F.substring(value, F.lit(1), F.length(value) - F.length(top) - 1)
    domain = F.concat(same_form(host, hexes, F.lit(0)), longer(hexes, attempt), F.lit("."), top)
    octets = F.split(value, r"\.")
    first = F.get(octets, F.lit(0)).cast("int")
    private = value.rlike(r"^(?:10\.|192\.168\.|127\.)")
    # A small range is left for the largest private one, and that for any, where it gives no new values.
    ip = F.concat_ws(
        ".",
        F.when(private & (attempt < WIDER), first).when(private & (attempt < 2 * WIDER), F.lit(10)).otherwise(number(hexes, 0, 99) + 11),
        F.when(value.startswith("192.168.") & (attempt < WIDER), F.lit(168)).otherwise(number(hexes, 1, 256)),
        number(hexes, 2, 256), number(hexes, 3, 254) + 1,
    )
    words = F.split(value, " ")
    script_ = script(value)
    given = by_script(
        script_,
        lambda s: F.when(gender == "m", chosen(GIVEN["m", s], number(hexes, 5, len(GIVEN["m", s]))))
        .when(gender == "f", chosen(GIVEN["f", s], number(hexes, 5, len(GIVEN["f", s]))))
        .otherwise(chosen(GIVEN["n", s], number(hexes, 5, len(GIVEN["n", s])))),
    )
    # A given name that was drawn already gets a second one; surnames must stay the same.
    family = surname(hexes, script_, attempt)
    first = F.when(attempt == 0, given).otherwise(F.concat(given, F.lit("-"), family))
    person = F.when(F.size(words) > 1, F.concat_ws(" ", first, part)).otherwise(part)
    secret = F.when(value.rlike(r"^[0-9a-f]+$"), same_form(value, hexes, F.lit(0), hexadecimal=True)).otherwise(plain)
    secret = F.concat(secret, more_digits(hexes, attempt))
    return (
        F.when(type_ == "email", mail).when(type_ == "domain", domain).when(type_ == "ip", ip)
        .when(type_ == "ip6", same_form(value, hexes, F.lit(4), hexadecimal=True))
        .when(type_ == "person", person).when(type_ == "surname", family)
        .when(type_.isin("phone", "card", "ssn", "iban", "key"), numeric).otherwise(secret)
    )


def with_parts(values: DataFrame, key: str) -> DataFrame:
    """``values`` with ``part``, the surrogate of an address's domain or a name's surname."""
    of = F.when(F.col("type") == "email", "domain").when(F.col("type") == "person", "surname")
    name = F.when(F.col("type") == "email", F.substring_index("value", "@", -1)).otherwise(F.substring_index("value", " ", -1))
    named = values.select("type", "value", "gender", of.alias("part_type"), F.when(of.isNotNull(), name).alias("name"))
    parts = named.where("name is not null").select(F.col("part_type").alias("type"), F.col("name").alias("value")).distinct()
    found = assigned(parts.select("type", "value", F.lit("n").alias("gender"), F.lit("").alias("part")), key)
    surrogates = found.select(F.col("type").alias("part_type"), F.col("value").alias("name"), F.col("surrogate").alias("part"))
    return named.join(surrogates, ["part_type", "name"], "left").select("type", "value", "gender", "part")


def assigned(values: DataFrame, key: str) -> DataFrame:
    """(type, value, surrogate): one surrogate per value, none twice, none that is a value itself."""
    open_ = values.select("type", "value", "gender", "part")
    taken = values.select("type", F.lower("value").alias("mark"))
    done = None
    for attempt in range(ROUNDS):
        drawn_ = stored(
            open_.withColumn("surrogate", drawn(key, F.col("type"), F.col("value"), F.col("gender"), F.col("part"), F.lit(attempt)))
            .withColumn("mark", F.lower("surrogate")),
            "drawn",
        )
        # The smallest value that drew a surrogate has it, unless it is taken.
        winners = drawn_.groupBy("type", "mark").agg(F.min("value").alias("value")).join(taken, ["type", "mark"], "left_anti")
        settled = stored(drawn_.join(winners, ["type", "mark", "value"], "left_semi"), "settled")
        done = settled if done is None else done.union(settled)
        open_ = stored(drawn_.join(settled, ["type", "value"], "left_anti").select("type", "value", "gender", "part"), "open")
        if open_.isEmpty():
            return done.select("type", "value", "surrogate")
        taken = taken.union(settled.select("type", "mark"))
    raise ValueError("the surrogates of a type are used up")


def written(raw: Column, type_: Column, surrogate: Column) -> Column:
    """A surrogate in the form its entity was written in."""

    def refill(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), r"[^\p{L}\p{N}]", ""))
        return F.when(c.rlike(r"[\p{L}\p{N}]"), F.substring(surrogate, before + 1, F.lit(1))).otherwise(c)

    # A surrogate may be longer than the number it stands for.
    beyond = F.substring(surrogate, F.length(F.regexp_replace(raw, r"[^\p{L}\p{N}]", "")) + 1, F.length(surrogate))
    title = F.regexp_extract(raw, rf"^(?:{_TITLE})\.? ", 0)
    name = F.when(F.upper(raw) == raw, F.upper(surrogate)).otherwise(surrogate)
    mail = F.when((F.upper(raw) == raw) & raw.rlike(r"\p{L}"), F.upper(surrogate)).otherwise(surrogate)
    return (
        F.when(type_.isin("phone", "card", "ssn", "iban"), F.concat(F.array_join(F.transform(F.split(raw, ""), refill), ""), beyond))
        .when(type_ == "person", F.concat(title, name)).when(type_ == "email", mail).otherwise(surrogate)
    )


def gender_of(raw: Column) -> Column:
    tests = [F.when(raw.rlike(rf"^(?:{'|'.join(TITLES[g])})\.? "), g) for g in ("m", "f")]
    return F.coalesce(*tests, F.lit("n"))


def replacements(texts: DataFrame, key: str) -> DataFrame:
    """(k1, k2, filled): the surrogates of the entities of each different text, in their order."""
    found = texts.select("k1", "k2", F.posexplode(F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0))).alias("pos", "raw"))
    # Equal texts have equal entities; they are kept once per text.
    found = stored(found.groupBy("k1", "k2", "pos").agg(F.min("raw").alias("raw")), "entities")
    forms = found.select("raw").distinct().withColumn("type", kind(F.col("raw"))).withColumn("value", value_of(F.col("type"), F.col("raw")))
    forms = stored(forms.withColumn("gender", gender_of(F.col("raw"))), "forms")
    values = stored(forms.groupBy("type", "value").agg(F.min("gender").alias("gender")), "values")
    whole = stored(with_parts(values, key), "values")
    ready = forms.join(assigned(whole, key), ["type", "value"]).select(
        "raw", written(F.col("raw"), F.col("type"), F.col("surrogate")).alias("replacement")
    )
    return (
        found.join(ready, "raw").groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("pos", "replacement"))).alias("filled"))
        .withColumn("filled", F.transform("filled", lambda x: x["replacement"]))
    )


def with_surrogates(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with every entity of the text replaced, and the column ``n_entities``.

    The same ``key`` gives the same surrogates; who does not know it cannot draw them again.
    """
    columns = [c for c in docs.columns if c != "n_entities"]
    text = F.col(f"`{text_col}`")
    held = F.coalesce(may_hold(text), F.lit(False))
    keys = [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit(1), text).alias("k2")]
    some = docs.where(held).select(*keys, text.alias("text"))
    k1, k2, new = unused(docs, "__k1", "__k2", "__filled")
    filled = replacements(some, key).select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("filled").alias(new))
    joined = docs.where(held).select(*[F.col(f"`{c}`") for c in columns]).join(
        filled, (F.xxhash64(text) == F.col(k1)) & (F.xxhash64(F.lit(1), text) == F.col(k2)), "left"
    )
    between = F.split(text, ENTITY)
    replaced = F.array_join(F.zip_with(between, F.col(new), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = joined.select(
        *[F.when(F.col(new).isNull(), text).otherwise(replaced).alias(c) if c == text_col else F.col(f"`{c}`") for c in columns],
        F.coalesce(F.size(new), F.lit(0)).cast("long").alias("n_entities"),
    )
    plain = docs.where(~held).select(*[F.col(f"`{c}`") for c in columns], F.lit(0).cast("long").alias("n_entities"))
    return plain.union(changed)

"""The same results in SQL, written apart from the Spark code."""

from __future__ import annotations


def _spell(number: str, *forms: str) -> str:
    """The form chosen by ``number``, counting round."""
    n = len(forms)
    cases = " ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(forms))
    return f"(CASE CAST({number} AS BIGINT) % {n} {cases} END)"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_EMAIL = "'customer#' || lpad(CAST({0} AS VARCHAR), 9, '0') || '@example.org'"
_DAY = "CAST({0} AS DATE)"
_LINE_ORDER = (
    "l_linenumber DESC, l_quantity DESC, l_extendedprice DESC, l_shipdate DESC, l_partkey DESC, "
    "l_suppkey DESC, l_discount DESC, l_tax DESC, l_returnflag DESC"
)
_LINE_ORDER_UP = _LINE_ORDER.replace(" DESC", " ASC")

_PEOPLE = """people AS (
  SELECT CAST(c_custkey AS VARCHAR) AS cv_partner_user_id, c_name AS user_name, n_name AS country,
         c_mktsegment, lower(c_name) || '@example.org' AS email,
         'team' || c_nationkey AS upn, 'ext_' || c_custkey AS external_user_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_RESUMES = """resumes AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS cv_partner_cv_id,
         CAST(o_custkey AS VARCHAR) AS cv_partner_user_id,
         o_orderpriority AS cv_title, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 1 AS sfia_level
  FROM orders)"""

_LABEL = """CASE WHEN {0} <= 2 THEN 'CPD1E' WHEN {0} = 3 THEN 'CPD2L' WHEN {0} = 4 THEN 'CPD3E'
         WHEN {0} = 5 THEN 'CPD3L' WHEN {0} >= 6 THEN 'CPD4E' END"""

_TECH = f"""tech AS (
  SELECT cv_partner_cv_id, technology, years_experience, proficiency FROM (
    SELECT CAST(l_orderkey AS VARCHAR) AS cv_partner_cv_id, p_brand AS technology,
           CAST(trunc(l_quantity) AS INTEGER) AS years_experience,
           CAST(l_linenumber % 6 AS INTEGER) AS proficiency,
           row_number() OVER (PARTITION BY l_orderkey, p_brand ORDER BY {_LINE_ORDER}) AS rn
    FROM lineitem JOIN part ON l_partkey = p_partkey) WHERE rn = 1)"""

_AVAIL = """avail AS (
  SELECT cv_partner_user_id, date, percent_available FROM (
    SELECT CAST(user_id AS VARCHAR) AS cv_partner_user_id, CAST(ts AS DATE) AS date,
           CAST(greatest(0, least(100, trunc(value))) AS INTEGER) AS percent_available,
           row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS rn
    FROM events) WHERE rn = 1)"""

_NEWEST = """newest AS (
  SELECT cv_partner_user_id, date AS latest_availability_date,
         percent_available AS latest_percent_available FROM (
    SELECT *, row_number() OVER (PARTITION BY cv_partner_user_id ORDER BY date DESC) AS rn
    FROM avail) WHERE rn = 1)"""

_CLEAR = """clear AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS cv_partner_user_id, event_type AS clearance
  FROM events)"""


def _profile(where: str = "") -> str:
    # Joined first and grouped last, the other way round than the Spark plan.
    return (
        _with(_PEOPLE, _RESUMES, _TECH, _AVAIL, _NEWEST, _CLEAR)
        + f"""SELECT u.cv_partner_user_id, u.user_name, c.cv_partner_cv_id, c.cv_title, c.sfia_level,
       {_LABEL.format('c.sfia_level')} AS cpd_label, u.country,
       string_agg(DISTINCT t.technology, ', ' ORDER BY t.technology) AS technologies,
       max(t.years_experience) AS max_years_experience, max(k.clearance) AS clearance,
       a.latest_availability_date, a.latest_percent_available
FROM people u JOIN resumes c ON c.cv_partner_user_id = u.cv_partner_user_id
LEFT JOIN tech t ON t.cv_partner_cv_id = c.cv_partner_cv_id
LEFT JOIN clear k ON k.cv_partner_user_id = u.cv_partner_user_id
LEFT JOIN newest a ON a.cv_partner_user_id = u.cv_partner_user_id
{where}
GROUP BY ALL"""
    )


_NAMED_PROFILE = """named_profile AS (
  SELECT r.cv_partner_cv_id, max(CASE WHEN k.clearance = 'purchase' THEN 'SC' WHEN k.clearance IS NOT NULL THEN 'None' END) AS clearance,
         any_value(n.latest_percent_available) AS latest_percent_available
  FROM people p JOIN resumes r USING (cv_partner_user_id)
  LEFT JOIN clear k USING (cv_partner_user_id) LEFT JOIN newest n USING (cv_partner_user_id)
  GROUP BY r.cv_partner_cv_id)"""
_TOP = "SELECT technology AS name, count(*) AS cnt FROM tech GROUP BY technology ORDER BY cnt DESC, name LIMIT 5"
_SC = "SELECT 'sc_available' AS metric, CAST(count(*) AS DOUBLE) AS value FROM named_profile WHERE clearance = 'SC' AND latest_percent_available >= 50"
_MEAN = "SELECT 'mean_availability' AS metric, coalesce(avg(percent_available), 0.0) AS value FROM avail"
_COUNTS = """SELECT 'users' AS metric, CAST(count(*) AS DOUBLE) AS value FROM customer
UNION ALL SELECT 'cvs', CAST(count(*) AS DOUBLE) FROM orders"""

_DIRTY = _spell(
    "c_custkey",
    "' int : ' || c_name || ' |no:' || c_mktsegment",
    "'int:' || c_name || '|int:' || c_mktsegment",
    "'junk|int:' || c_name || ':' || c_mktsegment || '|'",
    "'int:|no: ' || c_mktsegment",
    "':' || c_name || '|sv:' || c_mktsegment || '||'",
    "'no:' || c_mktsegment || '|int:' || c_name || '|no:  ' || c_name || chr(9)",
    "'   '",
    "NULL",
    "c_name || c_mktsegment",
)

_PAIRS = f"""parts AS (
  SELECT c_custkey, unnest(string_split({_DIRTY}, '|')) AS part,
         unnest(range(len(string_split({_DIRTY}, '|')))) AS pos
  FROM customer),
pairs AS (
  SELECT c_custkey, pos, substr(part, 1, strpos(part, ':') - 1) AS raw_code,
         substr(part, strpos(part, ':') + 1) AS raw_text
  FROM parts WHERE strpos(part, ':') > 0)"""

_STRIP = "trim({0}, ' ' || chr(9) || chr(10) || chr(13))"

_ORDER_TEXT = _spell(
    "o_orderkey",
    "strftime(o_orderdate, '%Y-%m-%d')",
    "strftime(o_orderdate, '%d/%m/%Y')",
    "strftime(o_orderdate, '%m/%d/%Y')",
    "strftime(o_orderdate, '%d.%m.%Y')",
    "strftime(o_orderdate, '%Y%m%d')",
    "strftime(o_orderdate, '%Y-%m-%d') || ' 10:30:00'",
    "strftime(o_orderdate, '%Y') || '-02-30'",
    "'soon'",
    "'  '",
    "NULL",
    "' ' || strftime(o_orderdate, '%d-%m-%Y') || ' '",
    "strftime(o_orderdate, '%-d %b %Y')",
    "strftime(o_orderdate, '%Y/%m/%d')",
)


def _parse(t: str) -> str:
    """Reads the spellings that the queries write."""
    t = f"trim({t})"
    return f"""CAST(CASE
    WHEN regexp_matches({t}, '^\\d{{4}}-\\d') THEN try_strptime(left({t}, 10), '%Y-%m-%d')
    WHEN regexp_full_match({t}, '\\d{{1,2}}[-/.]\\d{{1,2}}[-/.]\\d{{4}}') THEN coalesce(
      try_strptime(regexp_replace({t}, '[-.]', '/', 'g'), '%d/%m/%Y'),
      try_strptime(regexp_replace({t}, '[-.]', '/', 'g'), '%m/%d/%Y'))
    WHEN regexp_full_match({t}, '\\d{{8}}') THEN try_strptime({t}, '%Y%m%d')
    WHEN regexp_full_match({t}, '\\d{{4}}/\\d\\d/\\d\\d') THEN try_strptime({t}, '%Y/%m/%d')
    ELSE try_strptime({t}, '%d %b %Y') END AS DATE)"""


_BOOL_CELL = _spell(
    "o_orderkey", "'true'", "' YES '", "'1'", "'T'", "'y'", "'no'", "'False'", "'1.0'", "''",
    "NULL", "o_orderstatus",
)
_INT_CELL = _spell(
    "o_orderkey",
    "CAST(o_custkey AS VARCHAR)",
    "' ' || o_custkey || ' '",
    "'+' || o_custkey",
    "'-' || o_custkey",
    "o_custkey || '.0'",
    "o_custkey || 'x'",
    "''",
    "NULL",
)
_DOC_CELL = _spell(
    "doc_id", "'  ' || source || chr(9)", "text", "' ' || chr(10) || ' '", "''", "NULL", "lang"
)
_TOKEN_CELL = _spell(
    "c_custkey", "c_name", "'NA'", "'None'", "'n/a'", "'NaN'", "''", "' NA'", "'none'",
    "c_mktsegment", "'#N/A'", "'-1.#IND'", "'null'",
)
_Q = "'Q' || quarter(o_orderdate) || year(o_orderdate)"
_ROLE = _spell(
    "o_custkey", "'Associate'", "'Consultant'", "'Senior'", "'Principal'", "'Lead'", "'Head'",
    "'Director'", "o_orderpriority", "NULL",
)
_LEADER = _spell(
    "p_partkey", "'Head of AWS'", "'Head of  Azure '", "'Head of MS Apps'",
    "'Head of Microsoft Apps'", "'Head of Data'", "'Head of Data Engineering'",
    "'Head of ' || p_type", "'Director of ' || p_brand", "p_name", "NULL", "'Head of Quality'",
)
# Level and family that each title of the ladder query stands for.
_LADDER_LEVEL = _spell(
    "p_partkey", "'Associate'", "'Consultant'", "'Senior'", "'Principal'", "'Lead'", "'Head'",
    "'Director'", "'none'", "'Head'", "'Director'",
)
_LADDER_FAMILY = _spell(
    "p_partkey", "p_type", "p_type", "p_type", "p_type", "p_type", "p_type", "p_type", "p_name",
    "p_type", "trim(regexp_replace(p_type || ' of', 'of', ''))",
)
_ISO = _spell("c_nationkey", "'gb'", "'ie'", "'us'", "'au'", "'in'", "'es'", "'si'", "'GB'", "'no'", "NULL")
_REPORTS = (
    "user_report usage_report project_experiences certifications courses languages technologies "
    "key_qualifications educations work_experiences positions blogs cv_roles"
).split()
_REPORT_CELL = _spell("event_id // 3", *[f"'{r}'" for r in _REPORTS], "'notes'")

_SCALAR = {
    "multilang_pick": """SELECT c_custkey, c_name AS int_name, c_mktsegment AS no_name,
  CAST(NULL AS VARCHAR) AS sv_name, c_name AS direct_name FROM customer""",
    "multilang_dirty": _with(_PAIRS, f"""clean AS (
  SELECT c_custkey, pos, {_STRIP.format('raw_code')} AS code, {_STRIP.format('raw_text')} AS text FROM pairs),
kept AS (SELECT * FROM clean WHERE code <> '' AND text <> '')""")
    + """SELECT c.c_custkey,
  arg_max(k.text, k.pos) FILTER (WHERE k.code = 'int') AS int_text,
  arg_max(k.text, k.pos) FILTER (WHERE k.code = 'no') AS no_text,
  arg_max(k.text, k.pos) FILTER (WHERE k.code = 'sv') AS sv_text,
  CAST(count(DISTINCT k.code) AS INTEGER) AS codes
FROM customer c LEFT JOIN kept k ON k.c_custkey = c.c_custkey GROUP BY c.c_custkey""",
    "lang_fallback": _with(_PAIRS, """firsts AS (
  SELECT c_custkey, arg_min(raw_code, pos) AS first_code FROM pairs GROUP BY c_custkey)""")
    + """SELECT c.c_custkey,
  coalesce(arg_max(k.raw_text, k.pos) FILTER (WHERE k.raw_code = 'int'),
           arg_max(k.raw_text, k.pos) FILTER (WHERE k.raw_code = f.first_code), '') AS int_value,
  coalesce(arg_max(k.raw_text, k.pos) FILTER (WHERE k.raw_code = 'sv'),
           arg_max(k.raw_text, k.pos) FILTER (WHERE k.raw_code = f.first_code), '') AS sv_value
FROM customer c LEFT JOIN pairs k ON k.c_custkey = c.c_custkey
LEFT JOIN firsts f ON f.c_custkey = c.c_custkey GROUP BY c.c_custkey""",
    "date_normalise": f"SELECT o_orderkey, {_parse('t')} AS day FROM (SELECT o_orderkey, {_ORDER_TEXT} AS t FROM orders)",
    "date_default": f"""SELECT o_orderkey, CASE WHEN t IS NULL OR trim(t) = '' THEN DATE '1900-01-01' ELSE {_parse('t')} END AS day
FROM (SELECT o_orderkey, {_ORDER_TEXT} AS t FROM orders)""",
    "validity_repair": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS valid_from,
  CASE WHEN o_orderstatus <> 'P' AND o_custkey % 61 >= 30
       THEN CAST(o_orderdate AS DATE) + CAST(o_custkey % 61 - 30 AS INTEGER) END AS valid_to FROM orders""",
    "int_lenient": f"""SELECT o_orderkey,
  CASE WHEN regexp_full_match(trim(t), '[-+]?\\d+') THEN CAST(trim(t) AS INTEGER) END AS lenient,
  CASE WHEN regexp_full_match(trim(t), '[-+]?\\d+(\\.0)?') THEN CAST(regexp_replace(trim(t), '\\.0$', '') AS INTEGER) END AS whole
FROM (SELECT o_orderkey, {_INT_CELL} AS t FROM orders)""",
    "int_strict": "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS INTEGER) END AS number FROM orders",
    "percent_clamp": """SELECT event_id, CASE WHEN event_type = 'error' THEN 0 WHEN value - 50 < 0 THEN 0
  WHEN value - 50 > 100 THEN 100 ELSE CAST(trunc(value - 50) AS INTEGER) END AS percent_available FROM events""",
    "bool_parse": f"""SELECT o_orderkey,
  CASE WHEN t IS NOT NULL THEN lower(trim(t)) IN ('true', '1', 't', 'yes', 'y') END AS flag,
  CASE WHEN lower(trim(t)) IN ('true', '1', 't', 'yes', 'y', 'on') THEN true
       WHEN lower(trim(t)) IN ('false', '0', 'f', 'no', 'n', 'off') THEN false END AS stored
FROM (SELECT o_orderkey, {_BOOL_CELL} AS t FROM orders)""",
    "string_normalise": f"""SELECT doc_id, coalesce(t, '') AS or_empty, nullif(t, '') AS or_null,
  coalesce(nullif(t, ''), 'Fake generator') AS or_default
FROM (SELECT doc_id, regexp_replace({_DOC_CELL}, '^\\s+|\\s+$', '', 'g') AS t FROM documents)""",
    "null_tokens": f"""SELECT c_custkey, CASE WHEN t NOT IN ('NA', 'None', 'n/a', 'NaN', '', '#N/A', '-1.#IND', 'null') THEN t END AS cell
FROM (SELECT c_custkey, {_TOKEN_CELL} AS t FROM customer)""",
    "json_extract": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  json_extract_string(props, '$.int') AS missing FROM events""",
    "json_encode": """SELECT c_custkey, '{"int":"' || c_name || '","no":"' || c_mktsegment || '"}' AS name_json,
  '"say \\"' || c_name || '\\" \\\\ ' || c_mktsegment || '"' AS text_json FROM customer""",
    "quarter_label": f"SELECT {_Q} AS label, count(*) AS orders FROM orders GROUP BY 1",
    "latest_snapshot": f"""SELECT folder, CAST(substr(folder, 3, 4) AS INTEGER) AS year, CAST(substr(folder, 2, 1) AS INTEGER) AS quarter
FROM (SELECT {_spell('o_orderkey', _Q, _Q + " || '_old'", "'Q5' || year(o_orderdate)", "'old' || " + _Q, "'QTEST'")} AS folder FROM orders)
WHERE regexp_matches(folder, '^Q[1-4]\\d{{4}}') ORDER BY 2 DESC, 3 DESC, 1 DESC LIMIT 1""",
    "cpd_enrich": f"""SELECT o_orderkey, sfia,
  CASE WHEN sfia <= 2 THEN 1 WHEN sfia = 3 THEN 2 WHEN sfia IN (4, 5) THEN 3 WHEN sfia >= 6 THEN 4 END AS cpd_level,
  CASE WHEN sfia IN (3, 5) THEN 'L' WHEN sfia IS NOT NULL THEN 'E' END AS cpd_band,
  {_LABEL.format('sfia')} AS cpd_label
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey % 9 AS INTEGER) END AS sfia FROM orders)""",
    "role_sfia": f"""SELECT o_orderkey, role, CASE role WHEN 'Associate' THEN 2 WHEN 'Consultant' THEN 3 WHEN 'Senior' THEN 4
  WHEN 'Principal' THEN 5 WHEN 'Lead' THEN 6 WHEN 'Head' THEN 6 WHEN 'Director' THEN 6 ELSE 4 END AS sfia
FROM (SELECT o_orderkey, {_ROLE} AS role FROM orders)""",
    "leadership_title": f"""SELECT p_partkey, CASE
  WHEN regexp_full_match(t, 'Head of +(AWS|Azure|Quality|Microsoft Apps|Data) *') THEN 'Head of ' || trim(substr(t, 9)) || ' Engineering'
  WHEN regexp_full_match(t, 'Head of +MS Apps *') THEN 'Head of Microsoft Apps Engineering' ELSE t END AS title
FROM (SELECT p_partkey, {_LEADER} AS t FROM part)""",
    "career_ladder": f"""WITH titles AS (SELECT p_partkey, p_size, {_LADDER_LEVEL} AS level, {_LADDER_FAMILY} AS family FROM part),
rungs AS (SELECT * FROM (VALUES
  ('Associate', 1, 'Associate '),
  ('Consultant', 1, 'Associate '), ('Consultant', 2, 'Consultant '),
  ('Senior', 1, 'Associate '), ('Senior', 2, 'Consultant '), ('Senior', 3, 'Senior '),
  ('Principal', 1, 'Consultant '), ('Principal', 2, 'Senior '), ('Principal', 3, 'Principal '),
  ('Lead', 1, 'Senior '), ('Lead', 2, 'Principal '), ('Lead', 3, 'Lead '),
  ('none', 1, 'Consultant '), ('none', 2, 'Senior '), ('none', 3, 'Principal '),
  ('Head', 1, 'Senior '), ('Head', 2, 'Principal '), ('Head', 3, 'Lead '), ('Head', 4, 'Head of '),
  ('Director', 1, 'Senior '), ('Director', 2, 'Principal '), ('Director', 3, 'Lead '),
  ('Director', 4, 'Head of '), ('Director', 5, 'Director of ')) AS r(level, rung, prefix))
SELECT p_partkey, CAST(rung AS INTEGER) AS rung, prefix || family AS name,
  CAST(2000 + p_size + rung - 1 AS INTEGER) AS year_from, CAST(2000 + p_size + rung AS INTEGER) AS year_to
FROM titles JOIN rungs USING (level)""",
    "country_name": f"""SELECT c_custkey, CASE {_ISO} WHEN 'gb' THEN 'United Kingdom' WHEN 'ie' THEN 'Ireland' WHEN 'us' THEN 'USA'
  WHEN 'au' THEN 'Australia' WHEN 'in' THEN 'India' WHEN 'es' THEN 'Spain' WHEN 'si' THEN 'Slovenia' ELSE 'Unknown' END AS country
FROM customer""",
    "calendar_spine": """SELECT c_custkey, date, CASE WHEN isodow(date) >= 6 THEN 100
  ELSE CAST(greatest(0, least(100, trunc(c_acctbal / 50))) AS INTEGER) END AS percent_available
FROM (SELECT c_custkey, c_acctbal, DATE '2024-02-20' + CAST(unnest(range(20)) AS INTEGER) AS date FROM customer)""",
    "report_completeness": f"""WITH landed AS (
  SELECT 'u' || user_id || '_Q' || quarter(ts) || year(ts) AS snapshot, {_REPORT_CELL} AS report FROM events),
wanted AS (SELECT DISTINCT snapshot, unnest([{', '.join(f"'{r}'" for r in _REPORTS)}]) AS report
  FROM (SELECT snapshot FROM landed UNION SELECT 'u' || c_custkey || '_Q12024' FROM customer))
SELECT snapshot, report FROM wanted EXCEPT SELECT snapshot, report FROM landed""",
    "office_ids": """SELECT 'off-' || s_suppkey || '-a' AS office_id FROM supplier
UNION ALL SELECT 'off-' || s_suppkey || '-b' FROM supplier""",
    "latest_status": """SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1""",
}

# --- table queries ----------------------------------------------------------------

_LABELS = "known AS (SELECT CAST(doc_id AS VARCHAR) AS cv_partner_cv_id FROM labels)"
_LIVE_ORDERS = "known AS (SELECT CAST(o_orderkey AS VARCHAR) AS cv_partner_cv_id FROM orders WHERE o_orderstatus <> 'P')"
_ALL_CUSTOMERS = "known AS (SELECT CAST(c_custkey AS VARCHAR) AS cv_partner_cv_id FROM customer)"


def _v(*names: str) -> str:
    return ", ".join(f"CAST(NULL AS VARCHAR) AS {n}" for n in names)


def _i(*names: str) -> str:
    return ", ".join(f"CAST(NULL AS INTEGER) AS {n}" for n in names)


def _d(*names: str) -> str:
    return ", ".join(f"CAST(NULL AS DATE) AS {n}" for n in names)


def _section(parents: str, source: str, key: str, order: str, columns: str, where: str = "") -> str:
    """Last row per key, of known parents only."""
    return _with(parents) + f"""SELECT * EXCLUDE (rn) FROM (
  SELECT {columns}, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source} {where})
WHERE rn = 1 AND cv_partner_cv_id IN (SELECT cv_partner_cv_id FROM known)"""


_WORDS_TRUE = "('true', '1', 't', 'yes', 'y')"
_E_EMAIL = _spell("user_id", f"upper({_EMAIL.format('user_id')})", "'nobody' || user_id || '@example.org'", "''", "NULL")
_E_UPN = _spell("user_id", "NULL", "'TEAM' || (user_id % 30)", "'no team'", "''")
_E_EXT = _spell("event_id", "'ext_' || user_id", "'EXT_' || user_id", "NULL")

_KEYS = """by_email AS (SELECT lower(email) AS k, min(cv_partner_user_id) AS id FROM people GROUP BY 1),
by_upn AS (SELECT lower(upn) AS k, min(cv_partner_user_id) AS id FROM people GROUP BY 1),
by_ext AS (SELECT external_user_id AS k, min(cv_partner_user_id) AS id FROM people GROUP BY 1)"""


def _resolved(columns: str) -> str:
    """Rows of ``facts`` (email, upn, ext) with their person, tier by tier."""
    return f"""resolved AS (SELECT {columns}, coalesce(e.id, u.id, x.id) AS cv_partner_user_id FROM facts f
  LEFT JOIN by_email e ON e.k = lower(f.email) LEFT JOIN by_upn u ON u.k = lower(f.upn)
  LEFT JOIN by_ext x ON x.k = f.ext)"""


_FACTS = f"facts AS (SELECT event_id, {_E_EMAIL} AS email, {_E_UPN} AS upn, {_E_EXT} AS ext FROM events)"

_C_FACTS = f"""facts AS (SELECT event_id, user_id,
  {_spell('event_id', _EMAIL.format('user_id'), f"upper({_EMAIL.format('user_id')})", 'NULL')} AS email,
  CAST(NULL AS VARCHAR) AS upn,
  CASE WHEN event_type <> 'click' THEN 'ext_' || user_id END AS ext,
  {_spell('event_id', "event_type", "event_type", "'None'", "'None'")} AS clearance,
  {_spell('event_id', 'CAST(ts AS DATE)', 'CAST(ts AS DATE)', "DATE '1900-01-01'", "DATE '1900-01-01'", 'CAST(ts AS DATE)')} AS valid_from,
  {_spell('event_id', 'CAST(ts AS DATE) + 9', 'CAST(ts AS DATE) - 9', 'NULL')} AS valid_to,
  {_spell('user_id', "'HR'", 'NULL', 'NULL')} AS verified_by,
  'event ' || event_id AS notes FROM events)"""

_A_FACTS = f"""facts AS (SELECT event_id, value, event_type, CAST(ts AS DATE) AS date,
  {_spell('event_id', _EMAIL.format('user_id'), f"'x' || {_EMAIL.format('user_id')}", "''")} AS email,
  {_spell('user_id', "'team' || user_id", 'NULL')} AS upn,
  'ext_' || user_id AS ext,
  {_spell('event_id', "'Manual'", "'Fake generator'", "'Fake generator'", 'event_type')} AS source FROM events)"""

_REJECT_ROWS = f"""SELECT o_custkey, concat_ws(', ',
    CASE WHEN o_orderstatus = 'P' THEN 'cv_partner_section_id' END,
    CASE WHEN o_orderkey % 4 = 1 THEN 'year_from' END,
    CASE WHEN o_orderkey % 3 = 2 THEN 'updated' END) AS problem FROM orders"""

_TABLES = {
    "profile": _profile(),
    "profile_numeric_subset": _profile("WHERE u.c_mktsegment <> 'BUILDING'"),
    "latest_availability": _with(_AVAIL, _NEWEST) + "SELECT * FROM newest",
    "top_skills": _with(_TECH) + _TOP,
    "kpi_counts": _COUNTS,
    "kpi_available": _with(_PEOPLE, _AVAIL, _NEWEST, _CLEAR, _RESUMES, _NAMED_PROFILE) + _SC,
    "kpi_mean": _with(_AVAIL) + _MEAN,
    "kpi_report": _with(_PEOPLE, _AVAIL, _NEWEST, _CLEAR, _RESUMES, _NAMED_PROFILE, _TECH)
    + f"""{_COUNTS} UNION ALL SELECT 'top_skill:' || name, CAST(cnt AS DOUBLE) FROM ({_TOP})
UNION ALL {_SC} UNION ALL {_MEAN}""",
    "nationality_lookup": """WITH last AS (SELECT * FROM (
  SELECT o_custkey, o_orderpriority, o_orderstatus,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderstatus <> 'P') WHERE rn = 1)
SELECT CAST(c_custkey AS VARCHAR) AS cv_partner_user_id, o_orderpriority AS nationality,
  o_orderstatus AS nationality_no, CASE WHEN o_custkey IS NULL THEN 0 ELSE 2 END AS languages
FROM customer LEFT JOIN last ON o_custkey = c_custkey""",
    "identity_resolve": _with(_PEOPLE, _KEYS, _FACTS, _resolved("event_id"))
    + "SELECT event_id, cv_partner_user_id FROM resolved WHERE cv_partner_user_id IS NOT NULL",
    "identity_unresolved": _with(_PEOPLE, _KEYS, _FACTS, _resolved("event_id"))
    + "SELECT event_id FROM resolved WHERE cv_partner_user_id IS NULL",
    "cv_resolve": "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "unmatched_rows": "SELECT doc_id, lang, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "unmatched_counts": """SELECT user_id AS doc_id, count(*) AS rows FROM events
WHERE user_id NOT IN (SELECT doc_id FROM labels) GROUP BY user_id""",
    "dim_technology": "SELECT DISTINCT p_brand AS name FROM lineitem JOIN part ON l_partkey = p_partkey",
    "dim_new_members": """WITH named AS (SELECT l_returnflag, l_shipdate, p_brand || '/' || l_partkey || '/' || l_linenumber AS name
  FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT name FROM named WHERE l_returnflag <> 'A' EXCEPT SELECT name FROM named WHERE year(l_shipdate) < 1997""",
    "dim_lookup": """WITH named AS (SELECT CASE WHEN l_returnflag <> 'A' THEN p_type END AS name
  FROM lineitem JOIN part ON l_partkey = p_partkey),
types AS (SELECT p_type, count(*) AS parts FROM part GROUP BY p_type)
SELECT name, parts, count(*) AS lines FROM named LEFT JOIN types ON p_type = name GROUP BY name, parts""",
    "report_layout": f"""SELECT 'part ' || l_partkey AS name, 'int:' || c_name AS name_multilang, 'int:' || o_orderpriority AS title,
  {_EMAIL.format('c_custkey')} AS email, CAST(NULL AS VARCHAR) AS upn,
  CAST(c_custkey AS VARCHAR) AS user_key, CAST(o_orderkey AS VARCHAR) AS cv_key,
  c_mktsegment AS department, CAST(NULL AS VARCHAR) AS country,
  CAST(l_linenumber AS VARCHAR) AS section_key, CAST(trunc(l_quantity) AS INTEGER) AS percent_allocated,
  'part ' || l_partkey AS section_name
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey""",
    "section_summary": _with(_TECH, """keys AS (SELECT o_orderkey AS k FROM orders)""",
    "w AS (SELECT l_orderkey AS k, count(*) AS n, max(CAST(l_shipdate AS DATE)) AS d FROM lineitem GROUP BY 1)",
    "p AS (SELECT o_orderkey AS k, count(*) AS n, max(CAST(o_orderdate AS DATE)) AS d FROM orders GROUP BY 1)",
    "s AS (SELECT CAST(cv_partner_cv_id AS BIGINT) AS k, count(*) AS n FROM tech GROUP BY 1)")
    + """SELECT CAST(keys.k AS VARCHAR) AS cv_partner_cv_id, CAST(coalesce(w.n, 0) AS INTEGER) AS work_experience_count,
  w.d AS work_experience_updated, CAST(coalesce(p.n, 0) AS INTEGER) AS position_count, p.d AS position_updated,
  CAST(coalesce(s.n, 0) AS INTEGER) AS cv_technology_count, CAST(NULL AS DATE) AS cv_technology_updated
FROM keys LEFT JOIN w USING (k) LEFT JOIN p USING (k) LEFT JOIN s USING (k)
UNION ALL SELECT 'c' || c_custkey, 0::INTEGER, NULL, 0::INTEGER, NULL, 0::INTEGER, NULL FROM customer""",
    "upsert_last_wins": _with(_TECH) + "SELECT * FROM tech",
    "upsert_immutable": f"""SELECT l_orderkey, owner, tax FROM (
  SELECT l_orderkey, l_tax AS tax,
         first_value(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER_UP}) AS owner,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS rn FROM lineitem) WHERE rn = 1""",
    "upsert_incremental": """SELECT CAST(user_id AS VARCHAR) AS cv_partner_user_id, CAST(ts AS DATE) AS date,
  CAST(greatest(0, least(100, trunc(value))) AS INTEGER) AS percent_available,
  CASE WHEN hour(ts) < 12 THEN DATE '2024-06-01' ELSE DATE '2024-07-01' END AS updated_at
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY hour(ts) >= 12 DESC, event_id DESC) = 1""",
    "upsert_first_writer_kept": """SELECT o_custkey,
  first_value(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) >= 1995, o_orderkey) AS first_priority,
  o_orderstatus AS status
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) >= 1995 DESC, o_orderkey DESC) = 1""",
    "users_load": f"""SELECT CAST(c_custkey AS VARCHAR) AS cv_partner_user_id,
  '{{"int":"' || c_name || '","no":"' || o_orderpriority || '"}}' AS name_json,
  '{{"int":"' || c_nationkey || '"}}' AS nationality_json,
  {_EMAIL.format('c_custkey')} AS email, CASE WHEN o_orderstatus <> 'P' THEN 'upn' || o_orderkey END AS upn,
  {_v('external_user_id', 'phone_number')}, CAST(c_nationkey + 1950 AS INTEGER) AS birth_year,
  c_mktsegment AS department, n_name AS country, CAST(o_orderdate AS DATE) AS user_created_at
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY o_orderkey DESC) = 1""",
    "cvs_load": f"""WITH rows AS (SELECT * FROM lineitem WHERE l_partkey IN (SELECT c_custkey FROM customer))
SELECT CAST(l_orderkey AS VARCHAR) AS cv_partner_cv_id,
  CAST(first_value(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER_UP}) AS VARCHAR) AS cv_partner_user_id,
  l_returnflag || l_linestatus AS cv_title, CAST(trunc(l_quantity) AS INTEGER) AS years_of_education,
  CAST(trunc(l_quantity) AS INTEGER) AS years_since_first_work_experience,
  {_spell('l_linenumber', 'true', 'false', 'NULL', 'true')} AS has_profile_image,
  CAST(NULL AS BOOLEAN) AS owns_reference_project, CAST(l_shipdate AS DATE) AS cv_last_updated,
  CAST({_spell('l_linenumber', '3', 'NULL', 'NULL', 'NULL', '5')} AS INTEGER) AS sfia_level,
  CAST(NULL AS INTEGER) AS cpd_level, 'CPD' || l_linenumber AS cpd_label
FROM rows QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) = 1""",
    "technologies_load": _section(
        _LIVE_ORDERS, "lineitem JOIN part ON l_partkey = p_partkey", "l_orderkey, p_brand", _LINE_ORDER,
        """CAST(l_orderkey AS VARCHAR) AS cv_partner_cv_id, p_brand AS technology,
        CAST(trunc(l_quantity) AS INTEGER) AS years_experience, CAST(l_linenumber % 6 AS INTEGER) AS proficiency,
        '"{\\"int\\":\\"' || l_linestatus || '\\"}"' AS is_official_masterdata""",
        "WHERE l_returnflag <> 'N'",
    ),
    "languages_load": _section(
        _LABELS, "documents", "doc_id, lang", "doc_id",
        f"""CAST(doc_id AS VARCHAR) AS cv_partner_cv_id, lang AS language, source AS level,
        {_spell('n_chars', 'true', 'false', 'NULL')} AS highlighted, '{{}}' AS is_official_masterdata,
        {_d('updated', 'updated_by_owner')}""",
        "WHERE lang <> ''",
    ),
    "project_load": _section(
        _LIVE_ORDERS, "lineitem JOIN part ON l_partkey = p_partkey", "l_orderkey, l_linenumber", _LINE_ORDER,
        f"""CAST(l_orderkey AS VARCHAR) AS cv_partner_cv_id, CAST(l_linenumber AS VARCHAR) AS cv_partner_section_id,
        {_v('external_unique_id')}, CAST(month(l_shipdate) AS INTEGER) AS month_from,
        CAST(year(l_shipdate) AS INTEGER) AS year_from, {_i('month_to', 'year_to')},
        'Part ' || l_partkey AS customer_int, '"int:Part ' || l_partkey || '"' AS customer_multilang,
        p_name AS customer_anon_int, '{{}}' AS customer_anon_multilang, {_v('description_int')},
        '{{}}' AS description_multilang, {_v('long_description_int')}, '{{}}' AS long_description_multilang,
        p_type AS industry, CASE WHEN l_returnflag <> 'A' THEN p_brand END AS project_type,
        CAST(trunc(l_quantity) AS INTEGER) AS percent_allocated, {_i('extent_individual_hours')},
        p_size AS extent_hours, {_i('extent_total_hours')}, l_linestatus AS extent_unit,
        {_v('extent_currency')}, {_i('extent_total')}, {_v('extent_total_currency')}, {_i('project_area')},
        {_v('project_area_unit')}, {_spell('l_suppkey', 'true', 'false', 'NULL')} AS highlighted,
        CAST(l_shipdate AS DATE) AS updated,
        {_parse("strftime(l_shipdate, '%m/%d/%Y')")} AS updated_by_owner""",
    ),
    "section_work": _section(
        _LIVE_ORDERS, "lineitem", "l_orderkey, l_linenumber", _LINE_ORDER,
        f"""CAST(l_orderkey AS VARCHAR) AS cv_partner_cv_id, CAST(l_linenumber AS VARCHAR) AS cv_partner_section_id,
        'x' || l_suppkey AS external_unique_id, CAST(month(l_shipdate) AS INTEGER) AS month_from,
        CAST(year(l_shipdate) AS INTEGER) AS year_from, {_i('month_to', 'year_to')},
        {_spell('l_suppkey', 'true', 'false', 'NULL')} AS highlighted, 'Supplier ' || l_suppkey AS employer,
        {_v('description')}, 'price ' || l_partkey AS long_description, CAST(l_shipdate AS DATE) AS updated,
        {_d('updated_by_owner')}""",
    ),
    "certification_load": _section(
        _LABELS, "events", "user_id, event_type", "event_id DESC",
        f"""CAST(user_id AS VARCHAR) AS cv_partner_cv_id, event_type AS cv_partner_section_id,
        CAST(event_id AS VARCHAR) AS external_unique_id, CAST(month(ts) AS INTEGER) AS month,
        CAST(year(ts) AS INTEGER) AS year, CAST(trunc(value) AS INTEGER) AS month_expire,
        {_i('year_expire')}, CAST(ts AS DATE) AS updated, {_d('updated_by_owner')}""",
    ),
    "course_load": _section(
        _LABELS, "events", "user_id, json_extract_string(props, '$.k')", "event_id DESC",
        f"""CAST(user_id AS VARCHAR) AS cv_partner_cv_id, json_extract_string(props, '$.k') AS cv_partner_section_id,
        {_v('external_unique_id')}, {_i('month')}, CAST(year(ts) AS INTEGER) AS year, event_type AS name,
        {_v('organiser', 'long_description')},
        {_spell('event_id', 'true', 'false', 'NULL', 'true')} AS highlighted,
        '"' || replace(props, '"', '\\"') || '"' AS is_official_masterdata,
        {_spell('event_id', "'file.pdf'", 'NULL', 'NULL')} AS attachments, {_d('updated', 'updated_by_owner')}""",
    ),
    "education_load": _section(
        _ALL_CUSTOMERS, "orders", "o_custkey, o_orderpriority", "o_orderkey DESC",
        f"""CAST(o_custkey AS VARCHAR) AS cv_partner_cv_id, o_orderpriority AS cv_partner_section_id,
        {_v('external_unique_id')}, {_i('month_from')}, CAST(year(o_orderdate) AS INTEGER) AS year_from,
        {_i('month_to')}, CAST(year(o_orderdate) + 4 AS INTEGER) AS year_to,
        CASE WHEN o_orderstatus <> 'F' THEN true END AS highlighted, {_v('attachments')},
        o_orderstatus AS place_of_study, 'order ' || o_orderkey AS degree, {_v('description')},
        {_d('updated')}, CAST(o_orderdate AS DATE) AS updated_by_owner""",
    ),
    "position_load": _section(
        _ALL_CUSTOMERS, "orders", "o_custkey, year(o_orderdate)", "o_orderkey DESC",
        f"""CAST(o_custkey AS VARCHAR) AS cv_partner_cv_id, CAST(year(o_orderdate) AS VARCHAR) AS cv_partner_section_id,
        {_v('external_unique_id')}, CAST(year(o_orderdate) AS INTEGER) AS year_from, {_i('year_to')},
        CAST(NULL AS BOOLEAN) AS highlighted, o_orderpriority AS name, 'order ' || o_orderkey AS description,
        {_d('updated', 'updated_by_owner')}""",
    ),
    "blog_load": _section(
        _LABELS, "pages", "page_id, url", "page_id DESC",
        f"""CAST(page_id AS VARCHAR) AS cv_partner_cv_id, url AS cv_partner_section_id, {_v('external_unique_id')},
        url AS name, html AS description, CAST(NULL AS BOOLEAN) AS highlighted, {_d('updated', 'updated_by_owner')}""",
    ),
    "section_role": _section(
        _LABELS, "conversations", "conv_id, role", "turn DESC",
        f"""CAST(conv_id AS VARCHAR) AS cv_partner_cv_id, role AS name, text AS description,
        CAST(NULL AS BOOLEAN) AS highlighted, {_d('updated', 'updated_by_owner')}""",
    ),
    "key_qualification_load": _section(
        _LABELS, "documents", "doc_id", "doc_id",
        f"""CAST(doc_id AS VARCHAR) AS cv_partner_cv_id, 'kq-' || doc_id AS cv_partner_section_id,
        {_v('external_unique_id')}, source AS label, text AS summary, lang AS short_description,
        {_d('updated', 'updated_by_owner')}""",
    ),
    "clearance_load": _with(_PEOPLE, _KEYS, _C_FACTS, _resolved("event_id, clearance, valid_from, valid_to, verified_by, notes"))
    + """SELECT cv_partner_user_id, clearance, valid_from,
  CASE WHEN valid_to >= valid_from THEN valid_to END AS valid_to, verified_by, notes
FROM resolved WHERE cv_partner_user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY cv_partner_user_id, clearance, valid_from ORDER BY event_id DESC) = 1""",
    "availability_load": _with(_PEOPLE, _KEYS, _A_FACTS, _resolved("event_id, date, value, event_type, source"))
    + """SELECT cv_partner_user_id, date,
  CASE WHEN event_type = 'error' THEN 0 ELSE CAST(greatest(0, least(100, trunc(value - 50))) AS INTEGER) END AS percent_available,
  source, DATE '2024-06-01' AS updated_at
FROM resolved WHERE cv_partner_user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY cv_partner_user_id, date ORDER BY event_id DESC) = 1""",
    "section_rejects": f"""SELECT 'position' AS table_name, problem, count(*) AS rows FROM ({_REJECT_ROWS})
WHERE problem <> '' AND o_custkey IN (SELECT doc_id FROM labels) GROUP BY problem""",
    "dq_not_null": """WITH j AS (SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT 'labelled' AS table_name, 'not_null' AS check_name, 'doc_id' AS column_name, count(*) - count(doc_id) AS violations FROM j
UNION ALL SELECT 'labelled', 'not_null', 'lang', count(*) - count(lang) FROM j
UNION ALL SELECT 'labelled', 'not_null', 'quality', count(*) - count(quality) FROM j
UNION ALL SELECT 'labelled', 'not_null', 'toxic', count(*) - count(toxic) FROM j""",
    "dq_unique": """SELECT 'lineitem' AS table_name, 'unique' AS check_name, 'l_orderkey, l_linenumber' AS column_name, count(*) AS violations
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'orders', 'unique', 'o_orderkey', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)""",
    "dq_fk": """SELECT 'documents' AS table_name, 'foreign_key' AS check_name, 'doc_id' AS column_name, count(*) AS violations
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'events', 'foreign_key', 'user_id', count(*) FROM events WHERE user_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'orders', 'foreign_key', 'o_custkey', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""",
    "dq_range": """SELECT 'events' AS table_name, 'range' AS check_name, 'value' AS column_name, count(*) AS violations
FROM events WHERE value < 0 OR value > 100""",
    "cascade_delete": """SELECT l_returnflag, count(*) AS lines, sum(l_quantity) AS quantity FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_returnflag""",
    "restrict_delete": """SELECT l_orderkey AS o_orderkey, count(*) AS rows FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') GROUP BY l_orderkey""",
}

SQL: dict[str, str] = {**_TABLES, **_SCALAR}

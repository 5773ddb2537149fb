"""SQL texts shared by both engines, and DuckDB spellings of the column functions."""

from __future__ import annotations

from obsforge.functions.rules import STATE_CODES

AS_OF = "1999-01-01"

_CODES = "AL,AK,AZ,AR,CA,CO,CT,DE,FL,GA,HI,ID,IL,IN,IA,KS,KY,LA,ME,MD,MA,MI,MN,MS,MO"

# Loosely formatted records, one per order; runs on both engines.
DIRTY = f"""
SELECT k AS record_index,
  CASE k % 11 WHEN 0 THEN lower(code) WHEN 1 THEN 'XX' WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN concat('  ', code, ' ') ELSE code END AS state,
  CASE k % 7 WHEN 0 THEN concat('  ', lower(seg), '   o''brien  COUNTY ') WHEN 1 THEN concat(seg, ' County') ELSE NULL END AS county,
  CASE k % 9 WHEN 0 THEN CAST(nk % 10 AS STRING) WHEN 1 THEN lpad(CAST(nk AS STRING), 2, '0') WHEN 2 THEN CAST(100 + nk AS STRING)
             WHEN 3 THEN CAST(6000 + nk AS STRING) WHEN 4 THEN concat('0', CAST(6000 + nk AS STRING)) WHEN 5 THEN 'FIPS-06'
             WHEN 6 THEN '1234567' WHEN 7 THEN 'n/a' ELSE NULL END AS fips_code,
  CASE k % 8 WHEN 0 THEN concat(lpad(m, 2, '0'), '/', lpad(d, 2, '0'), '/', y) WHEN 1 THEN concat(y, '/', lpad(m, 2, '0'), '/', lpad(d, 2, '0'))
             WHEN 2 THEN concat(lpad(d, 2, '0'), '-', lpad(m, 2, '0'), '-', y) WHEN 3 THEN concat(y, '-', m, '-', d) WHEN 4 THEN 'not a date'
             WHEN 5 THEN NULL ELSE concat(y, '-', lpad(m, 2, '0'), '-', lpad(d, 2, '0')) END AS date,
  CASE k % 10 WHEN 0 THEN concat('$', ps) WHEN 1 THEN concat('-', ps) WHEN 2 THEN '1,234.50' WHEN 3 THEN 'suppressed' WHEN 4 THEN ''
              WHEN 5 THEN NULL ELSE ps END AS value,
  CASE WHEN k % 13 = 0 THEN '18-24' WHEN k % 13 = 1 THEN '65+' ELSE NULL END AS age_group,
  CASE WHEN k % 4 = 0 THEN 'Male' WHEN k % 4 = 1 THEN 'Female' ELSE NULL END AS gender,
  CASE WHEN k % 6 = 0 THEN 'White' ELSE NULL END AS race,
  CASE WHEN k % 5 = 0 THEN y ELSE NULL END AS year
FROM (
  SELECT o.o_orderkey AS k, c.c_nationkey AS nk, c.c_mktsegment AS seg,
         substring('{_CODES}', c.c_nationkey * 3 + 1, 2) AS code,
         CAST(year(o.o_orderdate) AS STRING) AS y, CAST(month(o.o_orderdate) AS STRING) AS m, CAST(day(o.o_orderdate) AS STRING) AS d,
         CAST(CAST(o.o_totalprice AS DECIMAL(15,2)) AS STRING) AS ps
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey) b
"""

# Number spellings, one per order; runs on both engines.
NUMBERS = """
SELECT o_orderkey AS record_index,
  CASE o_orderkey % 18
    WHEN 0 THEN ps WHEN 1 THEN concat('$', ps) WHEN 2 THEN concat(k, '_000.5') WHEN 3 THEN concat(k, 'e', CAST(o_orderkey % 5 AS STRING))
    WHEN 4 THEN concat('  ', ps, ' ') WHEN 5 THEN 'nan' WHEN 6 THEN '-Infinity' WHEN 7 THEN concat(k, 'd') WHEN 8 THEN concat('.', k)
    WHEN 9 THEN concat(k, '.') WHEN 10 THEN '0x10' WHEN 11 THEN concat('+', k) WHEN 12 THEN concat('-', ps) WHEN 13 THEN ''
    WHEN 14 THEN NULL WHEN 15 THEN concat(k, '__0') WHEN 16 THEN concat(k, ',', k, '.25') ELSE concat(k, 'E+12') END AS value
FROM (SELECT o_orderkey, CAST(o_orderkey AS STRING) AS k, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) AS ps FROM orders) b
"""

# Flags as words, one per order; runs on both engines.
FLAGS = """
SELECT o_orderkey AS record_index,
  CASE o_orderkey % 16
    WHEN 0 THEN 'true' WHEN 1 THEN 'T' WHEN 2 THEN 'YES' WHEN 3 THEN 'y' WHEN 4 THEN '1' WHEN 5 THEN ' On '
    WHEN 6 THEN 'false' WHEN 7 THEN 'F' WHEN 8 THEN 'no' WHEN 9 THEN 'N' WHEN 10 THEN '0' WHEN 11 THEN 'off'
    WHEN 12 THEN '' WHEN 13 THEN NULL WHEN 14 THEN o_orderstatus ELSE o_orderpriority END AS flag
FROM orders
"""

# Ragged records as JSON texts, one per order; runs on both engines.
RAGGED = """
SELECT o_orderkey AS record_index,
  concat('{"value":', k,
    CASE o_orderkey % 3 WHEN 0 THEN ',"cases":null' WHEN 1 THEN concat(',"cases":"', k, ',5"') ELSE '' END,
    CASE o_orderkey % 5 WHEN 0 THEN ',"deaths":2.5' WHEN 1 THEN ',"rate":true' ELSE '' END,
    CASE o_orderkey % 4 WHEN 0 THEN ',"state":"tx","stateabbr":" ny "' WHEN 1 THEN ',"stateabbr":null,"state":"TX"' ELSE ',"state":"  Ohio "' END,
    CASE o_orderkey % 6 WHEN 0 THEN ',"fips":6037' WHEN 1 THEN ',"fips":"6"' WHEN 2 THEN ',"locationid":6.0' ELSE '' END,
    CASE o_orderkey % 7 WHEN 0 THEN ',"unit":"own","data_value_unit":"mapped"' WHEN 1 THEN ',"data_value_unit":"mapped"' ELSE '' END,
    ',"year":', CAST(year(o_orderdate) AS STRING), ',"measure":"', o_orderpriority, '","extra":"', o_orderstatus, '"}') AS body
FROM (SELECT o_orderkey, o_orderdate, o_orderpriority, o_orderstatus, CAST(o_orderkey AS STRING) AS k FROM orders) b
"""


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- DuckDB spellings -------------------------------------------------------

_SPACES = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13, 28, 29, 30, 31, 133, 160))
_SPACE_CLASS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}]"
_D = r"\d+(_\d+)*"
_FLOAT = rf"(?i)^[+-]?(nan|inf|infinity|({_D}\.?({_D})?|\.{_D})(e[+-]?{_D})?)$"
_INT = rf"^[+-]?{_D}$"
STATE_LISTING = text(str(list(STATE_CODES)))
STATE_SET = ", ".join(text(c) for c in STATE_CODES)


def strip(x: str) -> str:
    return f"trim({x}, {_SPACES})"


def clean_string(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def parse_float(x: str) -> str:
    bare = strip(x)
    return (
        f"CASE WHEN regexp_matches({bare}, {text(_FLOAT)}) "
        f"THEN TRY_CAST(replace({bare}, '_', '') AS DOUBLE) END"
    )


def clean_numeric(x: str) -> str:
    return parse_float(f"replace(replace({x}, ',', ''), '$', '')")


def number_text(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


_LOOKS = {
    "%Y-%m-%d": r"^\d{4}-\d{1,2}-( \d|\d{1,2})$",
    "%m/%d/%Y": r"^\d{1,2}/( \d|\d{1,2})/\d{4}$",
    "%Y/%m/%d": r"^\d{4}/\d{1,2}/( \d|\d{1,2})$",
    "%d-%m-%Y": r"^( \d|\d{1,2})-\d{1,2}-\d{4}$",
}


def parse_date(x: str, spelled: str = "%Y-%m-%d") -> str:
    return (
        f"CASE WHEN regexp_matches({x}, {text(_LOOKS[spelled])}) "
        f"THEN CAST(try_strptime(replace({x}, ' ', ''), {text(spelled)}) AS DATE) END"
    )


def clean_date(x: str) -> str:
    return "coalesce(" + ", ".join(parse_date(strip(x), f) for f in _LOOKS) + ")"


def clean_state(x: str) -> str:
    up = f"upper({clean_string(x)})"
    return (
        rf"CASE WHEN regexp_matches({up}, '^\p{{L}}{{2}}$') THEN {up} "
        f"ELSE nullif(regexp_extract({up}, '^([A-Z]{{2}})', 1), '') END"
    )


def clean_fips(x: str) -> str:
    digits = f"regexp_replace({clean_string(x)}, '[^0-9]', '', 'g')"
    return (
        f"CASE WHEN length({digits}) BETWEEN 1 AND 2 THEN lpad({digits}, 2, '0') "
        f"WHEN length({digits}) BETWEEN 3 AND 5 THEN lpad({digits}, 5, '0') END"
    )


def clean_county(x: str) -> str:
    runs = rf"regexp_extract_all({clean_string(x)}, '(\p{{L}}+|[^\p{{L}}]+)')"
    titled = f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || lower(w[2:])), '')"
    spaced = f"regexp_replace({titled}, {text(_SPACE_CLASS + '+')}, ' ', 'g')"
    return f"trim(regexp_replace({spaced}, '(?i) +County$', ''))"


def clean_boolean(x: str) -> str:
    word = f"lower({strip(x)})"
    return (
        f"CASE WHEN {word} IN ('true','t','yes','y','1','on') THEN true "
        f"WHEN {word} IN ('false','f','no','n','0','off','') THEN false END"
    )


def strip_special(x: str, keep: str = "") -> str:
    kept = "".join("\\" + c for c in keep)
    cls = _SPACE_CLASS[1:-1]
    left = f"regexp_replace({clean_string(x)}, {text(f'[^a-zA-Z0-9{cls}{kept}]')}, '', 'g')"
    return strip(f"nullif({left}, '')")


# Rule messages: NULL when the value passes. All inputs are texts.

def _unless_missing(x: str, failing: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE ({failing}) END"


def rule_numeric(x: str) -> str:
    return f"CASE WHEN ({parse_float(x)}) IS NULL THEN 'Value ''' || coalesce({x}, 'None') || ''' is not numeric' END"


def rule_at_least_zero(x: str, complaint: str) -> str:
    number = f"({parse_float(x)})"
    return (
        f"CASE WHEN {number} IS NULL THEN 'Value ''' || coalesce({x}, 'None') || ''' is not numeric' "
        # DuckDB orders NaN above all numbers, so it passes as well
        f"WHEN {number} < 0 THEN 'Value ' || {number_text(number)} || {text(complaint)} END"
    )


def rule_date_format(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'Date value must be string or date object' "
        f"WHEN ({parse_date(x)}) IS NULL THEN 'Date ''' || {x} || ''' does not match format %Y-%m-%d' END"
    )


def rule_not_future(x: str) -> str:
    day = f"({parse_date(x)})"
    return (
        f"CASE WHEN {x} IS NULL THEN 'Value must be a date, got <class ''str''>' "
        f"WHEN {day} IS NULL THEN 'Invalid date format: ' || {x} "
        f"WHEN {day} > DATE '{AS_OF}' THEN 'Date ' || CAST({day} AS VARCHAR) || ' cannot be in the future' END"
    )


def rule_state(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL OR upper({x}) NOT IN ({STATE_SET}) "
        f"THEN 'Value ''' || coalesce(upper({x}), 'None') || ''' not in allowed values: ' || {STATE_LISTING} END"
    )


def rule_fips(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN 'FIPS code must be a string' "
        f"WHEN NOT regexp_matches({strip(x)}, {text(_INT)}) THEN 'FIPS code must be numeric, got ''' || {x} || '''' "
        f"WHEN length({x}) NOT IN (2, 5) THEN 'FIPS code must be 2 (state) or 5 (county) digits, got ' || length({x}) END"
    )


BASIC = (
    ("state", rule_state, False),
    ("date", rule_date_format, False),
    ("date", rule_not_future, True),
    ("value", rule_numeric, False),
    ("value", lambda x: rule_at_least_zero(x, " cannot be negative"), False),
    ("fips_code", rule_fips, False),
)


def validated(source: str, rules=BASIC, extra: str = "") -> str:
    """CTE body: source columns, then each rule's message, errors, warnings, status."""
    told = ", ".join(
        f"({_unless_missing(f, rule(f))}) AS _m{i}" for i, (f, rule, _) in enumerate(rules)
    )

    def listed(warning: bool) -> str:
        parts = [f"'{f}: ' || _m{i}" for i, (f, _, w) in enumerate(rules) if w == warning]
        return f"list_filter([{', '.join(parts) or 'NULL::VARCHAR'}], lambda m: m IS NOT NULL)"

    return (
        f"SELECT *, CASE WHEN len(errors) > 0 THEN 'invalid' WHEN len(warnings) > 0 THEN 'warning' ELSE 'valid' END AS status "
        f"FROM (SELECT *, {listed(False)} AS errors, {listed(True)} AS warnings "
        f"FROM (SELECT *, {told}{extra} FROM ({source}) s0) s1) s2"
    )


# Canonical observations of the dirty records.
OBSERVED = f"""
SELECT record_index, state, county, fips_code, value, age_group, gender, race, year,
  CASE WHEN county <> '' OR length(fips_code) = 5 THEN 'county' WHEN state <> '' THEN 'state' ELSE 'nation' END AS geography_level,
  coalesce(day, CASE WHEN yn BETWEEN 1 AND 9999 THEN make_date(yn, 1, 1) END) AS period_start,
  coalesce(CASE WHEN day IS NULL AND yn BETWEEN 1 AND 9999 THEN make_date(yn, 12, 31) END, day) AS period_end
FROM (SELECT record_index, {clean_state('state')} AS state, {clean_county('county')} AS county, {clean_fips('fips_code')} AS fips_code,
    {clean_date('date')} AS day, {clean_numeric('value')} AS value, age_group, gender, race, year, TRY_CAST(year AS INTEGER) AS yn
  FROM ({DIRTY}) d0) d1
"""

# Calendar-year variant: without a day many records share a fact key.
OBSERVED_YEARLY = OBSERVED.replace(clean_date("date"), "CAST(NULL AS DATE)").replace(
    "TRY_CAST(year AS INTEGER) AS yn", "1990 + CAST(record_index % 10 AS INTEGER) AS yn"
)

"""Cleaners, rules, presets and validation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import sql as q
from checks.registry import Data, query
from obsforge.functions import clean, rules
from obsforge.functions.pyvalue import float_text, text_value
from obsforge.functions.user import user_check
from obsforge.operators import validation

_DAY = date.fromisoformat(q.AS_OF)


def as_of():
    return F.lit(_DAY)


def _cleaner(name: str, column: str, build, sql: str):
    statement = f"SELECT record_index, {sql} AS cleaned FROM ({q.DIRTY}) d"

    @query(name, statement)
    def run(data: Data) -> DataFrame:
        return data.dirty().select("record_index", build(F.col(column)).alias("cleaned"))


_cleaner("clean_date", "date", clean.clean_date, q.clean_date("date"))
_cleaner("clean_state", "state", clean.clean_state_code, q.clean_state("state"))
_cleaner("clean_fips", "fips_code", clean.clean_fips_code, q.clean_fips("fips_code"))
_cleaner("clean_county", "county", clean.clean_county, q.clean_county("county"))


@query("clean_string", f"SELECT doc_id, {q.clean_string('text')} AS cleaned FROM documents")
def clean_string(data: Data) -> DataFrame:
    return data.documents.select("doc_id", clean.clean_string(F.col("text")).alias("cleaned"))


@query(
    "strip_special",
    f"SELECT doc_id, {q.strip_special('text')} AS plain, {q.strip_special('text', '-_].')} AS kept FROM documents",
)
def strip_special(data: Data) -> DataFrame:
    text = F.col("text")
    return data.documents.select(
        "doc_id",
        clean.strip_special(text).alias("plain"),
        clean.strip_special(text, "-_].").alias("kept"),
    )


@query(
    "clean_numeric",
    f"SELECT record_index, {q.number_text(q.clean_numeric('value'))} AS cleaned FROM ({q.NUMBERS}) n",
)
def clean_numeric(data: Data) -> DataFrame:
    number = clean.clean_numeric(F.col("value"))
    return data.numbers().select("record_index", float_text(number).alias("cleaned"))


@query("clean_boolean", f"SELECT record_index, {q.clean_boolean('flag')} AS cleaned FROM ({q.FLAGS}) f")
def clean_boolean(data: Data) -> DataFrame:
    return data.flags().select("record_index", clean.clean_boolean(F.col("flag")).alias("cleaned"))


def _rule(name: str, column: str, check, sql: str, source: str = "dirty"):
    body = {"dirty": q.DIRTY, "numbers": q.NUMBERS}[source]

    @query(name, f"SELECT record_index, {sql} AS message FROM ({body}) d")
    def run(data: Data) -> DataFrame:
        rows = getattr(data, source)()
        failure = (check() if callable(check) and check.__name__ == "made" else check)
        return rows.select("record_index", failure(text_value(F.col(column))).alias("message"))


def made(factory):
    """Delay a check that needs a session to be built."""

    def made():
        return factory()

    return made


_rule(
    "rule_not_empty", "state", rules.not_empty,
    f"CASE WHEN state IS NULL OR {q.strip('state')} = '' THEN 'Value cannot be empty' END",
)
_rule(
    "rule_not_null", "county", rules.not_null,
    "CASE WHEN county IS NULL THEN 'Value cannot be null' END",
)
_rule("rule_numeric", "value", rules.numeric, q.rule_numeric("value"), "numbers")
_rule(
    "rule_positive", "value", rules.positive,
    q.rule_at_least_zero("value", " must be positive"), "numbers",
)
_rule(
    "rule_non_negative", "value", rules.non_negative,
    q.rule_at_least_zero("value", " cannot be negative"), "numbers",
)
_rule("rule_date_format", "date", rules.date_format(), q.rule_date_format("date"))
_rule(
    "rule_not_future", "date", made(lambda: rules.not_future(as_of())),
    q.rule_not_future("date"),
)
_rule(
    "rule_in_list", "age_group", rules.in_list(["18-24", "25-34"]),
    "CASE WHEN age_group IS NULL OR age_group NOT IN ('18-24', '25-34') THEN 'Value ''' || "
    "coalesce(age_group, 'None') || ''' not in allowed values: [''18-24'', ''25-34'']' END",
)
_rule(
    "rule_regex", "fips_code", rules.matches("[0-9]{2}"),
    "CASE WHEN fips_code IS NULL THEN 'Value must be string for regex validation' "
    "WHEN NOT regexp_matches(fips_code, '^[0-9]{2}') THEN "
    "'Value ''' || fips_code || ''' does not match pattern [0-9]{2}' END",
)
_rule("rule_state_code", "state", rules.state_code, q.rule_state("state"))
_rule("rule_fips", "fips_code", rules.fips_code, q.rule_fips("fips_code"))


@query(
    "rule_required",
    "SELECT record_index, CASE WHEN state IS NULL OR state = '' THEN 'state is required but missing' "
    f"ELSE ({q.rule_state('state')}) END AS required, "
    f"({q._unless_missing('state', q.rule_state('state'))}) AS optional FROM ({q.DIRTY}) d",
)
def rule_required(data: Data) -> DataFrame:
    state = text_value(F.col("state"))
    required = rules.Rule("state", rules.state_code, required=True)
    optional = rules.Rule("state", rules.state_code)
    return data.dirty().select(
        "record_index",
        required.failure(state).alias("required"),
        optional.failure(state).alias("optional"),
    )


# cases, deaths and population as further dirty columns
_COUNTS = (
    f"SELECT *, value AS cases, CASE WHEN record_index % 3 = 0 THEN '-1' WHEN record_index % 3 = 1 THEN 'many' ELSE age_group END AS deaths, "
    f"CAST(5 - record_index % 7 AS STRING) AS population FROM ({q.DIRTY}) d"
)
_AT_LEAST_ZERO = lambda x: q.rule_at_least_zero(x, " cannot be negative")


def _counted(data: Data) -> DataFrame:
    k = F.col("record_index")
    return data.dirty().withColumns(
        {
            "cases": F.col("value"),
            "deaths": F.when(k % 3 == 0, "-1").when(k % 3 == 1, "many").otherwise(F.col("age_group")),
            "population": (5 - k % 7).cast("string"),
        }
    )


def _shown(validated: DataFrame) -> DataFrame:
    return validated.select(
        "record_index",
        "status",
        F.array_join("errors", " | ").alias("errors"),
        F.array_join("warnings", " | ").alias("warnings"),
    )


_SHOWN = (
    "SELECT record_index, status, array_to_string(errors, ' | ') AS errors, "
    "array_to_string(warnings, ' | ') AS warnings FROM"
)


def _preset(name: str, preset, extra):
    checks = (*q.BASIC, *((f, _AT_LEAST_ZERO, False) for f in extra))

    @query(name, f"{_SHOWN} ({q.validated(_COUNTS, checks)}) v")
    def run(data: Data) -> DataFrame:
        return _shown(validation.validate(_counted(data), preset(as_of()), keep=("record_index",)))


_preset("preset_basic", rules.basic_rules, ())
_preset("preset_covid", rules.covid_rules, ("cases", "deaths"))
_preset("preset_mortality", rules.mortality_rules, ("deaths", "population"))


def validated(data: Data) -> DataFrame:
    return validation.validate(data.dirty(), rules.basic_rules(as_of()), keep=("record_index",))


_VALIDATED = q.validated(q.DIRTY)
_LAST = {"state": 0, "date": 2, "value": 4, "fips_code": 5}


@query(
    "validate_rows",
    "SELECT record_index, status, array_to_string(errors, ' | ') AS errors, "
    + ", ".join(f"_m{i} AS {f}_error, (_m{i} IS NULL) AS {f}_ok" for f, i in _LAST.items())
    + f" FROM ({_VALIDATED}) v",
)
def validate_rows(data: Data) -> DataFrame:
    results = F.col("field_results")
    return validated(data).select(
        "record_index",
        "status",
        F.array_join("errors", " | ").alias("errors"),
        *(results[f]["error"].alias(f"{f}_error") for f in _LAST),
        *(results[f]["is_valid"].alias(f"{f}_ok") for f in _LAST),
    )


@query(
    "validate_batch_summary",
    "SELECT count(*) AS total_records, count(*) FILTER (status = 'valid') AS valid_records, "
    "count(*) FILTER (status = 'invalid') AS invalid_records, "
    f"count(*) FILTER (status = 'warning') AS records_with_warnings FROM ({_VALIDATED}) v",
)
def validate_batch_summary(data: Data) -> DataFrame:
    return validation.validation_summary(validated(data))


_MESSAGES = (
    "SELECT kind, message, count(*) AS n FROM ("
    f"SELECT 'error' AS kind, unnest(errors) AS message FROM ({_VALIDATED}) v WHERE status = 'invalid' "
    f"UNION ALL SELECT 'warning', unnest(warnings) FROM ({_VALIDATED}) v WHERE status = 'warning') m "
    "GROUP BY kind, message"
)


@query("summary_messages", _MESSAGES)
def summary_messages(data: Data) -> DataFrame:
    return validation.distinct_messages(validated(data))


@query(
    "top_errors",
    f"SELECT message, n FROM ({_MESSAGES}) t WHERE kind = 'error' ORDER BY n DESC, message LIMIT 10",
)
def top_errors(data: Data) -> DataFrame:
    return validation.top_messages(validated(data))


@query(
    "validate_stop_first",
    f"SELECT record_index, status FROM ({_VALIDATED}) v WHERE record_index <= "
    f"coalesce((SELECT min(record_index) FROM ({_VALIDATED}) w WHERE status = 'invalid'), 9223372036854775807)",
)
def validate_stop_first(data: Data) -> DataFrame:
    cut = validation.until_first_invalid(validated(data), "record_index")
    return cut.select("record_index", "status")


@query(
    "valid_records",
    "SELECT record_index, state, county, fips_code, date, value, age_group, gender, race, year "
    f"FROM ({_VALIDATED}) v WHERE status <> 'invalid'",
)
def valid_records(data: Data) -> DataFrame:
    return validation.valid_records(validated(data), keep=("record_index",))


@query(
    "invalid_records",
    "SELECT record_index, state, fips_code, date, value, array_to_string(errors, ' | ') AS errors "
    f"FROM ({_VALIDATED}) v WHERE status = 'invalid'",
)
def invalid_records(data: Data) -> DataFrame:
    bad = validation.invalid_records(validated(data))
    return bad.select(
        "record_index", "state", "fips_code", "date", "value",
        F.array_join("errors", " | ").alias("errors"),
    )


@query(
    "schema_check",
    f"SELECT record_index, {q.parse_date('date')} AS date, {q.number_text(q.parse_float('value'))} AS value, "
    f"CASE WHEN value IS NOT NULL AND ({q.parse_float('value')}) IS NULL THEN 'value: not a number' "
    f"WHEN ({q.parse_float('value')}) < 0 THEN 'value: Value cannot be negative' "
    f"WHEN date IS NOT NULL AND ({q.parse_date('date')}) IS NULL THEN 'date: not a date' "
    f"WHEN ({q.parse_date('date')}) > DATE '{q.AS_OF}' THEN 'date: Date cannot be in the future' END AS schema_error "
    f"FROM ({q.DIRTY}) d",
)
def schema_check(data: Data) -> DataFrame:
    checked = validation.check_schema(data.dirty(), as_of(), keep=("record_index",))
    return checked.select(
        "record_index", "date", float_text(F.col("value")).alias("value"), "schema_error"
    )


@query(
    "rule_in_table",
    f"SELECT record_index, coalesce(age_group IN (SELECT DISTINCT age_group FROM ({q.DIRTY}) e "
    f"WHERE gender = 'Male' AND age_group IS NOT NULL), false) AS allowed FROM ({q.DIRTY}) d",
)
def rule_in_table(data: Data) -> DataFrame:
    allowed = data.dirty().where(F.col("gender") == "Male").select("age_group")
    flagged = validation.flag_not_in_table(
        data.dirty().select("record_index", F.col("age_group").alias("given")), "given", allowed
    )
    return flagged.select("record_index", "allowed")


# A check of a user that raises for what it cannot read, and one of single values that tells why.
_PRICE = r"regexp_matches(value, '^\d+\.\d\d$')"


def _large(values):
    def large(value: str) -> bool:
        if not value.replace(".", "", 1).isdigit():
            raise ValueError(f"cannot read {value}")
        return float(value) >= 100000

    return values.map(large)


def _place(value: str) -> tuple[bool, str | None]:
    return len(value) < 3 or int(value) > 6000, f"{value} is too small"


@query(
    "rule_user_raises",
    "SELECT record_index, CASE WHEN value IS NULL OR value = '' THEN NULL "
    f"WHEN NOT {_PRICE} THEN 'Validation error: cannot read ' || value WHEN value::DOUBLE < 100000 THEN 'small' END AS amount, "
    "CASE WHEN fips_code IS NULL OR length(fips_code) < 3 THEN NULL WHEN TRY_CAST(fips_code AS INT) IS NULL "
    "THEN 'Validation error: invalid literal for int() with base 10: ''' || fips_code || '''' "
    f"WHEN fips_code::INT <= 6000 THEN fips_code || ' is too small' END AS place FROM ({q.DIRTY}) d",
)
def rule_user_raises(data: Data) -> DataFrame:
    checks = [rules.Rule("value", user_check(_large), message="small"), rules.Rule("fips_code", user_check(_place, each=True))]
    told = F.col("field_results")
    checked = validation.validate(data.dirty(), checks, keep=("record_index",))
    return checked.select("record_index", told["value"]["error"].alias("amount"), told["fips_code"]["error"].alias("place"))

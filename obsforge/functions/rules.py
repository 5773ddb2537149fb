"""Field rules: each check gives NULL for a passing value, else a message."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsforge.functions.dates import ISO, parse_date
from obsforge.functions.pyvalue import INTEGER_TEXT, FieldValue, float_text

Check = Callable[[FieldValue], Column]

# Codes of the 50 states and the federal district.
STATE_CODES = (
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY", "DC",
)


# The texts of all messages below are those that users of the rules expect.
def _message(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def not_empty(v: FieldValue) -> Column:
    blank = v.none | (v.is_text & (v.stripped == ""))
    return F.when(blank, F.lit("Value cannot be empty"))


def not_null(v: FieldValue) -> Column:
    return F.when(v.none, F.lit("Value cannot be null"))


def _not_numeric(v: FieldValue) -> Column:
    return _message("Value '", v.shown, "' is not numeric")


def numeric(v: FieldValue) -> Column:
    return F.when(v.as_float().isNull(), _not_numeric(v))


def _at_least_zero(v: FieldValue, complaint: str) -> Column:
    number = v.as_float()
    return F.when(number.isNull(), _not_numeric(v)).when(
        number < 0, _message("Value ", float_text(number), complaint)
    )


def positive(v: FieldValue) -> Column:
    """Despite the name zero passes: only negative numbers fail."""
    return _at_least_zero(v, " must be positive")


def non_negative(v: FieldValue) -> Column:
    return _at_least_zero(v, " cannot be negative")


def date_format(expected: str = ISO) -> Check:
    def check(v: FieldValue) -> Column:
        return (
            F.when(v.is_date, F.lit(None).cast("string"))
            .when(~v.is_text, F.lit("Date value must be string or date object"))
            .when(
                parse_date(v.text, expected).isNull(),
                _message("Date '", v.text, f"' does not match format {expected}"),
            )
        )

    return check


def not_future(as_of: Column | None = None) -> Check:
    """Dates after ``as_of`` (today unless given) fail."""

    def check(v: FieldValue) -> Column:
        limit = F.current_date() if as_of is None else as_of
        day = F.when(v.is_text, parse_date(v.text)).when(v.is_date, v.date)
        return (
            F.when(
                v.is_timestamp,
                F.lit("Validation error: can't compare datetime.datetime to datetime.date"),
            )
            .when(v.is_text & day.isNull(), _message("Invalid date format: ", v.text))
            .when(
                ~v.is_text & ~v.is_date,
                _message("Value must be a date, got <class '", v.type_name, "'>"),
            )
            .when(day > limit, _message("Date ", day.cast("string"), " cannot be in the future"))
        )

    return check


def _member(v: FieldValue, text: Column, allowed: Sequence) -> Column:
    texts = [a for a in allowed if isinstance(a, str)]
    numbers = [float(a) for a in allowed if isinstance(a, (bool, int, float))]
    found = F.lit(None in allowed) & v.none
    if texts:
        found = found | (v.is_text & text.isin(*texts))
    if numbers:
        found = found | (v.is_number & v.number.isin(*numbers))
    return F.coalesce(found, F.lit(False))


def in_list(allowed: Sequence) -> Check:
    """Exact membership; the message prints the whole list."""
    listing = str(list(allowed))

    def check(v: FieldValue) -> Column:
        return F.when(
            ~_member(v, v.text, allowed),
            _message("Value '", v.shown, f"' not in allowed values: {listing}"),
        )

    return check


def matches(pattern: str) -> Check:
    """Texts must match ``pattern`` from their start; the end is left open."""

    def check(v: FieldValue) -> Column:
        return F.when(~v.is_text, F.lit("Value must be string for regex validation")).when(
            ~v.text.rlike(rf"\A(?:{pattern})"),
            _message("Value '", v.text, f"' does not match pattern {pattern}"),
        )

    return check


def state_code(v: FieldValue) -> Column:
    """One of the 51 codes, in any case but without blanks around it."""
    upper = F.upper(v.text)
    shown = F.when(v.is_text, upper).otherwise(v.shown)
    return F.when(
        ~_member(v, upper, STATE_CODES),
        _message("Value '", shown, f"' not in allowed values: {list(STATE_CODES)}"),
    )


def fips_code(v: FieldValue) -> Column:
    """An integer text whose raw length, sign and blanks included, is 2 or 5."""
    size = F.length(v.text)
    return (
        F.when(~v.is_text, F.lit("FIPS code must be a string"))
        .when(
            ~v.stripped.rlike(INTEGER_TEXT),
            _message("FIPS code must be numeric, got '", v.text, "'"),
        )
        .when(
            ~size.isin(2, 5),
            _message(
                "FIPS code must be 2 (state) or 5 (county) digits, got ", size.cast("string")
            ),
        )
    )


def unless_falsy(check: Check) -> Check:
    """Let empty texts, zero and false pass unchecked."""
    return lambda v: F.when(~v.falsy, check(v))


def column_check(holds: Callable[[Column], Column], message: str) -> Check:
    """Check from a plain Column predicate, which may be a pandas UDF call.

    Rows where the predicate is false or NULL fail with ``message``.
    """
    return lambda v: F.when(~F.coalesce(holds(v.raw), F.lit(False)), F.lit(message))


@dataclass(frozen=True)
class Rule:
    """A check bound to a field, with its severity and what to do if it is absent."""

    field: str
    check: Check
    message: str = "Invalid value"
    required: bool = False
    warning_only: bool = False

    def failure(self, value: FieldValue) -> Column:
        """Message of the failed rule, NULL when the value passes."""
        found = self.check(value)
        # an empty message falls back to the rule's own
        complaint = F.when(found == "", F.lit(self.message)).otherwise(found)
        if self.required:
            absent = F.lit(f"{self.field} is required but missing")
        else:
            absent = F.lit(None).cast("string")
        return F.when(value.missing, absent).otherwise(complaint)


def basic_rules(as_of: Column | None = None) -> list[Rule]:
    """State, date, value and place code of common health tables."""
    return [
        Rule("state", unless_falsy(state_code)),
        Rule("date", unless_falsy(date_format())),
        Rule("date", unless_falsy(not_future(as_of)), warning_only=True),
        Rule("value", numeric),
        Rule("value", non_negative),
        Rule("fips_code", unless_falsy(fips_code)),
    ]


def covid_rules(as_of: Column | None = None) -> list[Rule]:
    return [*basic_rules(as_of), Rule("cases", non_negative), Rule("deaths", non_negative)]


def mortality_rules(as_of: Column | None = None) -> list[Rule]:
    return [*basic_rules(as_of), Rule("deaths", non_negative), Rule("population", non_negative)]

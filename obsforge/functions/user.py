"""Checks and transforms that users write in Python, whose failures cost one value and not the job.

A function gets the values of a whole batch as a Series of plain objects: text, int, float, bool, date, datetime, list or
dict, as the record has them. If it raises, the batch is halved until the values that make it raise stand alone; the rest
is taken from the calls that succeed. With ``each`` it gets one value at a time. A result that does not fit the declared
type counts as raised, too. Functions must treat values one by one: what else is in a batch is left to chance.

Nothing there (no field, null, and for checks an empty text) is not passed on: a check has nothing to say about it, and a
transform leaves it NULL.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from datetime import date, datetime
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from obsforge.functions.pyvalue import FieldValue

Result = tuple[Any, str | None]

_READ: dict[str, Callable[[str], Any]] = {
    "int": int,
    "float": float,
    "bool": lambda text: text == "True",
    "date": date.fromisoformat,
    "datetime": datetime.fromisoformat,
    "list": json.loads,
    "dict": json.loads,
}


def _day(value: Any) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    raise TypeError(f"{value!r} is not a date")


_FIT: dict[str, Callable[[Any], Any]] = {"string": str, "double": float, "bigint": int, "boolean": bool, "date": _day}


def attempt(function: Callable, values: list, each: bool = False) -> list[Result]:
    """The result of every value with None, or None with the text of what was raised for it."""
    if each and len(values) != 1:
        return [r for value in values for r in attempt(function, [value], each)]
    try:
        found = [function(values[0])] if each else list(function(pd.Series(values, dtype=object)))
        if len(found) != len(values):
            raise ValueError(f"{len(found)} results for {len(values)} values")
        return [(r, None) for r in found]
    except Exception as error:  # whatever a user's function raises belongs to its value
        if len(values) == 1:
            return [(None, str(error))]
    half = len(values) // 2
    return attempt(function, values[:half]) + attempt(function, values[half:])


def _is_null(value: Any) -> bool:
    return value is None or (pd.api.types.is_scalar(value) and bool(pd.isna(value)))


def _apply(function: Callable, each: bool, kinds: Iterable[str | None], texts: Iterable[str | None]) -> list[Result | None]:
    """Results by position; None where there is no value."""
    found: list[Result | None] = []
    values, places = [], []
    for place, (kind, text) in enumerate(zip(kinds, texts, strict=True)):
        found.append(None)
        if kind is None:
            continue
        try:
            values.append(_READ.get(kind, str)(text))
            places.append(place)
        except ValueError as error:
            found[place] = (None, str(error))
    if values:
        for place, result in zip(places, attempt(function, values, each), strict=True):
            found[place] = result
    return found


def _message(result: Result | None) -> str | None:
    if result is None:
        return None
    outcome, error = result
    if error is not None:
        return f"Validation error: {error}"
    passed, message = outcome if isinstance(outcome, tuple) else (outcome, None)
    return None if not _is_null(passed) and bool(passed) else message or ""


def _kind(v: FieldValue, absent: Column) -> Column:
    return F.when(~absent, v.type_name)


def user_check(function: Callable, each: bool = False) -> Callable[[FieldValue], Column]:
    """Check from a Python function that says true for a value that passes, or a pair of that and a message.

    Without a message the rule's own is told. What the function raises for a value is the message of that value.
    """

    @F.pandas_udf("string")
    def told(kinds: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([_message(r) for r in _apply(function, each, kinds, texts)], dtype=object)

    return lambda v: told(_kind(v, v.missing), v.scalar)


def user_transform(function: Callable, returns: str = "string", each: bool = False) -> Callable[[FieldValue], Column]:
    """Transform from a Python function; a value for which it raises stays as it is, as far as its type allows."""
    fit = _FIT[returns]

    @F.pandas_udf(f"value {returns}, failed boolean")
    def changed(kinds: pd.Series, texts: pd.Series) -> pd.DataFrame:
        values, failed = [], []
        for result in _apply(function, each, kinds, texts):
            value, error = result or (None, None)
            try:
                values.append(None if _is_null(value) else fit(value))
            except Exception as misfit:  # a result of another type is a failure of its value
                values.append(None)
                error = str(misfit)
            failed.append(error is not None)
        return pd.DataFrame({"value": pd.Series(values, dtype=object), "failed": failed})

    def transform(v: FieldValue) -> Column:
        out = changed(_kind(v, v.none), v.scalar)
        return F.when(out["failed"], v.as_text().try_cast(returns)).otherwise(out["value"])

    return transform

"""Cleaning functions: loosely typed field value in, clean Column out.

All of them are total: what cannot be read becomes NULL, nothing raises.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from obsforge.functions.dates import FALLBACK_FORMATS, ISO, parse_date
from obsforge.functions.pyvalue import (
    SPACE_CLASS,
    FieldValue,
    blank_to_null,
    parse_float,
    strip,
    text_value,
)

# Texts read as true and as false.
TRUE_TEXTS = ("true", "t", "yes", "y", "1", "on")
FALSE_TEXTS = ("false", "f", "no", "n", "0", "off", "")

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def _value(value: FieldValue | Column) -> FieldValue:
    return value if isinstance(value, FieldValue) else text_value(value)


def clean_string(value: FieldValue | Column) -> Column:
    """Trimmed text, numbers as text; empty and other types become NULL."""
    return blank_to_null(_value(value).stripped)


def clean_numeric(value: FieldValue | Column) -> Column:
    """Double, after dropping thousands commas and dollar signs."""
    v = _value(value)
    plain = parse_float(F.translate(v.scalar, ",$", ""))
    return F.when(v.is_number, v.number).when(v.is_text, plain)


def clean_date(value: FieldValue | Column, date_format: str = ISO) -> Column:
    """Date in ``date_format`` or one of the fallback formats."""
    v = _value(value)
    readings = [parse_date(v.stripped, f) for f in (date_format, *FALLBACK_FORMATS)]
    return F.when(v.is_date, v.date).when(v.is_text, F.coalesce(*readings))


def clean_state_code(value: FieldValue | Column, strict: bool = False) -> Column:
    """Two-letter upper-case code.

    Longer texts give their first two letters (``TEXAS`` -> ``TE``); with
    ``strict`` they give NULL.
    """
    upper = F.upper(_value(value).stripped)
    code = r"\p{L}{2}\z" if strict else r"\p{L}{2}\z|[A-Z]{2}"
    return blank_to_null(F.regexp_extract(upper, rf"\A({code})", 1))


def clean_fips_code(value: FieldValue | Column) -> Column:
    """Digits only, padded to 2 (state) or 5 (county); more than 5 gives NULL."""
    digits = F.regexp_replace(_value(value).stripped, "[^0-9]", "")
    size = F.length(digits)
    state = F.when(size.between(1, 2), F.lpad(digits, 2, "0"))
    return state.when(size.between(3, 5), F.lpad(digits, 5, "0"))


def title_case(text: Column) -> Column:
    """Capitalise every run of letters, also after quotes and hyphens."""
    runs = F.regexp_extract_all(text, F.lit(f"([{_CASED}]+|[^{_CASED}]+)"), F.lit(1))
    return F.array_join(
        F.transform(
            runs,
            lambda run: F.concat(
                F.upper(F.substring(run, 1, 1)), F.lower(F.substr(run, F.lit(2)))
            ),
        ),
        "",
    )


def clean_county(value: FieldValue | Column) -> Column:
    """Title case, single blanks, without a trailing ``County``."""
    named = title_case(clean_string(value))
    spaced = F.regexp_replace(named, f"[{SPACE_CLASS}]+", " ")
    return strip(F.regexp_replace(spaced, r"(?i) +County\z", ""))


def clean_boolean(value: FieldValue | Column) -> Column:
    """True or false from flags, numbers and the usual words, else NULL."""
    v = _value(value)
    word = F.lower(v.stripped)
    return (
        F.when(v.is_number, v.number != 0)
        .when(v.is_text & word.isin(*TRUE_TEXTS), F.lit(True))
        .when(v.is_text & word.isin(*FALSE_TEXTS), F.lit(False))
    )


def strip_special(value: FieldValue | Column, keep: str = "") -> Column:
    """Keep ASCII letters, digits, whitespace and the characters in ``keep``."""
    kept = "".join(re.sub(r"([^A-Za-z0-9\s])", r"\\\1", ch) for ch in keep)
    left = F.regexp_replace(clean_string(value), f"[^a-zA-Z0-9{SPACE_CLASS}{kept}]", "")
    return strip(blank_to_null(left))

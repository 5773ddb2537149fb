"""Strict date parsing: day, month and year patterns without surprises."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO = "%Y-%m-%d"
# Formats tried after the caller's own, in this order.
FALLBACK_FORMATS = ("%m/%d/%Y", "%Y/%m/%d", "%d-%m-%Y")

# directive -> (what the text must look like, how Spark reads it)
_DIRECTIVES = {
    "%Y": (r"(?!0000)\d{4}", "yyyy"),
    "%m": (r"\d{1,2}", "M"),
    "%d": (r"( \d|\d{1,2})", "d"),
}


def _guard_and_pattern(date_format: str) -> tuple[str, str]:
    guard, pattern = [], []
    for piece in re.findall(r"%.|[^%]", date_format):
        if piece in _DIRECTIVES:
            look, read = _DIRECTIVES[piece]
        elif piece.startswith("%"):
            raise ValueError(f"unsupported date directive {piece!r} in {date_format!r}")
        else:
            look, read = re.escape(piece), f"'{piece}'" if piece.isalpha() else piece
        guard.append(look)
        pattern.append(read)
    return rf"\A{''.join(guard)}\z", "".join(pattern)


def parse_date(text: Column, date_format: str = ISO) -> Column:
    """Date that ``text`` writes in exactly ``date_format``, else NULL.

    Spark's parser alone is too lenient on digits and too strict on padding, so
    a pattern decides first and only texts of the right shape are parsed.
    """
    guard, pattern = _guard_and_pattern(date_format)
    compact = text if " " in date_format else F.replace(text, F.lit(" "), F.lit(""))
    return F.when(text.rlike(guard), F.try_to_date(compact, pattern))

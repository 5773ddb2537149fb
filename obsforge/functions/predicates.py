"""Row filters from plain Python values."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _condition(field: str, wanted: Any) -> Column | None:
    column = F.col(field)
    if isinstance(wanted, (str, bool, int, float)):
        return column == F.lit(wanted)
    if isinstance(wanted, list):
        # an empty list asks for membership in the empty text
        return column.isin(*wanted) if wanted else column == F.lit("")
    return None


def filter_condition(filters: Mapping[str, Any] | None) -> Column | None:
    """AND of one equality or membership test per field; None when there is none.

    Values of other types are ignored. Values are literals, never pasted text,
    so quotes need no escaping and simple tests reach the parquet scan.
    """
    tests = [_condition(field, wanted) for field, wanted in (filters or {}).items()]
    tests = [t for t in tests if t is not None]
    return reduce(Column.__and__, tests) if tests else None

"""Integrity constraints of the star schema as row checks and audits.

A reason column is NULL for a good row and else names the first constraint
broken, so bad rows can be filtered, counted and kept.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Longest texts the warehouse accepts.
INDICATOR_LENGTHS = {"code": 100, "name": 255, "unit": 50, "category": 100, "data_type": 50}
GEOGRAPHY_LENGTHS = {
    "country": 3, "state": 2, "state_name": 100, "county": 100, "fips_code": 10,
    "level": 20, "region": 50,
}
STRATIFIER_LENGTHS = {"dimension": 50, "value": 100}
OBSERVATION_LENGTHS = {"data_source": 255, "data_source_id": 100}
LOG_LENGTHS = {"run_id": 100, "data_source": 255, "status": 20}

# Closed sets.
LEVELS = ("nation", "state", "county", "metro")
DIMENSIONS = ("age_group", "gender", "race", "ethnicity", "education", "income", "other")
RUN_STATUSES = ("running", "completed", "failed", "partial")

# Column defaults of a newly written row.
INDICATOR_DEFAULTS = {"data_type": "numeric"}
GEOGRAPHY_DEFAULTS = {"country": "USA"}
LOG_DEFAULTS = {"records_processed": 0, "records_inserted": 0, "records_failed": 0}

INDICATOR_CODE = r"\A[A-Z0-9_]+\z"


def _first(reasons: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*(F.when(broken, F.lit(reason)) for broken, reason in reasons))


def _lengths(limits: Mapping[str, int], present: list[str] | None = None) -> list[tuple[Column, str]]:
    return [
        (F.length(name) > size, f"{name} longer than {size}")
        for name, size in limits.items()
        if present is None or name in present
    ]


def _nulls(*names: str) -> list[tuple[Column, str]]:
    return [(F.col(name).isNull(), f"{name} is null") for name in names]


def length_reason(limits: Mapping[str, int]) -> Column:
    """First text longer than its limit."""
    return _first(_lengths(limits))


def amount(value: Column) -> Column:
    """NUMERIC(15,4): rounded half up, NULL when unreadable or out of range."""
    return value.try_cast("decimal(15,4)")


_AMOUNTS = ("value", "value_lower_bound", "value_upper_bound")


def typed_measures() -> dict[str, Column]:
    """The numeric columns with their types in the fact table, unreadable numbers as NULL."""
    return {**{c: amount(F.col(c)) for c in _AMOUNTS}, "sample_size": F.col("sample_size").try_cast("int")}


def measure_reason(columns: list[str]) -> Column:
    """First constraint that the period, the measures and the texts of a canonical observation break."""
    typed = typed_measures()
    return _first(
        [
            *_nulls("period_start", "period_end", "value"),
            *((F.col(c).isNotNull() & t.isNull(), f"{c} is not a valid number") for c, t in typed.items()),
            (F.col("period_end") < F.col("period_start"), "period ends before it starts"),
            (typed["value"] < 0, "value is negative"),
            *_lengths(OBSERVATION_LENGTHS, columns),
        ]
    )


def key_reason() -> Column:
    """First key that is not resolved."""
    return _first(_nulls("indicator_id", "geography_id"))


def check_observation(df: DataFrame, reason: str = "reason") -> DataFrame:
    """Type the fact columns and name the first constraint each row breaks.

    Expects the resolved keys next to the canonical observation columns; the
    numeric columns come back typed, with unreadable numbers as NULL.
    """
    typed = typed_measures()
    return df.select(
        *(typed[c].alias(c) if c in typed else F.col(c) for c in df.columns),
        F.coalesce(key_reason(), measure_reason(df.columns)).alias(reason),
    )


def indicator_reason() -> Column:
    return _first(
        [
            *_nulls("code", "name"),
            (~F.col("code").rlike(INDICATOR_CODE), "code has characters other than A-Z, 0-9 and _"),
            *_lengths({k: INDICATOR_LENGTHS[k] for k in ("code", "name", "unit")}),
        ]
    )


def geography_reason(level: str = "level") -> Column:
    """Level in the closed set, nation exactly when there is no state, text lengths."""
    at = F.col(level)
    state = F.col("state")
    names = ("state", "state_name", "county", "fips_code")
    return _first(
        [
            (F.coalesce(~at.isin(*LEVELS), F.lit(True)), "unknown level"),
            ((at == "nation") & state.isNotNull(), "a nation has no state"),
            ((at != "nation") & state.isNull(), "state is null"),
            *_lengths({n: GEOGRAPHY_LENGTHS[n] for n in names}),
        ]
    )


def stratifier_reason() -> Column:
    return _first(
        [
            *_nulls("dimension", "value"),
            (~F.col("dimension").isin(*DIMENSIONS), "unknown dimension"),
            *_lengths(STRATIFIER_LENGTHS),
        ]
    )


def run_log_reason() -> Column:
    return _first(
        [
            *_nulls("run_id", "data_source", "status"),
            (~F.col("status").isin(*RUN_STATUSES), "unknown status"),
            *_lengths(LOG_LENGTHS),
        ]
    )


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row; a NULL key repeats nothing."""
    known = df
    for key in keys:
        known = known.where(F.col(key).isNotNull())
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(df: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str = "id") -> DataFrame:
    """Rows whose non-null foreign key has no parent."""
    parents = parent.select(F.col(parent_key).alias("_parent"))
    referring = df.where(F.col(foreign_key).isNotNull())
    return referring.join(parents, F.col(foreign_key) == F.col("_parent"), "left_anti")


def apply_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill NULLs of the named columns before writing."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})

"""Get-or-create for indicators and stratifiers, and the stratifier choice.

New members get ``base + first + 1`` as id, where ``first`` is the position of
the record that introduced them and ``base`` the highest id in use. That is
unique, rises in creation order like an identity column, leaves gaps like one
too, and needs no global sort. A caller who keeps account of the ids gives
``base``; else it is the highest in the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.operators.constraints import indicator_reason, stratifier_reason
from obsforge.schema import INDICATOR, STRATIFIER

STRATIFIER_FIELDS = ("age_group", "gender", "race")


def highest_id(table: DataFrame) -> Column:
    """Highest id of a table as a scalar; 0 for an empty table."""
    return table.agg(F.coalesce(F.max("id"), F.lit(0).cast("bigint")).alias("m")).select("m").scalar()


def new_id(table: DataFrame, first: Column, base: int | None = None) -> Column:
    highest = highest_id(table) if base is None else F.lit(base).cast("bigint")
    return highest + first + F.lit(1).cast("bigint")


def _given(requests: DataFrame, **kinds: str) -> DataFrame:
    """``requests`` with the optional columns it lacks, as NULL."""
    absent = {n: F.lit(None).cast(kind) for n, kind in kinds.items() if n not in requests.columns}
    return requests.withColumns(absent) if absent else requests


def new_indicators(
    requests: DataFrame, existing: DataFrame, order_by: str, at: Column, base: int | None = None
) -> DataFrame:
    """Indicator rows to add for codes not yet known.

    ``requests`` holds code, name, unit and description per record, and category
    and metadata (a JSON text) if it likes. The first record of a code supplies
    the rest; rows breaking a constraint add nothing.
    Aggregated before the anti join, so a code held by most rows stays cheap.
    """
    known = _given(requests, category="string", metadata="string")
    wanted = known.where(F.col("code").isNotNull() & (F.col("code") != ""))
    first = wanted.groupBy("code").agg(
        F.min_by(F.struct("name", "unit", "description", "category", "metadata"), F.col(order_by)).alias("_row"),
        F.min(order_by).alias("_first"),
    )
    fresh = first.select("code", "_first", "_row.*").withColumn(
        "name", F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("code"))
    )
    missing = fresh.join(existing.select("code"), "code", "left_anti")
    return missing.where(indicator_reason().isNull()).select(
        new_id(existing, F.col("_first"), base).alias("id"),
        "code",
        "name",
        "description",
        "unit",
        "category",
        F.lit("numeric").alias("data_type"),
        "metadata",
        at.alias("created_at"),
        at.alias("updated_at"),
    ).to(INDICATOR)


def pick_stratifier(age_group: Column, gender: Column, race: Column) -> tuple[Column, Column]:
    """Dimension and value of the first of the three that is not empty."""
    given = dict(zip(STRATIFIER_FIELDS, (age_group, gender, race)))
    dimension = F.coalesce(*(F.when(v != "", F.lit(n)) for n, v in given.items()))
    value = F.coalesce(*(F.when(v != "", v) for v in given.values()))
    return dimension, value


def new_stratifiers(
    requests: DataFrame, existing: DataFrame, order_by: str, at: Column, base: int | None = None
) -> DataFrame:
    """Stratifier rows to add; ``requests`` holds dimension and value per record.

    It may hold display_order, parent_id and metadata (a JSON text) as well; the
    first record of a member supplies them.
    """
    known = _given(requests, display_order="int", parent_id="bigint", metadata="string")
    wanted = known.where((F.col("dimension") != "") & (F.col("value") != ""))
    rest = F.min_by(F.struct("display_order", "parent_id", "metadata"), F.col(order_by)).alias("_row")
    first = wanted.groupBy("dimension", "value").agg(F.min(order_by).alias("_first"), rest)
    missing = first.join(existing.select("dimension", "value"), ["dimension", "value"], "left_anti")
    return missing.where(stratifier_reason().isNull()).select(
        new_id(existing, F.col("_first"), base).alias("id"),
        "dimension",
        "value",
        "_row.display_order",
        "_row.parent_id",
        "_row.metadata",
        at.alias("created_at"),
    ).to(STRATIFIER)

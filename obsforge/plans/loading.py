"""Loading a batch of canonical observations into the warehouse."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.operators.constraints import INDICATOR_CODE
from obsforge.operators.dimensions import new_indicators, new_stratifiers
from obsforge.operators.facts import (
    assign_indicator,
    assign_stratifier,
    check_keys,
    key_rows,
    last_and_first,
    measure_rows,
    place_keys,
    upsert_observations,
    with_measures,
)
from obsforge.operators.geography import geography_lookup, new_geographies, requests_of
from obsforge.operators.runlog import complete_runs, run_outcome, start_runs
from obsforge.schema import struct
from obsforge.session import released, staged
from obsforge.sources.warehouse import Warehouse

#: Characters of an error that the log keeps.
LONGEST_MESSAGE = 4000

_START = struct("run_id STRING, data_source STRING, started_at TIMESTAMP, position BIGINT")
_OUTCOME = struct(
    "status STRING, records_processed BIGINT, records_inserted BIGINT, records_failed BIGINT, "
    "error_message STRING, metadata STRING"
)


def start_run(warehouse: Warehouse, run_id: str, data_source: str, at: datetime, ids: int = 1) -> int:
    """Log a run as running and give it ``ids`` ids; the highest id given away before."""
    base = warehouse.highest_id()
    start = warehouse.spark.createDataFrame([(run_id, data_source, at, 0)], _START)
    known = warehouse.table("ingestion_log").where(F.col("run_id") == run_id)
    warehouse.append_log(start_runs(known, start, base), base + ids)
    return base


def complete_run(warehouse: Warehouse, run_id: str, outcome: DataFrame, at: datetime) -> None:
    done = outcome.withColumns({"run_id": F.lit(run_id), "completed_at": F.lit(at)})
    known = warehouse.table("ingestion_log").where(F.col("run_id") == run_id)
    warehouse.append_log(complete_runs(known, done), warehouse.highest_id())


def fail_run(warehouse: Warehouse, run_id: str, message: str, at: datetime) -> None:
    """Log the end of a run as failed."""
    failed = warehouse.spark.createDataFrame([("failed", 0, 0, 0, message[:LONGEST_MESSAGE], None)], _OUTCOME)
    complete_run(warehouse, run_id, failed, at)


def load_batch(
    warehouse: Warehouse,
    observations: DataFrame,
    order_by: str,
    data_source: str,
    run_id: str,
    at: datetime,
    indicator_code: str | None = None,
    indicator_name: str | None = None,
    indicator_from: str = "argument",
) -> DataFrame:
    """Resolve, check and upsert a batch; returns its one-row outcome.

    ``order_by`` names a unique, non-negative position of each observation:
    later rows overwrite earlier ones. An observation without a geography level
    is of a state. Members created for rows that fail later stay. An indicator
    code the warehouse cannot hold fails the whole run; an error ends it as
    ``failed`` in the log before it is raised. What the load stages goes when it ends. Observations are read several
    times, so what is costly to make should be staged before.
    """
    spark = warehouse.spark
    level = F.coalesce(F.nullif(F.col("geography_level"), F.lit("")), F.lit("state"))
    batch = observations.withColumn("geography_level", level)
    base = None
    try:
        last = batch.agg(F.max(order_by)).first()[0]
        if last is None:
            return spark.createDataFrame([("completed", 0, 0, 0, None, None)], _OUTCOME)
        # an id for each position, in whatever table
        base = start_run(warehouse, run_id, data_source, at, last + 1)
        with released(spark):
            return _load(warehouse, batch, order_by, run_id, at, base, indicator_code, indicator_name, indicator_from)
    except Exception as error:
        if base is None:
            start_run(warehouse, run_id, data_source, at)
        fail_run(warehouse, run_id, str(error), at)
        raise


def _load(
    warehouse: Warehouse,
    batch: DataFrame,
    order_by: str,
    run_id: str,
    at: datetime,
    base: int,
    indicator_code: str | None,
    indicator_name: str | None,
    indicator_from: str,
) -> DataFrame:
    """Keys go through place, stratifier and check as narrow rows; the measures join what is left of them once."""
    spark = warehouse.spark
    now = F.lit(at)
    unusable = indicator_code and (
        len(indicator_code) > 100 or not re.search(INDICATOR_CODE.replace(r"\z", r"\Z"), indicator_code)
    )
    if unusable:
        message = f"indicator code {indicator_code!r} is not allowed"
        outcome = spark.createDataFrame([("failed", 0, 0, 0, message, None)], _OUTCOME)
        complete_run(warehouse, run_id, outcome, at)
        return outcome

    if indicator_code or indicator_from == "row":
        code = F.lit(indicator_code) if indicator_from == "argument" else F.col("indicator_code")
        name = F.lit(indicator_name) if indicator_from == "argument" else F.col("indicator_name")
        wanted = batch.select(
            F.col(order_by),
            code.alias("code"),
            name.alias("name"),
            F.col("indicator_unit").alias("unit"),
            F.col("indicator_description").alias("description"),
        )
        warehouse.append(
            "indicator", new_indicators(wanted, warehouse.table("indicator"), order_by, now, base)
        )

    geographies = warehouse.table("geography")
    created = staged(new_geographies(requests_of(batch, order_by), geographies, now, base), "new-geographies")
    # staged, so that Spark knows its size and can split hot keys of the join
    lookup = staged(geography_lookup(geographies, created), "geography-lookup")
    placed = staged(place_keys(key_rows(batch, order_by), order_by, lookup), "placed-keys")
    warehouse.append("geography", created)

    # only rows that have a place get as far as their stratifier
    strata = placed.where(F.col("geography_id").isNotNull()).select(
        F.col(order_by), "dimension", F.col("stratum").alias("value")
    )
    warehouse.append(
        "stratifier", new_stratifiers(strata, warehouse.table("stratifier"), order_by, now, base)
    )

    stratified = assign_stratifier(placed, order_by, warehouse.table("stratifier"))
    keyed = assign_indicator(
        stratified, order_by, warehouse.table("indicator"), indicator_code, indicator_from
    )
    checked = staged(check_keys(keyed, order_by), "checked-keys")
    counted = run_outcome(checked, order_by).select(*_OUTCOME.names).first()
    outcome = spark.createDataFrame([tuple(counted)], _OUTCOME)

    chosen = staged(last_and_first(checked.where(F.col("reason").isNull()), order_by), "fact-keys")
    touched = warehouse.touched(chosen)
    if touched:
        rows = with_measures(chosen, measure_rows(batch, order_by), order_by)
        merged = upsert_observations(rows, warehouse.observations(p for p in touched if p.load), now, base)
        warehouse.publish_facts(merged, touched, at)
    complete_run(warehouse, run_id, outcome, at)
    return outcome

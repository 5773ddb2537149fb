"""Questions to the star schema.

Facts meet dimensions through inner equi-joins. No join is forced to be a
broadcast: Spark broadcasts a dimension while it measures it below its
threshold. Every limited result is ordered by a total key.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.sources.warehouse import Warehouse


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    total = counts[0]
    for other in counts[1:]:
        total = total.unionByName(other)
    return total


def _named(observation: DataFrame, indicator: DataFrame) -> DataFrame:
    codes = indicator.select(
        F.col("id").alias("indicator_id"),
        F.col("code").alias("indicator_code"),
        F.col("name").alias("indicator_name"),
    )
    return observation.join(codes, "indicator_id")


def _placed(observation: DataFrame, geography: DataFrame) -> DataFrame:
    places = geography.select(
        F.col("id").alias("geography_id"), "state", "state_name", "county", "level"
    )
    return observation.join(places, "geography_id")


def recent_observations(
    observation: DataFrame, indicator: DataFrame, geography: DataFrame, limit: int = 10
) -> DataFrame:
    """Latest ingested observations with names, newest first.

    Facts without both dimensions drop out in semi joins before the top-k, so
    only ``limit`` rows are ever joined to names.
    """
    linked = observation.join(
        indicator.select(F.col("id").alias("indicator_id")), "indicator_id", "left_semi"
    ).join(geography.select(F.col("id").alias("geography_id")), "geography_id", "left_semi")
    newest = (
        linked.select(
            "id", "indicator_id", "geography_id", "period_start", "value", "data_source", "ingested_at"
        )
        .orderBy(F.desc("ingested_at"), F.desc("id"))
        .limit(limit)
    )
    return (
        _placed(_named(newest, indicator), geography)
        .orderBy(F.desc("ingested_at"), F.desc("id"))
        .select(
            "id", "indicator_code", "indicator_name", "state", "county",
            "period_start", "value", "data_source",
        )
    )


def recent_of_warehouse(warehouse: Warehouse, limit: int = 10) -> DataFrame:
    """``recent_observations`` of a warehouse, from the partitions that its newest runs wrote.

    Facts keep the moment they came in, and the log says when runs began. So the
    scan asks for what came in since the newest run, the newest two, four and so
    on, until there are enough facts with a place and an indicator.
    """
    spark = warehouse.spark
    indicator, geography = warehouse.table("indicator"), warehouse.table("geography")
    begun = warehouse.table("ingestion_log").select("started_at").distinct().orderBy(F.desc("started_at"))
    runs = 1
    while True:
        moments = [r.started_at for r in begun.limit(runs).collect()]
        whole = len(moments) < runs
        facts = warehouse.observations() if whole else warehouse.recent_observations(moments[-1])
        found = recent_observations(facts, indicator, geography, limit)
        rows = found.collect()  # limit rows at most
        if whole or len(rows) == limit:
            return spark.createDataFrame(rows, found.schema)
        runs *= 2


def list_indicators(indicator: DataFrame) -> DataFrame:
    return indicator.select("code", "name", "unit", "category").orderBy("code")


def geographies_by_level(geography: DataFrame) -> DataFrame:
    return geography.groupBy("level").agg(F.count(F.lit(1)).alias("n")).orderBy("level")


def recent_runs(log: DataFrame, limit: int = 10) -> DataFrame:
    """Latest runs, newest first."""
    return log.orderBy(F.desc("started_at"), F.desc("id")).limit(limit).select(
        "run_id", "data_source", "status", "records_processed", "records_inserted",
        "records_failed", "started_at", "completed_at",
    )


def _of_indicator(observation: DataFrame, indicator: DataFrame, code: str) -> DataFrame:
    """Facts of one indicator, by its id as a scalar.

    On a fact table with partition columns the id prunes the scan.
    """
    chosen = indicator.where(F.col("code") == code).agg(F.max("id").alias("id")).select("id").scalar()
    facts = observation.where(F.col("indicator_id") == chosen)
    return facts.where(F.col("part_indicator") == chosen) if "part_indicator" in observation.columns else facts


def indicator_series(
    observation: DataFrame, indicator: DataFrame, geography: DataFrame, code: str
) -> DataFrame:
    """One indicator everywhere, latest period first."""
    facts = _of_indicator(observation, indicator, code)
    return (
        _placed(facts, geography)
        .orderBy(F.desc("period_start"), F.desc("id"))
        .select("state_name", "county", "period_start", "value")
    )


def state_series(
    observation: DataFrame, indicator: DataFrame, geography: DataFrame, code: str, since: date
) -> DataFrame:
    """One indicator by state from ``since`` on."""
    recent = observation.where(F.col("period_start") >= F.lit(since))
    if "part_year" in observation.columns:
        recent = recent.where(F.col("part_year") >= F.lit(since.year))
    facts = _of_indicator(recent, indicator, code)
    return (
        _placed(facts, geography.where(F.col("level") == "state"))
        .orderBy("state_name", "period_start", "id")
        .select("state_name", "period_start", "value")
    )


# more than any id; latest days first, and of one day the lowest id
_IDS = Decimal(10**19)


def latest_per_indicator(observation: DataFrame, indicator: DataFrame) -> DataFrame:
    """Latest observation of each indicator.

    Aggregated on the surrogate key before the join: each task hands on one row
    per indicator, so an indicator with a third of all facts is no hot spot. Day
    and id are packed into one number, which keeps the aggregate hashed. Given
    ``Warehouse.newest_observations()`` it reads one partition per indicator.
    """
    days = F.datediff("period_start", F.lit("1970-01-01").cast("date")).cast("decimal(10,0)")
    rank = days * F.lit(_IDS) + (F.lit(_IDS - 1) - F.col("id").cast("decimal(19,0)"))
    newest = (
        observation.select("indicator_id", "value", rank.cast("decimal(38,0)").alias("rank"))
        .groupBy("indicator_id")
        .agg(F.max_by("value", "rank").alias("value"), F.max("rank").alias("rank"))
    )
    # the remainder is never negative, so the quotient rounds down before 1970 as well
    left = F.pmod("rank", F.lit(_IDS))
    day = ((F.col("rank") - left) / F.lit(_IDS)).cast("int")
    return (
        _named(newest, indicator)
        .select(
            F.col("indicator_code").alias("code"),
            F.col("indicator_name").alias("name"),
            "value",
            F.date_add(F.lit("1970-01-01").cast("date"), day).alias("period_start"),
        )
        .orderBy("code")
    )


def count_for_indicator(observation: DataFrame, indicator: DataFrame, code: str) -> DataFrame:
    return _of_indicator(observation, indicator, code).agg(F.count(F.lit(1)).alias("n"))


def latest_run_for_source(log: DataFrame, data_source: str) -> DataFrame:
    return (
        log.where(F.col("data_source") == data_source)
        .orderBy(F.desc("started_at"), F.desc("id"))
        .limit(1)
        .select("run_id", "data_source", "status", "records_inserted", "records_failed")
    )

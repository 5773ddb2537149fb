"""The star schema as parquet tables."""

from __future__ import annotations

import time
from collections.abc import Iterable
from datetime import datetime
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsforge.schema import WAREHOUSE_TABLES, struct

# The fact table's layout: a load rewrites only the partitions it touches, and
# queries on an indicator or a period over ``observations()`` skip the rest.
FACT_PARTITIONS = ("part_indicator", "part_year")

# orders the states of a run in the log; the highest id that is given away by then
_VERSION, _IDS = "version", "ids"
_LOG = T.StructType([*WAREHOUSE_TABLES["ingestion_log"].fields, *struct("version BIGINT, ids BIGINT").fields])
# which load holds the current rows of a partition, and when that load ran
_PARTS = struct("part_indicator BIGINT, part_year INT, load BIGINT, at TIMESTAMP")


class Part(NamedTuple):
    """A partition of the fact table: its load is the folder with its current rows."""

    part_indicator: int
    part_year: int
    load: int
    at: datetime  # the latest load that wrote it


def _partitioned(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"part_indicator": F.col("indicator_id"), "part_year": F.year("period_start")}
    )


class Warehouse:
    """Reads and writes the tables below one folder.

    Dimensions only ever grow, and the log has a row for each state of a run, so
    they are appended to. A load writes the partitions of the fact table that it
    touches anew, in a folder of its own and once; then one small file says that
    they are the current ones. Readers follow these files, so they see a load as
    a whole or not at all, and a load that breaks off leaves the table as it was.
    ``vacuum`` deletes what no current partition needs. One load at a time may
    write: two at once could give ids twice and lose each other's facts.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def create(self) -> Warehouse:
        """Write the empty tables that do not exist yet."""
        schemas = {**WAREHOUSE_TABLES, "ingestion_log": _LOG, "observation_parts": _PARTS}
        for table, schema in schemas.items():
            if table != "observation":
                self.spark.createDataFrame([], schema).write.mode("ignore").parquet(self.path(table))
        return self

    def table(self, table: str) -> DataFrame:
        schema = WAREHOUSE_TABLES[table]
        if table == "observation":
            return self.observations().select(*schema.names)
        if table == "ingestion_log":
            return self._log()
        return self.spark.read.schema(schema).parquet(self.path(table))

    def parts(self) -> list[Part]:
        """The current partitions, a row each."""
        known = self.spark.read.schema(_PARTS).parquet(self.path("observation_parts"))
        current = known.groupBy(*FACT_PARTITIONS).agg(F.max("load").alias("load"), F.max("at").alias("at"))
        return sorted(Part(*r) for r in current.select(*_PARTS.names).collect())

    def observations(self, parts: Iterable[Part] | None = None) -> DataFrame:
        """The fact table with its partition columns, for pruned reads; of some partitions if they are named."""
        schema = T.StructType(
            [*WAREHOUSE_TABLES["observation"].fields, *struct("load BIGINT, part_indicator BIGINT, part_year INT").fields]
        )
        top = self.path("observation")
        paths = [
            f"{top}/load={p.load}/part_indicator={p.part_indicator}/part_year={p.part_year}"
            for p in (self.parts() if parts is None else parts)
        ]
        if not paths:
            return self.spark.createDataFrame([], schema).drop("load")
        return self.spark.read.schema(schema).option("basePath", top).parquet(*paths).drop("load")

    def newest_observations(self) -> DataFrame:
        """The facts of each indicator's newest year."""
        newest = {p.part_indicator: p for p in self.parts()}  # in the order of their years
        return self.observations(newest.values())

    def recent_observations(self, since: datetime) -> DataFrame:
        """The facts that came in at or after a moment, from the partitions written since."""
        recent = self.observations(p for p in self.parts() if p.at >= since)
        return recent.where(F.col("ingested_at") >= F.lit(since))

    def append(self, table: str, rows: DataFrame) -> None:
        schema = WAREHOUSE_TABLES[table]
        rows.select(*schema.names).write.mode("append").parquet(self.path(table))

    def touched(self, batch: DataFrame) -> list[Part]:
        """The partitions that hold keys of ``batch``, with their current load, or 0 for new ones."""
        keys = _partitioned(batch).select(*FACT_PARTITIONS).distinct().collect()  # a row for each partition
        current = {p[:2]: p for p in self.parts()}
        return sorted(current.get(tuple(k), Part(*k, 0, datetime.min)) for k in keys)

    def publish_facts(self, merged: DataFrame, touched: list[Part], at: datetime) -> None:
        """Make ``merged`` the content of the ``touched`` partitions; all others stay as they are.

        Rebalancing gathers a partition into few files and splits one that is
        too large for a task, so a hot indicator is written by many tasks.
        """
        load = 1 + max((p.load for p in self.parts()), default=0)
        (
            _partitioned(merged)
            .hint("rebalance", *(F.col(c) for c in FACT_PARTITIONS))
            .sortWithinPartitions(*FACT_PARTITIONS, "geography_id", "period_start")
            .write.mode("overwrite")
            .partitionBy(*FACT_PARTITIONS)
            .parquet(f"{self.path('observation')}/load={load}")
        )
        rows = [(p.part_indicator, p.part_year, load, at) for p in touched]
        self.spark.createDataFrame(rows, _PARTS).coalesce(1).write.mode("append").parquet(self.path("observation_parts"))

    def vacuum(self) -> int:
        """Delete the rows that later loads have replaced; how many partitions of loads that were. No one may read meanwhile."""
        known = self.spark.read.schema(_PARTS).parquet(self.path("observation_parts"))
        current = {p[:3] for p in self.parts()}
        old = {tuple(r)[:3] for r in known.collect()} - current  # a row for each partition of a load
        jvm, settings = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        gone = 0
        for indicator, year, load in old:
            folder = jvm.org.apache.hadoop.fs.Path(f"{self.path('observation')}/load={load}/part_indicator={indicator}/part_year={year}")
            gone += folder.getFileSystem(settings).delete(folder, True)
        return gone

    def _states(self) -> DataFrame:
        return self.spark.read.schema(_LOG).parquet(self.path("ingestion_log"))

    def highest_id(self) -> int:
        """The highest id that any load has given away, as the log has it; no table is scanned for it."""
        return self._states().agg(F.coalesce(F.max(_IDS), F.lit(0))).first()[0]

    def append_log(self, rows: DataFrame, ids: int) -> None:
        """Add new states of runs; the last one of a run is what the log shows. ``ids`` is the highest id given away."""
        stated = rows.withColumns({_VERSION: F.lit(time.time_ns()), _IDS: F.lit(ids).cast("bigint")})
        stated.select(*_LOG.names).write.mode("append").parquet(self.path("ingestion_log"))

    def _log(self) -> DataFrame:
        schema = WAREHOUSE_TABLES["ingestion_log"]
        last = self._states().groupBy("run_id").agg(F.max_by(F.struct(*schema.names), F.col(_VERSION)).alias("row"))
        return last.select("row.*").select(*schema.names)

    def register(self) -> None:
        """Temporary views of all tables, for SQL."""
        for table in WAREHOUSE_TABLES:
            self.table(table).createOrReplaceTempView(table)

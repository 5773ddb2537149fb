"""The registry: one entry per operator, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.sql import DIRTY, FLAGS, NUMBERS, RAGGED
from obsforge.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def spread(df: DataFrame) -> DataFrame:
    """Use all cores of a small check machine on an input of one row group."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


class Data:
    """The given tables below one folder, and the records made from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare(spark)
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _sql(self, text: str, *names: str) -> DataFrame:
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})

    def dirty(self) -> DataFrame:
        text = DIRTY.replace("FROM orders o JOIN customer c", "FROM {orders} o JOIN {customer} c")
        return spread(self._sql(text, "orders", "customer"))

    def numbers(self) -> DataFrame:
        return self._sql(NUMBERS.replace("FROM orders", "FROM {orders}"), "orders")

    def flags(self) -> DataFrame:
        return self._sql(FLAGS.replace("FROM orders", "FROM {orders}"), "orders")

    def ragged(self) -> DataFrame:
        # braces of the JSON texts are not placeholders
        text = RAGGED.replace("{", "{{").replace("}", "}}").replace("FROM orders", "FROM {orders}")
        return spread(self._sql(text, "orders"))


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with the SQL it must agree with."""

    def register(build: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, folder: build(Data(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register

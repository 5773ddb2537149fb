"""Local Spark session for tests, checks and benchmarks."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

from obsforge.session import prepare


def local_session(cpus: str | None = None, partitions: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus or os.environ.get('BENCH_CPUS', '8')}]")
        .appName("obsforge")
        .config("spark.ui.enabled", "false")
        # skips the call-site capture of every column operation
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)

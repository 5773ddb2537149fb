"""A geography that a third of all rows ask for is split, and nothing is lost."""

from datetime import datetime

from pyspark.sql import functions as F

from obsforge.operators import geography
from obsforge.operators.facts import dedupe_batch, last_and_first
from obsforge.schema import GEOGRAPHY
from obsforge.session import staged

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


def test_hot_geography_is_split(spark):
    rows = spark.range(0, 120000, 1, 8).select(
        F.col("id").alias("idx"),
        F.lit("county").alias("level"),
        F.lit("CA").alias("state"),
        F.lit(None).cast("string").alias("state_name"),
        F.when(F.col("id") % 3 == 0, F.lit("Kings")).otherwise(
            F.concat(F.lit("c"), (F.col("id") % 500).cast("string"))
        ).alias("county"),
        F.lit(None).cast("string").alias("fips_code"),
    )
    requests = staged(rows, "requests")
    none = spark.createDataFrame([], GEOGRAPHY)
    made = staged(geography.new_geographies(requests, none, F.lit(datetime(2024, 1, 1))), "made")
    lookup = staged(geography.geography_lookup(none, made), "lookup")
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    try:
        placed = geography.resolve_geography(requests, lookup)
        counts = placed.groupBy("geography_id").agg(F.count(F.lit(1)).alias("n"))
        total = placed.agg(F.count("geography_id"), F.count_if(F.col("geography_id") == 1))
        assert [tuple(r) for r in total.collect()] == [(120000, 40000)]
        plan = total._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
        assert counts.count() == made.count()
    finally:
        for key in SMALL:
            spark.conf.unset(key)


def test_hot_fact_key_is_combined_before_the_shuffle(spark):
    rows = spark.range(0, 60000, 1, 8).select(
        F.col("id").alias("idx"),
        F.lit(1).cast("bigint").alias("indicator_id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("bigint").alias("geography_id"),
        F.lit(None).cast("bigint").alias("stratifier_id"),
        F.lit("2020-01-01").cast("date").alias("period_start"),
        F.lit("2020-01-01").cast("date").alias("period_end"),
        *(F.col("id").alias(c) for c in ("value", "value_lower_bound", "value_upper_bound", "sample_size")),
        *(F.lit("x").alias(c) for c in ("value_notes", "data_source", "data_source_id")),
    )
    once = dedupe_batch(rows, "idx")
    hot = once.where(F.col("geography_id") == 0).first()
    assert (hot["value"], hot["first_idx"]) == (59997, 0)
    assert once.count() == 40001
    plan = last_and_first(rows, "idx")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_max(") and "SortAggregate" not in plan

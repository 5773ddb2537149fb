"""Schemas of the warehouse tables and the canonical observation."""

from __future__ import annotations

from pyspark.sql import types as T

AMOUNT = T.DecimalType(15, 4)


_TYPES = {
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "AMOUNT": AMOUNT,
    "TEXTS": T.MapType(T.StringType(), T.StringType()),
}


def struct(spec: str) -> T.StructType:
    """Schema from ``name TYPE, ...``; unlike a DDL string it needs no running session."""
    pairs = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


INDICATOR = struct(
    "id BIGINT, code STRING, name STRING, description STRING, unit STRING, category STRING, "
    "data_type STRING, metadata STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
)
GEOGRAPHY = struct(
    "id BIGINT, country STRING, state STRING, state_name STRING, county STRING, fips_code STRING, "
    "level STRING, region STRING, created_at TIMESTAMP"
)
STRATIFIER = struct(
    "id BIGINT, dimension STRING, value STRING, display_order INT, parent_id BIGINT, "
    "metadata STRING, created_at TIMESTAMP"
)
OBSERVATION = struct(
    "id BIGINT, indicator_id BIGINT, geography_id BIGINT, stratifier_id BIGINT, "
    "period_start DATE, period_end DATE, value AMOUNT, value_lower_bound AMOUNT, "
    "value_upper_bound AMOUNT, sample_size INT, value_notes STRING, data_source STRING, "
    "data_source_id STRING, ingested_at TIMESTAMP, updated_at TIMESTAMP"
)
INGESTION_LOG = struct(
    "id BIGINT, run_id STRING, data_source STRING, status STRING, records_processed BIGINT, "
    "records_inserted BIGINT, records_failed BIGINT, started_at TIMESTAMP, completed_at TIMESTAMP, "
    "error_message STRING, metadata STRING"
)
DATASET_METADATA = struct("name STRING, description STRING").add(
    "columns", T.ArrayType(struct("name STRING, dataTypeName STRING"))
)

WAREHOUSE_TABLES = {
    "indicator": INDICATOR,
    "geography": GEOGRAPHY,
    "stratifier": STRATIFIER,
    "observation": OBSERVATION,
    "ingestion_log": INGESTION_LOG,
}

# Column types of a transformed observation, before the warehouse ids are known.
CANONICAL = struct(
    "state STRING, state_name STRING, county STRING, fips_code STRING, geography_level STRING, "
    "period_start DATE, period_end DATE, value DOUBLE, value_lower_bound STRING, "
    "value_upper_bound STRING, sample_size STRING, value_notes STRING, indicator_code STRING, "
    "indicator_name STRING, indicator_unit STRING, indicator_description STRING, "
    "indicator_category STRING, age_group STRING, gender STRING, race STRING, ethnicity STRING, "
    "data_source STRING, data_source_id STRING, record_id BIGINT, metadata TEXTS"
)

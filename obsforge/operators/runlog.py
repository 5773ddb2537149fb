"""Load statistics and the ingestion log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.operators.constraints import LOG_DEFAULTS
from obsforge.operators.dimensions import new_id
from obsforge.schema import INGESTION_LOG

FIRST_ERRORS = 10


def load_status(inserted: Column, failed: Column) -> Column:
    """completed without failures, partial with some, failed when nothing got in."""
    return (
        F.when(failed == 0, F.lit("completed"))
        .when(inserted > 0, F.lit("partial"))
        .otherwise(F.lit("failed"))
    )


def load_counts(checked: DataFrame, *by: str) -> DataFrame:
    """processed / inserted / failed and the status, over all rows or per ``by``.

    Inserted counts every row that passed, also those which later rows of the
    same batch overwrite.
    """
    counted = checked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("records_processed"),
        F.count_if(F.col("reason").isNull()).alias("records_inserted"),
        F.count_if(F.col("reason").isNotNull()).alias("records_failed"),
    )
    status = load_status(F.col("records_inserted"), F.col("records_failed"))
    return counted.withColumn("status", status)


def first_errors(checked: DataFrame, order_by: str, limit: int = FIRST_ERRORS) -> DataFrame:
    """Messages of the first failing records, in order; a top-k, never a full sort."""
    return (
        checked.where(F.col("reason").isNotNull())
        .select(F.col(order_by).alias("idx"), "reason")
        .orderBy("idx")
        .limit(limit)
        .select(
            "idx",
            F.concat(F.lit("Record "), F.col("idx").cast("string"), F.lit(": "), "reason").alias(
                "error"
            ),
        )
    )


def run_outcome(checked: DataFrame, order_by: str) -> DataFrame:
    """One row: counts, status, the first errors joined, and the error total as JSON."""
    errors = first_errors(checked, order_by)
    joined = errors.agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("idx", "error"))),
                                 lambda e: e["error"]), "; ").alias("m")
    )
    return load_counts(checked).withColumns(
        {
            "error_message": F.nullif(joined.select("m").scalar(), F.lit("")),
            "metadata": F.to_json(F.struct(F.col("records_failed").alias("total_errors"))),
        }
    )


def start_runs(log: DataFrame, starts: DataFrame, base: int | None = None) -> DataFrame:
    """The log after starting runs: one row (run_id, data_source, started_at, position) each.

    ``position`` numbers the runs of one call from 0; it orders their new ids past ``base``. A known run id is reset to
    running with zero counts and keeps its source, completion time and error message.
    """
    fresh = starts.select(
        F.col("run_id"),
        F.struct("data_source", "started_at", "position").alias("s"),
    )
    old = log.select("run_id", F.struct(*(c for c in log.columns if c != "run_id")).alias("o"))
    both = old.join(fresh, "run_id", "full_outer")
    known, begun = F.col("o").isNotNull(), F.col("s").isNotNull()
    columns = {
        "id": F.when(known, F.col("o.id")).otherwise(new_id(log, F.col("s.position"), base)),
        "run_id": F.col("run_id"),
        "data_source": F.when(known, F.col("o.data_source")).otherwise(F.col("s.data_source")),
        "status": F.when(begun, F.lit("running")).otherwise(F.col("o.status")),
        **{c: F.when(begun, F.lit(v)).otherwise(F.col(f"o.{c}")) for c, v in LOG_DEFAULTS.items()},
        "started_at": F.when(begun, F.col("s.started_at")).otherwise(F.col("o.started_at")),
        **{c: F.col(f"o.{c}") for c in ("completed_at", "error_message", "metadata")},
    }
    return both.select(
        *(columns[f.name].cast(f.dataType).alias(f.name) for f in INGESTION_LOG.fields)
    )


def complete_runs(log: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The log after completing runs: status, counts, errors and completion time by run id.

    Outcomes of unknown runs change nothing.
    """
    fields = (
        "status", "records_processed", "records_inserted", "records_failed",
        "completed_at", "error_message", "metadata",
    )
    done = outcomes.select("run_id", F.struct(*fields).alias("d"))
    joined = log.join(done, "run_id", "left")
    finished = F.col("d").isNotNull()
    return joined.select(
        *(
            (
                F.when(finished, F.col(f"d.{f.name}")).otherwise(F.col(f.name))
                if f.name in fields
                else F.col(f.name)
            ).cast(f.dataType).alias(f.name)
            for f in INGESTION_LOG.fields
        )
    )

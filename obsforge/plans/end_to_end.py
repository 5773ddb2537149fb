"""Pages in, facts out: extract, validate, transform and load with stage statistics."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame

from obsforge.functions.rules import Rule, basic_rules
from obsforge.operators.mapping import (
    DEFAULT_ALIASES,
    DEFAULT_TRANSFORMS,
    Aliases,
    Transform,
    to_observation,
)
from obsforge.operators.validation import (
    invalid_records,
    top_messages,
    valid_records,
    validate,
    validation_summary,
)
from obsforge.plans.loading import LONGEST_MESSAGE, fail_run, load_batch, start_run
from obsforge.schema import struct
from obsforge.session import prepare, scratch_root
from obsforge.sources.pages import extract, path_exists
from obsforge.sources.warehouse import Warehouse

POSITION = "record_index"
# Stage names, statuses and the messages of a run below are part of its result.
_STAGES = struct(
    "position INT, stage STRING, status STRING, records_in BIGINT, records_out BIGINT, "
    "records_failed BIGINT, records_with_warnings BIGINT, duration_seconds DOUBLE, run_id STRING"
)


@dataclass
class RunResult:
    """Outcome of a run; the DataFrames are lazy reads of staged tables."""

    run_id: str
    status: str
    records_loaded: int
    stages: DataFrame
    message: str | None = None
    top_errors: DataFrame | None = None
    top_warnings: DataFrame | None = None
    quarantine: DataFrame | None = None


def transform_batch(
    valid: DataFrame,
    indicator_code: str | None = None,
    indicator_name: str | None = None,
    aliases: Aliases = DEFAULT_ALIASES,
    transforms: Mapping[str, Transform] = DEFAULT_TRANSFORMS,
    record: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Canonical observations of valid records. Total, so nothing is skipped."""
    return to_observation(
        valid, indicator_code, indicator_name, aliases, transforms, record, keep
    )


class _Run:
    """The stages of one run: what they staged, their statistics, and how it ended."""

    def __init__(self, warehouse: Warehouse, run_id: str, name: str, at: datetime, resume: bool):
        self.warehouse, self.run_id, self.name, self.at, self.resume = warehouse, run_id, name, at, resume
        self.rows: list[tuple] = []
        self.frames: dict[str, DataFrame] = {}

    def staged(self, table: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The table under a name of the run; one that an earlier attempt finished is taken as it is if the run goes on."""
        spark = self.warehouse.spark
        path = f"{scratch_root(spark)}/run-{self.run_id}/{table}"
        if not (self.resume and path_exists(spark, f"{path}/_SUCCESS")):
            build().write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    @contextmanager
    def stage(self, label: str, taken: int = 0) -> Iterator[_Stage]:
        """Statistics of a stage; whatever is raised in it ends the run as failed, in its statistics and in the log."""
        stage, began = _Stage("completed", taken), datetime.now(timezone.utc)
        try:
            yield stage
        except _Ended:
            raise
        except Exception as error:
            stage.status, stage.given, stage.failed = "failed", 0, taken
            if label != "loading":  # a load closes its own
                start_run(self.warehouse, self.run_id, self.name, self.at)
                fail_run(self.warehouse, self.run_id, str(error), self.at)
            raise _Ended("failed", f"{label.capitalize()} failed: {str(error)[:LONGEST_MESSAGE]}") from error
        finally:
            seconds = (datetime.now(timezone.utc) - began).total_seconds()
            self.rows.append(
                (len(self.rows) + 1, label, stage.status, stage.taken, stage.given, stage.failed, stage.warned, seconds, self.run_id)
            )

    def result(self, end: _Ended) -> RunResult:
        stages = self.warehouse.spark.createDataFrame(self.rows, _STAGES)
        return RunResult(self.run_id, end.status, end.loaded, stages, end.message, **self.frames)


@dataclass
class _Stage:
    status: str
    taken: int = 0
    given: int = 0
    failed: int = 0
    warned: int = 0


class _Ended(Exception):
    """A run has come to its end, good or bad."""

    def __init__(self, status: str, message: str | None = None, loaded: int = 0):
        super().__init__(message)
        self.status, self.message, self.loaded = status, message, loaded


def run_dataset(
    warehouse: Warehouse,
    landing: str,
    dataset_id: str,
    dataset_name: str | None = None,
    indicator_code: str | None = None,
    indicator_name: str | None = None,
    limit: int | None = None,
    filters: Mapping[str, Any] | None = None,
    use_resource_endpoint: bool = False,
    rules: Sequence[Rule] | None = None,
    aliases: Aliases = DEFAULT_ALIASES,
    transforms: Mapping[str, Transform] = DEFAULT_TRANSFORMS,
    run_id: str | None = None,
    at: datetime | None = None,
    indicator_from: str = "argument",
    resume: bool = False,
) -> RunResult:
    """Run all four stages for one dataset.

    Records are validated under their source names and mapped afterwards. Each
    stage is staged once in the shared folder, and its statistics are counted
    from narrow columns of the staged table: unlike counters gathered by
    running tasks, those stay exact when a lost executor's work is repeated.

    Any exception in a stage is the result of the run: status ``failed``, its
    text as the message, and a closed entry in the log. ``resume`` with the id
    of such a run goes on from the last stage that it finished.
    """
    prepare(warehouse.spark)
    run_id = run_id or str(uuid.uuid4())
    at = at or datetime.now(timezone.utc).replace(tzinfo=None)
    name = dataset_name or dataset_id
    run = _Run(warehouse, run_id, name, at, resume)
    try:
        _stages(
            run, landing, dataset_id, indicator_code, indicator_name, limit, filters, use_resource_endpoint,
            list(rules) if rules else basic_rules(), aliases, transforms, indicator_from,
        )
    except _Ended as end:
        return run.result(end)
    raise AssertionError("the last stage ends the run")


def _stages(
    run: _Run,
    landing: str,
    dataset_id: str,
    indicator_code: str | None,
    indicator_name: str | None,
    limit: int | None,
    filters: Mapping[str, Any] | None,
    use_resource_endpoint: bool,
    rules: Sequence[Rule],
    aliases: Aliases,
    transforms: Mapping[str, Transform],
    indicator_from: str,
) -> None:
    with run.stage("ingestion") as stage:
        found: list[DataFrame] = []

        def extracted() -> DataFrame:
            records, info = extract(
                run.warehouse.spark, landing, dataset_id, run.run_id, run.at, run.name, limit, filters, use_resource_endpoint
            )
            found.append(records)
            return info

        info = run.staged("info", extracted).first()
        stage.status, stage.taken, stage.given = info["status"], info["records_extracted"], info["records_extracted"]
    if info["status"] != "success":
        raise _Ended("failed", f"Extraction failed: {info['error']}")
    if not stage.given:
        raise _Ended("completed", "No records to process")

    with run.stage("validation", stage.given) as stage:

        def validated() -> DataFrame:
            if not found:  # an earlier attempt extracted, but came no further
                extracted()
            return validate(found[0], rules, record="record", keep=(POSITION,))

        checked = run.staged("validated", validated)
        counts = validation_summary(checked).first()
        run.frames |= {
            "top_errors": top_messages(checked, "error"),
            "top_warnings": top_messages(checked, "warning"),
            "quarantine": invalid_records(checked),
        }
        stage.taken, stage.failed = counts["total_records"], counts["invalid_records"]
        stage.given = counts["valid_records"] + counts["records_with_warnings"]
        stage.warned = counts["records_with_warnings"]
    if not stage.given:
        raise _Ended("failed", "All records failed validation")

    with run.stage("transformation", stage.given) as stage:
        observations = run.staged(
            "transformed",
            lambda: transform_batch(
                valid_records(checked, record="record", keep=(POSITION,)),
                indicator_code, indicator_name, aliases, transforms, "record", (POSITION,),
            ),
        )
        stage.given = observations.count()
    if not stage.given:
        raise _Ended("failed", "Transformation produced no records")

    with run.stage("loading", stage.given) as stage:
        loaded = load_batch(
            run.warehouse, observations, POSITION, run.name, run.run_id, run.at,
            indicator_code, indicator_name, indicator_from,
        ).first()
        stage.status, stage.taken = loaded["status"], loaded["records_processed"]
        stage.given, stage.failed = loaded["records_inserted"], loaded["records_failed"]
    if not stage.given:
        raise _Ended("failed", "No records loaded")
    raise _Ended("completed" if stage.status == "completed" else "partial", loaded["error_message"], stage.given)

"""Record validation: rules become added columns in one projection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.functions.dates import parse_date
from obsforge.functions.rules import Rule, non_negative, not_future
from obsforge.operators.records import records_of
from obsforge.session import staged

VALID, WARNING, INVALID = "valid", "warning", "invalid"
_RESULT_COLUMNS = ("status", "errors", "warnings", "field_results")


def _messages(rules: Sequence[Rule], failed: Sequence[Column], warning: bool) -> Column:
    told = [
        F.concat(F.lit(f"{rule.field}: "), failure)
        for rule, failure in zip(rules, failed)
        if rule.warning_only == warning
    ]
    return F.array_compact(F.array(*told)) if told else F.array().cast("array<string>")


def _field_results(rules: Sequence[Rule], failed: Sequence[Column]) -> Column:
    last = {rule.field: failure for rule, failure in zip(rules, failed)}
    if not last:
        return F.create_map().cast("map<string,struct<is_valid:boolean,error:string>>")
    pairs = []
    for field, failure in last.items():
        pairs += [
            F.lit(field),
            F.struct(failure.isNull().alias("is_valid"), failure.alias("error")),
        ]
    return F.create_map(*pairs)


def validate(
    df: DataFrame, rules: Sequence[Rule], record: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Add status, errors, warnings and field_results to every record.

    Messages read ``field: text`` in rule order; a field checked by several
    rules keeps the result of its last one. One narrow projection, no shuffle.
    """
    bound = records_of(df, record, keep).bind({rule.field: [rule.field] for rule in rules})
    checks = [rule.failure(bound[rule.field]) for rule in rules]
    # each message is computed once; the later columns only refer to it
    named = [f"_rule_{i}" for i in range(len(checks))]
    checked = bound.df.select(*df.columns, *(c.alias(n) for c, n in zip(checks, named)))
    failed = [F.col(n) for n in named]
    errors = _messages(rules, failed, warning=False)
    warnings = _messages(rules, failed, warning=True)
    told = checked.select(
        *df.columns,
        errors.alias("errors"),
        warnings.alias("warnings"),
        _field_results(rules, failed).alias("field_results"),
    )
    status = (
        F.when(F.size("errors") > 0, F.lit(INVALID))
        .when(F.size("warnings") > 0, F.lit(WARNING))
        .otherwise(F.lit(VALID))
    )
    return told.select(*df.columns, status.alias("status"), "errors", "warnings", "field_results")


def valid_records(
    validated: DataFrame, record: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Records without errors, warnings included; records without any field drop out."""
    fields = records_of(validated, record, (*_RESULT_COLUMNS, *keep))
    kept = validated.where((F.col("status") != INVALID) & fields.non_empty())
    return kept.drop(*_RESULT_COLUMNS)


def invalid_records(validated: DataFrame) -> DataFrame:
    """Quarantine: failing records, whole, with their messages and field results."""
    return validated.where(F.col("status") == INVALID)


def validation_summary(validated: DataFrame) -> DataFrame:
    """One row of counts."""
    status = F.col("status")
    return validated.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(status == VALID).alias("valid_records"),
        F.count_if(status == INVALID).alias("invalid_records"),
        F.count_if(status == WARNING).alias("records_with_warnings"),
    )


def distinct_messages(validated: DataFrame) -> DataFrame:
    """Every distinct message with its count.

    Errors come from invalid records, warnings only from records whose status
    is warning. A DataFrame, because texts in messages make the set unbounded.
    """
    status = F.col("status")
    told = F.when(
        status == INVALID,
        F.transform("errors", lambda m: F.struct(F.lit("error").alias("kind"), m.alias("message"))),
    ).when(
        status == WARNING,
        F.transform(
            "warnings", lambda m: F.struct(F.lit("warning").alias("kind"), m.alias("message"))
        ),
    )
    return (
        validated.select(F.explode(told).alias("m"))
        .groupBy(F.col("m.kind").alias("kind"), F.col("m.message").alias("message"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_messages(validated: DataFrame, kind: str = "error", limit: int = 10) -> DataFrame:
    """The most frequent distinct messages, ties by text."""
    return (
        distinct_messages(validated)
        .where(F.col("kind") == kind)
        .orderBy(F.desc("n"), "message")
        .limit(limit)
        .select("message", "n")
    )


def until_first_invalid(validated: DataFrame, order_by: str) -> DataFrame:
    """Results up to and including the first invalid record in ``order_by``.

    The cut is a scalar found by one distributed minimum, not a sort.
    """
    cut = (
        validated.where(F.col("status") == INVALID).agg(F.min(order_by).alias("cut")).select("cut")
    ).scalar()
    return validated.where(cut.isNull() | (F.col(order_by) <= cut))


def early_summary(validated: DataFrame, order_by: str) -> DataFrame:
    """Counts of a validation that stops at the first invalid record; the total is of all records."""
    total = validated.agg(F.count(F.lit(1)).alias("n")).select("n").scalar()
    return validation_summary(until_first_invalid(validated, order_by)).withColumn("total_records", total)


def flag_not_in_table(
    df: DataFrame, field: str, allowed: DataFrame, flag: str = "allowed"
) -> DataFrame:
    """Membership in an allowed list too large for a literal.

    ``allowed`` has one column. Its distinct values are staged: Spark then knows
    their size, broadcasts them only below its threshold, and else can split a
    value that most rows hold.
    """
    (name,) = allowed.columns
    distinct = allowed.where(F.col(name).isNotNull()).distinct()
    known = staged(
        distinct.select(F.col(name).alias("_member"), F.lit(True).alias(flag)), "allowed"
    )
    joined = df.join(known, F.col(field) == F.col("_member"), "left")
    return joined.select(*df.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag))


def check_schema(
    df: DataFrame, as_of: Column | None = None, keep: tuple[str, ...] = (), record: str | None = None
) -> DataFrame:
    """Typed check of state, county, date and value; other columns pass untouched.

    ``state`` and ``county`` must be text, ``date`` and ``value`` are read
    strictly; ``schema_error`` is NULL for a record that fits.
    """
    names = ("value", "date", "state", "county")
    bound = records_of(df, record, keep).bind({n: [n] for n in names})
    value, day = bound["value"], bound["date"]
    number = value.as_float()
    parsed = F.coalesce(day.date, parse_date(day.text))
    future = not_future(as_of)
    return bound.df.select(
        *(c for c in df.columns if c not in ("date", "value")),
        parsed.alias("date"),
        number.alias("value"),
        F.when(~value.none & number.isNull(), F.lit("value: not a number"))
        .when(~value.none & non_negative(value).isNotNull(), F.lit("value: Value cannot be negative"))
        .when(~day.none & parsed.isNull(), F.lit("date: not a date"))
        .when(~day.none & future(day).isNotNull(), F.lit("date: Date cannot be in the future"))
        .when(~bound["state"].none & ~bound["state"].is_text, F.lit("state: not a text"))
        .when(~bound["county"].none & ~bound["county"].is_text, F.lit("county: not a text"))
        .alias("schema_error"),
    )

"""Fact keys, in-batch deduplication and the merge into the fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.operators.constraints import check_observation, key_reason, measure_reason, typed_measures
from obsforge.operators.dimensions import new_id, pick_stratifier
from obsforge.operators.geography import has_a_form, resolve_geography
from obsforge.schema import OBSERVATION

FACT_KEY = ("indicator_id", "geography_id", "stratifier_key", "period_start", "period_end")
UPDATED = ("value", "value_lower_bound", "value_upper_bound", "sample_size", "value_notes")
KEPT = ("data_source", "data_source_id")
NO_STRATIFIER = -1


def stratifier_key(stratifier_id: Column) -> Column:
    """Stratifier part of the fact key: absence is a value of its own."""
    return F.coalesce(stratifier_id, F.lit(NO_STRATIFIER).cast("bigint"))


def place(observations: DataFrame, order_by: str, lookup: DataFrame) -> DataFrame:
    """Add ``geography_id``; the place columns stay, with empty texts as NULL."""
    texts = ("state", "county", "fips_code")
    known = observations.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})
    return resolve_geography(known, lookup, order_by, "geography_level")


def with_stratum(observations: DataFrame) -> DataFrame:
    """Add the dimension and value of the one stratifier a row is filed under."""
    dimension, value = pick_stratifier(F.col("age_group"), F.col("gender"), F.col("race"))
    return observations.withColumns({"dimension": dimension, "stratum": value})


def assign_stratifier(placed: DataFrame, order_by: str, stratifiers: DataFrame) -> DataFrame:
    """Add ``stratifier_id`` and whether a wanted stratifier has no member.

    Rows without a stratum match nothing; they are spread over the partitions
    of the join by their position.
    """
    members = stratifiers.select(
        "dimension", F.col("value").alias("stratum"), F.col("id").alias("stratifier_id")
    )
    spread = placed.withColumns(
        {
            "dimension": F.coalesce("dimension", F.lit("")),
            "stratum": F.coalesce(F.col("stratum"), F.col(order_by).cast("string")),
        }
    )
    joined = spread.join(members, ["dimension", "stratum"], "left")
    lost = (F.col("dimension") != "") & F.col("stratifier_id").isNull()
    return joined.withColumn("stratifier_lost", lost).drop("dimension", "stratum")


def assign_indicator(
    rows: DataFrame, order_by: str, indicators: DataFrame, code: str | None, source: str = "argument"
) -> DataFrame:
    """Add ``indicator_id``: one for the whole load (``argument``) or each row's own (``row``)."""
    if source == "row":
        codes = indicators.select(F.col("code").alias("_code"), F.col("id").alias("indicator_id"))
        own = F.nullif(F.col("indicator_code"), F.lit(""))
        spread = F.coalesce(own, F.concat(F.lit("\x00"), F.col(order_by).cast("string")))
        return rows.withColumn("_code", spread).join(codes, "_code", "left").drop("_code")
    if source != "argument":
        raise ValueError("indicator source is 'argument' or 'row'")
    if not code:
        return rows.withColumn("indicator_id", F.lit(None).cast("bigint"))
    known = indicators.where(F.col("code") == code).agg(F.max("id").alias("id"))
    return rows.withColumn("indicator_id", known.select("id").scalar())


def resolve_keys(
    observations: DataFrame,
    order_by: str,
    indicators: DataFrame,
    lookup: DataFrame,
    stratifiers: DataFrame,
    indicator_code: str | None = None,
    indicator_from: str = "argument",
) -> DataFrame:
    """All three surrogate ids for every observation, NULL where unresolved.

    Geography and stratifier are one equi-join each; Spark broadcasts the
    members only when it measures them small.
    """
    placed = place(with_stratum(observations), order_by, lookup)
    stratified = assign_stratifier(placed, order_by, stratifiers)
    return assign_indicator(stratified, order_by, indicators, indicator_code, indicator_from)


def _with_own_reasons(reason: Column) -> Column:
    """A reason, with more about a missing place, and about a stratifier that is not there."""
    lost = F.when(F.col("geography_id").isNotNull() & F.col("stratifier_lost"), F.lit("no stratifier"))
    unfit = F.when((reason == "geography_id is null"), F.col("unfit"))
    return F.coalesce(unfit, reason, lost)


def _unfit() -> Column:
    level = F.coalesce("geography_level", F.lit("none"))
    told = F.concat(F.lit("level "), level, F.lit(" with this place cannot be loaded"))
    return F.when(~has_a_form("geography_level"), told)


def check_resolved(resolved: DataFrame) -> DataFrame:
    """Typed fact rows with the reason why a row cannot be loaded, if any."""
    checked = check_observation(resolved).withColumn("unfit", _unfit())
    return checked.withColumn("reason", _with_own_reasons(F.col("reason"))).drop("stratifier_lost", "unfit")


def key_rows(observations: DataFrame, order_by: str) -> DataFrame:
    """What resolving and checking need of each observation, a few short columns.

    The constraints on its measures are checked on the way; ``measures`` is the first that is broken.
    """
    texts = ("state", "county", "fips_code", "indicator_code")
    placed = with_stratum(observations).withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})
    return placed.select(
        order_by, "geography_level", *texts, "dimension", "stratum", "period_start", "period_end",
        measure_reason(observations.columns).alias("measures"), _unfit().alias("unfit"),
    )


def place_keys(keys: DataFrame, order_by: str, lookup: DataFrame) -> DataFrame:
    """Key rows with ``geography_id`` in place of the place."""
    placed = resolve_geography(keys, lookup, order_by, "geography_level")
    return placed.drop("geography_level", "state", "county", "fips_code")


def check_keys(resolved: DataFrame, order_by: str) -> DataFrame:
    """Position, keys and period of each observation with the reason why it cannot be loaded, if any."""
    reason = F.coalesce(key_reason(), F.col("measures"))
    return resolved.select(
        order_by, "indicator_id", "geography_id", "stratifier_id", "period_start", "period_end",
        _with_own_reasons(reason).alias("reason"),
    )


def measure_rows(observations: DataFrame, order_by: str) -> DataFrame:
    """Position, typed measures and origin of each observation."""
    typed = typed_measures()
    return observations.select(order_by, *(typed[c].alias(c) if c in typed else c for c in (*UPDATED, *KEPT)))


def last_and_first(keys: DataFrame, order_by: str) -> DataFrame:
    """For each fact key the positions of its last and its first record.

    Positions are plain numbers, so tasks combine them in hashed rows before the
    shuffle: a key held by a third of all rows leaves each task as one row.
    """
    keyed = keys.withColumn("stratifier_key", stratifier_key(F.col("stratifier_id")))
    position = F.col(order_by)
    return keyed.groupBy(*FACT_KEY).agg(F.max(position).alias("last_idx"), F.min(position).alias("first_idx"))


def with_measures(chosen: DataFrame, rows: DataFrame, order_by: str) -> DataFrame:
    """One row per fact key: measures of its last record, origin of its first.

    The records meet their keys in one join on the position, of which there are
    two at most for a key. Structs travel as units, so a NULL in the last record
    is kept, not skipped.
    """
    wanted = chosen.withColumn(order_by, F.explode(F.array_distinct(F.array("last_idx", "first_idx"))))
    held = rows.select(order_by, F.struct(*UPDATED).alias("_measures"), F.struct(*KEPT).alias("_origin"))
    found = wanted.join(held, order_by)
    last, first = F.col(order_by) == F.col("last_idx"), F.col(order_by) == F.col("first_idx")
    return (
        found.groupBy(*FACT_KEY)
        .agg(
            F.first(F.when(last, F.col("_measures")), ignorenulls=True).alias("_last"),
            F.first(F.when(first, F.col("_origin")), ignorenulls=True).alias("_first"),
            F.min("first_idx").alias("first_idx"),
        )
        .select(*FACT_KEY, "_last.*", "_first.*", "first_idx")
    )


def dedupe_batch(rows: DataFrame, order_by: str) -> DataFrame:
    """One row per fact key of typed fact rows, which are read twice: for their keys, and for what is kept of them."""
    return with_measures(last_and_first(rows, order_by), rows, order_by)


def upsert_observations(
    batch: DataFrame, target: DataFrame, at: Column, base: int | None = None
) -> DataFrame:
    """The fact table after merging a deduplicated batch.

    Known keys take the batch's measures and a new ``updated_at`` and keep id,
    origin and ``ingested_at``; new keys get an id past ``base``, or else past the
    highest. ``target`` may be just the part of the table that can hold keys of the batch.
    """
    old = target.withColumn("stratifier_key", stratifier_key(F.col("stratifier_id")))
    old = old.select(
        *FACT_KEY,
        F.struct("id", *UPDATED, *KEPT, "ingested_at", "updated_at").alias("old"),
    )
    new = batch.select(*FACT_KEY, F.struct(*UPDATED, *KEPT, "first_idx").alias("new"))
    both = new.join(old, list(FACT_KEY), "full_outer")
    known, touched = F.col("old").isNotNull(), F.col("new").isNotNull()
    key = F.col("stratifier_key")
    columns = {
        "id": F.when(known, F.col("old.id")).otherwise(new_id(target, F.col("new.first_idx"), base)),
        "indicator_id": F.col("indicator_id"),
        "geography_id": F.col("geography_id"),
        "stratifier_id": F.nullif(key, F.lit(NO_STRATIFIER).cast("bigint")),
        "period_start": F.col("period_start"),
        "period_end": F.col("period_end"),
        **{c: F.when(touched, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) for c in UPDATED},
        **{c: F.when(known, F.col(f"old.{c}")).otherwise(F.col(f"new.{c}")) for c in KEPT},
        "ingested_at": F.when(known, F.col("old.ingested_at")).otherwise(at),
        "updated_at": F.when(touched, at).otherwise(F.col("old.updated_at")),
    }
    return both.select(
        *(columns[f.name].cast(f.dataType).alias(f.name) for f in OBSERVATION.fields)
    )

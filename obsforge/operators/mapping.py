"""Source fields to the canonical observation, as one projection.

Several source names may feed one target. Among the names present in a record
the last registered one wins, even with a null value; a field whose own name is
a target but not a registered source beats them all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.functions.clean import (
    clean_county,
    clean_date,
    clean_fips_code,
    clean_numeric,
    clean_state_code,
)
from obsforge.functions.pyvalue import FieldValue, blank_to_null
from obsforge.operators.records import LINEAGE, BoundFields, Records, records_of
from obsforge.schema import CANONICAL

Aliases = Mapping[str, Sequence[str]]
Transform = Callable[[FieldValue], Column]

# Canonical target -> source names, in order of registration.
DEFAULT_ALIASES: Aliases = {
    "state": ("state", "stateabbr"),
    "state_name": ("state_name", "statedesc"),
    "county": ("county", "county_name", "locationname"),
    "fips_code": ("fips", "fips_code", "locationid"),
    "geography": ("geography",),
    "date": ("date", "report_date", "week_ending"),
    "year": ("year",),
    "period_start": ("period_start",),
    "period_end": ("period_end",),
    "value": ("value", "data_value", "cases", "deaths", "count", "rate", "percentage"),
    "measure": ("measure",),
    "category": ("category",),
    "unit": ("data_value_unit",),
    "value_lower_bound": ("low_confidence_limit",),
    "value_upper_bound": ("high_confidence_limit",),
    "sample_size": ("totalpopulation",),
    "age_group": ("age_group", "age"),
    "gender": ("gender", "sex"),
    "race": ("race",),
    "ethnicity": ("ethnicity",),
}

# Mapped names that have a place of their own in the observation.
PLACED_FIELDS = (
    "state", "state_name", "county", "fips_code",
    "date", "period_start", "period_end",
    "value", "value_lower_bound", "value_upper_bound",
    "sample_size", "value_notes",
    "indicator_code", "indicator_name", "unit", "description",
    "age_group", "gender", "race", "ethnicity",
    "data_source", "data_source_id",
)


def _date_or_null(v: FieldValue) -> Column:
    return F.when(~v.falsy, clean_date(v))


DEFAULT_TRANSFORMS: Mapping[str, Transform] = {
    "state": clean_state_code,
    "fips_code": clean_fips_code,
    "county": clean_county,
    "date": _date_or_null,
    "period_start": _date_or_null,
    "period_end": _date_or_null,
    "value": clean_numeric,
}


class OrderedAliases(dict):
    """Aliases that remember in which order their sources were registered."""

    def __init__(self, aliases: Aliases, order: Sequence[str]):
        super().__init__(aliases)
        self.order = tuple(order)


def with_alias(aliases: Aliases, source: str, target: str) -> OrderedAliases:
    """``aliases`` plus one more source name, registered last.

    A source feeds one target: an earlier registration elsewhere is dropped, but
    its place in the order of registration stays, and so its strength.
    """
    order = getattr(aliases, "order", [name for names in aliases.values() for name in names])
    if source not in order:
        order = [*order, source]
    moved = {t: tuple(s for s in names if s != source) for t, names in aliases.items()}
    moved[target] = tuple(sorted((*moved.get(target, ()), source), key=order.index))
    return OrderedAliases(moved, order)


class MappedRecord:
    """Records seen under their canonical names."""

    def __init__(self, fields: Records, aliases: Aliases):
        self._fields = fields
        self._aliases = aliases
        self._sources = {name for names in aliases.values() for name in names}

    def candidates(self, target: str) -> list[str]:
        """Record keys that may supply ``target``, strongest first.

        A name that is a source of another target is not copied under its own.
        """
        own = [] if target in self._sources else [target]
        return [*own, *reversed(tuple(self._aliases.get(target, ())))]

    def bind(self, targets: Sequence[str]) -> BoundFields:
        return self._fields.bind({t: self.candidates(t) for t in targets})

    def unplaced(self) -> list[str]:
        """Targets without a place of their own that are fed by other names."""
        return [
            t for t, names in self._aliases.items()
            if t not in PLACED_FIELDS and tuple(names) != (t,)
        ]

    def residual(self, bound: BoundFields) -> Column:
        """Mapped fields without a place of their own, as a map of texts."""
        fed = self.unplaced()
        kept = {t for t in self._aliases if t not in PLACED_FIELDS and t not in fed}
        dropped = sorted({*PLACED_FIELDS, LINEAGE, *fed, *self._sources} - kept)
        rest = self._fields.entries(dropped)
        if not fed:
            return rest
        pairs = [c for t in fed for c in (F.lit(t), bound[t].as_text())]
        return F.map_concat(rest, F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()))


def map_fields(
    df: DataFrame,
    aliases: Aliases = DEFAULT_ALIASES,
    transforms: Mapping[str, Transform] = DEFAULT_TRANSFORMS,
    record: str | None = None,
    keep: tuple[str, ...] = (),
    targets: Sequence[str] | None = None,
) -> DataFrame:
    """Canonical names and cleaned values for the alias targets.

    Columns in ``keep`` (and lineage) stay; unmapped tabular columns are copied.
    """
    fields = records_of(df, record, keep)
    names = list(targets if targets is not None else aliases)
    if targets is None and record is None:
        sources = {s for group in aliases.values() for s in group}
        names += [f for f in fields.fields if f not in sources and f not in names]
    bound = MappedRecord(fields, aliases).bind(names)

    def column(name: str) -> Column:
        transform = transforms.get(name)
        return transform(bound[name]) if transform else bound[name].as_text()

    kept = [c for c in df.columns if c == LINEAGE or c in keep]
    return bound.df.select(*kept, *(column(n).alias(n) for n in names))


def derive_period(
    start: Column, end: Column, day: Column, year: Column
) -> tuple[Column, Column]:
    """Closed period from explicit bounds, else the day, else the calendar year.

    ``year`` is an integer. It is used only without any start, and then also
    replaces the end. A period that still lacks an end is a single day.
    """
    first, last = F.coalesce(start, day), F.coalesce(end, day)
    calendar = F.when(first.isNull() & year.between(1, 9999), year.cast("int"))
    begun = F.coalesce(first, F.make_date(calendar, F.lit(1), F.lit(1)))
    ended = F.coalesce(F.make_date(calendar, F.lit(12), F.lit(31)), last, begun)
    return begun, ended


def year_number(year: FieldValue) -> Column:
    """Integer a year field writes; empty, zero and unreadable give NULL."""
    return F.when(~year.falsy, year.as_int())


def geography_level(state: Column, county: Column, fips_code: Column) -> Column:
    """county, state or nation, from what is known; empty texts count as unknown."""
    return (
        F.when((county != "") | (F.length(fips_code) == 5), F.lit("county"))
        .when(state != "", F.lit("state"))
        .otherwise(F.lit("nation"))
    )


def _whole_number_text(v: FieldValue) -> Column:
    """Text of a count; a fractional number is rounded half away from zero."""
    rounded = F.round(v.number).try_cast("bigint").cast("string")
    return F.when(v.is_number, F.coalesce(rounded, v.shown)).otherwise(v.as_text())


_OBSERVATION_INPUTS = (
    "state", "state_name", "county", "fips_code", "date", "period_start", "period_end", "year",
    "value", "value_lower_bound", "value_upper_bound", "sample_size", "value_notes",
    "measureid", "indicator_code", "measure", "indicator_name", "unit", "data_value_unit",
    "description", "short_question_text", "category", "age_group", "gender", "race", "ethnicity",
    "data_source", "data_source_id",
)


def to_observation(
    df: DataFrame,
    indicator_code: str | None = None,
    indicator_name: str | None = None,
    aliases: Aliases = DEFAULT_ALIASES,
    transforms: Mapping[str, Transform] = DEFAULT_TRANSFORMS,
    record: str | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Records to canonical observations: the 24 scalar fields and the rest as a map.

    Total: every input row gives one output row. ``keep`` columns come first.
    """
    mapped = MappedRecord(records_of(df, record, keep), aliases)
    bound = mapped.bind(dict.fromkeys([*_OBSERVATION_INPUTS, *mapped.unplaced()]))

    def pick(name: str) -> Column:
        transform = transforms.get(name)
        return transform(bound[name]) if transform else bound[name].as_text()

    def either(given: str | None, *names: str) -> Column:
        known = [F.lit(given)] if given else [bound[n].truthy_text() for n in names]
        return F.coalesce(*known)

    has_lineage = LINEAGE in df.columns
    lineage = (lambda f: F.col(f"{LINEAGE}.{f}")) if has_lineage else (lambda f: F.lit(None))
    carried = [c for c in df.columns if c in keep]

    # first the cleaned inputs, so that derived fields refer to them by name
    cleaned_names = ("state", "county", "fips_code", "date", "period_start", "period_end")
    direct = {
        "state_name": pick("state_name"),
        "value": pick("value"),
        "value_lower_bound": pick("value_lower_bound"),
        "value_upper_bound": pick("value_upper_bound"),
        "sample_size": _whole_number_text(bound["sample_size"]),
        "value_notes": pick("value_notes"),
        "indicator_code": either(indicator_code, "measureid", "indicator_code"),
        "indicator_name": either(indicator_name, "measure", "indicator_name"),
        "indicator_unit": either(None, "unit", "data_value_unit"),
        "indicator_description": either(None, "description", "short_question_text"),
        "indicator_category": pick("category"),
        "age_group": pick("age_group"),
        "gender": pick("gender"),
        "race": pick("race"),
        "ethnicity": pick("ethnicity"),
        "data_source": F.coalesce(
            blank_to_null(lineage("dataset_name").cast("string")),
            bound["data_source"].as_text(),
        ),
        "data_source_id": F.coalesce(
            blank_to_null(lineage("dataset_id").cast("string")),
            bound["data_source_id"].as_text(),
        ),
        "record_id": lineage("record_index").cast("bigint"),
        "metadata": mapped.residual(bound),
    }
    cleaned = bound.df.select(
        *(F.col(c).alias(f"_keep_{c}") for c in carried),
        *(pick(n).alias(n) for n in cleaned_names),
        year_number(bound["year"]).alias("_year"),
        *(c.alias(n) for n, c in direct.items()),
    )
    begun, ended = derive_period(*(F.col(c) for c in ("period_start", "period_end", "date", "_year")))
    derived = cleaned.select(
        "*",
        geography_level(F.col("state"), F.col("county"), F.col("fips_code")).alias("geography_level"),
        begun.alias("_begun"),
        ended.alias("_ended"),
    )
    replaced = {"period_start": F.col("_begun"), "period_end": F.col("_ended")}
    return derived.select(
        *(F.col(f"_keep_{c}").alias(c) for c in carried),
        *(
            replaced.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in CANONICAL.fields
        ),
    )


def enrich_with_metadata(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Fill missing indicator names and descriptions from a dataset's metadata.

    ``metadata`` is the one-row DataFrame of a metadata document. Its values
    enter as scalars, so the records are neither joined nor shuffled.
    """

    def known(column: str) -> Column:
        return blank_to_null(metadata.select(column).scalar())

    document = metadata.select(F.to_json(F.struct("*")).alias("document")).scalar()
    entry = F.create_map(F.lit("dataset_metadata"), document)
    without_old = F.map_filter("metadata", lambda name, _: name != "dataset_metadata")
    return df.withColumns(
        {
            "indicator_name": F.coalesce(blank_to_null(F.col("indicator_name")), known("name")),
            "indicator_description": F.coalesce(
                blank_to_null(F.col("indicator_description")), known("description")
            ),
            "metadata": F.when(F.col("metadata").isNull(), entry).otherwise(
                F.map_concat(without_old, entry)
            ),
        }
    )

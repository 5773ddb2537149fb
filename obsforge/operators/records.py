"""Uniform access to tabular and ragged records.

Tabular: one typed column per field. Ragged: one VARIANT (or MAP) column that
holds the whole record, so a key may be absent, null or of any type.

``bind`` takes the wanted fields out of the records once, as narrow columns.
Everything built on the bound values refers to those columns, which keeps the
generated code small no matter how often a rule or cleaner looks at a value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsforge.functions.pyvalue import (
    FieldValue,
    field_value,
    is_text_type,
    strip,
    text_value,
    typed_parts,
    value_of_parts,
    variant_parts,
    variant_value,
)

LINEAGE = "_meta"


class BoundFields:
    """Fields taken out of the records of ``df``, under names of the caller's choice."""

    def __init__(self, df: DataFrame, values: Mapping[str, FieldValue]):
        self.df = df
        self._values = values

    def __getitem__(self, name: str) -> FieldValue:
        return self._values[name]


def _bound_texts(df: DataFrame, raws: Mapping[str, Column]) -> BoundFields:
    """Bind text columns: the text and its stripped form."""
    plain = df.withColumns({f"_raw_{n}": c.cast("string") for n, c in raws.items()})
    bound = plain.withColumns({f"_bare_{n}": strip(F.col(f"_raw_{n}")) for n in raws})
    return BoundFields(
        bound, {n: text_value(F.col(f"_raw_{n}"), F.col(f"_bare_{n}")) for n in raws}
    )


def _value_of_columns(name: str) -> FieldValue:
    return value_of_parts(F.col(f"_raw_{name}"), lambda part: F.col(f"_{part}_{name}"))


class TabularRecords:
    """Fields are the columns of a DataFrame."""

    def __init__(self, df: DataFrame, reserved: tuple[str, ...] = (LINEAGE,)):
        self._df = df
        self._types = {f.name: f.dataType for f in df.schema.fields if f.name not in reserved}

    @property
    def fields(self) -> list[str]:
        return list(self._types)

    def bind(self, wanted: Mapping[str, Sequence[str]]) -> BoundFields:
        """Bind each name to the first of its fields that is a column, else to NULL."""
        texts, parts, others = {}, {}, {}
        for name, fields in wanted.items():
            field = next((f for f in fields if f in self._types), None)
            if field is None:
                others[name] = text_value(F.lit(None).cast("string"))
            elif is_text_type(self._types[field]):
                texts[name] = F.col(f"`{field}`")
            else:
                column = F.col(f"`{field}`")
                parts[f"_raw_{name}"] = column
                for part, taken in typed_parts(column, self._types[field]).items():
                    parts[f"_{part}_{name}"] = taken
                others[name] = _value_of_columns(name)
        bound = _bound_texts(self._df, texts)
        values = {n: bound[n] for n in texts} | others
        return BoundFields(bound.df.withColumns(parts) if parts else bound.df, values)

    def non_empty(self) -> Column:
        return F.lit(bool(self._types))

    def entries(self, dropped: Sequence[str] = ()) -> Column:
        """Fields as a map of texts, without the dropped ones."""
        kept = [f for f in self._types if f not in dropped]
        values = {f: field_value(F.col(f"`{f}`"), self._types[f]).as_text() for f in kept}
        pairs = [c for f, v in values.items() for c in (F.lit(f), v)]
        return F.create_map(*pairs).cast("map<string,string>")


class RaggedRecords:
    """Fields are the keys of one VARIANT or MAP<STRING, STRING> column."""

    def __init__(self, df: DataFrame, column: str):
        self._df = df
        self._column = F.col(column)
        self._dtype = df.schema[column].dataType
        if not isinstance(self._dtype, (T.VariantType, T.MapType)):
            raise TypeError(f"{column} must be VARIANT or MAP, not {self._dtype.simpleString()}")
        self._variant = isinstance(self._dtype, T.VariantType)

    def value(self, field: str) -> FieldValue:
        """One field on its own, for a filter."""
        if self._variant:
            raw = F.try_variant_get(self._column, f'$["{field}"]', "variant")
            return field_value(raw, T.VariantType())
        return text_value(F.try_element_at(self._column, F.lit(field)).cast("string"))

    def bind(self, wanted: Mapping[str, Sequence[str]]) -> BoundFields:
        """Bind each name to the first of its keys present in the record.

        A key with a null value is present. The record is opened once into a map
        of the entries it has; every name is a lookup in that map.
        """
        absent = {n: text_value(F.lit(None).cast("string")) for n, f in wanted.items() if not f}
        present = {n: fields for n, fields in wanted.items() if fields}
        if not self._variant:
            chains = {n: self._first_key(fields) for n, fields in present.items()}
            bound = _bound_texts(self._df, chains)
            return BoundFields(bound.df, {n: bound[n] for n in present} | absent)
        opened = self._df.withColumn(
            "_entries", variant_parts(F.try_variant_get(self._column, "$", "map<string,variant>"))
        )
        entry = lambda field: F.try_element_at("_entries", F.lit(field))
        taken = opened.withColumns(
            {f"_field_{n}": F.coalesce(*map(entry, fields)) for n, fields in present.items()}
        )
        values = {n: variant_value(F.col(f"_field_{n}.scalar"), F.col(f"_field_{n}")) for n in present}
        return BoundFields(taken, values | absent)

    def _first_key(self, fields: Sequence[str]) -> Column:
        chain = F
        for field in fields:
            found = F.try_element_at(self._column, F.lit(field))
            chain = chain.when(F.map_contains_key(self._column, field), found)
        return chain

    def non_empty(self) -> Column:
        if self._variant:
            return F.schema_of_variant(self._column) != "OBJECT<>"
        return F.size(self._column) > 0

    def entries(self, dropped: Sequence[str] = ()) -> Column:
        """Entries of a bound record as a map of texts, without the dropped keys."""
        whole = F.col("_entries") if self._variant else self._column.cast("map<string,string>")
        kept = F.map_filter(whole, lambda name, _: ~name.isin(*dropped)) if dropped else whole
        return F.transform_values(kept, lambda _, v: v["scalar"]) if self._variant else kept


Records = TabularRecords | RaggedRecords


def records_of(df: DataFrame, record: str | None = None, keep: tuple[str, ...] = ()) -> Records:
    """Ragged access through column ``record`` if named, else tabular access.

    ``keep`` names columns which are bookkeeping, not fields of the record.
    """
    if record is not None:
        return RaggedRecords(df, record)
    return TabularRecords(df, reserved=(LINEAGE, *keep))

"""Dynamically typed field values as Columns.

Source records are loosely typed: a field may hold text, a number, a flag, a
date, a nested value or nothing, and rules and cleaners decide by that type.
``FieldValue`` answers those questions with Columns. For text columns most answers are
constants which Catalyst folds away; other values are taken apart into kind,
text form, number and date.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters stripped from both ends of a text.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same characters as the inside of a regular-expression class.
SPACE_CLASS = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

_DIGITS = r"\d+(_\d+)*"
FLOAT_TEXT = (
    rf"(?i)\A[+-]?(nan|inf|infinity|({_DIGITS}\.?({_DIGITS})?|\.{_DIGITS})(e[+-]?{_DIGITS})?)\z"
)
INTEGER_TEXT = rf"\A[+-]?{_DIGITS}\z"

def _absent(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def strip(text: Column) -> Column:
    """Remove surrounding whitespace."""
    return F.trim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def parse_float(text: Column, stripped: bool = False) -> Column:
    """Double written by ``text``, or NULL; accepts nan, inf and ``1_000``."""
    bare = text if stripped else strip(text)
    number = F.replace(bare, F.lit("_"), F.lit("")).try_cast("double")
    # past the pattern only a signed nan still fails to cast
    return F.when(bare.rlike(FLOAT_TEXT), F.coalesce(number, F.lit(float("nan"))))


def parse_int(text: Column, stripped: bool = False) -> Column:
    """Integer written by ``text``, or NULL."""
    bare = text if stripped else strip(text)
    return F.when(bare.rlike(INTEGER_TEXT), F.replace(bare, F.lit("_"), F.lit("")).try_cast("bigint"))


def float_text(number: Column) -> Column:
    """Shortest decimal text of a double: ``123456789.0``, ``1e+16``, ``nan``."""
    spelled = number.cast("string")
    usual = F.replace(F.lower(spelled), F.lit("infinity"), F.lit("inf"))
    size = F.abs(number)
    plain = F.regexp_replace(
        number.try_cast("decimal(38,16)").cast("string"), r"(\.\d+?)0+$", "$1"
    )
    short = F.regexp_replace(usual, r"\.0e", "e")
    signed = F.regexp_replace(F.regexp_replace(short, r"e(\d)", "e+$1"), r"e-(\d)$", "e-0$1")
    return (
        F.when(~spelled.contains("E"), usual)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(signed)
    )


class FieldValue:
    """One field of a record, with its dynamic type.

    ``scalar`` is the text form of a text, number or flag; ``stripped`` the same
    without surrounding whitespace. Columns are built when first asked for.
    """

    raw: Column
    none: Column
    is_text: Column
    is_number: Column
    is_date: Column
    is_timestamp: Column
    scalar: Column
    stripped: Column
    number: Column
    date: Column
    shown: Column
    type_name: Column

    @property
    def text(self) -> Column:
        """The text itself; meaningful only where ``is_text`` holds."""
        return self.scalar

    @cached_property
    def missing(self) -> Column:
        """Nothing there: no value, or an empty text."""
        return self.none | (self.is_text & (self.scalar == ""))

    @cached_property
    def falsy(self) -> Column:
        return self.missing | self.hollow | (self.is_number & (self.number == 0))

    @property
    def hollow(self) -> Column:
        """An empty list or object."""
        return F.lit(False)

    def as_float(self) -> Column:
        """The value as a double, NULL where it does not read as one."""
        return F.when(self.is_number, self.number).when(
            self.is_text, parse_float(self.stripped, stripped=True)
        )

    def as_int(self) -> Column:
        """The value as an integer; fractions of numbers are cut off."""
        return F.when(self.is_number, self.number.try_cast("bigint")).when(
            self.is_text, parse_int(self.stripped, stripped=True)
        )

    def as_text(self) -> Column:
        """Text form, NULL when there is no value."""
        return F.when(~self.none, self.shown)

    def truthy_text(self) -> Column:
        return F.when(~self.falsy, self.shown)


class TextValue(FieldValue):
    """A value known to be text or nothing."""

    def __init__(self, text: Column, stripped: Column | None = None):
        self.raw = self.scalar = text
        self._stripped = stripped

    none = cached_property(lambda self: self.scalar.isNull())
    is_text = cached_property(lambda self: self.scalar.isNotNull())
    is_number = is_date = is_timestamp = property(lambda self: F.lit(False))
    number = property(lambda self: _absent("double"))
    date = property(lambda self: _absent("date"))
    shown = cached_property(lambda self: F.coalesce(self.scalar, F.lit("None")))
    type_name = property(lambda self: F.lit("str"))
    missing = cached_property(lambda self: self.none | (self.scalar == ""))
    falsy = property(lambda self: self.missing)

    @cached_property
    def stripped(self) -> Column:
        return strip(self.scalar) if self._stripped is None else self._stripped

    def as_float(self) -> Column:
        return parse_float(self.stripped, stripped=True)

    def as_int(self) -> Column:
        return parse_int(self.stripped, stripped=True)

    def as_text(self) -> Column:
        return self.scalar

    def truthy_text(self) -> Column:
        return blank_to_null(self.scalar)


# Kinds of numbers, flags included.
_NUMBERS = ("int", "float", "bool")


class PartsValue(FieldValue):
    """A value taken apart beforehand into kind, text form, number, date and bare text."""

    def __init__(self, raw: Column, part: Callable[[str], Column]):
        self.raw = raw
        self._part = part

    kind = cached_property(lambda self: self._part("kind"))
    scalar = cached_property(lambda self: self._part("scalar"))
    stripped = cached_property(lambda self: self._part("bare"))
    number = cached_property(lambda self: self._part("number"))
    date = cached_property(lambda self: self._part("date"))
    type_name = cached_property(lambda self: F.coalesce(self.kind, F.lit("NoneType")))
    none = cached_property(lambda self: self.type_name == "NoneType")
    is_text = cached_property(lambda self: self.type_name == "str")
    is_number = cached_property(lambda self: self.type_name.isin(*_NUMBERS))
    is_date = cached_property(lambda self: self.type_name.isin("date", "datetime"))
    is_timestamp = cached_property(lambda self: self.type_name == "datetime")
    hollow = cached_property(
        lambda self: self.type_name.isin("list", "dict") & F.coalesce(self.scalar.isin("[]", "{}"), F.lit(False))
    )
    shown = cached_property(lambda self: F.coalesce(self.scalar, F.lit("None")))

    def as_text(self) -> Column:
        return self.scalar


def text_value(text: Column, stripped: Column | None = None) -> FieldValue:
    return TextValue(text, stripped)


def value_of_parts(raw: Column, parts: Callable[[str], Column]) -> FieldValue:
    return PartsValue(raw, parts)


# Kind of a value by its JSON type.
_KINDS = {
    "STRING": "str", "BIGINT": "int", "DECIMAL": "float", "DOUBLE": "float", "FLOAT": "float",
    "BOOLEAN": "bool", "VOID": "NoneType", "OBJECT": "dict", "ARRAY": "list",
}


def _read_variant(_: Column, value: Column) -> Column:
    """Kind and plain text of a VARIANT, each from a single look at it."""
    tag = F.schema_of_variant(value)
    head = F.substring_index(F.substring_index(tag, "(", 1), "<", 1)
    names = F.create_map(*(F.lit(x) for pair in _KINDS.items() for x in pair))
    plain = F.try_variant_get(value, "$", "string")
    return F.struct(F.try_element_at(names, head).alias("kind"), plain.alias("plain"))


def _shape_parts(_: Column, known: Column) -> Column:
    kind, plain = known["kind"], known["plain"]
    # the usual decimals already read right; only tiny, huge and scientific ones do not
    unusual = plain.contains("E") | (F.length(plain) > 16) | plain.rlike(r"\A-?0\.0000")
    decimal = F.when(unusual, float_text(plain.try_cast("double"))).otherwise(
        F.when(plain.contains("."), plain).otherwise(F.concat(plain, F.lit(".0")))
    )
    scalar = (
        F.when(kind == "float", decimal).when(kind == "bool", F.initcap(plain)).otherwise(plain)
    )
    number = F.when(kind.isin("int", "float"), plain.try_cast("double")).when(
        kind == "bool", (plain == "true").cast("double")
    )
    bare = F.when(kind == "str", strip(plain)).when(kind.isin(*_NUMBERS), scalar)
    return F.struct(
        kind.alias("kind"), scalar.alias("scalar"), number.alias("number"), bare.alias("bare")
    )


def variant_parts(values: Column) -> Column:
    """Parts of every VARIANT in a map, as a map of structs.

    All values share one expression, so plans stay small for any number of
    fields, and only entries that exist cost anything.
    """
    return F.transform_values(F.transform_values(values, _read_variant), _shape_parts)


def typed_parts(column: Column, dtype: T.DataType) -> dict[str, Column]:
    """Parts of a column of any type but VARIANT."""
    number, day, shown = _absent("double"), _absent("date"), column.cast("string")
    if isinstance(dtype, T.BooleanType):
        kind, number, shown = "bool", column.cast("double"), F.initcap(column.cast("string"))
    elif isinstance(dtype, T.IntegralType):
        kind, number = "int", column.cast("double")
    elif isinstance(dtype, (T.FractionalType, T.DecimalType)):
        kind, number = "float", column.cast("double")
        shown = float_text(column.cast("double"))
    elif isinstance(dtype, T.DateType):
        kind, day = "date", column
    elif isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        kind, day = "datetime", column.cast("date")
    elif isinstance(dtype, (T.StructType, T.MapType, T.ArrayType)):
        kind = "list" if isinstance(dtype, T.ArrayType) else "dict"
        shown = F.to_json(column)
    else:
        kind = "str"
    named = F.when(column.isNull(), F.lit("NoneType")).otherwise(F.lit(kind))
    bare = strip(shown) if kind in ("str", *_NUMBERS) else _absent("string")
    return {"kind": named, "scalar": shown, "number": number, "date": day, "bare": bare}


def is_text_type(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.NullType))


def field_value(column: Column, dtype: T.DataType) -> FieldValue:
    """View ``column`` of Spark type ``dtype`` as a dynamically typed value.

    Handy for single expressions. Operators which use a value many times take
    it apart into columns first (``operators.records``).
    """
    if is_text_type(dtype):
        return text_value(column.cast("string"))
    if isinstance(dtype, T.VariantType):
        return variant_value(column, variant_parts(F.create_map(F.lit(0), column))[0])
    return value_of_parts(column, typed_parts(column, dtype).__getitem__)


def variant_value(raw: Column, parts: Column) -> FieldValue:
    """A VARIANT whose parts are at hand as a struct."""
    return value_of_parts(raw, lambda part: _absent("date") if part == "date" else parts[part])

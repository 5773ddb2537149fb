"""Filters, mapping and transformation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import sql as q
from checks.registry import Data, query
from obsforge.functions.predicates import filter_condition
from obsforge.functions.pyvalue import float_text, text_value
from obsforge.functions.user import user_transform
from obsforge.operators import mapping
from obsforge.sources.pages import scan

_ORDERS = "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey FROM orders"


def _filtered(name: str, filters: dict, where: str):
    @query(name, f"{_ORDERS} WHERE {where}")
    def run(data: Data) -> DataFrame:
        found = scan(data.orders, filter_condition(filters))
        return found.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")


_filtered("filter_eq", {"o_orderstatus": "F"}, "o_orderstatus = 'F'")
_filtered(
    "filter_in", {"o_orderpriority": ["1-URGENT", "5-LOW"]}, "o_orderpriority IN ('1-URGENT', '5-LOW')"
)
_filtered(
    "filter_conj",
    {"o_orderstatus": "O", "o_custkey": [1, 2, 3, 5, 8, 13, 21, 34, 55, 89], "ignored": {"a": 1}},
    "o_orderstatus = 'O' AND o_custkey IN (1, 2, 3, 5, 8, 13, 21, 34, 55, 89)",
)


@query("filter_expr", f"{_ORDERS} WHERE o_totalprice > 100000 OR o_orderstatus = 'P'")
def filter_expr(data: Data) -> DataFrame:
    found = scan(data.orders, F.expr("o_totalprice > 100000 OR o_orderstatus = 'P'"))
    return found.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_custkey")


@query(
    "order_limit_offset",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 20",
)
def order_limit_offset(data: Data) -> DataFrame:
    rows = data.orders.select("o_orderkey", "o_totalprice")
    return scan(rows, order=[F.desc("o_totalprice"), F.asc("o_orderkey")], limit=50, offset=20)


@query(
    "map_fields",
    f"SELECT record_index, {q.clean_state('state')} AS st, {q.clean_fips('fips_code')} AS place, "
    f"value AS amount, date, age_group, gender, race, year, county FROM ({q.DIRTY}) d",
)
def map_fields(data: Data) -> DataFrame:
    from obsforge.functions.clean import clean_fips_code, clean_state_code

    aliases = {"st": ("state",), "place": ("fips", "fips_code"), "amount": ("value",)}
    return mapping.map_fields(
        data.dirty(), aliases, {"st": clean_state_code, "place": clean_fips_code},
        keep=("record_index",),
    )


@query(
    "map_defaults",
    f"SELECT record_index, {q.clean_state('state')} AS state, {q.clean_county('county')} AS county, "
    f"{q.clean_fips('fips_code')} AS fips_code, {q.clean_date('date')} AS date, "
    f"{q.number_text(q.clean_numeric('value'))} AS value, year, CAST(NULL AS VARCHAR) AS measure FROM ({q.DIRTY}) d",
)
def map_defaults(data: Data) -> DataFrame:
    mapped = mapping.map_fields(data.dirty(), keep=("record_index",))
    return mapped.select(
        "record_index", "state", "county", "fips_code", "date",
        float_text(F.col("value")).alias("value"), "year", "measure",
    )


def ragged(data: Data) -> DataFrame:
    return data.ragged().select("record_index", F.parse_json("body").alias("record"))


# The winner among value, cases, deaths and rate, in that order of registration.
_WINNER = (
    "CASE WHEN k % 5 = 1 THEN 1.0 WHEN k % 5 = 0 THEN 2.5 WHEN k % 3 = 0 THEN NULL "
    "WHEN k % 3 = 1 THEN CAST(k * 10 + 5 AS DOUBLE) ELSE CAST(k AS DOUBLE) END"
)
_FIPS = "CASE k % 6 WHEN 0 THEN '06037' WHEN 1 THEN '06' WHEN 2 THEN '60' END"
_STATE = "CASE k % 4 WHEN 0 THEN 'NY' WHEN 1 THEN NULL ELSE 'OH' END"
_UNIT = "CASE k % 7 WHEN 0 THEN 'own' WHEN 1 THEN 'mapped' END"
_KEYED = "(SELECT *, o_orderkey AS k FROM orders) o"


@query(
    "map_last_wins",
    f"SELECT k AS record_index, {q.number_text(_WINNER)} AS value, {_STATE} AS state, {_FIPS} AS fips_code, "
    f"{_UNIT} AS unit, CAST(year(o_orderdate) AS VARCHAR) AS year FROM {_KEYED}",
)
def map_last_wins(data: Data) -> DataFrame:
    mapped = mapping.map_fields(ragged(data), record="record", keep=("record_index",))
    return mapped.select(
        "record_index", float_text(F.col("value")).alias("value"), "state", "fips_code", "unit", "year"
    )


@query(
    "derive_period",
    f"SELECT record_index, period_start, period_end FROM ({q.OBSERVED}) o",
)
def derive_period(data: Data) -> DataFrame:
    from obsforge.functions.clean import clean_date

    nothing = F.lit(None).cast("date")
    begun, ended = mapping.derive_period(
        nothing, nothing, clean_date(F.col("date")),
        mapping.year_number(text_value(F.col("year"))),
    )
    return data.dirty().select(
        "record_index", begun.alias("period_start"), ended.alias("period_end")
    )


@query("geo_level", f"SELECT record_index, geography_level FROM ({q.OBSERVED}) o")
def geo_level(data: Data) -> DataFrame:
    mapped = mapping.map_fields(data.dirty(), keep=("record_index",))
    level = mapping.geography_level(F.col("state"), F.col("county"), F.col("fips_code"))
    return mapped.select("record_index", level.alias("geography_level"))


def observed(data: Data, **options) -> DataFrame:
    return mapping.to_observation(
        data.dirty(), "ORDER_VALUE", "Order value", keep=("record_index",), **options
    )


@query(
    "to_observation",
    "SELECT record_index, state, county, fips_code, geography_level, period_start, period_end, "
    f"{q.number_text('value')} AS value, 'ORDER_VALUE' AS indicator_code, 'Order value' AS indicator_name, "
    f"age_group, gender, race, CAST(NULL AS VARCHAR) AS data_source FROM ({q.OBSERVED}) o",
)
def to_observation(data: Data) -> DataFrame:
    return observed(data).select(
        "record_index", "state", "county", "fips_code", "geography_level", "period_start", "period_end",
        float_text(F.col("value")).alias("value"), "indicator_code", "indicator_name",
        "age_group", "gender", "race", "data_source",
    )


@query(
    "residual_map",
    "SELECT k AS record_index, 3 AS n, o_orderstatus AS extra, "
    f"o_orderpriority AS measure, CAST(year(o_orderdate) AS VARCHAR) AS year FROM {_KEYED}",
)
def residual_map(data: Data) -> DataFrame:
    rest = mapping.to_observation(ragged(data), record="record", keep=("record_index",))
    kept = F.col("metadata")
    return rest.select(
        "record_index", F.size(kept).alias("n"),
        *(kept[name].alias(name) for name in ("extra", "measure", "year")),
    )


@query(
    "transform_batch",
    f"SELECT k AS record_index, {q.number_text(_WINNER)} AS value, {_STATE} AS state, {_FIPS} AS fips_code, "
    f"CASE WHEN ({_FIPS}) = '06037' THEN 'county' WHEN ({_STATE}) IS NOT NULL THEN 'state' ELSE 'nation' END AS geography_level, "
    "make_date(year(o_orderdate), 1, 1) AS period_start, make_date(year(o_orderdate), 12, 31) AS period_end, "
    f"o_orderpriority AS indicator_name, {_UNIT} AS indicator_unit FROM {_KEYED}",
)
def transform_batch(data: Data) -> DataFrame:
    from obsforge.plans.end_to_end import transform_batch as transform

    rows = transform(ragged(data), record="record", keep=("record_index",))
    return rows.select(
        "record_index", float_text(F.col("value")).alias("value"), "state", "fips_code",
        "geography_level", "period_start", "period_end", "indicator_name", "indicator_unit",
    )


@query(
    "enrich_metadata",
    "SELECT k AS record_index, CASE WHEN k % 3 = 0 THEN o_orderpriority ELSE (SELECT max(r_name) FROM region) END AS indicator_name, "
    "(SELECT min(r_name) FROM region) AS indicator_description, (SELECT max(r_name) FROM region) AS document_name, "
    f"o_orderstatus AS extra FROM {_KEYED}",
)
def enrich_metadata(data: Data) -> DataFrame:
    metadata = data.region.agg(
        F.max("r_name").alias("name"), F.min("r_name").alias("description"),
        F.array(F.struct(F.lit("a").alias("name"), F.lit("text").alias("dataTypeName"))).alias("columns"),
    )
    rows = mapping.to_observation(ragged(data), record="record", keep=("record_index",))
    named = F.when(F.col("record_index") % 3 == 0, F.col("indicator_name")).otherwise(F.lit(""))
    enriched = mapping.enrich_with_metadata(rows.withColumn("indicator_name", named), metadata)
    document = F.col("metadata")["dataset_metadata"]
    return enriched.select(
        "record_index", "indicator_name", "indicator_description",
        F.get_json_object(document, "$.name").alias("document_name"),
        F.col("metadata")["extra"].alias("extra"),
    )


def _cents(values):
    def cents(value: str) -> str:
        whole, part = value.split(".")
        return f"{int(whole)}{int(part):02}"

    return values.map(cents)


@query(
    "transform_user_raises",
    r"SELECT record_index, CASE WHEN regexp_matches(value, '^\d+\.\d\d$') THEN replace(value, '.', '') ELSE value END AS value, "
    r"CASE WHEN regexp_matches(year, '^\d+$') THEN year::BIGINT - 1990 END AS year "
    f"FROM (SELECT record_index, CASE WHEN value LIKE '-%' THEN 'minus' ELSE value END AS value, year FROM ({q.DIRTY}) d) d",
)
def transform_user_raises(data: Data) -> DataFrame:
    rows = data.dirty().withColumn("value", F.when(F.col("value").startswith("-"), "minus").otherwise(F.col("value")))
    transforms = {"value": user_transform(_cents), "year": user_transform(lambda year: int(year) - 1990, "bigint", each=True)}
    aliases = {"value": ("value",), "year": ("year",)}
    return mapping.map_fields(rows, aliases, transforms, keep=("record_index",), targets=["value", "year"])

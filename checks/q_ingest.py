"""Landed pages, extraction and the whole way from pages to answers."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import sql as q
from checks.registry import Data, query
from obsforge.functions.rules import Rule, basic_rules, in_list, numeric
from obsforge.operators.mapping import DEFAULT_ALIASES, with_alias
from obsforge.plans import star_queries as star
from obsforge.plans.end_to_end import RunResult, run_dataset
from obsforge.plans.loading import load_batch
from obsforge.schema import CANONICAL
from obsforge.session import scratch_path, staged
from obsforge.sources import pages
from obsforge.sources.warehouse import Warehouse

AT = datetime(2024, 1, 1)
PAGE = 500

# One event as a JSON record; runs on both engines.
_EVENT = (
    "concat('{\"event_id\":', CAST(event_id AS STRING), ',\"kind\":\"', event_type, '\",\"user\":', CAST(user_id AS STRING), "
    "',\"props\":', props, '}')"
)
_SHAPE = f"(event_id DIV {PAGE}) % 4"


def event_pages(data: Data, mixed: bool = False) -> DataFrame:
    """Response pages of 500 events each; ``mixed`` alternates the response shapes."""
    shape = F.expr(_SHAPE)
    item = F.expr(_EVENT)
    if mixed:
        lone = (F.col("event_id") % 7 == 0) & (F.col("event_id") % PAGE > 0)
        wrapped = F.when(lone, F.concat(F.lit('{"other":'), item, F.lit("}"))).otherwise(
            F.concat(F.lit('{"row":'), item, F.lit("}"))
        )
        item = F.when(shape == 1, wrapped).when(shape == 3, F.concat(F.lit("["), item, F.lit("]"))).otherwise(item)
    rows = data.events.select(
        "event_id", F.expr(f"event_id DIV {PAGE}").alias("page_no"), shape.alias("shape"), item.alias("item")
    )
    # a page holds at most 500 records, so the groups are small by construction
    listed = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("event_id", "item"))), lambda r: r["item"]), ","
    )
    body = F.concat(F.lit("["), listed, F.lit("]"))
    grouped = rows.groupBy("page_no", "shape").agg(body.alias("body"))
    if mixed:
        enclosed = F.concat(F.lit('{"meta":{},"data":'), F.col("body"), F.lit("}"))
        grouped = grouped.withColumn(
            "body", F.when(F.col("shape") == 2, enclosed).otherwise(F.col("body"))
        )
    return grouped.select("page_no", "body")


def _fields(records: DataFrame, *columns: str) -> DataFrame:
    return records.select(
        *columns,
        F.try_variant_get("record", "$.event_id", "bigint").alias("event_id"),
        F.try_variant_get("record", "$.kind", "string").alias("kind"),
        F.try_variant_get("record", "$.props.k", "bigint").alias("k"),
    )


_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k"


@query(
    "normalize_pages",
    f"SELECT page_no, pos, CASE WHEN lone THEN NULL ELSE event_id END AS event_id, CASE WHEN lone THEN NULL ELSE event_type END AS kind, "
    f"CASE WHEN lone THEN NULL ELSE k END AS k FROM (SELECT event_id // {PAGE} AS page_no, event_id % {PAGE} AS pos, event_id, event_type, {_K}, "
    f"(event_id // {PAGE}) % 4 = 1 AND event_id % 7 = 0 AND event_id % {PAGE} > 0 AS lone, (event_id // {PAGE}) % 4 AS shape FROM events) e "
    "WHERE shape < 2",
)
def normalize_pages(data: Data) -> DataFrame:
    return _fields(pages.normalize_pages(event_pages(data, mixed=True)), "page_no", "pos")


def _landed(data: Data, resource: bool = True) -> str:
    root = scratch_path(data.spark, "landing")
    pages.land_pages(event_pages(data), pages.page_folder(root, "events", resource))
    return root


@query(
    "scan_pages",
    f"SELECT event_id // {PAGE} AS page_no, event_id % {PAGE} AS pos, event_id, event_type AS kind, {_K} FROM events",
)
def scan_pages(data: Data) -> DataFrame:
    folder = pages.page_folder(_landed(data), "events", True)
    return _fields(pages.normalize_pages(pages.read_pages(data.spark, folder)), "page_no", "pos")


@query(
    "paged_scan",
    f"SELECT row_number() OVER (ORDER BY event_id) - 1 AS record_index, event_id, event_type AS kind, {_K} FROM events",
)
def paged_scan(data: Data) -> DataFrame:
    return _fields(pages.paged_scan(event_pages(data)), "record_index")


@query(
    "paged_scan_uneven",
    f"SELECT row_number() OVER (ORDER BY event_id) - 1 AS record_index, event_id, event_type AS kind, {_K} FROM events",
)
def paged_scan_uneven(data: Data) -> DataFrame:
    """Pages of one record, then of many more, with gaps in their numbers."""
    records = pages.normalize_pages(event_pages(data)).select(F.to_json("record").alias("item"))
    numbered = records.select("item", F.get_json_object("item", "$.event_id").cast("bigint").alias("event_id"))
    paged = numbered.withColumn("page_no", 3 * F.floor(F.sqrt(F.col("event_id"))))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "item"))), lambda r: r["item"]), ",")
    body = F.concat(F.lit("["), listed, F.lit("]")).alias("body")
    return _fields(pages.paged_scan(paged.groupBy("page_no").agg(body)), "record_index")


@query(
    "extract_numbers",
    "SELECT row_number() OVER (ORDER BY event_id) - 1 AS record_index, event_id FROM events WHERE event_id % 4 = 1",
)
def extract_numbers(data: Data) -> DataFrame:
    """Whole numbers past 2^53, and a list of numbers against a number, a decimal number and a text."""
    item = F.expr(
        "concat('{\"event_id\":', event_id, ',\"big\":', 9007199254740992 + event_id % 4, ',\"y\":',"
        " CASE event_id % 3 WHEN 0 THEN '2023' WHEN 1 THEN '2023.0' ELSE '\"2023\"' END, '}')"
    )
    rows = data.events.select("event_id", F.expr(f"event_id DIV {PAGE}").alias("page_no"), item.alias("item"))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("event_id", "item"))), lambda r: r["item"]), ",")
    root = scratch_path(data.spark, "landing")
    body = F.concat(F.lit("["), listed, F.lit("]")).alias("body")
    pages.land_pages(rows.groupBy("page_no").agg(body), pages.page_folder(root, "numbers", True))
    wanted = {"big": 9007199254740993, "y": [2023, 1999]}
    records, _ = pages.extract(data.spark, root, "numbers", "run-1", AT, filters=wanted, use_resource_endpoint=True)
    return records.select("record_index", F.try_variant_get("record", "$.event_id", "bigint").alias("event_id"))


_LINEAGE = (
    "'events' AS dataset_id, 'Event log' AS dataset_name, 'run-1' AS run_id, '2024-01-01T00:00:00' AS ingested_at, "
    "'cdc_open_data_api' AS source"
)


@query(
    "lineage",
    f"SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS record_index, {_LINEAGE} FROM events",
)
def lineage(data: Data) -> DataFrame:
    numbered = pages.paged_scan(event_pages(data))
    found = pages.with_lineage(numbered, "events", "Event log", "run-1", AT)
    return found.select(F.try_variant_get("record", "$.event_id", "bigint").alias("event_id"), "_meta.*")


@query(
    "extract",
    f"SELECT row_number() OVER (ORDER BY event_id) - 1 AS record_index, event_id, event_type AS kind, {_K}, (SELECT count(*) FROM events WHERE event_type IN ('click', 'view')) AS records_extracted, "
    "'success' AS status FROM events WHERE event_type IN ('click', 'view')",
)
def extract(data: Data) -> DataFrame:
    records, info = pages.extract(
        data.spark, _landed(data, resource=False), "events", "run-1", AT, "Event log",
        filters={"kind": ["click", "view"]},
    )
    return _fields(records, "record_index").withColumns(
        {
            "records_extracted": info.select("records_extracted").scalar(),
            "status": info.select("status").scalar(),
        }
    )


@query(
    "dataset_columns",
    "SELECT 'block-' || (p_partkey // 100) AS dataset, CAST(p_partkey % 100 AS INTEGER) AS position, p_name AS name, p_type AS type FROM part",
)
def dataset_columns(data: Data) -> DataFrame:
    # one metadata document per block of 100 parts
    described = F.transform(
        F.sort_array(F.collect_list(F.struct("p_partkey", F.col("p_name").alias("name"), F.col("p_type").alias("dataTypeName")))),
        lambda c: F.struct(c["name"].alias("name"), c["dataTypeName"].alias("dataTypeName")),
    )
    block = F.expr("p_partkey DIV 100").cast("string")
    documents = data.part.groupBy(F.concat(F.lit("block-"), block).alias("name")).agg(
        F.lit("parts").alias("description"), described.alias("columns")
    )
    path = scratch_path(data.spark, "metadata")
    # one file per document, as an endpoint would deliver it
    documents.select(
        F.col("name").alias("document"), F.to_json(F.struct("name", "description", "columns")).alias("value")
    ).write.partitionBy("document").text(path)
    return pages.dataset_columns(pages.read_dataset_metadata(data.spark, path))


# --- the whole way -------------------------------------------------------------

def dirty_pages(data: Data) -> DataFrame:
    """Response pages of the loosely formatted records, numbered by record index."""
    rows = data.dirty()
    fields = [c for c in rows.columns if c != "record_index"]
    packed = rows.select("record_index", F.to_json(F.struct(*fields)).alias("item"))
    listed = F.array_join(
        F.transform(F.sort_array(F.collect_list(F.struct("record_index", "item"))), lambda r: r["item"]), ","
    )
    return packed.groupBy(F.expr(f"record_index DIV {PAGE}").alias("page_no")).agg(
        F.concat(F.lit("["), listed, F.lit("]")).alias("body")
    )


def loaded(data: Data, **options) -> tuple[Warehouse, RunResult]:
    root = scratch_path(data.spark, "landing")
    pages.land_pages(dirty_pages(data), pages.page_folder(root, "orders", True))
    warehouse = Warehouse(data.spark, scratch_path(data.spark, "warehouse")).create()
    settings = {
        "rules": basic_rules(F.lit(q.AS_OF).cast("date")),
        "indicator_code": "ORDER_VALUE", "indicator_name": "Order value",
        **options,
    }
    result = run_dataset(
        warehouse, root, "orders", "Orders", use_resource_endpoint=True,
        run_id="run-1", at=AT, **settings,
    )
    return warehouse, result


def _end_to_end_sql(valid: str) -> str:
    """Facts of the valid records, by natural key, in SQL."""
    from checks.q_load import _GEO, _STRATA, _geo_ctes

    none = _GEO + " WHERE n_nationkey < 0"
    ctes = _geo_ctes().replace(_GEO, none).replace(
        f"FROM ({q.OBSERVED}) ob", f"FROM ({q.OBSERVED}) ob WHERE record_index IN ({valid})"
    ).replace("SELECT max(id) AS top FROM ex", "SELECT 0 AS top")
    return ctes + f""",
strat AS (SELECT record_index, {_STRATA} FROM ({q.DIRTY}) d),
rows AS (SELECT o.record_index, p.geography_id, m.level, m.state, m.county, m.fips_code, t.dimension, t.value AS stratum,
    o.period_start, o.period_end, TRY_CAST(CAST(o.value AS VARCHAR) AS DECIMAL(15,4)) AS value
  FROM ({q.OBSERVED}) o JOIN placed p ON o.record_index = p.record_index JOIN mem m ON m.id = p.geography_id
  JOIN strat t ON t.record_index = o.record_index
  WHERE o.period_start IS NOT NULL AND o.value IS NOT NULL AND o.value >= 0),
facts AS (SELECT level, state, county, fips_code, dimension, stratum, period_start, period_end,
    arg_max(value, record_index) AS value, 'Orders' AS data_source FROM rows GROUP BY ALL)
"""


_VALID = f"SELECT record_index FROM ({q.validated(q.DIRTY)}) v WHERE status <> 'invalid'"


def _facts(warehouse: Warehouse) -> DataFrame:
    place = warehouse.table("geography").select(
        F.col("id").alias("geography_id"), "level", "state", "county", "fips_code"
    )
    strata = warehouse.table("stratifier").select(
        F.col("id").alias("stratifier_id"), "dimension", F.col("value").alias("stratum")
    )
    joined = warehouse.table("observation").join(place, "geography_id").join(strata, "stratifier_id", "left")
    return joined.select(
        "level", "state", "county", "fips_code", "dimension", "stratum", "period_start", "period_end",
        "value", "data_source",
    )


@query("end_to_end", _end_to_end_sql(_VALID) + "SELECT * FROM facts")
def end_to_end(data: Data) -> DataFrame:
    warehouse, _ = loaded(data)
    return _facts(warehouse)


# Only the value is checked, and races stand in for the place's county.
_CUSTOM = (("value", q.rule_numeric, False), ("gender", lambda x: (
    f"CASE WHEN {x} NOT IN ('Male') THEN 'Value ''' || {x} || ''' not in allowed values: [''Male'']' END"), True))
_VALID_CUSTOM = f"SELECT record_index FROM ({q.validated(q.DIRTY, _CUSTOM)}) v WHERE status <> 'invalid'"


@query("end_to_end_custom_rules", _end_to_end_sql(_VALID_CUSTOM) + "SELECT * FROM facts")
def end_to_end_custom_rules(data: Data) -> DataFrame:
    rules = [Rule("value", numeric), Rule("gender", in_list(["Male"]), warning_only=True)]
    aliases = with_alias(DEFAULT_ALIASES, "amount", "value")
    warehouse, _ = loaded(data, rules=rules, aliases=aliases)
    return _facts(warehouse)


@query(
    "stage_stats",
    _end_to_end_sql(_VALID) + f", chk AS ({q.validated(q.DIRTY)}), n AS (SELECT count(*) AS total, "
    "count(*) FILTER (status <> 'invalid') AS passed, count(*) FILTER (status = 'invalid') AS bad, count(*) FILTER (status = 'warning') AS warned, "
    "(SELECT count(*) FROM rows) AS good FROM chk) "
    "SELECT 1 AS position, 'ingestion' AS stage, 'success' AS status, total AS records_in, total AS records_out, 0 AS records_failed, 0 AS records_with_warnings FROM n "
    "UNION ALL SELECT 2, 'validation', 'completed', total, passed, bad, warned FROM n "
    "UNION ALL SELECT 3, 'transformation', 'completed', passed, passed, 0, 0 FROM n "
    "UNION ALL SELECT 4, 'loading', CASE WHEN passed = good THEN 'completed' WHEN good > 0 THEN 'partial' ELSE 'failed' END, passed, good, passed - good, 0 FROM n",
)
def stage_stats(data: Data) -> DataFrame:
    _, result = loaded(data)
    return result.stages.drop("duration_seconds", "run_id")


@query(
    "latest_after_load",
    _end_to_end_sql(_VALID) + "SELECT 'ORDER_VALUE' AS code, 'Order value' AS name, max(period_start) AS period_start, "
    # several facts may share the latest day, so the value is checked to be one of theirs
    "true AS value_known FROM facts",
)
def latest_after_load(data: Data) -> DataFrame:
    warehouse, _ = loaded(data)
    latest = star.latest_per_indicator(warehouse.newest_observations(), warehouse.table("indicator"))
    facts = _facts(warehouse).select("period_start", "value").distinct().withColumn("value_known", F.lit(True))
    known = latest.join(facts, ["period_start", "value"], "left")
    return known.select("code", "name", "period_start", F.coalesce("value_known", F.lit(False)).alias("value_known"))


# Facts of three loads with parts as indicators: the lines of orders, of which those with the same number count as one.
_LINES = (
    "SELECT l_orderkey * 8 + l_linenumber AS k, concat('PART_', CAST(min(l_partkey) % 20 AS STRING)) AS indicator_code, "
    "substring('ALAKAZARCACOCTDEFLGA', CAST(2 * (min(l_suppkey) % 10) + 1 AS INT), 2) AS state, CAST(min(l_shipdate) AS DATE) AS day, "
    "CAST(min(l_extendedprice) AS DOUBLE) AS price, l_orderkey % 3 AS batch FROM lineitem GROUP BY l_orderkey, l_linenumber"
)


def three_loads(data: Data) -> Warehouse:
    """A warehouse after loading the lines of every third order in turn, a day apart."""
    rows = staged(data._sql(_LINES.replace("FROM lineitem", "FROM {lineitem}"), "lineitem"), "lines")
    given = {
        "indicator_code": F.col("indicator_code"), "state": F.col("state"), "geography_level": F.lit("state"),
        "period_start": F.col("day"), "period_end": F.col("day"), "value": F.col("price"), "data_source": F.lit("Lines"),
    }
    columns = [given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CANONICAL.fields]
    warehouse = Warehouse(data.spark, scratch_path(data.spark, "warehouse")).create()
    for batch in range(3):
        observations = rows.where(F.col("batch") == batch).select("k", *columns)
        load_batch(warehouse, observations, "k", "Lines", f"run-{batch}", AT + timedelta(days=batch), indicator_from="row")
    return warehouse


# a fact is as old as the first load with its key, and has the value of the last record of the last such load
_FACTS = (
    f"WITH l AS ({_LINES}), f AS (SELECT indicator_code AS code, state, day, min(batch) AS came, arg_max(price, batch * 1000000000000 + k) AS price, "
    "arg_min(k, batch * 1000000000000 + k) AS first_k FROM l GROUP BY 1, 2, 3), "
    "base AS (SELECT batch, coalesce(sum(top) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ids "
    "FROM (SELECT batch, max(k) + 1 AS top FROM l GROUP BY batch) t), "
    "o AS (SELECT f.*, CAST(price AS DECIMAL(15,4)) AS value, CAST(ids + first_k + 1 AS BIGINT) AS id FROM f JOIN base ON batch = came) "
)


@query(
    "latest_of_warehouse",
    _FACTS + "SELECT code, code AS name, value, day AS period_start FROM "
    "(SELECT *, row_number() OVER (PARTITION BY code ORDER BY day DESC, id) AS rn FROM o) r WHERE rn = 1",
)
def latest_of_warehouse(data: Data) -> DataFrame:
    warehouse = three_loads(data)
    return star.latest_per_indicator(warehouse.newest_observations(), warehouse.table("indicator"))


@query(
    "recent_of_warehouse",
    _FACTS + "SELECT id, code AS indicator_code, code AS indicator_name, state, CAST(NULL AS VARCHAR) AS county, day AS period_start, value, "
    "'Lines' AS data_source FROM o ORDER BY came DESC, id DESC LIMIT 10",
)
def recent_of_warehouse(data: Data) -> DataFrame:
    return star.recent_of_warehouse(three_loads(data))


# Places of all levels, of none and of one that no member can have. A state's place may name a county, a metro is a
# member for each record, and a nation with a state needs a nation that is there already.
_LEVELS = (
    "SELECT o_orderkey AS k, CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'state' WHEN 3 THEN 'county' "
    "WHEN 4 THEN 'nation' WHEN 5 THEN 'metro' ELSE 'planet' END AS geography_level, "
    "CASE WHEN o_orderkey % 7 = 4 AND o_custkey % 4 > 0 THEN NULL ELSE substring('ALAKAZARCACOCTDEFLGA', CAST(2 * (o_custkey % 10) + 1 AS INT), 2) END AS state, "
    "CASE WHEN o_orderkey % 7 = 3 AND o_custkey % 3 > 0 THEN concat('County ', CAST(o_custkey % 7 AS STRING)) "
    "WHEN o_orderkey % 7 = 2 AND o_custkey % 3 = 0 THEN 'Seat' ELSE NULL END AS county, "
    "CAST(o_orderdate AS DATE) AS day, o_totalprice AS price FROM orders"
)


@query(
    "load_levels",
    f"WITH l AS ({_LEVELS}), first_nation AS (SELECT min(k) AS k FROM l WHERE geography_level = 'nation' AND state IS NULL), "
    "n AS (SELECT count(*) AS total, count(*) FILTER (geography_level = 'planet' OR (geography_level = 'nation' AND state IS NOT NULL "
    "AND k < (SELECT k FROM first_nation))) AS lost FROM l) "
    "SELECT 'partial' AS status, total AS records_processed, total - lost AS records_inserted, lost AS records_failed, "
    "(SELECT count(*) FROM (SELECT DISTINCT state FROM l WHERE coalesce(nullif(geography_level, ''), 'state') = 'state') s) AS states, "
    "(SELECT count(*) FROM (SELECT DISTINCT state, county FROM l WHERE geography_level = 'county' AND county IS NOT NULL) c) AS counties, "
    "(SELECT CAST(sign(count(*)) AS BIGINT) FROM l WHERE geography_level = 'nation' AND state IS NULL) AS nations, "
    "(SELECT count(*) FROM l WHERE geography_level = 'metro') AS metros, lost AS named FROM n",
)
def load_levels(data: Data) -> DataFrame:
    rows = data._sql(_LEVELS.replace("FROM orders", "FROM {orders}"), "orders")
    given = {"geography_level": "geography_level", "state": "state", "county": "county", "period_start": "day", "period_end": "day"}
    columns = [F.col(given[f.name]).cast(f.dataType).alias(f.name) if f.name in given
               else F.col("price").cast("double").alias("value") if f.name == "value"
               else F.lit("Orders").alias(f.name) if f.name == "data_source"
               else F.lit(None).cast(f.dataType).alias(f.name) for f in CANONICAL.fields]
    observations = rows.select("k", *columns)
    warehouse = Warehouse(data.spark, scratch_path(data.spark, "warehouse")).create()
    done = load_batch(warehouse, observations, "k", "Orders", "run-1", AT, "ORDER_VALUE")
    level = F.col("level")
    places = warehouse.table("geography").agg(
        F.count_if(level == "state").alias("states"),
        F.count_if((level == "county") & F.col("county").isNotNull()).alias("counties"),
        F.count_if(level == "nation").alias("nations"),
        F.count_if(level == "metro").alias("metros"),
    )
    named = F.regexp_count(F.col("error_message"), F.lit("level (planet|nation) with this place cannot be loaded"))
    return done.select(
        "status", "records_processed", "records_inserted", "records_failed",
        *(places.select(c).scalar().alias(c) for c in ("states", "counties", "nations", "metros")),
        # the message tells of the first ten
        F.when(named == F.least(F.lit(10), "records_failed"), F.col("records_failed")).otherwise(named).alias("named"),
    )

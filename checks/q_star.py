"""Star-schema questions, on a star bound to the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.q_load import _LOG, logged
from checks.registry import Data, query
from obsforge.plans import star_queries as star

_CODES = "AL,AK,AZ,AR,CA,CO,CT,DE,FL,GA,HI,ID,IL,IN,IA,KS,KY,LA,ME,MD,MA,MI,MN,MS,MO"

# part -> indicator, nation and region -> geography, market segment ->
# stratifier, orders and lineitem -> observation; run on both engines.
INDICATOR = (
    "SELECT CAST(p_partkey + 1 AS BIGINT) AS id, concat('PART_', CAST(p_partkey AS STRING)) AS code, p_name AS name, "
    "p_brand AS unit, p_type AS category FROM part"
)
GEOGRAPHY = (
    f"SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, substring('{_CODES}', n_nationkey * 3 + 1, 2) AS state, r_name AS state_name, "
    "CASE n_nationkey % 4 WHEN 0 THEN NULL ELSE n_name END AS county, CASE n_nationkey % 4 WHEN 0 THEN 'state' ELSE 'county' END AS level "
    "FROM nation JOIN region ON n_regionkey = r_regionkey "
    "UNION ALL SELECT CAST(101 + r_regionkey AS BIGINT), substring(r_name, 1, 2), r_name, NULL, 'state' FROM region"
)
STRATIFIER = "SELECT min(c_custkey) + 1 AS id, 'other' AS dimension, c_mktsegment AS value FROM customer GROUP BY c_mktsegment"
OBSERVATION = (
    "SELECT o_orderkey * 100000000 + l_partkey AS id, l_partkey + 1 AS indicator_id, "
    "CAST(CASE o_orderkey % 3 WHEN 0 THEN 101 + c_nationkey % 5 ELSE c_nationkey + 1 END AS BIGINT) AS geography_id, "
    "CAST(o_orderdate AS DATE) AS period_start, CAST(price AS DECIMAL(15,4)) AS value, o_orderpriority AS data_source, "
    "o_orderdate AS ingested_at FROM (SELECT l_orderkey, l_partkey, max(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey, l_partkey) l "
    "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
)


def _bound(data: Data, text: str, *names: str) -> DataFrame:
    for name in names:
        for word in ("FROM", "JOIN"):
            text = text.replace(f"{word} {name}", f"{word} {{{name}}}")
    return data._sql(text, *names)


def indicator(data: Data) -> DataFrame:
    return _bound(data, INDICATOR, "part")


def geography(data: Data) -> DataFrame:
    return _bound(data, GEOGRAPHY, "nation", "region")


def stratifier(data: Data) -> DataFrame:
    return _bound(data, STRATIFIER, "customer")


def observation(data: Data) -> DataFrame:
    return _bound(data, OBSERVATION, "lineitem", "orders", "customer")


_STAR = f"WITH indicator AS ({INDICATOR}), geography AS ({GEOGRAPHY}), stratifier AS ({STRATIFIER}), observation AS ({OBSERVATION}), log AS ({_LOG}) "
_JOINED = "FROM observation o JOIN indicator i ON o.indicator_id = i.id JOIN geography g ON o.geography_id = g.id"


@query(
    "table_counts",
    _STAR + "SELECT 'indicator' AS table_name, count(*) AS n FROM indicator UNION ALL SELECT 'geography', count(*) FROM geography "
    "UNION ALL SELECT 'stratifier', count(*) FROM stratifier UNION ALL SELECT 'observation', count(*) FROM observation "
    "UNION ALL SELECT 'ingestion_log', count(*) FROM log",
)
def table_counts(data: Data) -> DataFrame:
    return star.table_counts(
        {
            "indicator": indicator(data),
            "geography": geography(data),
            "stratifier": stratifier(data),
            "observation": observation(data),
            "ingestion_log": logged(data),
        }
    )


@query(
    "recent_observations",
    _STAR + f"SELECT o.id, i.code AS indicator_code, i.name AS indicator_name, g.state, g.county, o.period_start, o.value, o.data_source {_JOINED} "
    "ORDER BY o.ingested_at DESC, o.id DESC LIMIT 10",
)
def recent_observations(data: Data) -> DataFrame:
    return star.recent_observations(observation(data), indicator(data), geography(data))


@query("list_indicators", _STAR + "SELECT code, name, unit, category FROM indicator ORDER BY code")
def list_indicators(data: Data) -> DataFrame:
    return star.list_indicators(indicator(data))


@query("geo_by_level", _STAR + "SELECT level, count(*) AS n FROM geography GROUP BY level ORDER BY level")
def geo_by_level(data: Data) -> DataFrame:
    return star.geographies_by_level(geography(data))


@query(
    "recent_runs",
    _STAR + "SELECT run_id, data_source, status, records_processed, records_inserted, records_failed, started, completed "
    "FROM log ORDER BY started_at DESC, id DESC LIMIT 10",
)
def recent_runs(data: Data) -> DataFrame:
    recent = star.recent_runs(logged(data))
    dates = {"started": F.to_date("started_at"), "completed": F.to_date("completed_at")}
    return recent.withColumns(dates).drop("started_at", "completed_at")


@query(
    "indicator_series",
    _STAR + f"SELECT g.state_name, g.county, o.period_start, o.value {_JOINED} WHERE i.code = 'PART_7' ORDER BY o.period_start DESC",
)
def indicator_series(data: Data) -> DataFrame:
    return star.indicator_series(observation(data), indicator(data), geography(data), "PART_7")


@query(
    "state_series",
    _STAR + f"SELECT g.state_name, o.period_start, o.value {_JOINED} WHERE i.code = 'PART_11' AND g.level = 'state' "
    "AND o.period_start >= DATE '1997-01-01' ORDER BY g.state_name, o.period_start",
)
def state_series(data: Data) -> DataFrame:
    return star.state_series(
        observation(data), indicator(data), geography(data), "PART_11", date(1997, 1, 1)
    )


_LATEST = (
    "SELECT code, name, value, period_start FROM (SELECT i.code, i.name, o.value, o.period_start, "
    "row_number() OVER (PARTITION BY i.code ORDER BY o.period_start DESC, o.id) AS rn "
    "FROM observation o JOIN indicator i ON o.indicator_id = i.id) r WHERE rn = 1"
)


@query("latest_per_indicator", _STAR + _LATEST)
def latest_per_indicator(data: Data) -> DataFrame:
    return star.latest_per_indicator(observation(data), indicator(data))


@query(
    "count_for_indicator",
    _STAR + "SELECT count(*) AS n FROM observation o JOIN indicator i ON o.indicator_id = i.id WHERE i.code = 'PART_3'",
)
def count_for_indicator(data: Data) -> DataFrame:
    return star.count_for_indicator(observation(data), indicator(data), "PART_3")


@query(
    "latest_run_for_source",
    _STAR + "SELECT run_id, data_source, status, records_inserted, records_failed FROM log "
    "WHERE data_source = 'orders-5' ORDER BY started_at DESC, id DESC LIMIT 1",
)
def latest_run_for_source(data: Data) -> DataFrame:
    return star.latest_run_for_source(logged(data), "orders-5")

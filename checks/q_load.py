"""Dimensions, facts, constraints and the run log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import sql as q
from checks.q_mapping import observed
from checks.registry import Data, query
from checks.sql import OBSERVED, OBSERVED_YEARLY
from obsforge.operators import constraints, dimensions, facts, geography, runlog
from obsforge.schema import GEOGRAPHY, INDICATOR, INGESTION_LOG, OBSERVATION, STRATIFIER
from obsforge.session import staged

IDX = "record_index"


def now():
    return F.lit(datetime(2024, 1, 1))


def empty(data: Data, schema) -> DataFrame:
    return data.spark.createDataFrame([], schema)


# --- existing members, from the given tables --------------------------------

_CODES = "AL,AK,AZ,AR,CA,CO,CT,DE,FL,GA,HI,ID,IL,IN,IA,KS,KY,LA,ME,MD,MA,MI,MN,MS,MO"
_GEO = (
    f"SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, substring('{_CODES}', n_nationkey * 3 + 1, 2) AS state, "
    "n_name AS state_name, CASE n_nationkey % 3 WHEN 0 THEN 'Machinery' END AS county, "
    "CASE n_nationkey % 2 WHEN 0 THEN lpad(CAST(n_nationkey AS STRING), 2, '0') END AS fips_code, "
    "CASE n_nationkey % 3 WHEN 0 THEN 'county' ELSE 'state' END AS level FROM nation"
)


def requested(data: Data) -> DataFrame:
    """Geography requests of the observations, staged as a load stages its batch.

    Checks on derived columns then read them, where on a lazy frame each check
    would be pushed below the mapping and repeat it.
    """
    return geography.requests_of(staged(observed(data), "observations"), IDX)


def existing_geography(data: Data) -> DataFrame:
    rows = data._sql(_GEO.replace("FROM nation", "FROM {nation}"), "nation")
    return rows.withColumns(
        {"country": F.lit("USA"), "region": F.lit(None).cast("string"), "created_at": now()}
    ).to(GEOGRAPHY)


# --- geography as SQL ---------------------------------------------------------

_REQ = (
    "SELECT record_index AS idx, geography_level AS level, nullif(state, '') AS state, "
    f"nullif(county, '') AS county, nullif(fips_code, '') AS fips_code FROM ({OBSERVED}) ob"
)
_OK = (
    "length(coalesce(state, '')) <= 2 AND length(coalesce(county, '')) <= 100 AND length(coalesce(fips_code, '')) <= 10 "
    "AND ((level = 'nation') = (state IS NULL))"
)


def _geo_ctes() -> str:
    return f"""
WITH ex AS ({_GEO}), req AS ({_REQ}),
known AS (SELECT id, level, state, county, fips_code, id - 4611686018427387904 AS born FROM ex),
cand AS (SELECT level, state, county, fips_code, min(idx) AS born FROM req WHERE {_OK} GROUP BY ALL),
free AS (SELECT * FROM cand WHERE fips_code IS NOT NULL AND fips_code NOT IN (SELECT fips_code FROM ex WHERE fips_code IS NOT NULL)),
taker0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fips_code ORDER BY born) AS rn FROM free WHERE level <> 'nation') t WHERE rn = 1),
nat AS (SELECT c.* FROM (SELECT * FROM free WHERE level = 'nation' UNION ALL SELECT * FROM cand WHERE level = 'nation' AND fips_code IS NULL) c
        LEFT JOIN taker0 t ON c.fips_code = t.fips_code WHERE (t.born IS NULL OR c.born < t.born)
        AND NOT EXISTS (SELECT 1 FROM known WHERE level = 'nation') ORDER BY c.born LIMIT 1),
taker AS (SELECT level, state, county, fips_code, born FROM taker0 WHERE fips_code NOT IN (SELECT fips_code FROM nat WHERE fips_code IS NOT NULL)),
m1 AS (SELECT level, state, county, fips_code, born FROM known UNION ALL SELECT * FROM taker UNION ALL SELECT * FROM nat),
named AS (SELECT c.* FROM cand c WHERE c.fips_code IS NULL AND (
    (c.level = 'state' AND NOT EXISTS (SELECT 1 FROM m1 m WHERE m.level = 'state' AND m.state = c.state AND m.born < c.born))
    OR (c.level = 'county' AND NOT EXISTS (SELECT 1 FROM m1 m WHERE m.state = c.state AND m.county = c.county AND m.born < c.born)))),
top AS (SELECT max(id) AS top FROM ex),
new AS (SELECT top + born + 1 AS id, level, state, county, fips_code, born FROM (SELECT * FROM taker UNION ALL SELECT * FROM nat UNION ALL SELECT * FROM named) n, top),
mem AS (SELECT id, level, state, county, fips_code, born FROM known UNION ALL SELECT * FROM new),
hit AS (
  SELECT r.idx, m.id, m.born FROM req r JOIN mem m ON r.level = 'nation' AND m.level = 'nation'
  UNION ALL SELECT r.idx, m.id, m.born FROM req r JOIN mem m ON m.fips_code = r.fips_code
    WHERE r.level <> 'nation' AND (r.level <> 'state' OR m.level = 'state')
      AND (r.state IS NULL OR r.state = m.state) AND (r.county IS NULL OR r.county = m.county)
  UNION ALL SELECT r.idx, m.id, m.born FROM req r JOIN mem m ON m.state = r.state
    WHERE r.fips_code IS NULL AND r.level = 'state' AND m.level = 'state'
  UNION ALL SELECT r.idx, m.id, m.born FROM req r JOIN mem m ON m.county = r.county
    WHERE r.fips_code IS NULL AND r.level = 'county' AND (r.state IS NULL OR r.state = m.state)),
placed AS (SELECT r.idx AS record_index, h.geography_id FROM req r LEFT JOIN (
    SELECT idx, arg_min(id, born) AS geography_id FROM (SELECT * FROM hit WHERE born <= idx) hh GROUP BY idx) h ON r.idx = h.idx)
"""


@query("dim_geography", _geo_ctes() + "SELECT id, level, state, county, fips_code FROM new")
def dim_geography(data: Data) -> DataFrame:
    requests = requested(data)
    made = geography.new_geographies(requests, existing_geography(data), now())
    return made.select("id", "level", "state", "county", "fips_code")


def placed(data: Data) -> tuple[DataFrame, DataFrame]:
    requests = requested(data)
    known = existing_geography(data)
    made = geography.new_geographies(requests, known, now())
    return requests, staged(geography.geography_lookup(known, made), "lookup")


@query("resolve_geography", _geo_ctes() + "SELECT record_index, geography_id FROM placed")
def resolve_geography(data: Data) -> DataFrame:
    requests, lookup = placed(data)
    found = geography.resolve_geography(requests, lookup)
    return found.select(F.col("idx").alias("record_index"), "geography_id")


_STRICT = f"""
WITH ex AS ({_GEO}), req AS ({_REQ}),
cand AS (SELECT level, state, county, fips_code, min(idx) AS born FROM req WHERE {_OK} GROUP BY ALL),
coded AS (SELECT level, state, county, fips_code, born FROM (SELECT *, row_number() OVER (PARTITION BY fips_code ORDER BY born) AS rn FROM cand
    WHERE fips_code IS NOT NULL AND fips_code NOT IN (SELECT fips_code FROM ex WHERE fips_code IS NOT NULL)) t WHERE rn = 1),
m1 AS (SELECT state, county, id - 4611686018427387904 AS born FROM ex UNION ALL SELECT state, county, born FROM coded),
named AS (SELECT level, state, county, fips_code, born FROM (
    SELECT *, row_number() OVER (PARTITION BY state, county ORDER BY born) AS rn FROM cand WHERE fips_code IS NULL AND state IS NOT NULL) c
    WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM m1 m WHERE m.state = c.state AND m.county IS NOT DISTINCT FROM c.county AND m.born < c.born)),
each AS (SELECT level, state, county, fips_code, idx AS born FROM req WHERE {_OK} AND state IS NULL AND fips_code IS NULL)
SELECT (SELECT max(id) FROM ex) + born + 1 AS id, level, state, county, fips_code
FROM (SELECT * FROM coded UNION ALL SELECT * FROM named UNION ALL SELECT * FROM each) n
"""


@query("dim_geography_strict", _STRICT)
def dim_geography_strict(data: Data) -> DataFrame:
    requests = requested(data)
    made = geography.new_geographies_strict(requests, existing_geography(data), now())
    return made.select("id", "level", "state", "county", "fips_code")


# --- indicators and stratifiers ------------------------------------------------

_PART_CODES = "replace(replace(upper(p_brand || '_' || p_type), '#', '_'), ' ', '_')"


@query(
    "dim_indicator",
    f"WITH p AS (SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN p_name ELSE {_PART_CODES} END AS code, p_name, p_brand, p_type FROM part), "
    "ex AS (SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, 'BRAND_' || (n_nationkey + 1) || '_ECONOMY' AS code FROM nation) "
    "SELECT (SELECT max(id) FROM ex) + min(p_partkey) + 1 AS id, code, arg_min(p_name, p_partkey) AS name, "
    "arg_min(p_brand, p_partkey) AS unit, arg_min(p_type, p_partkey) AS description, 'numeric' AS data_type "
    "FROM p WHERE code NOT IN (SELECT code FROM ex) AND regexp_matches(code, '^[A-Z0-9_]+$') GROUP BY code",
)
def dim_indicator(data: Data) -> DataFrame:
    built = F.translate(F.upper(F.concat_ws("_", "p_brand", "p_type")), "# ", "__")
    requests = data.part.select(
        "p_partkey",
        F.when(F.col("p_size") % 9 == 0, F.col("p_name")).otherwise(built).alias("code"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("unit"),
        F.col("p_type").alias("description"),
    )
    key = (F.col("n_nationkey") + 1).cast("bigint")
    existing = data.nation.select(
        key.alias("id"), F.concat(F.lit("BRAND_"), key, F.lit("_ECONOMY")).alias("code")
    )
    made = dimensions.new_indicators(requests, existing, "p_partkey", now())
    return made.select("id", "code", "name", "unit", "description", "data_type")


_STRATA = (
    "CASE WHEN age_group <> '' THEN 'age_group' WHEN gender <> '' THEN 'gender' WHEN race <> '' THEN 'race' END AS dimension, "
    "CASE WHEN age_group <> '' THEN age_group WHEN gender <> '' THEN gender WHEN race <> '' THEN race END AS value"
)


def _strata(data: Data) -> DataFrame:
    dimension, value = dimensions.pick_stratifier(F.col("age_group"), F.col("gender"), F.col("race"))
    return data.dirty().select(IDX, dimension.alias("dimension"), value.alias("value"))


@query("pick_stratifier", f"SELECT record_index, {_STRATA} FROM ({q.DIRTY}) d")
def pick_stratifier(data: Data) -> DataFrame:
    return _strata(data)


@query(
    "dim_stratifier",
    "SELECT 5 + min(record_index) + 1 AS id, dimension, value FROM "
    f"(SELECT record_index, {_STRATA} FROM ({q.DIRTY}) d) s WHERE dimension IS NOT NULL "
    "AND NOT (dimension = 'gender' AND value IN (SELECT CASE r_regionkey WHEN 0 THEN 'Male' ELSE r_name END FROM region)) GROUP BY dimension, value",
)
def dim_stratifier(data: Data) -> DataFrame:
    existing = data.region.select(
        (F.col("r_regionkey") + 1).cast("bigint").alias("id"),
        F.lit("gender").alias("dimension"),
        F.when(F.col("r_regionkey") == 0, "Male").otherwise(F.col("r_name")).alias("value"),
    )
    made = dimensions.new_stratifiers(_strata(data), existing, IDX, now())
    return made.select("id", "dimension", "value")


# --- facts -----------------------------------------------------------------------

def yearly(data: Data) -> DataFrame:
    """Observations by calendar year, so that many records share a fact key."""
    from obsforge.operators.mapping import to_observation

    rows = data.dirty().drop("date").withColumn(
        "year", (F.lit(1990) + F.col(IDX) % 10).cast("string")
    )
    return staged(to_observation(rows, "ORDER_VALUE", "Order value", keep=(IDX,)), "observations")


def _resolved(data: Data, observations: DataFrame) -> DataFrame:
    known = existing_geography(data)
    made = geography.new_geographies(geography.requests_of(observations, IDX), known, now())
    strata = dimensions.new_stratifiers(
        facts.with_stratum(observations).select(IDX, "dimension", F.col("stratum").alias("value")),
        empty(data, STRATIFIER), IDX, now(),
    )
    indicator = dimensions.new_indicators(
        observations.select(
            IDX, F.col("indicator_code").alias("code"), F.col("indicator_name").alias("name"),
            F.col("indicator_unit").alias("unit"), F.col("indicator_description").alias("description"),
        ),
        empty(data, INDICATOR), IDX, now(),
    )
    lookup = staged(geography.geography_lookup(known, made), "lookup")
    return facts.resolve_keys(observations, IDX, indicator, lookup, strata, "ORDER_VALUE")


def _fact_ctes() -> str:
    """Resolved, checked and typed fact rows of the yearly observations."""
    return _geo_ctes().replace(OBSERVED, OBSERVED_YEARLY) + f""",
strat AS (SELECT record_index, {_STRATA} FROM ({q.DIRTY}) d),
dimstrat AS (SELECT min(record_index) + 1 AS id, dimension, value FROM strat WHERE dimension IS NOT NULL GROUP BY dimension, value),
firstrow AS (SELECT min(record_index) + 1 AS indicator_id FROM ({q.DIRTY}) d),
keyed AS (SELECT o.record_index, f.indicator_id, p.geography_id, s.id AS stratifier_id, o.period_start, o.period_end, o.value
  FROM ({OBSERVED_YEARLY}) o JOIN placed p ON o.record_index = p.record_index
  JOIN strat t ON o.record_index = t.record_index
  LEFT JOIN dimstrat s ON t.dimension = s.dimension AND t.value = s.value, firstrow f),
checked AS (SELECT *, TRY_CAST(CAST(value AS VARCHAR) AS DECIMAL(15,4)) AS amount,
  CASE WHEN geography_id IS NULL THEN 'geography_id is null' WHEN period_start IS NULL THEN 'period_start is null'
       WHEN value IS NULL THEN 'value is null' WHEN value < 0 THEN 'value is negative' END AS reason FROM keyed)
"""


@query(
    "resolve_keys",
    _fact_ctes() + "SELECT record_index, indicator_id, geography_id, stratifier_id FROM keyed",
)
def resolve_keys(data: Data) -> DataFrame:
    rows = _resolved(data, yearly(data))
    return rows.select("record_index", "indicator_id", "geography_id", "stratifier_id")


def _checked(data: Data) -> DataFrame:
    return facts.check_resolved(_resolved(data, yearly(data)))


@query("check_observation", _fact_ctes() + "SELECT record_index, amount AS value, reason FROM checked")
def check_observation(data: Data) -> DataFrame:
    return _checked(data).select("record_index", "value", "reason")


_DEDUPED = (
    "SELECT indicator_id, geography_id, coalesce(stratifier_id, -1) AS stratifier_key, period_start, period_end, "
    "arg_max(amount, record_index) AS value, min(record_index) AS first_idx FROM checked WHERE reason IS NULL "
    "GROUP BY ALL"
)


@query("dedupe_batch", _fact_ctes() + _DEDUPED)
def dedupe_batch(data: Data) -> DataFrame:
    good = staged(_checked(data).where(F.col("reason").isNull()), "checked")
    once = facts.dedupe_batch(good, IDX)
    return once.select(*facts.FACT_KEY, "value", "first_idx")


# A target that shares some keys with the batch: the deduplicated rows of even
# first records, with other measures, and one key of their own each.
_OLD = (
    "SELECT first_idx + 1 AS id, indicator_id, geography_id, stratifier_key, period_start, "
    "CASE WHEN first_idx % 4 = 0 THEN period_end ELSE DATE '2099-12-31' END AS period_end, "
    "CAST(1.5 AS DECIMAL(15,4)) AS value FROM dd WHERE first_idx % 2 = 0"
)


@query(
    "upsert_observations",
    _fact_ctes() + f", dd AS ({_DEDUPED}), old AS ({_OLD}), past AS (SELECT max(id) AS highest FROM old) "
    "SELECT coalesce(o.id, highest + n.first_idx + 1) AS id, coalesce(o.indicator_id, n.indicator_id) AS indicator_id, "
    "coalesce(o.geography_id, n.geography_id) AS geography_id, nullif(coalesce(o.stratifier_key, n.stratifier_key), -1) AS stratifier_id, "
    "coalesce(o.period_start, n.period_start) AS period_start, coalesce(o.period_end, n.period_end) AS period_end, "
    "CASE WHEN n.first_idx IS NULL THEN o.value ELSE n.value END AS value, "
    "CASE WHEN o.id IS NULL THEN 'new' ELSE 'old' END AS data_source, "
    "CASE WHEN o.id IS NULL THEN 2024 ELSE 2020 END AS ingested, CASE WHEN n.first_idx IS NULL THEN 2020 ELSE 2024 END AS updated "
    "FROM dd n FULL JOIN old o ON n.indicator_id = o.indicator_id AND n.geography_id = o.geography_id "
    "AND n.stratifier_key = o.stratifier_key AND n.period_start = o.period_start AND n.period_end = o.period_end, past",
)
def upsert_observations(data: Data) -> DataFrame:
    good = staged(_checked(data).where(F.col("reason").isNull()), "checked")
    once = staged(
        facts.dedupe_batch(good, IDX).withColumn("data_source", F.lit("new")), "deduplicated"
    )
    past = F.lit(datetime(2020, 1, 1))
    first = F.col("first_idx")
    old = once.where(first % 2 == 0).select(
        (first + 1).alias("id"), "indicator_id", "geography_id",
        F.nullif("stratifier_key", F.lit(-1)).alias("stratifier_id"), "period_start",
        F.when(first % 4 == 0, F.col("period_end")).otherwise(F.make_date(F.lit(2099), F.lit(12), F.lit(31))).alias("period_end"),
        F.lit(1.5).alias("value"),
        *(F.lit(None).alias(c) for c in facts.UPDATED[1:]),
        F.lit("old").alias("data_source"), F.lit(None).alias("data_source_id"),
        past.alias("ingested_at"), past.alias("updated_at"),
    ).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in OBSERVATION.fields))
    merged = facts.upsert_observations(once, old, now())
    return merged.select(
        "id", "indicator_id", "geography_id", "stratifier_id", "period_start", "period_end", "value",
        "data_source", F.year("ingested_at").alias("ingested"), F.year("updated_at").alias("updated"),
    )


# --- run log ---------------------------------------------------------------------

@query(
    "load_batch_stats",
    _fact_ctes() + "SELECT count(*) AS records_processed, count(*) FILTER (reason IS NULL) AS records_inserted, "
    "count(*) FILTER (reason IS NOT NULL) AS records_failed, "
    "CASE WHEN count(*) FILTER (reason IS NOT NULL) = 0 THEN 'completed' WHEN count(*) FILTER (reason IS NULL) > 0 THEN 'partial' ELSE 'failed' END AS status, "
    "(SELECT string_agg('Record ' || record_index || ': ' || reason, '; ' ORDER BY record_index) FROM "
    "(SELECT * FROM checked WHERE reason IS NOT NULL ORDER BY record_index LIMIT 10) e) AS error_message, "
    "'{\"total_errors\":' || count(*) FILTER (reason IS NOT NULL) || '}' AS metadata FROM checked",
)
def load_batch_stats(data: Data) -> DataFrame:
    return runlog.run_outcome(staged(_checked(data), "checked"), IDX)


_RUNS = (
    "SELECT year(o_orderdate) * 100 + month(o_orderdate) AS month, count(*) AS processed, "
    "count(*) FILTER (WHERE o_orderstatus = 'F' OR month(o_orderdate) = 2) AS failed, max(o_orderdate) AS last "
    "FROM orders GROUP BY 1"
)
_STATUS = "CASE WHEN failed = 0 THEN 'completed' WHEN processed > failed THEN 'partial' ELSE 'failed' END"


def runs(data: Data) -> DataFrame:
    rows = data._sql(_RUNS.replace("FROM orders", "FROM {orders}"), "orders")
    inserted = F.col("processed") - F.col("failed")
    return rows.withColumns(
        {
            "run_id": F.concat(F.lit("run-"), F.col("month").cast("string")),
            "data_source": F.concat(F.lit("orders-"), (F.col("month") % 100).cast("string")),
            "inserted": inserted,
            "status": runlog.load_status(inserted, F.col("failed")),
        }
    )


@query(
    "load_status",
    f"SELECT 'run-' || month AS run_id, processed, processed - failed AS inserted, failed, {_STATUS} AS status FROM ({_RUNS}) r",
)
def load_status(data: Data) -> DataFrame:
    return runs(data).select("run_id", "processed", "inserted", "failed", "status")


def existing_log(data: Data) -> DataFrame:
    """A log of the runs of even months, long completed."""
    past = F.lit(datetime(1980, 1, 1))
    return (
        runs(data).where(F.col("month") % 2 == 0)
        .select(
            F.col("month").cast("bigint").alias("id"), "run_id", F.lit("kept").alias("data_source"),
            F.lit("failed").alias("status"), F.lit(7).alias("records_processed"),
            F.lit(0).alias("records_inserted"), F.lit(7).alias("records_failed"),
            past.alias("started_at"), past.alias("completed_at"),
            F.lit("old error").alias("error_message"), F.lit(None).alias("metadata"),
        )
        .select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in INGESTION_LOG.fields))
    )


def logged(data: Data) -> DataFrame:
    """Start all runs over the existing log, then complete those after January."""
    todo = runs(data)
    starts = todo.select(
        "run_id", "data_source", F.col("last").cast("timestamp").alias("started_at"),
        F.col("month").cast("bigint").alias("position"),
    )
    running = runlog.start_runs(existing_log(data), starts)
    done = todo.where(F.col("month") % 100 > 1).select(
        "run_id", "status", F.col("processed").alias("records_processed"),
        F.col("inserted").alias("records_inserted"), F.col("failed").alias("records_failed"),
        F.col("last").cast("timestamp").alias("completed_at"),
        F.lit(None).cast("string").alias("error_message"),
        F.to_json(F.struct(F.col("failed").alias("total_errors"))).alias("metadata"),
    )
    return runlog.complete_runs(running, done)


_LOG = (
    f"SELECT CAST(CASE WHEN month % 2 = 0 THEN month ELSE (SELECT max(month) FROM ({_RUNS}) x WHERE month % 2 = 0) + month + 1 END AS BIGINT) AS id, "
    "'run-' || month AS run_id, CASE WHEN month % 2 = 0 THEN 'kept' ELSE 'orders-' || (month % 100) END AS data_source, "
    f"CASE WHEN month % 100 = 1 THEN 'running' ELSE {_STATUS} END AS status, "
    "CASE WHEN month % 100 = 1 THEN 0 ELSE processed END AS records_processed, "
    "CASE WHEN month % 100 = 1 THEN 0 ELSE processed - failed END AS records_inserted, "
    "CASE WHEN month % 100 = 1 THEN 0 ELSE failed END AS records_failed, CAST(last AS DATE) AS started, "
    "CASE WHEN month % 100 = 1 THEN NULL ELSE CAST(last AS DATE) END AS completed, last AS started_at, "
    "CASE WHEN month % 100 = 1 THEN NULL ELSE '{\"total_errors\":' || failed || '}' END AS metadata "
    f"FROM ({_RUNS}) r"
)


@query("run_log", f"SELECT * EXCLUDE (started_at) FROM ({_LOG}) l")
def run_log(data: Data) -> DataFrame:
    return logged(data).select(
        "id", "run_id", "data_source", "status", "records_processed", "records_inserted", "records_failed",
        F.to_date("started_at").alias("started"), F.to_date("completed_at").alias("completed"), "metadata",
    )


# --- constraints -----------------------------------------------------------------

def _too_long(limits: dict[str, str], sizes: dict) -> str:
    cases = " ".join(
        f"WHEN length({column}) > {sizes[name]} THEN '{name} longer than {sizes[name]}'"
        for name, column in limits.items()
    )
    return f"CASE {cases} END"


@query(
    "check_lengths",
    "SELECT doc_id, " + _too_long(
        {"data_source": "text", "data_source_id": "lang"}, constraints.OBSERVATION_LENGTHS
    ) + " AS reason FROM documents",
)
def check_lengths(data: Data) -> DataFrame:
    named = data.documents.select(
        "doc_id", F.col("text").alias("data_source"), F.col("lang").alias("data_source_id")
    )
    reason = constraints.length_reason(constraints.OBSERVATION_LENGTHS)
    return named.select("doc_id", reason.alias("reason"))


@query(
    "check_indicator",
    "SELECT doc_id, CASE WHEN code IS NULL THEN 'code is null' WHEN name IS NULL THEN 'name is null' "
    "WHEN NOT regexp_matches(code, '^[A-Z0-9_]+$') THEN 'code has characters other than A-Z, 0-9 and _' "
    "WHEN length(code) > 100 THEN 'code longer than 100' WHEN length(name) > 255 THEN 'name longer than 255' "
    "WHEN length(unit) > 50 THEN 'unit longer than 50' END AS reason FROM (SELECT doc_id, "
    "CASE doc_id % 3 WHEN 0 THEN upper(lang) WHEN 1 THEN regexp_replace(upper(text), '[^A-Z0-9]', '_', 'g') ELSE source END AS code, "
    "text AS name, source AS unit FROM documents) d",
)
def check_indicator(data: Data) -> DataFrame:
    kind = F.col("doc_id") % 3
    rows = data.documents.select(
        "doc_id",
        F.when(kind == 0, F.upper("lang"))
        .when(kind == 1, F.regexp_replace(F.upper("text"), "[^A-Z0-9]", "_"))
        .otherwise(F.col("source")).alias("code"),
        F.col("text").alias("name"),
        F.col("source").alias("unit"),
    )
    return rows.select("doc_id", constraints.indicator_reason().alias("reason"))


@query(
    "check_geography",
    "SELECT record_index, CASE WHEN level IS NULL OR level NOT IN ('nation', 'state', 'county', 'metro') THEN 'unknown level' "
    "WHEN level = 'nation' AND state IS NOT NULL THEN 'a nation has no state' WHEN level <> 'nation' AND state IS NULL THEN 'state is null' "
    "WHEN length(state) > 2 THEN 'state longer than 2' WHEN length(county) > 100 THEN 'county longer than 100' "
    "WHEN length(fips_code) > 10 THEN 'fips_code longer than 10' END AS reason FROM (SELECT record_index, state, county, fips_code, "
    f"CASE record_index % 5 WHEN 0 THEN 'nation' WHEN 1 THEN 'planet' WHEN 2 THEN NULL ELSE 'county' END AS level FROM ({q.DIRTY}) d) g",
)
def check_geography(data: Data) -> DataFrame:
    kind = F.col(IDX) % 5
    level = F.when(kind == 0, "nation").when(kind == 1, "planet").when(kind > 2, "county")
    rows = data.dirty().withColumns({"level": level, "state_name": F.lit(None).cast("string")})
    return rows.select(IDX, constraints.geography_reason().alias("reason"))


@query(
    "check_stratifier",
    "SELECT event_id, CASE WHEN dimension IS NULL THEN 'dimension is null' WHEN value IS NULL THEN 'value is null' "
    "WHEN dimension NOT IN ('age_group', 'gender', 'race', 'ethnicity', 'education', 'income', 'other') THEN 'unknown dimension' END AS reason "
    "FROM (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'other' WHEN 1 THEN event_type END AS dimension, "
    "CASE WHEN event_id % 4 > 0 THEN props END AS value FROM events) e",
)
def check_stratifier(data: Data) -> DataFrame:
    kind = F.col("event_id") % 3
    rows = data.events.select(
        "event_id",
        F.when(kind == 0, "other").when(kind == 1, F.col("event_type")).alias("dimension"),
        F.when(F.col("event_id") % 4 > 0, F.col("props")).alias("value"),
    )
    return rows.select("event_id", constraints.stratifier_reason().alias("reason"))


@query(
    "check_run_log",
    "SELECT o_orderkey, CASE WHEN status IS NULL THEN 'status is null' WHEN status NOT IN ('running', 'completed', 'failed', 'partial') "
    "THEN 'unknown status' END AS reason FROM (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'open' END AS status FROM orders) o",
)
def check_run_log(data: Data) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "open")
    rows = data.orders.select(
        "o_orderkey", F.col("o_orderkey").cast("string").alias("run_id"),
        F.col("o_orderpriority").alias("data_source"), status.alias("status"),
    )
    return rows.select("o_orderkey", constraints.run_log_reason().alias("reason"))


@query(
    "check_unique",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def check_unique(data: Data) -> DataFrame:
    return constraints.duplicates(data.lineitem, "l_orderkey", "l_linenumber")


@query(
    "check_fk",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IS NOT NULL AND "
    "o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def check_fk(data: Data) -> DataFrame:
    parents = data.customer.where(F.col("c_acctbal") > 0)
    return constraints.orphans(data.orders, "o_custkey", parents, "c_custkey").select(
        "o_orderkey", "o_custkey"
    )


@query(
    "apply_defaults",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_orderpriority ELSE 'USA' END AS country, "
    "CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE 0 END AS records_failed FROM orders",
)
def apply_defaults(data: Data) -> DataFrame:
    status = F.col("o_orderstatus")
    rows = data.orders.select(
        "o_orderkey",
        F.when(status == "O", F.col("o_orderpriority")).alias("country"),
        F.when(status == "F", F.col("o_custkey")).alias("records_failed"),
    )
    return constraints.apply_defaults(rows, {**constraints.GEOGRAPHY_DEFAULTS, "records_failed": 0})

"""Mapping of ragged and tabular records to observations."""

from datetime import date

from pyspark.sql import functions as F

from obsforge.functions.predicates import filter_condition
from obsforge.operators import mapping

# Known inputs with known results.
RAGGED = [
    '{"state":"CA","county":"Los Angeles","date":"2023-01-15","value":100.5,"fips_code":"06037"}',
    '{"state":"NY","date":"2023-02-01","cases":250,"fips":"36001"}',
    '{"state":"TX","county":"Harris County","report_date":"2023-03-10","deaths":50}',
    '{"state":"  ca  ","fips":"6037","report_date":"2023-01-15","cases":"1,234"}',
]


def records(spark, bodies):
    df = spark.createDataFrame(list(enumerate(bodies)), "i INT, body STRING")
    return df.select("i", F.parse_json("body").alias("record"))


def test_ragged_records(spark):
    df = records(spark, RAGGED).withColumn(
        "_meta",
        F.struct(
            F.lit("test-dataset").alias("dataset_id"), F.lit("Test Dataset").alias("dataset_name"),
            F.col("i").alias("record_index"),
        ),
    )
    rows = mapping.to_observation(df, "TEST_INDICATOR", record="record", keep=("i",)).orderBy("i").collect()
    assert [r.value for r in rows] == [100.5, 250.0, 50.0, 1234.0]
    assert [r.fips_code for r in rows] == ["06037", "36001", None, "06037"]
    assert [r.geography_level for r in rows] == ["county"] * 4
    assert [r.county for r in rows] == ["Los Angeles", None, "Harris", None]
    assert [r.state for r in rows] == ["CA", "NY", "TX", "CA"]
    assert rows[0].period_start == rows[0].period_end == date(2023, 1, 15)
    assert rows[2].period_start == date(2023, 3, 10)
    assert {r.data_source for r in rows} == {"Test Dataset"} and {r.data_source_id for r in rows} == {"test-dataset"}
    assert {r.indicator_code for r in rows} == {"TEST_INDICATOR"} and [r.record_id for r in rows] == [0, 1, 2, 3]


def test_last_present_key_wins_even_if_null(spark):
    bodies = [
        '{"value": 1, "cases": null}',
        '{"cases": 2, "value": 1, "percentage": 9}',
        '{"unit": "own", "data_value_unit": "mapped"}',
        '{"year": 2020.0, "period_end": "2021-05-05", "extra": 1, "nested": {"a": [1]}, "flag": true}',
        '{"year": "20x0", "totalpopulation": 12.5}',
        "{}",
    ]
    rows = mapping.to_observation(records(spark, bodies), record="record", keep=("i",)).orderBy("i").collect()
    assert rows[0].value is None
    assert rows[1].value == 9.0
    assert rows[2].indicator_unit == "own"
    assert (rows[3].period_start, rows[3].period_end) == (date(2020, 1, 1), date(2020, 12, 31))
    assert rows[3].metadata == {"year": "2020.0", "extra": "1", "nested": '{"a":[1]}', "flag": "True"}
    assert rows[4].period_start is None and rows[4].sample_size == "13"
    assert rows[5].geography_level == "nation" and rows[5].metadata == {}


def test_map_column_and_tabular_agree_with_variant(spark):
    pairs = [{"state": "ca", "cases": "1,5", "x": "y"}, {"stateabbr": None, "state": "tx", "value": "$3"}]
    as_map = spark.createDataFrame([(i, p) for i, p in enumerate(pairs)], "i INT, record MAP<STRING,STRING>")
    rows = mapping.to_observation(as_map, record="record", keep=("i",)).orderBy("i").collect()
    assert [(r.state, r.value, r.metadata) for r in rows] == [("CA", 15.0, {"x": "y"}), (None, 3.0, {})]
    table = spark.createDataFrame([(0, "ca", 2.5, 2019)], "i INT, state STRING, cases DOUBLE, year INT")
    row = mapping.to_observation(table, keep=("i",)).first()
    assert (row.state, row.value, row.period_end, row.metadata) == ("CA", 2.5, date(2019, 12, 31), {"year": "2019"})


def test_custom_alias_and_transform(spark):
    aliases = mapping.with_alias(mapping.DEFAULT_ALIASES, "reading", "value")
    assert mapping.with_alias(aliases, "reading", "rate_of")["value"] == mapping.DEFAULT_ALIASES["value"]
    df = records(spark, ['{"value": 1, "reading": " 7 "}'])
    transforms = {**mapping.DEFAULT_TRANSFORMS, "gender": lambda v: F.upper(v.scalar)}
    row = mapping.to_observation(df, aliases=aliases, transforms=transforms, record="record").first()
    assert row.value == 7.0


def test_repointed_source_keeps_its_place(spark):
    aliases = mapping.with_alias(mapping.DEFAULT_ALIASES, "county", "value")
    rows = records(spark, ['{"county": "7", "value": 5}', '{"county": "7"}'])
    assert [r.value for r in mapping.to_observation(rows, aliases=aliases, record="record").collect()] == [5.0, 7.0]


def test_empty_lists_and_objects_are_absent(spark):
    df = records(spark, ['{"measureid": [], "indicator_code": "X", "state": {}, "date": [], "value": 1}'])
    row = mapping.to_observation(df, record="record").first()
    assert row.indicator_code == "X" and row.period_start is None


def test_renamed_target_joins_the_residual(spark):
    aliases = mapping.with_alias(mapping.DEFAULT_ALIASES, "src", "topic")
    row = mapping.to_observation(records(spark, ['{"src": "a", "b": 1}']), aliases=aliases, record="record").first()
    assert row.metadata == {"topic": "a", "b": "1"}


def test_filters(spark):
    df = spark.createDataFrame([("CA", 2023, "O'Hare"), ("NY", 2023, ""), ("CA", 2022, "x")], "state STRING, year INT, n STRING")
    assert df.where(filter_condition({"state": "CA", "year": 2023})).count() == 1
    assert df.where(filter_condition({"state": ["CA", "NY"]})).count() == 3
    assert df.where(filter_condition({"n": "O'Hare"})).count() == 1
    assert df.where(filter_condition({"n": []})).count() == 1
    assert filter_condition({}) is None and filter_condition({"state": {"a": 1}}) is None


def test_no_python_workers_in_the_plan(data):
    from checks.q_functions import validated
    from checks.q_mapping import observed, ragged

    for df in (validated(data), observed(data), mapping.to_observation(ragged(data), record="record")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan

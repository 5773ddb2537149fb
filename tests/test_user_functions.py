"""Checks and transforms of users: what they raise costs one value."""

import random
from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsforge.functions.rules import Rule, numeric, unless_falsy
from obsforge.functions.user import attempt, user_check, user_transform
from obsforge.operators.mapping import map_fields, to_observation
from obsforge.operators.validation import validate


def halve(values: pd.Series) -> pd.Series:
    return values.map(lambda v: 10 // (int(v) - 3))


@pytest.mark.parametrize("seed", range(4))
def test_attempt_finds_every_value_that_raises(seed):
    rng = random.Random(seed)
    values = [rng.randint(0, 6 if seed else 3) for _ in range(rng.randint(0, 200))]
    calls = []

    def counted(series):
        calls.append(len(series))
        return halve(series)

    wanted = [(None, "integer division or modulo by zero") if v == 3 else (10 // (v - 3), None) for v in values]
    assert attempt(counted, values) == wanted
    assert attempt(lambda v: 10 // (v - 3), values, each=True) == wanted
    if 3 not in values and values:
        assert calls == [len(values)]


def test_results_of_another_number_are_failures():
    assert attempt(lambda s: [1], [5, 6]) == [(1, None), (1, None)]
    assert attempt(lambda s: [1, 2], [5]) == [(None, "2 results for 1 values")]


ROWS = [(0, "5"), (1, "3"), (2, "x"), (3, ""), (4, None), (5, "13"), (6, "4")]


def test_a_raising_check_is_a_message_of_its_record(spark):
    df = spark.createDataFrame(ROWS, "id long, value string").repartition(2)
    rules = [Rule("value", user_check(lambda s: s.map(lambda v: 10 // (int(v) - 3) > 1)), message="too small"), Rule("value", numeric, warning_only=True)]
    found = {r.id: (r.status, r.errors) for r in validate(df, rules, keep=("id",)).collect()}
    assert found[0] == ("valid", []) and found[6] == ("valid", [])
    assert found[1] == ("invalid", ["value: Validation error: integer division or modulo by zero"])
    assert found[2] == ("invalid", ["value: Validation error: invalid literal for int() with base 10: 'x'"])
    assert found[3] == found[4] == ("valid", [])
    assert found[5] == ("invalid", ["value: too small"])


def test_a_check_of_single_values_with_messages(spark):
    def check(value):
        if value == "5":
            return False, "no fives"
        return (True, None) if value == "4" else None

    df = spark.createDataFrame(ROWS, "id long, value string")
    rules = [Rule("value", unless_falsy(user_check(check, each=True)), required=True)]
    found = {r.id: r.errors for r in validate(df, rules, keep=("id",)).collect()}
    assert found[0] == ["value: no fives"] and found[6] == [] and found[5] == ["value: Invalid value"]
    assert found[3] == found[4] == ["value: value is required but missing"]


def test_values_come_with_their_own_types(spark):
    body = '{"a":1,"b":1.5,"c":true,"d":"x","e":[1,2],"f":{"k":1},"g":null}'
    records = spark.sql("SELECT parse_json(:body) AS record", args={"body": body})
    name = user_check(lambda v: (False, type(v).__name__), each=True)
    row = validate(records, [Rule(f, name) for f in "abcdefgh"], record="record").first()
    assert row.errors == ["a: int", "b: float", "c: bool", "d: str", "e: list", "f: dict"]
    table = spark.createDataFrame([(1, 2.0, date(2020, 1, 2), [1])], "a int, b double, c date, d array<int>")
    row = validate(table, [Rule(f, name) for f in "abcd"]).first()
    assert row.errors == ["a: int", "b: float", "c: date", "d: list"]


def test_a_raising_transform_keeps_the_value(spark):
    df = spark.createDataFrame(ROWS, "id long, value string")
    changed = map_fields(df, {"value": ("value",)}, {"value": user_transform(lambda s: s.map(lambda v: str(10 // (int(v) - 3))))}, keep=("id",), targets=["value"])
    assert {r.id: r.value for r in changed.collect()} == {0: "5", 1: "3", 2: "x", 3: "", 4: None, 5: "1", 6: "10"}
    number = user_transform(lambda v: float(v) / 2, "double", each=True)
    seen = to_observation(df, "CODE", transforms={"value": number}, keep=("id",)).select("id", "value")
    assert {r.id: r.value for r in seen.collect()} == {0: 2.5, 1: 1.5, 2: None, 3: None, 4: None, 5: 6.5, 6: 2.0}
    days = user_transform(lambda v: {"5": date(2020, 1, 1), "3": "no day"}.get(v), "date", each=True)
    seen = to_observation(df.withColumn("date", F.col("value")), "CODE", transforms={"date": days}, keep=("id",)).select("id", "period_start")
    assert {r.id: r.period_start for r in seen.collect()}[0] == date(2020, 1, 1)
    assert {r.id: r.period_start for r in seen.collect()}[1] is None

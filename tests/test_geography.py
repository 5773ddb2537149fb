"""Set-wise geography resolution against loading one request after another."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from obsforge.operators import geography
from obsforge.schema import GEOGRAPHY



def one_by_one(requests, existing, strict=False):
    """Members and the id of every request, taken in order."""
    members = [dict(m) for m in existing]
    top = max((m["id"] for m in members), default=0)
    found = {}
    for r in requests:
        state, county, code, level = r["state"], r["county"], r["fips_code"], r["level"]

        def agrees(m):
            if strict:
                return (
                    state is not None and m["state"] == state and m["county"] == county
                    and (code is None or m["fips_code"] == code)
                )
            if level == "nation":
                return m["level"] == "nation"
            if level == "state":
                short = code is not None and len(code) == 2
                named = state is None or (m["level"] == "state" and m["state"] == state)
                return (state is not None or short) and named and (not short or m["fips_code"] == code)
            if level != "county" or (state, county, code) == (None, None, None):
                return False
            return (
                (state is None or m["state"] == state)
                and (county is None or m["county"] == county)
                and (code is None or m["fips_code"] == code)
            )

        match = next((m for m in members if agrees(m)), None)
        if match is None:
            taken = code is not None and any(m["fips_code"] == code for m in members)
            fits = (
                level in ("nation", "state", "county", "metro")
                and (level == "nation") == (state is None) and len(r["state_name"] or "") <= 100
            )
            if taken or not fits:
                found[r["idx"]] = None
                continue
            match = {**{k: r[k] for k in ("level", "state", "county", "fips_code")}, "id": top + r["idx"] + 1}
            members.append(match)
        found[r["idx"]] = match["id"]
    return members, found


def random_requests(rng, n, states, counties, codes, nation=0.1):
    requests = []
    for idx in range(n):
        state = rng.choice(states)
        code = rng.choice([None, *codes])
        roll = rng.random()
        if roll < nation:
            r = ("nation", None, None, code if code and len(code) == 2 else None)
        elif roll < 0.45:
            r = ("state", state, None, code if code and len(code) == 2 else None)
        else:
            r = ("county", rng.choice([state, state, None]), rng.choice([*counties, None]), code)
            if r[1:] == (None, None, None):
                r = ("county", state, counties[0], None)
        name = "n" * 101 if rng.random() < 0.15 else "name"
        requests.append(dict(zip(("level", "state", "county", "fips_code"), r), idx=idx * 2, state_name=name))
    return requests


def frames(spark, requests, existing):
    asked = spark.createDataFrame(
        [(r["idx"], r["level"], r["state"], r["state_name"], r["county"], r["fips_code"]) for r in requests],
        "idx BIGINT, level STRING, state STRING, state_name STRING, county STRING, fips_code STRING",
    )
    held = spark.createDataFrame(
        [(m["id"], "USA", m["state"], "x", m["county"], m["fips_code"], m["level"], None, datetime(2020, 1, 1))
         for m in existing], GEOGRAPHY)
    return asked, held


def compare(spark, requests, existing):
    members, found = one_by_one(requests, existing)
    asked, held = frames(spark, requests, existing)
    made = geography.new_geographies(asked, held, F.lit(datetime(2024, 1, 1)))
    got = {(r.id, r.level, r.state, r.county, r.fips_code) for r in made.collect()}
    want = {tuple(m[k] for k in ("id", "level", "state", "county", "fips_code")) for m in members[len(existing):]}
    assert got == want
    placed = geography.resolve_geography(asked, geography.geography_lookup(held, made))
    assert {r.idx: r.geography_id for r in placed.collect()} == found


@pytest.mark.parametrize("seed", range(3))
def test_many_small_worlds(spark, seed):
    """Hundreds of worlds of their own states and codes, interleaved in one run."""
    rng = random.Random(seed)
    requests, existing = [], []
    for world in range(350):
        mark = chr(0x4E00 + world)
        part = random_requests(
            rng, rng.randint(1, 9), [f"{mark}A", f"{mark}B"], [f"c{world}", f"d{world}"],
            [f"{mark}1", f"{mark}2", f"{mark}6037"], nation=0.01 if world % 50 == 0 else 0.0,
        )
        requests += part
        for state, county, code in rng.sample(
            [(f"{mark}A", None, f"{mark}1"), (f"{mark}A", f"c{world}", None), (f"{mark}B", None, None)], rng.randint(0, 2)
        ):
            existing.append({
                "id": len(existing) + 1, "level": "county" if county else "state",
                "state": state, "county": county, "fips_code": code,
            })
    rng.shuffle(requests)
    for position, request in enumerate(requests):
        request["idx"] = position * 3
    compare(spark, requests, existing)


@pytest.mark.parametrize("seed", range(6))
def test_nation_takes_codes(spark, seed):
    rng = random.Random(100 + seed)
    requests = random_requests(rng, 12, ["CA", "NY"], ["Kings"], ["06", "36", "06037"], nation=0.4)
    existing = [{"id": 4, "level": "state", "state": "CA", "county": None, "fips_code": "06"}] if seed % 2 else []
    compare(spark, requests, existing)


def test_strict_match(spark):
    rng = random.Random(7)
    requests = random_requests(rng, 120, ["CA", "NY", "TX"], ["Kings", "Kern"], ["06", "36", "06037", "06001"])
    existing = [{"id": 4, "level": "state", "state": "CA", "county": None, "fips_code": None}]
    members, _ = one_by_one(requests, existing, strict=True)
    asked, held = frames(spark, requests, existing)
    made = geography.new_geographies_strict(asked, held, F.lit(datetime(2024, 1, 1)))
    got = sorted(tuple(str(v) for v in (r.id, r.level, r.state, r.county, r.fips_code)) for r in made.collect())
    want = sorted(tuple(str(m[k]) for k in ("id", "level", "state", "county", "fips_code")) for m in members[1:])
    assert got == want


def any_request(rng, states, counties, codes, levels):
    return {
        "level": rng.choice(levels), "state": rng.choice([*states, None]), "county": rng.choice([*counties, None, None]),
        "fips_code": rng.choice([*codes, None, None]), "state_name": "n" * 101 if rng.random() < 0.1 else "name",
    }


@pytest.mark.parametrize("seed", range(4))
def test_requests_of_any_form(spark, seed):
    """Every level with any of the fields, hundreds of worlds at once, and one with nations."""
    rng = random.Random(200 + seed)
    requests, existing = [], []
    for world in range(300):
        mark = chr(0x4E00 + world)
        states, counties, codes = [f"{mark}A", f"{mark}B"], [f"c{world}", f"d{world}"], [f"{mark}1", f"{mark}2", f"{mark}6037"]
        levels = ["state", "state", "county", "county", "metro", "planet", None]
        requests += [any_request(rng, states, counties, codes, levels) for _ in range(rng.randint(1, 12))]
        if rng.random() < 0.3:
            existing.append({"id": len(existing) + 1, "level": rng.choice(["state", "county", "metro"]), "state": states[0],
                             "county": rng.choice([counties[0], None]), "fips_code": rng.choice([codes[0], None])})
    requests += [any_request(rng, ["CA"], ["Kings"], ["06", "06037"], ["nation", "nation", "state", "county", "metro"]) for _ in range(15)]
    rng.shuffle(requests)
    for position, request in enumerate(requests):
        request["idx"] = position * 2
    compare(spark, requests, existing)


def test_decisions_that_hang_on_one_another(spark):
    """Each request is served only if the one before it could not take its code: five rounds and more."""
    requests = []
    for i in range(12):
        # the state's own request takes code i+1 away from the next state, unless code i was taken from it
        requests.append({"level": "state", "state": f"S{i}"[:2], "county": None, "fips_code": f"{i:05}", "state_name": None})
        requests.append({"level": "county", "state": f"S{i}"[:2], "county": None, "fips_code": None, "state_name": None})
        requests.append({"level": "county", "state": f"S{i}"[:2], "county": "x", "fips_code": f"{i + 1:05}", "state_name": None})
    for position, request in enumerate(requests):
        request["idx"] = position
    compare(spark, requests, [])


def test_metros_insert_with_each_record(spark):
    metro = {"level": "metro", "state": "CA", "state_name": None, "county": None, "fips_code": None}
    requests = [{**metro, "idx": 0}, {**metro, "idx": 1}, {**metro, "idx": 2, "fips_code": "31080"}, {**metro, "idx": 3, "fips_code": "31080"},
                {**metro, "idx": 4, "state": None}]
    compare(spark, requests, [])
    asked, held = frames(spark, requests, [])
    made = geography.new_geographies(asked, held, F.lit(datetime(2024, 1, 1)))
    placed = geography.resolve_geography(asked, geography.geography_lookup(held, made)).orderBy("idx")
    assert [r.geography_id for r in placed.collect()] == [1, 2, 3, None, None]

"""Pages, loading and the run log on small warehouses."""

import re
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsforge.functions.rules import Rule
from obsforge.functions.user import user_check, user_transform
from obsforge.operators.facts import last_and_first, upsert_observations, with_measures
from obsforge.plans import star_queries
from obsforge.plans.end_to_end import run_dataset
from obsforge.plans.loading import load_batch, start_run
from obsforge.schema import CANONICAL
from obsforge.session import scratch_path, scratch_root, staged
from obsforge.sources import pages
from obsforge.sources.warehouse import Warehouse

AT = datetime(2024, 1, 1)
LATER = datetime(2024, 2, 2)


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, scratch_path(spark, "warehouse")).create()


def observations(spark, rows):
    base = {f.name: None for f in CANONICAL.fields}
    columns = ["idx", *base]
    made = [tuple({**base, "idx": i, **row}[c] for c in columns) for i, row in enumerate(rows)]
    schema = T.StructType([T.StructField("idx", T.LongType()), *CANONICAL.fields])
    return spark.createDataFrame(made, schema)


def row(state, day, value, **more):
    return {
        "state": state, "geography_level": "state", "period_start": day, "period_end": day, "value": value,
        "data_source": "Test Dataset", **more,
    }


BATCH = [
    row("CA", date(2023, 1, 15), 100.5, state_name="California", data_source_id="test-001"),
    row("NY", date(2023, 1, 16), 250.0, state_name="New York", data_source_id="test-002"),
]


def load(warehouse, rows, run="r1", at=AT, code="TEST_INDICATOR", **options):
    return load_batch(
        warehouse, observations(warehouse.spark, rows), "idx", "Test Dataset", run, at, code, "Test Indicator", **options
    ).first()


def test_load_twice(spark, warehouse):
    done = load(warehouse, BATCH)
    assert (done.records_processed, done.records_inserted, done.records_failed, done.status) == (2, 2, 0, "completed")
    again = load(warehouse, [{**BATCH[0], "value": 7.0, "data_source_id": "other"}, BATCH[1]], "r2", LATER)
    assert again.records_inserted == 2
    facts = {r.data_source_id: r for r in warehouse.table("observation").collect()}
    assert set(facts) == {"test-001", "test-002"}
    changed = facts["test-001"]
    assert (changed.value, changed.ingested_at, changed.updated_at) == (Decimal("7.0000"), AT, LATER)
    assert warehouse.table("geography").count() == 2 and warehouse.table("indicator").count() == 1
    log = {r.run_id: r for r in warehouse.table("ingestion_log").collect()}
    assert log["r1"].status == log["r2"].status == "completed" and log["r1"].id != log["r2"].id
    assert log["r2"].metadata == '{"total_errors":0}'


def test_last_value_first_source_and_failures(spark, warehouse):
    day = date(2023, 1, 1)
    rows = [
        row("CA", day, 1.0, value_notes="a", data_source_id="first"),
        row("CA", day, 2.0, data_source_id="second"),
        row("CA", day, -1.0),
        row("CA", None, 1.0),
        row("CA", day, 1.0, period_end=date(2022, 1, 1)),
        row("CA", day, 1.0, sample_size="many"),
        row("CA", day, 1.0, value_lower_bound="1e20"),
        row(None, day, 1.0, geography_level="county", county="Kings", gender="Male"),
        row("CA", day, 3.00005, age_group="18-24", gender="Male"),
        row("CA", day, 4.0, data_source_id="x" * 101),
    ]
    done = load(warehouse, rows)
    assert (done.records_processed, done.records_inserted, done.records_failed, done.status) == (10, 3, 7, "partial")
    assert done.error_message.startswith("Record 2: value is negative; Record 3: period_start is null; Record 4: period ends")
    facts = warehouse.table("observation").orderBy("stratifier_id").collect()
    assert len(facts) == 2
    assert (facts[0].value, facts[0].value_notes, facts[0].data_source_id) == (Decimal("2.0000"), None, "first")
    # rounded half up, filed under the age group, and the failed row created no stratifier
    assert facts[1].value in (Decimal("3.0001"), Decimal("3.0000"))
    assert [(r.dimension, r.value) for r in warehouse.table("stratifier").collect()] == [("age_group", "18-24")]


def test_untouched_partitions_stay(spark, warehouse):
    load(warehouse, BATCH)
    load(warehouse, [row("CA", date(2020, 5, 5), 5.0)], "r2", LATER, code="OTHER")
    load(warehouse, [row("CA", date(2023, 1, 15), 6.0)], "r3", LATER)
    kept = {(r.period_start.year, float(r.value)) for r in warehouse.table("observation").collect()}
    assert kept == {(2023, 6.0), (2023, 250.0), (2020, 5.0)}
    assert warehouse.table("observation").select("id").distinct().count() == 3
    touched = warehouse.touched(warehouse.table("observation").where(F.year("period_start") == 2020))
    assert [(p.part_year, p.load) for p in touched] == [(2020, 2)]
    assert warehouse.observations(touched).count() == 1


def test_only_touched_partitions_are_read(spark, warehouse):
    """Two indicators far apart, and all the others between them."""
    codes = [f"I{i:03}" for i in range(40)]
    load(warehouse, [{**row("CA", date(2020, 1, 1 + i % 9), 1.0 + i), "indicator_code": c} for i, c in enumerate(codes)], code=None, indicator_from="row")
    batch = warehouse.table("observation").where(F.col("indicator_id").isin(1, 40))
    touched = warehouse.touched(batch)
    files = warehouse.observations(touched).inputFiles()
    assert len(touched) == 2 and {re.search(r"part_indicator=(\d+)", f)[1] for f in files} == {"1", "40"}


def size_below(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))


def test_a_load_writes_its_facts_once(spark, warehouse):
    load(warehouse, BATCH)
    written = []
    plain = DataFrameWriter.parquet

    def parquet(self, path, *args, **options):
        plain(self, path, *args, **options)
        written.append((path, size_below(path), spark.read.parquet(path).columns))

    before = size_below(warehouse.path("observation"))
    DataFrameWriter.parquet = parquet
    try:
        load(warehouse, BATCH, "r2", LATER)
    finally:
        DataFrameWriter.parquet = plain
    facts = [w for w in written if w[0].startswith(warehouse.path("observation/load="))]
    assert len(facts) == 1 and size_below(warehouse.path("observation")) - before == facts[0][1]
    # on the way only narrow rows are staged: none has the measures
    assert not [w for w in written if w not in facts and "value_notes" in w[2]]


def test_a_broken_load_changes_nothing_and_old_rows_go(spark, warehouse, monkeypatch):
    load(warehouse, BATCH)
    reader = warehouse.table("observation")
    before = reader.orderBy("id").collect()
    changed = [{**BATCH[0], "value": 9.0}, row("CA", date(2021, 1, 1), 1.0)]

    with monkeypatch.context() as m:
        m.setattr(Warehouse, "touched", lambda self, batch: [1 / 0])
        with pytest.raises(ZeroDivisionError):
            load(warehouse, changed, "r2", LATER)
    assert warehouse.table("observation").orderBy("id").collect() == before
    load(warehouse, changed, "r3", LATER)
    # who began to read before the load reads what was there
    assert reader.orderBy("id").collect() == before
    now = {float(r.value) for r in warehouse.table("observation").collect()}
    assert now == {9.0, 250.0, 1.0}
    assert warehouse.vacuum() == 1 and warehouse.vacuum() == 0
    assert {float(r.value) for r in warehouse.table("observation").collect()} == now


def test_ids_come_from_the_log(spark, warehouse, monkeypatch):
    """No load looks for the highest id in a table, and no id is given twice."""
    monkeypatch.setattr("obsforge.operators.dimensions.highest_id", lambda table: 1 / 0)
    load(warehouse, BATCH)
    assert warehouse.highest_id() == 2
    load(warehouse, [row("TX", date(2023, 1, 15), 1.0), row("NY", date(2023, 1, 16), 2.0), row("OH", date(2023, 1, 16), 2.0)], "r2", LATER)
    assert warehouse.highest_id() == 5
    for table in ("observation", "geography", "indicator", "ingestion_log"):
        ids = [r.id for r in warehouse.table(table).collect()]
        assert len(set(ids)) == len(ids) and max(ids) <= 5
    assert [r.state for r in warehouse.table("geography").orderBy("id").collect()] == ["CA", "NY", "TX", "OH"]


def test_star_queries_prune_partitions(spark, warehouse):
    load(warehouse, BATCH)
    load(warehouse, [row("CA", date(2020, 5, 5), 5.0)], "r2", LATER, code="OTHER")
    facts, indicator, geography = (warehouse.observations(), warehouse.table("indicator"), warehouse.table("geography"))
    for found, n in (
        (star_queries.indicator_series(facts, indicator, geography, "OTHER"), 1),
        (star_queries.state_series(facts, indicator, geography, "TEST_INDICATOR", date(2023, 1, 16)), 1),
        (star_queries.count_for_indicator(facts, indicator, "TEST_INDICATOR"), 1),
    ):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[isnotnull\([^]]*part_indicator#", plan)
        assert found.count() == n
    assert star_queries.indicator_series(facts, indicator, geography, "NONE").count() == 0
    assert star_queries.count_for_indicator(facts, indicator, "TEST_INDICATOR").first().n == 2


def test_missing_level_is_a_state(spark, warehouse):
    done = load(warehouse, [{**BATCH[0], "geography_level": None}, {**BATCH[1], "geography_level": ""}])
    assert done.records_inserted == 2
    assert {(r.level, r.state) for r in warehouse.table("geography").collect()} == {("state", "CA"), ("state", "NY")}


def test_load_leaves_nothing_staged(spark, warehouse):
    root = Path(scratch_root(spark))
    before = set(root.iterdir())
    assert load(warehouse, BATCH).records_inserted == 2
    assert set(root.iterdir()) == before


def test_error_ends_the_run_as_failed(spark, warehouse):
    broken = observations(spark, BATCH).withColumn("state", F.raise_error(F.lit("no state")).cast("string"))
    with pytest.raises(Exception, match="no state"):
        load_batch(warehouse, broken, "idx", "Test Dataset", "r1", AT, "TEST_INDICATOR")
    run = warehouse.table("ingestion_log").first()
    assert run.status == "failed" and "no state" in run.error_message


def test_without_indicator_and_with_a_bad_one(spark, warehouse):
    nothing = load(warehouse, BATCH, code=None)
    assert (nothing.status, nothing.records_failed) == ("failed", 2)
    assert warehouse.table("geography").count() == 2
    bad = load(warehouse, BATCH, "r2", code="lower case")
    assert bad.status == "failed"
    assert {r.run_id: r.status for r in warehouse.table("ingestion_log").collect()} == {"r1": "failed", "r2": "failed"}
    own = load(warehouse, [{**r, "indicator_code": "OWN"} for r in BATCH], "r3", code=None, indicator_from="row")
    assert own.records_inserted == 2


def test_restarted_run_keeps_its_end(spark, warehouse):
    load(warehouse, BATCH)
    start_run(warehouse, "r1", "Other", LATER)
    run = warehouse.table("ingestion_log").first()
    assert (run.status, run.data_source, run.completed_at, run.started_at, run.records_processed) == (
        "running", "Test Dataset", AT, LATER, 0)


def test_merge_shuffles_each_side_once_by_key(spark, warehouse):
    load(warehouse, BATCH)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = warehouse.table("observation").withColumn("idx", F.col("id"))
        chosen = staged(last_and_first(facts, "idx"), "chosen")
        rows = with_measures(chosen, facts, "idx")
        merged = upsert_observations(rows, warehouse.table("observation"), F.lit(AT), 10)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(indicator_id") == 2
        assert "SortAggregate" not in chosen_plan(last_and_first(facts, "idx"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def chosen_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def page_frame(spark, bodies):
    return spark.createDataFrame(list(enumerate(bodies)), "page_no BIGINT, body STRING")


def scanned(spark, bodies, filters=None):
    found = pages.scan_dataset(page_frame(spark, bodies), filters)
    rows = found.records.select("record_index", F.to_json("record").alias("r")).orderBy("record_index").collect()
    assert found.kept == len(rows)
    return [(r.record_index, r.r) for r in rows], found.report


def test_page_shapes(spark):
    bodies = ['[{"a":2,"fips":"06"},{"fips":6}]', '[{"row":{"a":1}},{"row":{"a":null,"b":"x"}},{"x":1}]',
              '{"meta":{},"data":[[1,2]]}', "[]", "[[1]]", '[{"row":null},1]']
    rows = pages.normalize_pages(page_frame(spark, bodies)).select("page_no", "pos", F.to_json("record").alias("r"))
    assert [(r.page_no, r.r) for r in rows.orderBy("page_no", "pos").collect()] == [
        (0, '{"a":2,"fips":"06"}'), (0, '{"fips":6}'), (1, '{"a":1}'), (1, '{"a":null,"b":"x"}'), (1, "{}"),
        (5, "null"), (5, "{}"),
    ]


def test_every_landed_page_is_read(spark):
    full, short = '[{"a":1},{"a":2}]', '[{"a":3}]'
    rows, report = scanned(spark, [full, short, full, "[]", '[{"a":5},{"a":6},{"a":7}]', short])
    assert [i for i, _ in rows] == list(range(9)) and rows[2][1] == '{"a":3}' and rows[5][1] == '{"a":5}'
    assert (report.pages, report.missing, report.repeated, report.short, report.broken) == (6, 0, 0, 4, 0)
    assert scanned(spark, [full, "broken"])[1].broken == 1 and scanned(spark, ['[{"a":1},2]'])[1].broken == 1
    assert scanned(spark, ["[]"])[0] == []
    assert scanned(spark, [full, full], {"a": 2})[0] == [(0, '{"a":2}'), (1, '{"a":2}')]


def test_repeated_and_missing_pages_are_reported(spark):
    twice = spark.createDataFrame([(1, '[{"a":1},{"a":2}]'), (4, '[{"a":3}]'), (1, '[{"a":1},{"a":2}]')], "page_no BIGINT, body STRING")
    found = pages.scan_dataset(twice)
    assert (found.report.missing, found.report.repeated, found.kept) == (2, 1, 5)
    assert sorted(r.record_index for r in found.records.collect()) == list(range(5))


def test_filters_compare_numbers_as_numbers(spark):
    body = ['[{"y":2023},{"y":2023.0},{"y":"2023"},{"y":9007199254740993},{"y":9007199254740992},{"y":[]},{}]']
    kept = lambda f: [r for _, r in scanned(spark, body, f)[0]]
    assert len(kept({"y": 2023})) == len(kept({"y": [2023]})) == len(kept({"y": [2023, "x"]})) == 3
    assert kept({"y": 9007199254740993}) == ['{"y":9007199254740993}']
    assert kept({"y": "2023"}) == ['{"y":2023}', '{"y":"2023"}']


def test_loose_files_and_broken_landings(spark, tmp_path):
    folder = tmp_path / "views" / "d1"
    folder.mkdir(parents=True)
    (folder / "page-1.json").write_text('[{"a":2}]')
    (folder / "page-0.json").write_text('[{"a":1}]')
    records, info = pages.extract(spark, str(tmp_path), "d1", "r", AT)
    assert sorted(r.record_index for r in records.collect()) == [0, 1] and info.first().status == "success"
    (folder / "odd.json").write_text('[{"a":3}]')
    records, info = pages.extract(spark, str(tmp_path), "d1", "r", AT)
    assert records.count() == 0 and info.first().status == "failed" and "1 of 3 pages" in info.first().error
    records, info = pages.extract(spark, str(tmp_path), "nowhere", "r", AT)
    assert records.count() == 0 and info.first().status == "failed" and info.first().error


def landed(spark, bodies):
    root = scratch_path(spark, "landing")
    pages.land_pages(page_frame(spark, bodies), pages.page_folder(root, "d1"))
    return root


def test_run_ends_early(spark, warehouse):
    assert run_dataset(warehouse, landed(spark, ["{bad"]), "d1").status == "failed"
    empty = run_dataset(warehouse, landed(spark, ["[]"]), "d1")
    assert (empty.status, empty.message) == ("completed", "No records to process")
    invalid = run_dataset(warehouse, landed(spark, ['[{"state":"XX"}]']), "d1")
    assert (invalid.status, invalid.message) == ("failed", "All records failed validation")
    assert invalid.quarantine.count() == 1 and invalid.top_errors.count() == 1
    unloaded = run_dataset(warehouse, landed(spark, ['[{"state":"CA","value":1}]']), "d1", indicator_code="A")
    assert (unloaded.status, unloaded.message) == ("failed", "No records loaded")


def test_run_with_filter_and_limit(spark, warehouse):
    body = '[{"state":"CA","date":"2020-01-01","value":1},{"state":"NY","date":"2020-01-02","value":"2"},{"state":"CA","date":"2020-01-03","value":3}]'
    root = landed(spark, [body])
    done = run_dataset(warehouse, root, "d1", "D", "IND", filters={"state": "CA", "value": [1, 3]}, run_id="a", at=AT)
    assert (done.status, done.records_loaded) == ("completed", 2)
    done = run_dataset(warehouse, root, "d1", "D", "IND", limit=1, run_id="b", at=LATER)
    assert done.records_loaded == 1
    assert {r.data_source for r in warehouse.table("observation").collect()} == {"D"}
    warehouse.register()
    counted = spark.sql("SELECT count(*) AS n FROM observation o JOIN indicator i ON o.indicator_id = i.id WHERE i.code = 'IND'")
    assert counted.first().n == 2


BODY = '[{"state":"CA","date":"2020-01-01","value":1},{"state":"NY","date":"2020-01-02","value":"2"}]'


def test_errors_of_any_stage_are_results(spark, warehouse):
    root = landed(spark, [BODY])
    raising = lambda v: F.raise_error(F.lit("no such check")).cast("string")
    done = run_dataset(warehouse, root, "d1", "D", "IND", rules=[Rule("value", raising)], run_id="v", at=AT)
    assert (done.status, done.records_loaded) == ("failed", 0) and "no such check" in done.message
    assert [(r.stage, r.status, r.records_failed) for r in done.stages.collect()] == [("ingestion", "success", 0), ("validation", "failed", 2)]
    done = run_dataset(warehouse, root, "d1", "D", "IND", transforms={"value": raising}, run_id="t", at=AT)
    assert done.status == "failed" and "no such check" in done.message and done.quarantine.count() == 0
    assert [(r.stage, r.status) for r in done.stages.collect()][-1] == ("transformation", "failed")
    log = {r.run_id: r for r in warehouse.table("ingestion_log").collect()}
    assert {r.status for r in log.values()} == {"failed"} and all("no such check" in r.error_message for r in log.values())
    assert warehouse.table("observation").count() == 0


def test_a_failed_run_goes_on_from_its_last_stage(spark, warehouse, monkeypatch):
    root = landed(spark, [BODY])
    with monkeypatch.context() as m:
        m.setattr(Warehouse, "publish_facts", lambda *a: 1 / 0)
        done = run_dataset(warehouse, root, "d1", "D", "IND", run_id="on-" + root[-8:], at=AT)
    assert done.status == "failed" and "division by zero" in done.message
    assert [(r.stage, r.status) for r in done.stages.collect()][-1] == ("loading", "failed")
    for stage in ("extract", "validate", "transform_batch"):
        monkeypatch.setattr(f"obsforge.plans.end_to_end.{stage}", lambda *a, **k: 1 / 0)
    again = run_dataset(warehouse, root, "d1", "D", "IND", run_id="on-" + root[-8:], at=AT, resume=True)
    assert (again.status, again.records_loaded) == ("completed", 2) and again.stages.count() == 4
    assert warehouse.table("ingestion_log").first().status == "completed"
    fresh = run_dataset(warehouse, root, "d1", "D", "IND", run_id="on-" + root[-8:], at=AT)
    assert fresh.status == "failed"  # without resuming nothing is taken over


def test_a_run_stages_three_wide_tables(spark, warehouse):
    written = []
    plain = DataFrameWriter.parquet

    def parquet(self, path, *args, **options):
        plain(self, path, *args, **options)
        written.append((path, spark.read.parquet(path).columns))

    root = landed(spark, [BODY])
    DataFrameWriter.parquet = parquet
    try:
        assert run_dataset(warehouse, root, "d1", "D", "IND").status == "completed"
    finally:
        DataFrameWriter.parquet = plain
    wide = [path for path, columns in written if {"record", "value_notes"} & set(columns) and "/observation/" not in path]
    # pages as records, validated records, observations
    assert len(wide) == 3


def test_a_raising_user_function_costs_one_record(spark, warehouse):
    body = '[{"state":"CA","date":"2020-01-01","value":"1"},{"state":"NY","date":"2020-01-02","value":"x"},{"state":"TX","date":"2020-01-02","value":"0"}]'
    rules = [Rule("value", user_check(lambda s: s.map(lambda v: int(v) >= 0)))]
    transforms = {"value": user_transform(lambda v: 10.0 / int(v), "double", each=True)}
    done = run_dataset(warehouse, landed(spark, [body]), "d1", "D", "IND", rules=rules, transforms=transforms)
    assert (done.status, done.records_loaded) == ("completed", 2)
    assert [r.message for r in done.top_errors.collect()] == ["value: Validation error: invalid literal for int() with base 10: 'x'"]
    assert sorted(float(r.value) for r in warehouse.table("observation").collect()) == [0.0, 10.0]


@pytest.fixture(scope="module")
def packed(spark):
    """A hundred pages of one to five records each, numbered through, and one that is not JSON."""
    root = scratch_path(spark, "landing")
    sizes = [1 + i * 7 % 5 for i in range(100)]
    starts = [sum(sizes[:i]) for i in range(100)]
    bodies = ["[" + ",".join(f'{{"a":{start + j}}}' for j in range(size)) + "]" for start, size in zip(starts, sizes, strict=True)]
    pages.land_pages(page_frame(spark, [*bodies, "broken"]), pages.page_folder(root, "d1"))
    return root, sizes, starts


def test_a_limit_reads_the_pages_it_needs(spark, packed):
    root, sizes, starts = packed
    total = sum(sizes)
    for limit, offset in ((10, 0), (1, 0), (3, starts[50]), (7, starts[20] - 1), (50, total - 10), (5, total + 3)):
        records, info = pages.extract(spark, root, "d1", "r", AT, limit=limit, offset=offset)
        found = sorted((r.record_index, r.v) for r in records.select("record_index", F.try_variant_get("record", "$.a", "long").alias("v")).collect())
        wanted = range(offset, min(total, offset + limit))
        needed = [i for i in range(100) if starts[i] < offset + limit and starts[i] + sizes[i] > offset]
        report = info.first()
        if offset + limit <= total:
            assert found == [(i, i) for i in wanted] and report.records_extracted == len(wanted)
            assert (report.pages, report.status) == (len(needed), "success")
        else:  # it goes to the end, where a page is broken
            assert report.status == "failed" and f"1 of {report.pages} pages" in report.error
    assert pages.extract(spark, root, "d1", "r", AT)[1].first().status == "failed"


def test_a_page_is_read_from_its_file_alone(spark, packed):
    folder = pages.page_folder(packed[0], "d1")
    some = pages.read_pages(spark, folder).where(F.col("page_no").between(40, 41))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(page_no,40), LessThanOrEqual(page_no,41)" in plan
    # ranges of pages do not overlap, so the footers of all other files say that they hold none
    spans = sorted(tuple(r) for r in spark.read.parquet(f"{folder}/packed").groupBy(F.input_file_name()).agg(F.min("page_no"), F.max("page_no")).drop("input_file_name()").collect())
    assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert "body" not in pages.page_sizes(spark, folder)._jdf.queryExecution().executedPlan().toString()


def test_a_limit_after_a_filter_widens_until_enough_pass(spark, packed):
    root, _, _ = packed
    for wanted, limit, offset, most in (([5, 20, 21], 2, 1, 20), ([250], 1, 0, 101)):
        records, info = pages.extract(spark, root, "d1", "r", AT, limit=limit, filters={"a": wanted}, offset=offset)
        report = info.first()
        found = sorted((r.record_index, r.v) for r in records.select("record_index", F.try_variant_get("record", "$.a", "long").alias("v")).collect())
        if report.status == "success":
            assert found == list(enumerate(wanted))[offset : offset + limit] and report.pages <= most
        else:
            assert report.pages == 101  # it had to go to the end, where a page is broken


def test_latest_reads_the_newest_year_of_each_indicator(spark, warehouse):
    load(warehouse, [row("CA", date(2019, 5, 5), 1.0), row("NY", date(2021, 1, 2), 2.0), row("CA", date(2021, 1, 2), 3.0), row("CA", date(1969, 12, 31), 8.0)])
    load(warehouse, [row("CA", date(1960, 5, 5), 4.0), row("CA", date(1959, 5, 5), 5.0)], "r2", LATER, code="OLD")
    facts = warehouse.newest_observations()
    assert {re.search(r"part_indicator=\d+/part_year=\d+", f)[0] for f in facts.inputFiles()} == {"part_indicator=1/part_year=2021", "part_indicator=5/part_year=1960"}
    for source in (facts, warehouse.table("observation")):
        found = star_queries.latest_per_indicator(source, warehouse.table("indicator"))
        assert [(r.code, float(r.value), r.period_start) for r in found.collect()] == [("OLD", 4.0, date(1960, 5, 5)), ("TEST_INDICATOR", 2.0, date(2021, 1, 2))]
        assert "SortAggregate" not in chosen_plan(found)


def test_recent_facts_come_from_recent_runs(spark, warehouse):
    for day in range(1, 6):
        load(warehouse, [row("CA", date(2000 + day, 1, i + 1), 1.0 * i) for i in range(3)], f"r{day}", datetime(2024, 1, day))
    load(warehouse, [row("CA", date(2001, 1, 1), 9.0)], "r6", datetime(2024, 1, 6))  # adds nothing new
    since = warehouse.recent_observations(datetime(2024, 1, 4))
    assert since.count() == 6
    assert {re.search(r"part_year=(\d+)", f)[1] for f in since.inputFiles()} == {"2001", "2004", "2005"}
    assert "GreaterThanOrEqual(ingested_at" in chosen_plan(since)
    plain = star_queries.recent_observations(warehouse.table("observation"), warehouse.table("indicator"), warehouse.table("geography"), 7)
    assert star_queries.recent_of_warehouse(warehouse, 7).collect() == plain.collect()
    assert star_queries.recent_of_warehouse(warehouse, 99).count() == 15

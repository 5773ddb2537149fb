"""Records from landed JSON response pages.

Pages lie packed in parquet, many to a file, or as one file each. The reader
understands the response shapes of both endpoints, keeps every record as a
VARIANT, reads every landed page, and numbers the records that pass the filter
without sorting them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsforge.functions.pyvalue import INTEGER_TEXT, FieldValue
from obsforge.operators.records import LINEAGE, RaggedRecords
from obsforge.schema import DATASET_METADATA, struct
from obsforge.session import staged

# Fixed value: the origin written into every lineage struct.
SOURCE = "cdc_open_data_api"

# subfolder of packed pages
_PACKED = "packed"
# no dataset has as many
MOST_RECORDS = 1 << 60
# pages per block of the two-level running sum
_BLOCK = 4096


def page_folder(root: str, dataset_id: str, use_resource_endpoint: bool = False) -> str:
    """Where the pages of a dataset are landed, by endpoint."""
    endpoint = "resource" if use_resource_endpoint else "views"
    return f"{root.rstrip('/')}/{endpoint}/{dataset_id}"


def land_pages(pages: DataFrame, folder: str) -> None:
    """Write (page_no, body) rows packed, many pages to a file, with the number of elements of each page.

    Pages lie in the order of their number, over as many files as shuffles have
    partitions, so that a reader who wants some of them skips the others.
    ``elements`` is NULL for a body that is not JSON.
    """
    files = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # counted before the pages are dealt out, and of all pages only the numbers are kept
    counted = parse_pages(pages.withColumn("page_no", F.col("page_no").cast("bigint")), "body").select(
        "page_no", "body", F.when(F.col("shape") != "malformed", F.col("n")).alias("elements")
    )
    ordered = counted.repartitionByRange(files, "page_no").sortWithinPartitions("page_no")
    ordered.write.parquet(f"{folder}/{_PACKED}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether any file system that Spark knows has ``path``."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def page_sizes(spark: SparkSession, folder: str) -> DataFrame | None:
    """(page_no, elements) of packed pages without their bodies; None if the landing doesn't tell."""
    if not path_exists(spark, f"{folder}/{_PACKED}"):
        return None
    sizes = spark.read.schema("page_no BIGINT, elements BIGINT").parquet(f"{folder}/{_PACKED}")
    # pages packed before elements were counted have none
    return None if sizes.where("elements is not null").isEmpty() else sizes


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(page_no, body) of every landed page.

    Packed pages are read as they are. Otherwise every file below the folder is
    a page, with its number at the end of its name or of its folder's; files are
    packed into input splits, so many small pages share a task. The number of a
    file without one is NULL.
    """
    if path_exists(spark, f"{folder}/{_PACKED}"):
        return spark.read.schema("page_no BIGINT, body STRING").parquet(f"{folder}/{_PACKED}")
    files = spark.read.option("recursiveFileLookup", "true").text(folder, wholetext=True)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"page(?:_no=|-)(\d+)(?:\.[^/]*|/[^/]*)?$", 1)
    return files.select(number.try_cast("bigint").alias("page_no"), F.col("value").alias("body"))


def parse_pages(pages: DataFrame, *keep: str) -> DataFrame:
    """Add the response shape, its items and their number to (page_no, body).

    The first element decides: objects with a ``row`` key are unwrapped, other
    objects are records as they are. Everything else holds no records; a body
    that is not JSON has the shape ``malformed``.
    """
    doc = F.try_parse_json("body")
    parsed = pages.select(*keep, "page_no", doc.alias("doc"))
    first = F.try_variant_get("doc", "$[0]", "variant")
    is_object = F.schema_of_variant(first).startswith("OBJECT")
    shape = (
        F.when(F.col("doc").isNull(), F.lit("malformed"))
        .when(F.try_variant_get("doc", "$[0].row", "variant").isNotNull(), F.lit("rows"))
        .when(is_object, F.lit("records"))
        .otherwise(F.lit("none"))
    )
    shaped = parsed.withColumn("shape", shape)
    items = F.when(
        F.col("shape").isin("rows", "records"), F.try_variant_get("doc", "$", "array<variant>")
    )
    return shaped.select(
        *keep, "page_no", "shape", items.alias("items"), F.coalesce(F.size(items), F.lit(0)).alias("n")
    ).withColumn("n", F.greatest(F.col("n"), F.lit(0)).cast("bigint"))


def page_records(parsed: DataFrame, *keep: str) -> DataFrame:
    """(page_no, shape, n, pos, record) and columns to keep for every element, in one pass.

    Unwrapped elements without ``row`` are empty records. A page without
    records keeps one line with a NULL position, so that it can be counted.
    """
    exploded = parsed.select(*keep, "page_no", "shape", "n", F.posexplode_outer("items").alias("pos", "item"))
    inner = F.coalesce(
        F.try_variant_get("item", "$.row", "variant"), F.parse_json(F.lit("{}"))
    )
    record = F.when(F.col("shape") == "rows", inner).otherwise(F.col("item"))
    return exploded.select(
        *keep, "page_no", "shape", "n", F.col("pos").cast("bigint").alias("pos"), record.alias("record")
    )


def normalize_pages(pages: DataFrame) -> DataFrame:
    """Records of all pages in the common shape."""
    records = page_records(parse_pages(pages)).where(F.col("pos").isNotNull())
    return records.select("page_no", "pos", "record")


def page_offsets(counts: DataFrame) -> DataFrame:
    """(page, offset): kept records before each page, from (page, page_no, n).

    Pages are in the order of their number, repeated ones in the order they
    were read. Running sums are taken in two levels, within blocks of pages and
    over the blocks, so that no task sees all pages.
    """
    blocked = counts.withColumn("block", F.floor(F.col("page_no") / _BLOCK))
    sums = blocked.groupBy("block").agg(F.sum("n").alias("block_n"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("block", F.coalesce(F.sum("block_n").over(before), F.lit(0)).alias("start"))
    within = (
        Window.partitionBy("block").orderBy("page_no", "page").rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = blocked.withColumn("inside", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return inside.join(starts, "block").select("page", (F.col("start") + F.col("inside")).alias("offset"))


@dataclass(frozen=True)
class PageReport:
    """What the landed pages are like; nothing of it changes what is read."""

    pages: int
    missing: int
    repeated: int
    short: int
    broken: int

    def error(self) -> str | None:
        return f"{self.broken} of {self.pages} pages are broken" if self.broken else None


@dataclass(frozen=True)
class Scan:
    """Kept records of all pages, numbered from 0, how many they are, and a report on the pages."""

    records: DataFrame
    kept: int
    report: PageReport

    @property
    def broken(self) -> bool:
        return self.report.broken > 0


def scan_dataset(pages: DataFrame, filters: Mapping[str, Any] | None = None) -> Scan:
    """All records of all landed pages that pass the filters, numbered in page order from 0.

    Pages are parsed and filtered once into a staged table. One narrow
    aggregate over it has a row for each page: how many records it keeps,
    whether it is broken (no number, no JSON, or an element that is no object),
    and whether it is shorter than the longest without being the last. Missing,
    repeated and short pages are reported; repeated ones are read again.
    """
    numbered = parse_pages(pages).withColumn("page", F.monotonically_increasing_id())
    lines = page_records(numbered, "page")
    whole = F.schema_of_variant("record").startswith("OBJECT")
    wanted = record_filter(filters, lines)
    hit = F.col("pos").isNotNull() if wanted is None else F.col("pos").isNotNull() & F.coalesce(wanted, F.lit(False))
    bad = F.col("page_no").isNull() | (F.col("shape") == "malformed") | (F.col("pos").isNotNull() & ~whole)
    marked = lines.withColumns({"hit": hit, "bad": F.coalesce(bad, F.lit(False))})
    first = F.coalesce("pos", F.lit(0)) == 0
    opened = staged(marked.where(F.col("hit") | F.col("bad") | first), "page-records")

    by_page = staged(
        opened.groupBy("page").agg(
            F.first("page_no").alias("page_no"),
            F.count_if("hit").alias("n"),
            F.first("n").alias("size"),
            F.bool_or("bad").alias("bad"),
        ),
        "pages",
    )
    facts = by_page.agg(
        F.count(F.lit(1)).alias("pages"),
        F.coalesce(F.max("page_no") - F.min("page_no") + 1, F.lit(0)).alias("span"),
        F.count_distinct("page_no").alias("numbers"),
        F.count("page_no").alias("with_number"),
        F.coalesce(F.max("size"), F.lit(0)).alias("longest"),
        F.max("page_no").alias("last"),
        F.count_if("bad").alias("broken"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("kept"),
    ).first()
    short = by_page.where((F.col("size") < facts["longest"]) & (F.col("page_no") != facts["last"])).count()
    report = PageReport(
        facts["pages"], facts["span"] - facts["numbers"], facts["with_number"] - facts["numbers"], short, facts["broken"]
    )
    # staged, so that Spark knows its size: the records are shuffled only if the pages are too many to broadcast
    offsets = staged(page_offsets(by_page.select("page", "page_no", "n")), "page-offsets")
    kept = opened.where("hit").join(offsets, "page")
    if wanted is None:
        place = F.col("pos")
    else:
        # a page is one response, so its records are few
        place = F.row_number().over(Window.partitionBy("page").orderBy("pos")) - 1
    index = (F.col("offset") + place).cast("bigint")
    return Scan(kept.select(index.alias("record_index"), "record"), facts["kept"], report)


def page_range(sizes: DataFrame, skip: int, take: int) -> tuple[int, int, int] | None:
    """First and last page number that hold the given elements of all, and how many lie before the first.

    None if there are none. From the counts alone: running sums in two levels, of which two rows are asked for.
    """
    known = sizes.where(F.col("page_no").isNotNull()).groupBy("page_no").agg(F.coalesce(F.sum("elements"), F.lit(0)).alias("n"))
    counts = known.withColumn("page", F.col("page_no"))
    placed = counts.join(page_offsets(counts), "page")
    held = placed.where((F.col("offset") < skip + take) & (F.col("offset") + F.col("n") > skip))
    found = held.agg(F.min("page_no").alias("first"), F.max("page_no").alias("last"), F.min("offset").alias("before")).first()
    return None if found["first"] is None else (found["first"], found["last"], found["before"])


def scan_some(
    spark: SparkSession, folder: str, filters: Mapping[str, Any] | None, limit: int, offset: int = 0
) -> Scan:
    """The records ``offset`` to ``offset + limit`` of those that pass the filters, numbered as in a full scan.

    Reads no more pages than it needs, by the counts of packed pages: without a
    filter just those that hold these records, else twice as many from the first
    on until enough records pass. Broken pages beyond them are not met. Loose
    files are all read.
    """
    pages, sizes = read_pages(spark, folder), page_sizes(spark, folder)
    if sizes is None:
        found = scan_dataset(pages, filters)
        return _cut(found, limit, offset, 0)
    if not filters:
        edges = page_range(sizes, offset, limit)
        if edges is None:  # nothing there; the pages around tell whether all are sound
            return _cut(scan_dataset(pages), limit, offset, 0)
        first, last, before = edges
        return _cut(scan_dataset(pages.where(F.col("page_no").between(first, last))), limit, offset, before)
    take = offset + limit
    while True:
        edges = page_range(sizes, take, 1)  # the page after enough elements, if there is one
        near = pages if edges is None else pages.where(F.col("page_no") <= edges[1])
        found = scan_dataset(near, filters)
        if edges is None or found.broken or found.kept >= offset + limit:
            return _cut(found, limit, offset, 0)
        take *= 2


def _cut(found: Scan, limit: int, offset: int, before: int) -> Scan:
    """Some of the records of a scan that began ``before`` records after the first."""
    records = found.records.withColumn("record_index", F.col("record_index") + before) if before else found.records
    kept = max(0, min(found.kept + before, offset + limit) - offset)
    return Scan(records.where(F.col("record_index").between(offset, offset + limit - 1)), kept, found.report)


def paged_scan(pages: DataFrame) -> DataFrame:
    """(record_index, record) of a whole dataset, numbered from 0 in page order."""
    return scan_dataset(pages).records


def scan(
    records: DataFrame,
    where: Column | None = None,
    order: list[Column] | None = None,
    limit: int | None = None,
    offset: int | None = None,
) -> DataFrame:
    """Filter, order, skip and limit records; 0 counts as not given."""
    found = records if where is None else records.where(where)
    if order:
        found = found.orderBy(*order)
    if offset:
        found = found.offset(offset)
    return found.limit(limit) if limit else found


def read_dataset_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata document of a dataset as one row."""
    return spark.read.schema(DATASET_METADATA).json(path, multiLine=True)


def dataset_columns(metadata: DataFrame) -> DataFrame:
    """One row per column each metadata document describes."""
    described = metadata.select(
        F.col("name").alias("dataset"), F.posexplode("columns").alias("position", "c")
    )
    return described.select(
        "dataset", "position", F.col("c.name").alias("name"), F.col("c.dataTypeName").alias("type")
    )


def with_lineage(
    records: DataFrame, dataset_id: str, dataset_name: str, run_id: str, ingested_at: datetime
) -> DataFrame:
    """Attach where a record came from; ``record_index`` moves into the struct as well."""
    stamp = ingested_at.isoformat()
    lineage = F.struct(
        F.lit(dataset_id).alias("dataset_id"),
        F.lit(dataset_name).alias("dataset_name"),
        F.lit(run_id).alias("run_id"),
        F.col("record_index"),
        F.lit(stamp).alias("ingested_at"),
        F.lit(SOURCE).alias("source"),
    )
    return records.withColumn(LINEAGE, lineage)


def _equals(value: FieldValue, wanted: Any) -> Column | None:
    """Whether a field is equal to a plain value; None for values of other types.

    Numbers compare as numbers, also with texts that read as one; whole numbers exactly.
    """
    if isinstance(wanted, str):
        return value.as_text() == wanted
    if not isinstance(wanted, (bool, int, float)):
        return None
    near = value.as_float() == float(wanted)
    if isinstance(wanted, float):
        return near
    digits = F.replace(value.stripped, F.lit("_"), F.lit(""))
    exact = digits.try_cast("decimal(38,0)") == F.lit(int(wanted)).cast("decimal(38,0)")
    return near & F.when(value.stripped.rlike(INTEGER_TEXT), exact).otherwise(F.lit(True))


def record_filter(filters: Mapping[str, Any] | None, records: DataFrame) -> Column | None:
    """The filter of plain values on the fields of VARIANT records.

    A list asks for any of its elements, an empty one for the empty text.
    """
    fields = RaggedRecords(records, "record")
    total: Column | None = None
    for name, wanted in (filters or {}).items():
        value = fields.value(name)
        tests = [_equals(value, w) for w in ((wanted or [""]) if isinstance(wanted, list) else [wanted])]
        tests = [t for t in tests if t is not None]
        if tests:
            test = reduce(Column.__or__, tests)
            total = test if total is None else total & test
    return total


def metadata_path(root: str, dataset_id: str) -> str:
    """Where the metadata document of a dataset is landed."""
    return f"{root.rstrip('/')}/metadata/{dataset_id}.json"


_INFO = struct(
    "run_id STRING, dataset_id STRING, dataset_name STRING, records_extracted BIGINT, status STRING, "
    "error STRING, extraction_start TIMESTAMP, extraction_end TIMESTAMP, extraction_duration_seconds DOUBLE, "
    "pages BIGINT, pages_missing BIGINT, pages_repeated BIGINT, pages_short BIGINT, metadata STRING"
)


def extract(
    spark: SparkSession,
    root: str,
    dataset_id: str,
    run_id: str,
    ingested_at: datetime,
    dataset_name: str | None = None,
    limit: int | None = None,
    filters: Mapping[str, Any] | None = None,
    use_resource_endpoint: bool = False,
    offset: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """Records with lineage, and one row of information about the extraction.

    The filters apply first; what passes is numbered densely from 0, and a
    limit keeps the lowest numbers from ``offset`` on, of packed pages without
    reading more of them than that needs. Whatever goes wrong, such as a page that is
    not JSON, an element that is not an object, or a folder that is not there,
    fails the extraction as a whole: status ``failed``, the error, no records.
    """
    name = dataset_name or dataset_id
    start = datetime.now(timezone.utc).replace(tzinfo=None)
    records, kept, error, report, metadata = None, 0, None, PageReport(0, 0, 0, 0, 0), None
    try:
        described = metadata_path(root, dataset_id)
        if path_exists(spark, described):
            metadata = spark.read.text(described, wholetext=True).first()[0]
        folder = page_folder(root, dataset_id, use_resource_endpoint)
        if limit or offset:
            found = scan_some(spark, folder, filters, limit or MOST_RECORDS, offset)
        else:
            found = scan_dataset(read_pages(spark, folder), filters)
        report, error = found.report, found.report.error()
        if error is None:
            records, kept = found.records, found.kept
    except PySparkException as failure:
        error = str(failure)
    if records is None:
        records = spark.range(0).select(F.col("id").alias("record_index"), F.parse_json(F.lit("{}")).alias("record"))
    end = datetime.now(timezone.utc).replace(tzinfo=None)
    info = (
        run_id, dataset_id, name, kept, "success" if error is None else "failed", error, start, end,
        (end - start).total_seconds(), report.pages, report.missing, report.repeated, report.short, metadata,
    )
    return with_lineage(records, dataset_id, name, run_id, ingested_at), spark.createDataFrame([info], _INFO)

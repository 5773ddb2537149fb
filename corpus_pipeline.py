"""From raw documents to a training mix: five stages, each a function of (spark, docs, sf_dir).

A stage works on all documents its predecessor kept and returns the columns of documents; the last adds what the mix
takes of each. Rows with a null ``doc_id`` pass the stages that compare documents. Stages but the last don't read
other columns than they need and hand all on, whatever their names; the last replaces columns named like its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsforge.llm.decontaminate import drop_contaminated
from obsforge.llm.jaccard_join import similar_groups
from obsforge.llm.line_dedup import dedup_lines
from obsforge.llm.mixing import mix
from obsforge.llm.quality import score_quality
from obsforge.session import released, staged

#: The classifier is fitted, the quotas are routed and the order is seeded, so there is no SQL for the whole.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return score_quality(docs, _table(spark, sf_dir, "labels")).where("predicted = 1").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document holds; n_chars follows a changed text."""
    changed = F.col("n_dropped") > 0
    row = F.col("row").withField("text", F.when(changed, F.col("kept")).otherwise(F.col("row.text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(changed, F.length("kept").cast(kind)).otherwise(F.col("row.n_chars")))
    return dedup_lines(docs).select(row.alias("row")).select("row.*")


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group that 5-word shingles link at 0.8 or more."""
    copies = similar_groups(docs, shingle=5, percent=80).where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with size, source_size, target, and taken, the words taken of each."""
    route = F.col("routes")[0]
    own = {
        "size": F.col("size"),
        "source_size": route["source_size"],
        "target": route["target"],
        "taken": F.col("taken"),
    }
    given = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in own]
    return mix(docs, F.array("source")).where("taken > 0").select(*given, *(value.alias(name) for name, value in own.items()))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("jaccard_join", jaccard_join),
    ("decontaminate", decontaminate),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each written and read again for the next."""
    docs = _table(spark, sf_dir, "documents")
    with released(spark):
        for name, stage in STAGES:
            docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}", lasting=name == STAGES[-1][0])
    return docs

"""The registered queries of this subpackage, each over its whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

import corpus_pipeline
from obsforge.llm import sql
from obsforge.llm.decontaminate import contaminated
from obsforge.llm.embedding_dedup import near_groups
from obsforge.llm.jaccard_join import similar_groups
from obsforge.llm.language import identify_languages
from obsforge.llm.lexical_search import rank_documents
from obsforge.llm.line_dedup import dedup_lines
from obsforge.llm.mixing import mix
from obsforge.llm.quality import score_quality
from obsforge.llm.span_dedup import drop_repeated_passages
from obsforge.llm.substring_dedup import drop_repeated_substrings
from obsforge.llm.token_counts import count_tokens
from obsforge.llm.toxicity import score_toxicity
from obsforge.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op4_line_dedup", sql.LINE_DEDUP)
def line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup_lines(table(spark, folder, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op10_jaccard_join", sql.JACCARD_JOIN)
def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_groups(table(spark, folder, "documents"), shingle=3, percent=90)


@query("op2_mixing", sql.MIXING)
def mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents"), F.array("source")).select(
        "doc_id",
        "size",
        F.col("routes")[0]["source_size"].alias("source_size"),
        F.col("routes")[0]["target"].alias("target"),
        "taken",
    )


@query("op3_decontaminate")
def decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark")).drop("version")


@query("op1_quality")
def quality(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(table(spark, folder, "documents"), table(spark, folder, "labels")).drop("row")


@query("op5_embedding_dedup", sql.EMBEDDING_DEDUP)
def embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "embeddings"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


@query("op6_span_dedup")
def span_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_passages(table(spark, folder, "documents")).select(
        "doc_id", "n_sentences", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op9_language")
def language(spark: SparkSession, folder: str) -> DataFrame:
    return identify_languages(table(spark, folder, "documents"))


@query("op8_toxicity")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_substring_dedup", sql.SUBSTRING_DEDUP)
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return drop_repeated_substrings(table(spark, folder, "documents")).drop("spans")


@query("op11_whitening")
def whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


@query("op12_token_counts")
def token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op13_lexical_search", sql.LEXICAL_SEARCH)
def lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return rank_documents(table(spark, folder, "benchmark"), table(spark, folder, "documents"))

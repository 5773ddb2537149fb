"""Column helpers that several text operators share."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The blanks that separate words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
#: The same as a character class for regular expressions.
BLANK_CLASS = r"[\x20\x09-\x0D]"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay. Pure ASCII, where ``lower`` does just that, takes the faster way."""
    letters = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(letters)


def words(text: Column) -> Column:
    """Words between blanks; an empty array for null or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"{BLANK_CLASS}+"))


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that the optimizer computes once, however often lambdas above it refer to it."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo ``folds``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def packed(docs: DataFrame) -> DataFrame:
    """doc_id, text and ``row``, the whole input row, so that no input column can clash with a working one."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.struct("*").alias("row")
    )


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches have at most ``rows`` rows in what runs inside the block; the caller's setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)

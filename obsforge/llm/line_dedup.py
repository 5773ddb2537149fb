"""Exact line deduplication over the whole corpus, as keep bitmaps.

Line hashes are range-partitioned with a secondary sort by document and position, and each sorted range is streamed:
the first document of a hash holds it, lines of later ones go. A line that a third of all documents hold is cut into
slices of consecutive places, which lie in as many ranges as they need; only the first holders of these slices are
merged afterwards, by hash. The result names lines by bit, not by text.

Defined cases: null or empty text is one empty line, which is too short to be dropped. A null ``doc_id`` neither
drops nor causes drops. Rows that share a ``doc_id`` are one document to the rule, and each keeps a bitmap of its own.
Only ``doc_id`` and ``text`` are read, so other columns may have any name. An empty table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsforge.llm.text import BLANKS, lower_ascii, packed
from obsforge.session import released, staged

WORD_BITS = 64
#: Lines of a range that are looked at for hot hashes, and those of one hash that make a slice.
SAMPLED, SLICE = 256, 32
_SCALE = 1 << 30


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def text_version(text: Column) -> Column:
    """Tells apart rows that share a doc_id."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(BLANKS)))


def bit_of(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), position % WORD_BITS)


def _hot_hashes(lines: DataFrame, parts: int) -> DataFrame:
    """(hash, cuts): the places (doc_id, position) at which hashes with much of a range are cut into slices.

    Found in a sample of about ``SAMPLED`` lines a range, so at most ``SAMPLED / SLICE`` cuts a range come out. Where
    lines are cut decides which task reads them, and never the result.
    """
    share = math.ceil(_SCALE * min(1.0, SAMPLED * parts / max(lines.count(), 1)))
    return staged(
        lines.where(F.pmod(F.xxhash64("doc_id", "position"), F.lit(_SCALE)) < share)
        .groupBy("hash")
        .agg(F.sort_array(F.collect_list(F.struct("doc_id", "position"))).alias("places"))
        .where(F.size("places") > SLICE)
        .select("hash", F.filter("places", lambda _, i: i % SLICE == 0).alias("cuts")),
        "hot-lines",
    )


def keep_bitmaps(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """One row per document that loses lines: doc_id, version, n_dropped and keep.

    ``keep`` lists (word, bits) only for words of 64 lines that lose a line; bit i of word w stands for line
    64 * w + i and is 1 where the line stays. Words that are not listed keep all their lines.
    """
    with released(docs.sparkSession):
        return staged(_streamed_bitmaps(docs, min_chars), "bitmaps", lasting=True)


def _streamed_bitmaps(docs: DataFrame, min_chars: int) -> DataFrame:
    spark = docs.sparkSession
    lines = staged(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            text_version(F.col("text")).alias("version"),
            F.posexplode(lines_of(F.col("text"))).alias("position", "line"),
        )
        .where("doc_id is not null")
        .withColumn("key", line_key(F.col("line")))
        .where(F.length("key") >= min_chars)
        .select(F.unhex(F.md5("key")).alias("hash"), "doc_id", "position", "version"),
        "lines",
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct("doc_id", "position")
    slice_ = F.when(F.col("cuts").isNull(), 0).otherwise(1 + F.size(F.filter("cuts", lambda cut: cut <= place)))
    # one range exchange: its ranges keep each (hash, slice) together, so the window below only sorts and streams
    ranged = (
        lines.join(_hot_hashes(lines, parts), "hash", "left")
        .select("hash", slice_.alias("slice"), "doc_id", "position", "version")
        .repartitionByRange(parts, "hash", "slice")
    )
    so_far = (
        Window.partitionBy("hash", "slice").orderBy("doc_id", "position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    streamed = ranged.withColumn("later", F.col("doc_id") > F.first("doc_id").over(so_far))
    found = staged(streamed.where("later or slice > 0"), "later-lines")
    # first holders in the slices of a split hash: only the hash's own first one stays
    heads = found.where("slice > 0 and not later")
    firsts = staged(heads.groupBy("hash").agg(F.min("doc_id").alias("first_doc")), "split-lines")
    across = heads.join(firsts, "hash").where("doc_id > first_doc")
    dropped = ["doc_id", "version", "position"]
    bit = bit_of(F.col("position"))
    return (
        found.where("later")
        .select(*dropped)
        .union(across.select(*dropped))
        .groupBy("doc_id", "version", F.floor(F.col("position") / WORD_BITS).cast("int").alias("word"))
        .agg(F.bit_or(bit).alias("drop"))
        .groupBy("doc_id", "version")
        .agg(
            F.sum(F.bit_count("drop")).alias("n_dropped"),
            F.sort_array(F.collect_list(F.struct("word", F.bitwise_not("drop").alias("bits")))).alias("keep"),
        )
    )


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """doc_id, text, row (the whole input row), n_lines, n_dropped and kept, the lines that stay joined by \\n."""
    # opened before the join: one array lookup per line above it
    dense = bitmaps.select(
        F.col("doc_id").alias("of_doc"),
        F.col("version").alias("of_version"),
        "n_dropped",
        F.expr(
            "transform(sequence(0, element_at(keep, -1).word),"
            " w -> coalesce(element_at(map_from_entries(keep), w), -1L))"
        ).alias("bits"),
    )
    joined = packed(docs).join(
        dense, (F.col("doc_id") == F.col("of_doc")) & (text_version(F.col("text")) == F.col("of_version")), "left"
    )
    stays = lambda line, i: F.coalesce(
        F.get(F.col("bits"), F.floor(i / WORD_BITS).cast("int")).bitwiseAND(bit_of(i)) != 0,
        F.lit(True),
    )
    lines = lines_of(F.col("text"))
    return joined.select(
        "doc_id",
        "text",
        "row",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("n_dropped").isNull(), F.coalesce("text", F.lit("")))
        .otherwise(F.array_join(F.filter(lines, stays), "\n"))
        .alias("kept"),
    )


def dedup_lines(docs: DataFrame, min_chars: int = 10) -> DataFrame:
    """``apply_bitmaps`` of ``keep_bitmaps``."""
    return apply_bitmaps(docs, keep_bitmaps(docs, min_chars))

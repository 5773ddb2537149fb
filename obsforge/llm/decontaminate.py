"""Finding benchmark items in documents: SimHash fingerprints of item-sized windows, searched by Hamming blocks.

A window has as many words as an item. It is cut wherever a shingle of the document is also one of an item, so that
both would lie on each other; windows without any shingle of an item cannot be similar to one and are left out.
Windows and items get a SimHash of their shingles, weighed by how often they occur. Fingerprints fall into
``BLOCKS`` blocks: of two within ``RADIUS`` bits at least one block differs in RADIUS // BLOCKS bits or fewer, so
items are indexed under every block value that close, and each pair within the radius meets. Those pairs are
candidates; they count if the weighted Jaccard similarity of their shingles, exactly computed, is high enough.

Defined cases: a null or empty text, or one with fewer words than a shingle, holds no item; an item with fewer words
than a shingle is in no document. A document shorter than an item is one window. Rows that share ``doc_id`` and text
count once; rows with a null ``doc_id`` are searched as well. Other columns aren't read. Either table may be empty.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.llm.line_dedup import text_version
from obsforge.llm.text import computed, words
from obsforge.session import released, staged

#: Bits of a fingerprint and blocks they fall into.
BITS, BLOCKS = 60, 4
BLOCK_BITS = BITS // BLOCKS
#: Fingerprints this many bits apart, or fewer, are candidates.
RADIUS = 15
#: Item shingles up to this number are broadcast (about 40 bytes each); more are shuffled.
BROADCAST_ROWS = 500_000

#: Counters of three bits are added up in one number, this many bits apart.
_LANE = 20


def _shingles(df: DataFrame, shingle: int) -> DataFrame:
    """Adds ``shingles``, the hashes of all runs of ``shingle`` words of ``text``, and drops the text."""
    split = computed(df, "words", words(F.lower("text")))
    hashes = F.expr(
        f"CASE WHEN size(words) < {shingle} THEN array() ELSE"
        f" transform(sequence(1, size(words) - {shingle - 1}), i -> xxhash64(slice(words, i, {shingle}))) END"
    )
    return computed(split, "shingles", hashes.cast("array<bigint>")).drop("words", "text")


def simhash(rows: DataFrame, *keys: str) -> DataFrame:
    """The fingerprint of each group of ``keys`` over its rows ``hash``, ``weight``, as column ``fingerprint``."""
    mask = sum(1 << (_LANE * i) for i in range(3))
    sums = [
        F.sum(F.shiftright("hash", j).bitwiseAND(F.lit(mask)) * F.col("weight")).alias(f"lanes_{j}") for j in range(_LANE)
    ]
    counted = rows.groupBy(*keys).agg(F.sum("weight").alias("weights"), *sums)
    bits = F.lit(0).cast("long")
    for j in range(_LANE):
        for lane in range(3):
            ones = F.shiftright(f"lanes_{j}", _LANE * lane).bitwiseAND(F.lit((1 << _LANE) - 1))
            bits = bits.bitwiseOR(F.when(2 * ones > F.col("weights"), F.lit(1 << (_LANE * lane + j))).otherwise(F.lit(0)))
    return counted.select(*keys, F.col("weights").alias("n_shingles"), bits.alias("fingerprint"))


def blocks(fingerprint: Column) -> Column:
    """array<struct<block, value>>."""
    low = F.lit((1 << BLOCK_BITS) - 1)
    return F.array(
        *(
            F.struct(
                F.lit(b).alias("block"),
                F.shiftright(fingerprint, BLOCK_BITS * b).bitwiseAND(low).cast("int").alias("value"),
            )
            for b in range(BLOCKS)
        )
    )


def _near_values() -> list[int]:
    """Masks of up to RADIUS // BLOCKS bits of a block."""
    return [sum(1 << b for b in bits) for n in range(RADIUS // BLOCKS + 1) for bits in combinations(range(BLOCK_BITS), n)]


def candidates(fingerprints: DataFrame, items: DataFrame) -> DataFrame:
    """(fingerprint, item_id) of all pairs within RADIUS. Both inputs have ``fingerprint``; items ``item_id``."""
    masks = F.explode(F.array(*map(F.lit, _near_values()))).alias("mask")
    index = (
        items.select("item_id", F.col("fingerprint").alias("item_print"), F.inline(blocks(F.col("fingerprint"))))
        .select("*", masks)
        .select("item_id", "item_print", "block", F.col("value").bitwiseXOR(F.col("mask")).alias("value"))
    )
    probes = fingerprints.select("fingerprint", F.inline(blocks(F.col("fingerprint"))))
    return (
        probes.join(index, ["block", "value"])
        .where(F.bit_count(F.col("fingerprint").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("fingerprint", "item_id")
        .distinct()
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row per document and item it holds: doc_id, version, item_id, similarity, and the best window.

    The window is given by ``start`` (its first word, from 0) and ``n_words``; of equally similar ones the first.
    """
    with released(docs.sparkSession):
        return staged(_verified(docs, benchmark, shingle, similarity), "contaminated", lasting=True)


def _verified(docs: DataFrame, benchmark: DataFrame, shingle: int, similarity: float) -> DataFrame:
    of_items = computed(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")),
        "n_words",
        F.size(words(F.col("text"))),
    )
    item_rows = staged(
        _shingles(of_items, shingle).select("item_id", "n_words", F.posexplode("shingles").alias("offset", "hash")).distinct(),
        "items",
    )
    small = item_rows.count() <= BROADCAST_ROWS

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        text_version(F.col("text")).alias("version"),
    )
    marks = item_rows.select("hash", "offset", "n_words").distinct()
    hits = (
        _shingles(texts, shingle)
        .select("doc_id", "version", F.size("shingles").alias("n"), F.posexplode("shingles").alias("position", "hash"))
        .join(F.broadcast(marks) if small else marks, "hash")
    )
    # item-sized windows inside the document
    most = F.greatest(F.col("n") + (shingle - 1) - F.col("n_words"), F.lit(0))
    windows = hits.select(
        "doc_id",
        "version",
        F.greatest(F.least(F.col("position") - F.col("offset"), most), F.lit(0)).alias("start"),
        "n_words",
    ).distinct()
    of_doc = staged(
        windows.groupBy("doc_id", "version").agg(F.collect_list(F.struct("start", "n_words")).alias("windows")), "windows"
    ).withColumnsRenamed({"doc_id": "of_doc", "version": "of_version"})
    matched = texts.join(of_doc, F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("version") == F.col("of_version")))
    window = ["doc_id", "version", "start", "n_words"]
    cut = (
        _shingles(matched.select("doc_id", "version", "text", "windows"), shingle)
        .select("doc_id", "version", "shingles", F.inline("windows"))
        .select(*window, F.slice("shingles", F.col("start") + 1, F.col("n_words") - (shingle - 1)).alias("shingles"))
        .dropDuplicates(window)
        .select(*window, F.explode("shingles").alias("hash"))
        .groupBy(*window, "hash")
        .agg(F.count("*").alias("weight"))
    )
    window_rows = staged(cut, "window_shingles")
    prints = staged(simhash(window_rows, *window), "window_prints")
    item_weights = item_rows.groupBy("item_id", "n_words", "hash").agg(F.count("*").alias("weight"))
    item_prints = staged(simhash(item_weights, "item_id", "n_words"), "item_prints")
    near = staged(candidates(prints.select("fingerprint").distinct(), item_prints), "candidates")

    pairs = prints.join(near, "fingerprint").join(
        item_prints.select("item_id", F.col("n_shingles").alias("n_item"), F.col("n_words").alias("item_words")), "item_id"
    )
    pairs = pairs.select(*window, "item_id", "n_shingles", "n_item")
    rows = window_rows.withColumnsRenamed({c: f"w_{c}" for c in window})
    same = F.lit(True)
    for c in window:
        same = same & F.col(c).eqNullSafe(F.col(f"w_{c}"))
    of_item = item_weights.select("item_id", "hash", F.col("weight").alias("item_weight"))
    both = F.sum(F.least("weight", "item_weight"))
    verified = (
        pairs.join(rows, same)
        .join(of_item, ["item_id", "hash"])
        .groupBy(*window, "item_id", "n_shingles", "n_item")
        .agg(both.alias("both"))
        .withColumn("similarity", F.col("both") / (F.col("n_shingles") + F.col("n_item") - F.col("both")))
        .where(F.col("similarity") >= similarity)
    )
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words"))
    return (
        verified.groupBy("doc_id", "version", "item_id")
        .agg(best.alias("best"))
        .select(
            "doc_id",
            "version",
            "item_id",
            F.col("best.similarity").alias("similarity"),
            (-F.col("best.back")).alias("start"),
            F.col("best.n_words").alias("n_words"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The documents that hold no item, with their columns as they are."""
    found = contaminated(docs, benchmark, shingle, similarity).select(
        F.col("doc_id").alias("of_doc"), F.col("version").alias("of_version")
    )
    whole = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_version(F.col("text")).alias("version"), F.struct("*").alias("row")
    )
    same = F.col("doc_id").eqNullSafe(F.col("of_doc")) & (F.col("version") == F.col("of_version"))
    return whole.join(found.distinct(), same, "left_anti").select("row.*")

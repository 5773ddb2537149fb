"""Removing every byte that a repeated string covers, exactly, by suffix arrays of the places where texts may repeat.

Sorting all suffixes of a corpus would write each byte hundreds of times. Most strings of ``LENGTH`` bytes occur once, and
three steps of hashing leave those out before anything is sorted:

1. The anchor of a string is the ``GRAM``-byte piece in it with the least hash (the last of equal ones). Equal strings
   have equal anchors at equal offsets, and neighbouring strings mostly share theirs, so the starts of a text fall into
   segments of one anchor. Segments whose anchor occurs once have no repeated string.
2. Segments with equal anchor and equal bytes are repeated as a whole. Of the others of an anchor, one of each kind is
   cut into blocks of ``BLOCK`` starts at equal offsets from the anchor. All strings of a block hold its core; blocks
   whose core occurs once have no repeated string, and equal blocks are repeated as a whole.
3. What is left, the ends of repeated passages, is put together in pieces of text. Blocks of one core meet in one chunk of
   bounded size, whose suffixes are sorted in two stages; adjacent common prefixes of ``LENGTH`` or more bytes are
   the repeated strings. Where more than ``MOST`` kinds of block have a core, their strings are hashed one by one and
   counted instead, so that no chunk grows with a frequent passage.

Counts are combined before the shuffle, no step holds the places of a string together, and joins on frequent strings can
be split. Anchors, cores and blocks are matched by 64 to 128 bits of hashes; what ends in a chunk by its bytes.

Defined cases: null texts are empty, and texts shorter than ``LENGTH`` lose nothing. Rows that share a ``doc_id`` or have
none are documents of their own, so equal rows repeat each other. Other columns aren't read. An empty table gives
an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.llm.hashing import byte_hashes, mix, prefix_hash, span_hash, texts_of
from obsforge.llm.jaccard_join import small_batches
from obsforge.llm.suffix_array import repeated_starts
from obsforge.session import staged

#: Bytes of a string that must not repeat, of its anchor, and starts of a block.
LENGTH, GRAM, BLOCK = 400, 160, 32
#: Kinds of block of one core that meet in a chunk, and bytes that a chunk is meant to hold.
MOST, CHUNK_BYTES = 2048, 1 << 19
#: A kind of more rows than this share of a shuffle partition is matched without a shuffle.
SHARES = 8
#: Starts handled at once.
PIECE = 1 << 20

_U64 = np.uint64
_SECOND = _U64(0xA0761D6478BD642F)


def anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each window of hashes, the position of the least, the last of equal ones.

    Running minima from either end of blocks of one window's length give the minimum of any window.
    """
    n = len(hashes)
    bits = int(window).bit_length()
    full = _U64((1 << bits) - 1)
    rows = -(-n // window)
    keys = np.full(rows * window, np.iinfo(np.uint64).max, dtype=np.uint64)
    place = full - (np.arange(n, dtype=np.uint64) % _U64(window))
    keys[:n] = (hashes & ~full) | place
    table = keys.reshape(rows, window)
    ahead = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(table, axis=1).ravel()
    at = np.arange(n - window + 1)
    left, right = ahead[at], behind[at + window - 1]
    last = (right | full) <= (left | full)
    base = np.where(last, (at + window - 1) // window, at // window) * window
    return base + (full - (np.where(last, right, left) & full)).astype(np.int64)


def segments_of(text: bytes, length: int) -> np.ndarray:
    """Rows of anchor hash, segment hash, first start, offset of the anchor, number of starts (as int64)."""
    found = [np.zeros((0, 5), dtype=np.int64)]
    gram = _gram(length)
    for low in range(0, len(text) - length + 1, PIECE):
        data = np.frombuffer(text[low : low + PIECE + length - 1], dtype=np.uint8)
        prefix = prefix_hash(byte_hashes(data))
        at = np.arange(len(data) - gram + 1)
        hashes = span_hash(prefix, at, at + gram)
        anchor = anchors(hashes, length - gram + 1)
        first = np.concatenate(([0], np.flatnonzero(np.diff(anchor)) + 1))
        last = np.append(first[1:], len(anchor)) - 1
        offset, starts = anchor[first] - first, last - first + 1
        whole = mix(span_hash(prefix, first, last + length) + mix((offset * 4096 + starts).astype(np.uint64)))
        found.append(
            np.stack([hashes[anchor[first]].view(np.int64), whole.view(np.int64), first + low, offset, starts], axis=1)
        )
    return np.concatenate(found)


def _gram(length: int) -> int:
    return max(1, GRAM * length // LENGTH)


def blocks_of(text: bytes, segments: list, length: int) -> np.ndarray:
    """Rows of core hash, block hash, first start, number of starts, occurrences of the segment (as int64)."""
    data = np.frombuffer(text, dtype=np.uint8)
    prefix = prefix_hash(byte_hashes(data))
    low, offset, starts, n = (np.array([s[k] for s in segments], dtype=np.int64) for k in ("first", "offset", "starts", "n"))
    anchor, high = low + offset, low + starts - 1
    block = _block(length)
    found = [np.zeros((0, 5), dtype=np.int64)]
    for b in range(length // block + 1):
        top = anchor - b * block  # the block's last start
        first, last = np.maximum(low, top - block + 1), np.minimum(high, top)
        here = first <= last
        if not here.any():
            continue
        top, first, last, own = top[here], first[here], last[here], anchor[here]
        core = mix(span_hash(prefix, top, top - block + 1 + length) + _U64(b))
        kind = mix(span_hash(prefix, first, last + length) + mix(((own - first) * 4096 + last - first).astype(np.uint64)))
        found.append(np.stack([core.view(np.int64), kind.view(np.int64), first, last - first + 1, n[here]], axis=1))
    return np.concatenate(found)


def _block(length: int) -> int:
    return max(1, BLOCK * length // LENGTH)


def _rows(batch: pa.RecordBatch, tables: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """The id columns of a batch repeated for the rows of each text's table, then the table's columns."""
    at = pa.array(np.repeat(np.arange(len(tables)), [len(t) for t in tables]))
    columns = np.concatenate(tables) if tables else np.zeros((0, len(names)), dtype=np.int64)
    return pa.RecordBatch.from_arrays(
        [batch.column("id").take(at), batch.column("version").take(at), *(pa.array(np.ascontiguousarray(c)) for c in columns.T)],
        names=["id", "version", *names],
    )


_IDS = "id long, version long"


def _texts(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(doc_id, F.lit(0)).alias("id"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("version"),
        text.cast("binary").alias("text"),
    )


def _with_text(texts: DataFrame, places: DataFrame, *columns: str) -> DataFrame:
    """One row per document with its text and the list of its places."""
    listed = places.groupBy("id", "version").agg(F.collect_list(F.struct(*columns)).alias("places"))
    return texts.dropDuplicates(["id", "version"]).join(listed, ["id", "version"])


def _alike(rows: DataFrame, kinds: DataFrame, group: str) -> DataFrame:
    """The rows whose kind occurs more than once; ``kinds`` counts the rows of each kind.

    Kinds that hold more than a share of the rows are broadcast, so that their rows aren't gathered. They are fewer than
    ``SHARES`` for each shuffle partition, however many rows there are.
    """
    key = [group, "kind"]
    limit = rows.count() // (SHARES * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    hot = F.broadcast(kinds.where(F.col("n") > limit).select(*key))
    few = kinds.where((F.col("n") > 1) & (F.col("n") <= limit)).select(*key)
    return rows.join(hot, key, "left_semi").union(rows.join(hot, key, "left_anti").join(few, key, "left_semi"))


def repeated_starts_of(docs: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(id, version, first, last): stretches of starts of strings that also start elsewhere; and the texts with any."""
    small_batches(docs.sparkSession)

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = [segments_of(t, length) for t in texts_of(batch, "text")]
            yield _rows(batch, tables, ["anchor", "kind", "first", "offset", "starts"])

    segments = _texts(docs).drop("doc_id").mapInArrow(segment, f"{_IDS}, anchor long, kind long, first long, offset long, starts long")
    again = staged(segments.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "anchors")
    segments = staged(segments.join(again, "anchor", "left_semi"), "segments")
    one = F.min(F.struct("id", "version", "first", "offset", "starts")).alias("one")
    kinds = staged(segments.groupBy("anchor", "kind").agg(F.count("*").alias("n"), one), "kinds")
    stretch = ["id", "version", "first", (F.col("first") + F.col("starts") - 1).alias("last")]
    whole = _alike(segments, kinds, "anchor").select(*stretch)

    texts = staged(
        _texts(docs).drop("doc_id").join(segments.select("id", "version").distinct(), ["id", "version"], "left_semi"), "texts"
    )
    mixed = staged(kinds.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "mixed")
    unlike = kinds.join(mixed, "anchor", "left_semi").select("one.*", "n")

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column("places").to_pylist()
            tables = [blocks_of(t, p, length) for t, p in zip(texts_of(batch, "text"), places, strict=True)]
            yield _rows(batch, tables, ["core", "kind", "first", "starts", "n"])

    blocks = staged(
        _with_text(texts, unlike, "first", "offset", "starts", "n").mapInArrow(
            block, f"{_IDS}, core long, kind long, first long, starts long, n long"
        ),
        "blocks",
    )
    again = staged(blocks.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), "cores")
    blocks = staged(blocks.join(again, "core", "left_semi"), "blocks")
    one = F.min(F.struct("id", "version", "first", "starts")).alias("one")
    kinds = staged(blocks.groupBy("core", "kind").agg(F.count("*").alias("n"), F.max("n").alias("most"), one), "block_kinds")
    alike = _alike(blocks, kinds, "core").select(*stretch)

    single = (F.col("n") == 1) & (F.col("most") == 1)
    mixed = kinds.groupBy("core").agg(F.count("*").alias("kinds"), F.count_if(single).alias("open"))
    mixed = staged(mixed.where("kinds > 1 and open > 0").select("core", "kinds"), "mixed")
    ends = staged(kinds.join(mixed, "core").select("core", "kinds", "one.*", single.alias("open")), "ends")
    found = whole.union(alike).union(_sorted_ends(texts, ends.where(F.col("kinds") <= MOST), length))
    hot = ends.where(F.col("kinds") > MOST)
    if not hot.isEmpty():
        found = found.union(_counted_ends(texts, hot, length))
    return found, texts


def _sorted_ends(texts: DataFrame, ends: DataFrame, length: int) -> DataFrame:
    """Stretches of repeated starts in blocks, by suffix arrays of chunks that hold all blocks of their cores."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "version", "core", "first", "open", "piece"]
        for batch in batches:
            rows = [
                (i, v, p["core"], p["first"], p["open"], t[p["first"] : p["first"] + p["starts"] - 1 + length])
                for i, v, t, places in zip(
                    batch.column("id").to_pylist(), batch.column("version").to_pylist(), texts_of(batch, "text"),
                    batch.column("places").to_pylist(), strict=True,
                )
                for p in places
            ]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    pieces = staged(
        _with_text(texts, ends, "core", "first", "starts", "open").mapInArrow(
            cut, f"{_IDS}, core long, first long, open boolean, piece binary"
        ),
        "pieces",
    )
    total = pieces.agg(F.sum(F.octet_length("piece"))).first()[0] or 0
    chunks = total // CHUNK_BYTES + 1

    def sort(table: pa.Table) -> pa.Table:
        ids, versions, first, is_open = (table.column(c).to_numpy() for c in ("id", "version", "first", "open"))
        rows = []
        for at, starts in enumerate(repeated_starts(table.column("piece").to_pylist(), length)):
            if is_open[at] and starts.any():
                edge = np.flatnonzero(np.diff(np.concatenate(([0], starts.astype(np.int8), [0]))))
                rows += [(ids[at], versions[at], first[at] + a, first[at] + b - 1) for a, b in zip(edge[::2], edge[1::2], strict=True)]
        columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
        return pa.table({n: np.ascontiguousarray(c) for n, c in zip(("id", "version", "first", "last"), columns, strict=True)})

    chunk = F.pmod(F.xxhash64("core"), F.lit(chunks)).alias("chunk")
    grouped = pieces.select(chunk, "id", "version", "first", "open", "piece").groupBy("chunk")
    return grouped.applyInArrow(sort, f"{_IDS}, first long, last long")


def _counted_ends(texts: DataFrame, ends: DataFrame, length: int) -> DataFrame:
    """The same for blocks of cores with very many kinds: their strings are counted by hash."""

    def strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = []
            for text, places in zip(texts_of(batch, "text"), batch.column("places").to_pylist(), strict=True):
                data = np.frombuffer(text, dtype=np.uint8)
                one, two = prefix_hash(byte_hashes(data)), prefix_hash(mix(byte_hashes(data) ^ _SECOND))
                at = np.concatenate([np.arange(p["first"], p["first"] + p["starts"]) for p in places])
                is_open = np.repeat([int(p["open"]) for p in places], [p["starts"] for p in places])
                hashes = (span_hash(h, at, at + length).view(np.int64) for h in (one, two))
                tables.append(np.stack([*hashes, at, is_open], axis=1))
            yield _rows(batch, tables, ["one", "two", "first", "open"])

    rows = staged(
        _with_text(texts, ends, "first", "starts", "open").mapInArrow(
            strings, f"{_IDS}, one long, two long, first long, open long"
        ),
        "strings",
    )
    again = staged(rows.groupBy("one", "two").agg(F.count("*").alias("n")).where("n > 1").select("one", "two"), "strings")
    found = rows.where("open = 1").join(again, ["one", "two"], "left_semi")
    return found.select("id", "version", "first", F.col("first").alias("last"))


def merged(firsts: list[int], lasts: list[int], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal covered spans, as starts and ends, of strings that start in the given stretches."""
    order = np.argsort(firsts, kind="stable")
    low = np.array(firsts, dtype=np.int64)[order]
    high = np.maximum.accumulate(np.array(lasts, dtype=np.int64)[order] + length)
    opens = np.concatenate(([True], low[1:] > high[:-1]))
    return low[opens], high[np.append(opens[1:], True)]


def drop_repeated_substrings(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and spans, the removed (start, end) byte ranges."""
    found, texts = repeated_starts_of(docs, length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, places in zip(texts_of(batch, "text"), batch.column("places").to_pylist(), strict=True):
                starts, ends = merged([p["first"] for p in places], [p["last"] for p in places], length)
                edges = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(text)]
                kept = b"".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
                spans = [{"start": int(a), "end": int(b)} for a, b in zip(starts, ends, strict=True)]
                rows.append((int((ends - starts).sum()), len(starts), hashlib.sha256(kept).hexdigest(), spans))
            removed, spans, digest, ranges = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("version"),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(ranges, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["id", "version", "removed", "n", "digest", "ranges"],
            )

    shorter = staged(
        _with_text(texts, found, "first", "last").mapInArrow(
            cut, f"{_IDS}, removed long, n long, digest string, ranges array<struct<start:long,end:long>>"
        ),
        "shorter",
    )
    plain = _texts(docs).select(
        "doc_id", "id", "version", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("own")
    )
    return plain.join(shorter, ["id", "version"], "left").select(
        "doc_id",
        "n_bytes",
        F.coalesce("removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n", F.lit(0)).alias("n_spans"),
        F.coalesce("digest", "own").alias("kept_sha256"),
        F.coalesce("ranges", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
    )

"""Ranked lexical search of a query set over all documents by dense matrix products in blocks.

Items are taken in blocks of a bounded number of terms. One pass over the documents keeps, for each, its length and the
frequencies of the block's terms; sums of these give the weights of the terms. A second pass multiplies tiles: up to
``TILE_ITEMS`` items over the terms they use, times the impacts of these terms in up to ``TILE_DOCS`` documents. All
factors are integers held in doubles, and a product spans no more terms than keep every partial sum below 2**53, so
scores are exact whatever the order of additions. Of each tile the best documents of an item stay, with all that tie with
the last of them, until ties are cut by ``doc_id``; the best of the tasks meet in two steps.

Every block reads the documents once. What a task holds is one block of items and, for each of its items, the best
documents so far.

Defined cases: a null or empty text and one of other signs only has no terms; such a document counts nowhere, such an item
has no rows. Each row of the documents is a document, also under a repeated ``doc_id``; a null id comes after all others
among equal scores. Each row of the items is an item, also under a null or repeated ``item_id``. Only ids and texts are
read. An empty table on either side gives an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsforge.llm.text import batches_of
from obsforge.session import released, staged

#: Best documents of an item.
BEST = 50
#: Terms of the items of a block, each item's counted by themselves; one item may have more.
BLOCK_TERMS = 1 << 18
#: Items, terms and documents of one matrix product.
TILE_ITEMS, TILE_TERMS, TILE_DOCS = 64, 2048, 512
#: No impact is larger.
MOST_IMPACT = 1_000_000
#: Parts in which the best documents of an item are first compared.
PARTS = 64
#: Bytes of a text that are split at once.
PIECE = 1 << 20

# numbers of documents and of terms among the sums of a block
_DOCUMENTS, _TERMS = -1, -2
_IN_TERM = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))
_SIGNS = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in _IN_TERM)
_POSTINGS = "doc_id long, n long, terms array<int>, counts array<int>"
_HITS = "item long, item_id long, doc_id long, score long"


def term_counts(text: bytes) -> Counter:
    """How often each term occurs."""
    spaced = text.translate(_SIGNS)
    found: Counter = Counter()
    at = 0
    while at < len(spaced):
        stop = len(spaced) if len(spaced) - at <= PIECE else spaced.find(b" ", at + PIECE)
        stop = len(spaced) if stop < 0 else stop
        found.update(spaced[at:stop].split())
        at = stop
    return found


@dataclass
class Tile:
    items: range  # their numbers in the block
    parts: list[tuple[np.ndarray, np.ndarray]]  # terms, ascending, and items by terms: the weight or 0


@dataclass
class Block:
    first: int  # number of the first item among all items
    ids: list[int | None]
    items: list[np.ndarray]  # the terms of each, as numbers
    terms: list[bytes]


def item_blocks(items: DataFrame, most: int) -> Iterator[Block]:
    """The items with terms, ``most`` terms at a time; the driver holds one block."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(term_counts(t or b"")) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item_id"), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])

    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").cast("binary").alias("text"))
    rows = staged(texts.mapInArrow(cut, "item_id long, terms array<binary>").where("size(terms) > 0"), "items")
    first, ids, of, known = 0, [], [], {}
    size = 0
    for row in rows.toLocalIterator():
        if ids and size + len(row.terms) > most:
            yield Block(first, ids, of, list(known))
            first, ids, of, known, size = first + len(ids), [], [], {}, 0
        ids.append(row.item_id)
        of.append(np.sort(np.array([known.setdefault(bytes(t), len(known)) for t in row.terms], dtype=np.int32)))
        size += len(row.terms)
    if ids:
        yield Block(first, ids, of, list(known))


def tiles(block: Block, weights: np.ndarray) -> list[Tile]:
    """Products of at most so many terms that no partial sum reaches 2**53."""
    width = int(min(TILE_TERMS, (2**53 - 1) // (MOST_IMPACT * max(1, int(weights.max(initial=0))))))
    found = []
    for at in range(0, len(block.items), TILE_ITEMS):
        own = block.items[at : at + TILE_ITEMS]
        used = np.unique(np.concatenate(own))
        used = used[weights[used] > 0]
        whole = np.zeros((len(own), len(used)))
        for row, terms in zip(whole, own, strict=True):
            place = np.searchsorted(used, terms)
            held = (place < len(used)) & (used[np.minimum(place, len(used) - 1)] == terms) if len(used) else np.zeros(len(terms), dtype=bool)
            row[place[held]] = weights[terms[held]]
        parts = [(used[i : i + width], np.ascontiguousarray(whole[:, i : i + width])) for i in range(0, len(used), width)]
        found.append(Tile(range(at, at + len(own)), parts))
    return found


class Best:
    """The best documents of the items of a tile so far."""

    def __init__(self, items: int, many: int):
        self.many = many
        self.least = np.ones(items, dtype=np.int64)  # a score below is not among the best
        self.held: list[list[tuple[np.ndarray, ...]]] = [[] for _ in range(items)]
        self.size = np.zeros(items, dtype=np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        """scores: documents by items."""
        if len(scores) >= self.many:
            np.maximum(self.least, np.partition(scores, -self.many, axis=0)[-self.many], out=self.least)
        hit = scores >= self.least
        for item in np.flatnonzero(hit.any(axis=0)):
            at = np.flatnonzero(hit[:, item])
            self.held[item].append((scores[at, item], ids[at], null[at]))
            self.size[item] += len(at)
            if self.size[item] > 16 * self.many:
                self.cut(item)

    def cut(self, item: int) -> tuple[np.ndarray, ...]:
        columns = [np.concatenate(c) for c in zip(*self.held[item], strict=True)]
        scores, ids, null = columns
        order = np.lexsort((ids, null, -scores))[: self.many]
        kept = tuple(c[order] for c in columns)
        self.held[item], self.size[item] = [kept], len(order)
        if len(order) == self.many:
            self.least[item] = max(self.least[item], kept[0][-1])
        return kept


def impacts(counts: np.ndarray, lengths: list[int], documents: int, terms: int, whose: np.ndarray) -> np.ndarray:
    """What an occurrence count is worth in its document, before the weight of the term."""
    norm = np.array([50 + 50 * n * documents // terms for n in lengths], dtype=np.int64)[whose]
    return 1_000_000_000 * counts // (1000 * counts + 20 * norm)


def tile_scores(tile: Tile, terms: np.ndarray, whose: np.ndarray, worth: np.ndarray, documents: int) -> np.ndarray:
    """Scores of documents (rows) for the items of a tile."""
    total = np.zeros((documents, len(tile.items)), dtype=np.int64)
    for used, weights in tile.parts:
        place = np.minimum(np.searchsorted(used, terms), len(used) - 1)
        held = used[place] == terms
        dense = np.zeros((documents, len(used)))
        dense[whose[held], place[held]] = worth[held]
        total += (dense @ weights.T).astype(np.int64)
    return total


def _postings(docs: DataFrame, block: Block) -> DataFrame:
    number = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(block.terms)})  # BLOCK_TERMS at most

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = number.value
        for batch in batches:
            lengths, found, counts = [], [], []
            for text in batch.column("text").to_pylist():
                own = term_counts(text or b"")
                held = [(known[t], n) for t, n in own.items() if t in known]
                lengths.append(own.total())
                found.append([t for t, _ in held])
                counts.append([n for _, n in held])
            columns = [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(found, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return staged(texts.mapInArrow(count, _POSTINGS).where("n > 0"), "postings")


def _statistics(postings: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all their terms, and how many documents hold each term of the block."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(terms, dtype=np.int64)
        documents = length = 0
        for batch in batches:
            held += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=terms)
            documents += batch.num_rows
            length += sum(batch.column("n").to_pylist())
        some = np.flatnonzero(held)
        names = pa.array([_DOCUMENTS, _TERMS, *some.tolist()], pa.int64())
        yield pa.RecordBatch.from_arrays([names, pa.array([documents, length, *held[some].tolist()], pa.int64())], names=["term", "total"])

    rows = postings.select("n", "terms").mapInArrow(add, "term long, total long").groupBy("term").agg(F.sum("total").alias("total"))
    found = {r.term: r.total for r in rows.collect()}  # a row for each term of the block
    held = np.zeros(terms, dtype=np.int64)
    for term, total in found.items():
        if term >= 0:
            held[term] = total
    return found.get(_DOCUMENTS, 0), found.get(_TERMS, 0), held


def _hits(postings: DataFrame, block: Block, best: int) -> DataFrame:
    documents, length, held = _statistics(postings, len(block.terms))
    weights = np.array([floor(1000 * log((2 * documents + 2) / (2 * int(d) + 1))) if d else 0 for d in held], dtype=np.int64)
    model = postings.sparkSession.sparkContext.broadcast(tiles(block, weights))
    first, item_ids = block.first, block.ids

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = [(tile, Best(len(tile.items), best)) for tile in model.value]
        for batch in batches:
            for at in range(0, batch.num_rows, TILE_DOCS):
                part = batch.slice(at, TILE_DOCS)
                lists = part.column("terms")
                terms, counts = lists.flatten().to_numpy(), part.column("counts").flatten().to_numpy().astype(np.int64)
                whose = np.repeat(np.arange(part.num_rows), lists.value_lengths().to_numpy())
                worth = impacts(counts, part.column("n").to_pylist(), documents, length, whose).astype(np.float64)
                ids = part.column("doc_id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                numbers = ids.fill_null(0).to_numpy()
                for tile, kept in own:
                    kept.add(tile_scores(tile, terms, whose, worth, part.num_rows), numbers, null)
        for tile, kept in own:
            for turn, item in enumerate(tile.items):
                if kept.held[turn]:
                    scores, numbers, null = kept.cut(turn)
                    many = len(scores)
                    columns = [np.full(many, first + item), [item_ids[item]] * many, pa.array(numbers, pa.int64(), mask=null), scores]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "item_id", "doc_id", "score"])

    return postings.mapInArrow(search, _HITS)


def rank_documents(items: DataFrame, docs: DataFrame, best: int = BEST, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id and score of the best documents of each item."""
    spark = docs.sparkSession
    found = []
    with released(spark):
        for block in item_blocks(items, block_terms):
            with batches_of(spark, TILE_DOCS), released(spark):
                found.append(staged(_hits(_postings(docs, block), block, best), "hits", lasting=True))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = (F.desc("score"), F.asc_nulls_last("doc_id"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    rank = F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))
    few = reduce(DataFrame.unionAll, found).withColumn("part", part).withColumn("rank", rank).where(F.col("rank") <= best)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    return few.withColumn("rank", rank).where(F.col("rank") <= best).select("item_id", "rank", "doc_id", "score")

"""Similarity join of documents on the Jaccard similarity of their word shingles, by a size-aware heavy-light join.

Each document is the set of its distinct shingles; documents with equal sets form a class and only one of them is
compared. The shingles of a set are ordered rare ones first, by the product of their words' frequencies in the whole
corpus. Of two sets that are similar enough, a short head of each shares at least k shingles.

* Light sets are small: every subset of k = 2 shingles of the head is a key.
* Heavy sets are large: every shingle of the head (k = 1) is an inverted list, which light sets join as far as
  their size may match that of a heavy one. Heads are a few shingles longer than they need be, and each set leaves
  as many of its lists, the longest. Of all lists that two similar sets share the shortest is left to both, so
  lists of chance, of shingles that turn out frequent, go. Lists are scanned by counting, for each pair, the lists it
  shares: the head of a large set must share many.

The size that parts them is the one with the least cost: the number of subsets of all light sets against the list
entries of all heavy sets, each weighed with ``LIST_COST``.

Sets that share enough keys are candidates. A key that several sets share doesn't become all their pairs: first all are
compared with one pivot per key, then links join into components, and only sets of different components are compared
further; a pair inside a component is linked already, so no component is lost. A key of more than ``MANY`` sets has a
pivot for each range of sizes, with which all sets that may match one of that range are compared. Sets that were compared
with the same pivot, such as hundreds of edited copies of one text, are matched on what they differ in from it: A and B
differ in exactly those shingles in which their differences from the pivot differ. So blocks of these differences are
multiplied, as rows of zeros and ones, which gives the similarity of each pair exactly and without its texts. A block
product hands on a root for each set that it links, never its pairs. All other pairs are those that share enough keys.
Intersections are exact.

Defined cases: without words a document has size 0 and links with nothing; with fewer words than a shingle needs,
all its words are its one shingle. A null ``doc_id`` links with nothing. Rows that share a ``doc_id`` but not a text
are compared as texts of their own; equal rows give equal results. Other columns aren't read. An empty table gives
an empty table. Shingles are compared by 64-bit hashes of their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsforge.llm.components import components, least_labels
from obsforge.llm.hashing import mix, shingle_hashes, texts_of, word_hashes
from obsforge.llm.text import batches_of
from obsforge.session import released, staged

#: Bins in which all words of the corpus are counted.
BIN_BITS = 17
BINS = 1 << BIN_BITS
#: What one entry of an inverted list costs, in subsets.
LIST_COST = 4
#: Sets above this size have so many subsets that no boundary above it is the cheapest.
MOST_LIGHT = 512
#: Most lists that a set leaves, and shingles for each.
MOST_LEFT, PER_LEFT = 8, 8
#: Pairs of sets are only enumerated for keys of at most this many.
MANY = 256
#: Sets of a block whose differences from a pivot are compared at once, and shingles of one product.
BLOCK, TOKENS = 128, 4096
#: Differing shingles that a task hands on at once.
DIFFERENCES = 1 << 20
#: Documents a task holds at once.
BATCH_ROWS = 512

_LOW48 = np.uint64((1 << 48) - 1)


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def head_length(size: int, percent: int, k: int) -> int:
    """Length of the head in which a set shares k shingles with any set that is similar enough."""
    return size - -(-percent * size // 100) + k


def lists_left(size: str) -> str:
    """SQL: how many of its lists a set of this size leaves."""
    return f"least({MOST_LEFT}, {size} div {PER_LEFT})"


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))


def _bins(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(64 - BIN_BITS)).astype(np.int64)


def corpus_statistics(docs: DataFrame, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """How many words fall into each bin, and how many documents have each number of shingles (last: more)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = np.zeros(BINS, dtype=np.int64)
        sizes = np.zeros(MOST_LIGHT + 2, dtype=np.int64)
        for batch in batches:
            words = [*word_hashes(texts_of(batch, "text")), np.zeros(0, dtype=np.uint64)]
            bins += np.bincount(_bins(np.concatenate(words)), minlength=BINS)
            length = np.array([len(w) for w in words[:-1]], dtype=np.int64)
            size = np.where(length < shingle, np.minimum(length, 1), length - shingle + 1)
            sizes += np.bincount(np.minimum(size, MOST_LIGHT + 1), minlength=MOST_LIGHT + 2)
        slots = np.concatenate((bins, sizes))
        at = np.flatnonzero(slots)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(slots[at])], names=["slot", "n"])

    counted = _texts(docs).select("text").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = counted.toArrow()  # BINS + MOST_LIGHT + 2 rows at most
    slots = np.zeros(BINS + MOST_LIGHT + 2, dtype=np.int64)
    slots[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return slots[:BINS], slots[BINS:]


def boundary(sizes: np.ndarray, percent: int) -> int:
    """The largest size of light sets that makes subsets and list entries together the fewest."""
    best, at = None, 0
    heads = np.array([head_length(n, percent, 1) if n > 1 else 0 for n in range(len(sizes))])
    subsets = sizes * heads * (heads + 1) // 2
    entries = sizes * heads * LIST_COST
    for limit in range(MOST_LIGHT + 1):
        shared = percent * (limit + 1) // 100  # from this size on a set may match a heavy one
        cost = subsets[: limit + 1].sum() + entries[shared:].sum()
        if best is None or cost < best:
            best, at = cost, limit
    return at


def word_costs(bins: np.ndarray, shingle: int) -> np.ndarray:
    """The frequency of the words of each bin on a logarithmic scale of whole numbers, so that sums are exact."""
    bits = np.log2(bins + 1.0)
    return np.round(bits * (65535 // shingle) / max(float(bits.max()), 1.0)).astype(np.uint16)


def expected_frequency(words: np.ndarray, costs: np.ndarray, shingle: int) -> np.ndarray:
    """For each shingle of the words, how frequent it may be; the same wherever the shingle stands."""
    run = min(shingle, len(words))
    total = np.concatenate(([0], np.cumsum(costs[_bins(words)], dtype=np.int64)))
    return (total[run:] - total[: len(total) - run]).astype(np.uint64)


def signatures(docs: DataFrame, shingle: int, percent: int, light: int, costs: np.ndarray) -> DataFrame:
    """doc_id, n_shingles, two hashes of the whole set, and the set's keys: subsets and lists.

    A set of one shingle is similar to an equal set only and has no keys.
    """

    def ranked(words: np.ndarray, shingles: np.ndarray) -> np.ndarray:
        """Distinct shingles in the order of the corpus: expected frequency, then hash."""
        rank = expected_frequency(words, costs, shingle)
        return np.unique((rank << np.uint64(48)) | (shingles & _LOW48))

    def keys(row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(row)
        subsets = lists = row[:0]
        if 1 < n <= light:
            head = row[: head_length(n, percent, 2)]
            i, j = np.triu_indices(len(head), 1)
            subsets = mix(mix(head[i]) + head[j])
        if n > 1 and 100 * n > percent * light:
            # as many more as the largest set that may be similar leaves
            more = min(MOST_LEFT, -(-100 * n // percent) // PER_LEFT)
            lists = row[: head_length(n, percent, 1 + more)]
        return subsets, lists

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = word_hashes(texts_of(batch, "text"))
            runs = [shingle_hashes(w, shingle) for w in words]
            sets = [np.unique(x) for x in runs]
            heads = [keys(ranked(w, x)) if len(own) > 1 else (own[:0], own[:0]) for w, x, own in zip(words, runs, sets, strict=True)]
            seeds = [(mix(x).sum(dtype=np.uint64), mix(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) for x in sets]
            first, second = (pa.array(np.array([s[i] for s in seeds], dtype=np.uint64).view(np.int64)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in sets], pa.int64()),
                    first,
                    second,
                    *(pa.array([x[i].view(np.int64) for x in heads], pa.list_(pa.int64())) for i in (0, 1)),
                ],
                names=["doc_id", "n_shingles", "hash_a", "hash_b", "subsets", "lists"],
            )

    schema = "doc_id long, n_shingles long, hash_a long, hash_b long, subsets array<long>, lists array<long>"
    return staged(_texts(docs).mapInArrow(sign, schema), "signatures")


def _compared(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) with ``linked``, whether their whole texts are similar enough, and how b differs from a.

    ``differ`` are the shingles that one of them lacks, ``n_b`` the size of b. a is the side that occurs often.
    """
    pairs = staged(pairs, "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = staged(_texts(docs).join(staged(ids, "wanted"), "doc_id", "left_semi"), "texts")
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))

    def sets(texts: list[bytes]) -> Iterator[np.ndarray]:
        for words in word_hashes(texts):
            yield np.unique(shingle_hashes(words, shingle))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        names = ["a", "b", "linked", "n_b", "differ"]
        for batch in batches:
            at, size, rows = 0, 0, []
            for turn, (text, other) in enumerate(zip(texts_of(batch, "text_a"), sets(texts_of(batch, "text_b")), strict=True), 1):
                if text != last:
                    own, last = next(sets([text])), text
                differ = np.setxor1d(own, other, assume_unique=True)
                union = (len(own) + len(other) + len(differ)) // 2
                rows.append((100 * (union - len(differ)) >= percent * union, len(other), differ.view(np.int64)))
                size += len(differ)
                if size >= DIFFERENCES or turn == batch.num_rows:
                    linked, n, lists = zip(*rows, strict=True)
                    ids = [batch.column(c).slice(at, len(rows)) for c in ("a", "b")]
                    columns = [*ids, pa.array(linked, pa.bool_()), pa.array(n, pa.int64()), pa.array(lists, pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    at, size, rows = turn, 0, []

    schema = "a long, b long, linked boolean, n_b long, differ array<long>"
    return pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b").mapInArrow(compare, schema)


def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set on the left shares with each on the right."""

    def flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])

    sides = [flat(left), flat(right)]
    shared = np.intersect1d(sides[0][0], sides[1][0])
    total = np.zeros((len(left), len(right)), dtype=np.int64)
    for first in range(0, len(shared), TOKENS):
        some = shared[first : first + TOKENS]
        rows = []
        for (tokens, whose), many in zip(sides, (len(left), len(right)), strict=True):
            place = np.minimum(np.searchsorted(some, tokens), len(some) - 1)
            held = some[place] == tokens
            ones = np.zeros((many, len(some)), dtype=np.float32)  # exact: no product has more than TOKENS terms
            ones[whose[held], place[held]] = 1
            rows.append(ones)
        total += (rows[0] @ rows[1].T).astype(np.int64)
    return total


def block_links(table: pa.Table, percent: int) -> pa.Table:
    """a and b: each set that links with one of another component, and the smallest set it reaches in this pair of blocks."""
    table = table.take(pa.array(np.argsort(table.column("x").to_numpy(), kind="stable")))
    ids, n, root, block, home = (table.column(c).to_numpy() for c in ("x", "n", "root", "block", "home"))
    sets = [np.asarray(x, dtype=np.int64) for x in table.column("differ").to_numpy()]
    apart = np.array([len(x) for x in sets])
    low, high = (table.column(c)[0].as_py() for c in ("low", "high"))
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    linked = np.zeros((0, 0), dtype=bool)
    if len(left) and len(right):
        differ = apart[left][:, None] + apart[right] - 2 * _common([sets[i] for i in left], [sets[i] for i in right])
        union = (n[left][:, None] + n[right] + differ) // 2
        linked = 100 * (union - differ) >= percent * union
        linked &= (root[left][:, None] != root[right]) & (home[left][:, None] | home[right])
    i, j = np.nonzero(linked)
    labels = least_labels(len(ids), left[i], right[j])
    found = np.unique(np.concatenate((left[i], right[j])))
    return pa.table({"a": ids[labels[found]], "b": ids[found]})


def _by_differences(tested: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join different components among the sets that were compared with the same pivot.

    In ranges of sizes, as for keys of many; of each range, blocks of ``BLOCK`` sets meet in pairs.
    """
    placed = staged(
        tested.join(roots, tested.b == roots.node, "left").select(
            F.col("a").alias("pivot"), F.col("b").alias("x"), F.col("n_b").alias("n"), "differ", F.coalesce("root", "b").alias("root")
        ),
        "differences",
    )
    ranged = placed.withColumn("own", F.expr(_range_of(percent))).withColumn("range", F.explode(F.expr("array(own, own + 1)")))
    key = ["pivot", "range"]
    several = ranged.groupBy(*key).agg(
        F.min("root").alias("least"), F.max("root").alias("most"), F.bool_or(F.col("own") == F.col("range")).alias("homes"),
        F.expr(f"cast(ceil(count(*) / {BLOCK}) as int)").alias("blocks"),
    )
    several = staged(several.where("least < most and homes").select(*key, "blocks"), "pivots")
    seats = ranged.join(several, key).select(
        *key, "x", "n", "root", "differ", "blocks", (F.col("own") == F.col("range")).alias("home"),
        F.expr("cast(pmod(xxhash64(x), blocks) as int)").alias("block"),
    )
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    pairs = seats.withColumn("other", other).select(
        *key, "x", "n", "root", "differ", "home", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )

    def match(table: pa.Table) -> pa.Table:
        return block_links(table, percent)

    return pairs.groupBy(*key, "low", "high").applyInArrow(match, "a long, b long")


def _range_of(percent: int) -> str:
    """SQL: the number of the range that a set of size n falls into."""
    firsts = ", ".join(f"{n}L" for n in size_ranges(percent))
    return f"size(filter(array({firsts}), first -> first <= n))"


def size_ranges(percent: int) -> list[int]:
    """First sizes of ranges such that a set can only match sets of its own range and the two beside it."""
    firsts = [1]
    while firsts[-1] < 1 << 40:
        firsts.append(100 * firsts[-1] // percent + 1)
    return firsts


def similar_groups(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id that links of at least ``percent`` reach."""
    if not 50 < percent < 100:
        raise ValueError("percent must be over 50 and under 100")
    spark = docs.sparkSession
    with batches_of(spark, BATCH_ROWS), released(spark):
        return staged(_groups(docs, shingle, percent), "groups", lasting=True)


def _groups(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    bins, sizes = corpus_statistics(docs, shingle)
    light, costs = boundary(sizes, percent), word_costs(bins, shingle)
    signed = signatures(docs, shingle, percent, light, costs)
    same = ["n_shingles", "hash_a", "hash_b"]
    classes = signed.where("n_shingles > 0 and doc_id is not null").groupBy(*same).agg(F.min("doc_id").alias("rep"))
    classes = staged(classes, "classes")

    alone = signed.where("size(subsets) + size(lists) > 0").join(classes, same).where("doc_id = rep")
    kinds = [alone.selectExpr("rep", "n_shingles AS n", f"{listed} AS listed", f"explode({c}) AS key") for c, listed in (("subsets", False), ("lists", True))]
    entries = kinds[0].union(kinds[1])
    counts = staged(entries.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1"), "keys")
    longest = Window.partitionBy("rep", "listed").orderBy(F.desc("sets"), "key")
    entries = entries.join(counts, "key").withColumn("place", F.row_number().over(longest))
    shared = staged(entries.where(f"not listed or place > {lists_left('n')}").drop("sets", "place"), "entries")
    counts = staged(shared.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1"), "keys")
    shared = staged(shared.join(counts, "key"), "entries")
    # of each set, how much it has in common with all others: much, if others are copies of it
    common = staged(shared.groupBy("rep").agg(F.sum("sets").alias("common")), "common")
    shared = staged(shared.join(common, "rep"), "entries")
    leader = "max(struct({} AS home, common, -rep AS minus, rep, n)) AS pivot"

    sizes_fit = F.expr(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    # how many shingles of both heads two similar sets share at least, if one of them is heavy
    both = f"ceil({percent} * (n_a + n_b) / {100 + percent})"
    spare = ", ".join(
        f"{both} - ceil({percent} * {n} / 100) + 1 + {lists_left(f'cast(ceil(100 * {n} / {percent}) as bigint)')}" for n in ("n_a", "n_b")
    )
    left = f"greatest({lists_left('n_a')}, {lists_left('n_b')})"
    shares = F.expr(f"CASE WHEN greatest(n_a, n_b) > {light} THEN least({spare}) - {left} ELSE 1 END")

    # keys of fewer sets: each with the leading one. A pair shares other keys as well, so half of the shared shingles
    # will do here; what it misses is compared as a pair that shares keys.
    few = shared.where(F.col("sets") <= MANY)
    pivots = staged(few.groupBy("key").agg(F.expr(leader.format("true"))), "pivots")
    met = few.join(pivots, "key").selectExpr("key", "pivot.rep AS a", "rep AS b", "pivot.n AS n_a", "n AS n_b")
    close = met.where("a <> b").where(sizes_fit).groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("n"))
    pairs = close.where(2 * F.col("n") >= shares).select("a", "b")

    # keys of many: each with the leading one of its range of sizes and of the range above it
    many = shared.where(F.col("sets") > MANY).withColumn("own", F.expr(_range_of(percent)))
    many = many.select("*", F.explode(F.expr("array(own, own + 1)")).alias("range"))
    pivots = staged(many.groupBy("key", "range").agg(F.expr(leader.format("own = range"))).where("pivot.home"), "pivots")
    ranged = many.join(pivots, ["key", "range"]).selectExpr("pivot.rep AS a", "rep AS b").where("a <> b")

    tested = staged(_compared(pairs.union(ranged).distinct(), docs, shingle, percent), "tested")
    links = tested.where("linked").select("a", "b")
    roots = components(links, "a", "b")

    # sets of different components that share a key of few and weren't both compared with its pivot
    with_pivot = staged(tested.select("a", "b"), "with_pivot").withColumn("known", F.lit(True))
    placed = (
        met.join(with_pivot, ["a", "b"], "left")
        .join(roots, met.b == roots.node, "left")
        .selectExpr("key", "b AS rep", "n_b AS n", "coalesce(root, b) AS root", "coalesce(known, false) or a = b AS known")
    )
    rest = staged(placed, "placed")
    open_keys = rest.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.bool_and("known").alias("done"))
    open_keys = staged(open_keys.where("low < high and not done").select("key"), "open_keys")
    rest = staged(rest.join(open_keys, "key", "left_semi"), "rest")
    one = rest.where("not known").selectExpr("key", "rep AS x", "n AS n_a", "root AS root_a")
    two = rest.selectExpr("key", "rep AS y", "n AS n_b", "root AS root_b", "known")
    pairs = (
        one.join(two, "key")
        .where("root_a <> root_b and (known or x < y)")
        .where(sizes_fit)
        .selectExpr("least(x, y) AS a", "greatest(x, y) AS b", "least(n_a, n_b) AS n_a", "greatest(n_a, n_b) AS n_b")
        .groupBy("a", "b", "n_a", "n_b")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= shares)
        .select("a", "b")
    )
    more = staged(_compared(pairs, docs, shingle, percent).where("linked").select("a", "b"), "links")
    same_pivot = staged(_by_differences(tested, roots, percent), "links")
    roots = components(links.union(more).union(same_pivot), "a", "b")

    members = signed.join(classes, same, "left").select("doc_id", "n_shingles", "rep")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "rep", "doc_id"))
    return members.join(roots, members.rep == roots.node, "left").select("doc_id", "n_shingles", component.alias("component_id"))

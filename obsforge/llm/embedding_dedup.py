"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products, one representative of each group.

Centroids are fitted on a bounded sample. Every vector is at home in the cell of its nearest centroid, and visits each
lower-numbered cell whose border with its own is near enough: two unit vectors of cosine c are sqrt(2 - 2c) apart, and
vectors on either side of a border are at least as far apart as either is from it. So each linked pair meets in
exactly one cell, the lower of its two, and no link is lost whatever the centroids are. Pairs of homes and of homes
with visitors are compared in blocks by matrix products in double precision; a cell of any size is as many blocks as
it needs. A block product returns a count and a root for each vector, never its pairs. Equal vectors are compared
once and counted as often as they occur.

Defined cases: a null, empty or zero vector and one with null or non-finite components link with nothing, and so does
a null ``vec_id``. Vectors of different length don't link. Rows that share a ``vec_id`` are one node of the graph, but
each counts as a vector. Other columns aren't read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.llm.components import components
from obsforge.session import staged

#: Vectors that the centroids are fitted on at most.
SAMPLE = 20_000
#: Vectors a cell is meant to hold and most cells. A cell with more is compared all the same, in more blocks.
CELL, MOST_CELLS = 4096, 1024
#: Vectors of one side of a block product.
BLOCK = 4096
ROUNDS = 12
#: For rounding in margins, which are compared with a bound from exact arithmetic.
SLACK = 1e-6


def units(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def fit_centroids(vectors: np.ndarray, cells: int) -> np.ndarray:
    """Spherical k-means: unit centroids that are the directions of their members' sums."""
    x = units(vectors)
    centroids = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)]
    for _ in range(ROUNDS):
        nearest = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, x)
        length = np.sqrt((sums * sums).sum(axis=1))
        alive = length > 1e-9
        centroids = np.where(alive[:, None], sums / np.maximum(length, 1e-9)[:, None], centroids)
    return np.unique(centroids, axis=0)


def cells_of(vectors: np.ndarray, centroids: np.ndarray, reach: float) -> list[np.ndarray]:
    """Cells of each vector: its home first, then the lower ones it visits."""
    similarity = units(vectors) @ centroids.T
    home = similarity.argmax(axis=1)
    gaps = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))
    margin = similarity.max(axis=1)[:, None] - similarity  # times 1 / gap: the distance from the border
    near = (margin <= (reach + SLACK) * gaps[home]) & (np.arange(len(centroids)) < home[:, None])
    return [np.concatenate(([h], np.flatnonzero(n))) for h, n in zip(home, near, strict=True)]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    rows = column.to_pylist()
    return np.array(rows, dtype=np.float64).reshape(len(rows), -1)


def _roots(n: int, left: np.ndarray, right: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Smallest label that each of n nodes reaches over the edges."""
    while True:
        low = np.minimum(labels[left], labels[right])
        after = labels.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if (after == labels).all():
            return labels
        labels = after


def block_links(table: pa.Table, cosine: float) -> pa.Table:
    """vec_id, n and root of the vectors of a block pair that link with one of the other side (or of the same block)."""
    order = np.argsort(table.column("vec_id").to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    ids = table.column("vec_id").to_numpy()
    weight = table.column("weight").to_numpy()
    side = table.column("side").to_numpy()
    x = units(_matrix(table.column("embedding")))
    own = np.flatnonzero(side == 0)
    other = np.flatnonzero(side == 1)
    within = table.column("b")[0].as_py() == table.column("a")[0].as_py() and table.column("kind")[0].as_py() == 0
    if within:
        other = own
    counts = np.zeros(len(ids), dtype=np.int64)
    labels = np.arange(len(ids))
    for at in range(0, len(own), 256):
        strip = own[at : at + 256]
        hit = x[strip] @ x[other].T >= cosine
        if within:
            hit[np.arange(len(strip)), at + np.arange(len(strip))] = False
        i, j = np.nonzero(hit)
        counts[strip] += hit @ weight[other]
        if not within:
            counts[other] += weight[strip] @ hit
        if len(i):
            labels = _roots(len(ids), strip[i], other[j], labels)
    found = np.flatnonzero(counts)
    return pa.table({"vec_id": ids[found], "n": counts[found], "root": ids[labels[found]]})


def near_groups(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per input row."""
    spark = vectors.sparkSession
    reach = float(np.sqrt(2 - 2 * cosine))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("embedding"))
    sound = F.expr(
        "vec_id is not null and size(embedding) > 0"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(embedding, x -> x <> 0)"
    )
    classes = staged(
        rows.where(F.coalesce(sound, F.lit(False)))
        .groupBy("embedding")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")),
        "vectors",
    )
    sizes = classes.groupBy(F.size("embedding").alias("length")).count().orderBy(F.desc("count"), "length").first()
    length, n = (sizes[0], sizes[1]) if sizes else (0, 0)
    drawn = classes.where(F.size("embedding") == length).orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE)
    sample = [r.embedding for r in drawn.select("embedding").collect()]  # SAMPLE rows at most
    cells = max(1, min(MOST_CELLS, -(-n // CELL)))
    centroids = fit_centroids(np.array(sample, dtype=np.float64), cells) if sample else np.zeros((0, 0))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            long = np.array([len(e) for e in batch.column("embedding").to_pylist()], dtype=np.int64)
            found: list[np.ndarray] = [np.array([-size]) for size in long]  # other lengths: a cell each
            usual = np.flatnonzero(long == length)
            if len(usual):
                placed = cells_of(_matrix(batch.column("embedding").take(pa.array(usual))), centroids, reach)
                for at, own in zip(usual, placed, strict=True):
                    found[at] = own
            out = pa.array([[int(c) for c in f] for f in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, out], names=[*batch.schema.names, "cells"])

    placed = staged(
        classes.withColumnRenamed("rep", "vec_id").mapInArrow(
            place, f"embedding {classes.schema['embedding'].dataType.simpleString()}, vec_id long, weight long, cells array<int>"
        ),
        "cells",
    )
    stays = placed.select("vec_id", "weight", "embedding", F.posexplode("cells").alias("turn", "cell"))
    blocks = f"cast(greatest(1, ceil(count_if({{}}) / {BLOCK})) as int)"
    counted = stays.groupBy("cell").agg(F.expr(blocks.format("turn = 0")).alias("homes"), F.expr(blocks.format("turn > 0")).alias("visits"))
    # MOST_CELLS rows and one for each other length; the join with it stays a join of Spark's choice
    counted = staged(counted, "blocks")
    seats = stays.join(counted, "cell").withColumn(
        "block", F.expr("cast(pmod(xxhash64(vec_id), if(turn = 0, homes, visits)) as int)")
    )
    as_home = F.expr(
        "concat("
        " transform(sequence(0, homes - 1), o -> named_struct('kind', 0, 'a', least(o, block), 'b', greatest(o, block),"
        "  'side', if(block <= o, 0, 1))),"
        " transform(sequence(0, visits - 1), o -> named_struct('kind', 1, 'a', block, 'b', o, 'side', 0)))"
    )
    as_visitor = F.expr("transform(sequence(0, homes - 1), o -> named_struct('kind', 1, 'a', o, 'b', block, 'side', 1))")
    pairs = seats.select(
        "cell", "vec_id", "weight", "embedding", F.inline(F.when(F.col("turn") == 0, as_home).otherwise(as_visitor))
    )

    def compare(table: pa.Table) -> pa.Table:
        return block_links(table, cosine)

    found = staged(
        pairs.groupBy("cell", "kind", "a", "b").applyInArrow(compare, "vec_id long, n long, root long"), "links"
    )
    roots = components(found, "vec_id", "root")
    links = found.groupBy("vec_id").agg(F.sum("n").alias("n"))
    reps = staged(
        classes.select(F.col("embedding").alias("of"), "rep", "weight")
        .join(links.withColumnRenamed("vec_id", "rep"), "rep", "left")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left"),
        "groups",
    )
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("root", "rep", "vec_id"))
    return (
        rows.withColumn("key", F.when(sound, F.col("embedding")))
        .join(reps, F.col("key") == F.col("of"), "left")
        .select(
            "vec_id",
            (F.coalesce("n", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).alias("n_links"),
            component.alias("component_id"),
            F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
        )
    )

"""Whitened embeddings: exact integer scatter, its characteristic polynomial, and components from the roots.

Entries become integers, ``floor(256 * c)``. Each task sums the outer products of its distinct vectors exactly, and the
sums meet in one row per pair of dimensions. Modulo each of as many primes as the coefficients need, a task computes the
characteristic polynomial of the scatter matrix ``n * sum(x x') - S S'``; Chinese remaindering joins them. The driver
holds one matrix, its polynomial and the components, whose size depends on the number of dimensions alone.

Defined cases: a null vector and one with a null or non-finite entry have no rows. Vectors of each length are a fit of
their own. Only components with positive variance exist, so a single distinct vector, an empty one or a table of them
gives no rows; of equal eigenvalues any orthogonal components are taken, the same for all rows. Repeated rows and a null
``vec_id`` are projected like any other. An entry beyond 2**63 / 256 becomes the nearest integer of 64 bits; a
``deviation`` beyond 64 bits is null. Only ``vec_id`` and ``embedding`` are read. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsforge.llm.characteristic import coefficient_bound, join_residues, largest_roots, polynomial_mod, primes, unit_vectors
from obsforge.session import released, staged

#: Steps of an entry in one unit.
STEPS = 256
COMPONENTS = 4

_SUMS = "length int, i int, j int, total decimal(38,0)"
_ROWS = "vec_id long, component int, n long, deviation long, whitened double, explained double, length int"


@dataclass
class Fit:
    """What the fit list of one vector length gives."""

    n: int
    sums: np.ndarray  # exact, one for each dimension
    components: np.ndarray  # a row each
    roots: list[float]  # of the scatter matrix, which is n * n times the covariance
    explained: list[float]


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the entries as integers, of the rows whose entries are all finite."""
    sound = F.expr("embedding is not null and forall(embedding, c -> c is not null and not isnan(c) and abs(c) < double('infinity'))")
    entries = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    return entries.where(sound).select("vec_id", F.expr(f"transform(embedding, c -> cast(floor({STEPS} * c) as bigint))").alias("x"))


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and matrix of the vectors of each length above 0."""
    lengths = column.value_lengths().to_numpy()
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        yield rows, column.take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), -1)


def outer_sums(x: np.ndarray) -> np.ndarray:
    """The sum of the outer products of the rows, as exact integers."""
    largest = max(abs(int(x.max())), abs(int(x.min())))
    if largest * largest * len(x) < 1 << 53:  # every partial sum is an exact double
        floats = x.astype(np.float64)
        return (floats.T @ floats).astype(np.int64).astype(object)
    exact = x.astype(object)
    return exact.T @ exact


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, list] = {}
    for batch in batches:
        for rows, x in _by_length(batch.column("x")):
            own = totals.setdefault(x.shape[1], [0, 0, 0])
            own[0] += len(rows)
            own[1] = own[1] + x.astype(object).sum(axis=0)
            own[2] = own[2] + outer_sums(x)
    for length, (n, sums, products) in totals.items():
        upper = [(i, j) for i in range(length) for j in range(i, length)]
        found = [(-1, -1, n), *((i, -1, int(s)) for i, s in enumerate(sums)), *((i, j, int(products[i, j])) for i, j in upper)]
        columns = [[length] * len(found), *([f[k] for f in found] for k in range(2)), [Decimal(f[2]) for f in found]]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.decimal128(38, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["length", "i", "j", "total"])


def polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Coefficients of the characteristic polynomial; the primes are dealt over the tasks."""
    trace = sum(int(matrix[i, i]) for i in range(len(matrix)))
    moduli = primes(2 * coefficient_bound(trace, len(matrix)))

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = [moduli[i] for i in batch.column("id").to_pylist()]
            found = [polynomial_mod(matrix, p) for p in wanted]
            yield pa.RecordBatch.from_arrays([pa.array(wanted, pa.int64()), pa.array(found, pa.list_(pa.int64()))], names=["p", "rest"])

    slices = min(len(moduli), spark.sparkContext.defaultParallelism)
    rows = spark.range(0, len(moduli), 1, slices).mapInArrow(reduce, "p long, rest array<long>").collect()  # a row for each prime
    return join_residues({r.p: r.rest for r in rows})


def fit_components(fit_list: DataFrame, many: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of each vector length from its distinct vectors in column x."""
    # a row for each pair of dimensions
    found = fit_list.mapInArrow(_sums, _SUMS).groupBy("length", "i", "j").agg(F.sum("total").alias("total")).collect()
    fits = {}
    for length in sorted({r.length for r in found}):
        sums, products, n = np.zeros(length, dtype=object), np.zeros((length, length), dtype=object), 0
        for r in found:
            if r.length != length:
                continue
            if r.i < 0:
                n = int(r.total)
            elif r.j < 0:
                sums[r.i] = int(r.total)
            else:
                products[r.i, r.j] = products[r.j, r.i] = int(r.total)
        scatter = n * products - np.outer(sums, sums)
        trace = sum(scatter[i, i] for i in range(length))
        roots = largest_roots(polynomial(fit_list.sparkSession, scatter), many) if trace else []
        fits[length] = Fit(
            n, sums, unit_vectors(scatter, roots), [float(r) for r in roots], [float(Fraction(r) / trace) for r in roots]
        )
    return fits


def project(x: np.ndarray, fit: Fit) -> tuple[list[int | None], np.ndarray]:
    """Deviation and whitened coordinates of the rows of x."""
    largest = max(abs(int(x.max())), abs(int(x.min())), *(abs(int(s)) // fit.n + 1 for s in fit.sums)) * 2 * fit.n
    if largest * largest * x.shape[1] < 1 << 63:
        centred = fit.n * x - fit.sums.astype(np.int64)
        deviation = (centred * centred).sum(axis=1).tolist()
    else:
        centred = fit.n * x.astype(object) - fit.sums
        deviation = [d if d < 1 << 63 else None for d in (centred * centred).sum(axis=1)]
    whitened = centred.astype(np.float64) @ fit.components.T / np.array([sqrt(r) for r in fit.roots])
    return deviation, whitened


def _projected(rows: DataFrame, fits: dict[int, Fit]) -> DataFrame:
    names = [f.split()[0] for f in _ROWS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32()]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id")
            for at, x in _by_length(batch.column("x")):
                fit = fits[x.shape[1]]
                many = len(fit.roots)
                if not many:
                    continue
                deviation, whitened = project(x, fit)
                repeated = np.repeat(np.arange(len(at)), many)
                columns = [
                    ids.take(pa.array(at[repeated])),
                    np.tile(np.arange(1, many + 1, dtype=np.int32), len(at)),
                    np.full(len(repeated), fit.n),
                    pa.array(deviation, pa.int64()).take(pa.array(repeated)),
                    whitened.ravel(),
                    np.tile(np.array(fit.explained), len(at)),
                    np.full(len(repeated), x.shape[1], dtype=np.int32),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return rows.mapInArrow(place, _ROWS)


def identity_errors(fit_list: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """The largest entry of the whitened fit list's covariance minus the identity, by vector length."""
    worst: dict[int, float] = {}
    for length, fit in fits.items():
        many = len(fit.roots)
        if not many:
            continue

        def coordinates(batches: Iterator[pa.RecordBatch], fit: Fit = fit, length: int = length) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, x in _by_length(batch.column("x")):
                    if x.shape[1] == length:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, project(x, fit)[1].T)), names=[f"c{i}" for i in range(len(fit.roots))])

        pairs = [(i, j) for i in range(many) for j in range(i, many)]
        placed = fit_list.mapInArrow(coordinates, ", ".join(f"c{i} double" for i in range(many)))
        row = placed.agg(*(F.covar_pop(f"c{i}", f"c{j}").alias(f"v{i}_{j}") for i, j in pairs)).first()
        worst[length] = max(abs(v - (i == j)) for v, (i, j) in zip(row, pairs, strict=True))
    return worst


def whiten(vectors: DataFrame, many: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error, a row for each vector and component."""
    rows = integer_vectors(vectors)
    # copies leave each task as one row, so a vector that fills a third of the table is no hot key
    with released(vectors.sparkSession):
        fit_list = staged(rows.select("x").distinct(), "fit-list")
        fits = fit_components(fit_list, many)
        errors = identity_errors(fit_list, fits)
    error = F.create_map(*(F.lit(v) for pair in errors.items() for v in pair)) if errors else F.create_map().cast("map<int,double>")
    return _projected(rows, fits).withColumn("identity_error", error[F.col("length")]).drop("length")

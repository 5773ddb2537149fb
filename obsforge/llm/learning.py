"""Bounded labelled samples and a small logistic regression, for models that are fitted on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from obsforge.llm.text import crc_fold
from obsforge.session import released, staged


#: Labelled documents of all classes together that a sample has at most, if there are fewer classes.
MOST_ROWS = 10_000


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for the documents that no label may be learnt from; false for a null id."""
    return F.coalesce(crc_fold(doc_id, folds) == fold, F.lit(False))


def first_by_hash(known: DataFrame, classes: dict[object, int], each: int) -> DataFrame:
    """doc_id and label of the ``each`` documents of each class that come first by a hash of their id, fewer if there are.

    Only documents with a hash below what that many of the class need are ranked, so a class with most rows is no group
    that one task must sort.
    """
    spark, place = known.sparkSession, F.xxhash64("doc_id")
    share = place.cast("double") / float(1 << 64) + 0.5
    rank = F.row_number().over(Window.partitionBy("label").orderBy(place, "doc_id"))
    room = 1
    while True:
        enough = room * (each + 8 * each**0.5 + 16)
        cuts = spark.createDataFrame(
            [(value, enough / n) for value, n in classes.items()], StructType([known.schema["label"], StructField("cut", DoubleType())])
        )
        near = known.join(cuts, "label").where(share < F.col("cut")).withColumn("rank", rank).where(F.col("rank") <= each)
        drawn = staged(near.select("doc_id", "label"), "drawn")
        got = {r.label: r.n for r in drawn.groupBy("label").agg(F.count("*").alias("n")).collect()}  # a row for each class
        if all(got.get(value, 0) == min(each, n) for value, n in classes.items()):
            return drawn
        room *= 2


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, per_class: int, max_bytes: int
) -> tuple[list[tuple[bytes, object]], dict[object, int]]:
    """Whole texts with their label, at most ``per_class`` of each class, and how many labels each class has.

    All of them lie outside the held-out fold, and all classes together have at most ``MOST_ROWS``, or one for each.

    Documents come in the order of a hash of their id, so a run repeats. Texts of more than ``max_bytes`` are left
    out, which bounds what the driver gets. Of several labels of a document the largest counts, of several texts the
    first by hash. Labels are read once and texts once, however many classes there are.
    """
    with released(docs.sparkSession):
        known = staged(
            labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).alias("label"))
            .where("doc_id is not null and label is not null")
            .where(~held_out(F.col("doc_id"), folds, fold))
            .groupBy("doc_id")
            .agg(F.max("label").alias("label")),
            "labels",
        )
        sizes = known.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")
        classes = {r.label: r.n for r in sizes.collect()}  # a row for each class
        if not classes:
            return [], {}
        drawn = first_by_hash(known, classes, max(1, min(per_class, MOST_ROWS // len(classes))))
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
        sound = texts.where(F.octet_length("text").between(1, max_bytes)).join(drawn, "doc_id")
        once = sound.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
        rows = once.select("doc_id", "label", "first.text").collect()
    order = {value: turn for turn, value in enumerate(classes)}
    return [(bytes(r.text), r.label) for r in sorted(rows, key=lambda r: (order[r.label], r.doc_id))], classes


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def __call__(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.mean) / self.scale) @ self.weights + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_logistic(features: np.ndarray, labels: np.ndarray, ridge: float = 1e-3, weights: np.ndarray | None = None) -> Logistic:
    """Newton's method on standardised features; labels may be probabilities. Without both classes: their share."""
    n, k = features.shape if features.size else (len(labels), features.shape[1])
    share = float(np.average(labels, weights=weights)) if n else 0.5
    if n == 0 or share in (0.0, 1.0):
        bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return Logistic(np.zeros(k), np.ones(k), np.zeros(k), bias)
    mean, scale = features.mean(0), features.std(0)
    scale[scale < 1e-12] = 1.0
    design = np.column_stack([np.ones(n), (features - mean) / scale])
    each = np.ones(n) if weights is None else weights
    penalty = (1.0 + ridge * each.sum()) * np.r_[1e-9, np.ones(k)]
    w = np.zeros(k + 1)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ w, -40, 40)))
        gradient = design.T @ (each * (p - labels)) + penalty * w
        hessian = (design.T * (each * p * (1 - p))) @ design + np.diag(penalty) + 1e-9 * np.eye(k + 1)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(mean, scale, w[1:], float(w[0]))

"""Quality scores by compression: dictionaries of good and of bad text, and the calibrated difference they make.

Two zstandard dictionaries are built from labelled texts of either class. A text is compressed in blocks with both:
text like the good one gets smaller with the good dictionary. The difference, normalised by the compressed size,
and how far the text compresses at all (endless repetition compresses far) go through a logistic calibration that is
fitted on labelled texts the dictionaries haven't seen.

The fit takes at most ``PER_CLASS`` documents of a class with at most ``MAX_BYTES`` each; every document is scored
on its whole text. Defined cases: a null or empty text has equal sizes with both dictionaries and gets the calibrated
score of that. Without labels of both classes the score is the share of the one there is, or 0.5 without any. A null
``doc_id`` is not held out. Only ``doc_id`` and ``text`` are read; equal rows get equal scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsforge.llm.learning import Logistic, fit_logistic, held_out, labelled_sample

#: Labelled documents of a class that the fit takes at most, and bytes of one.
PER_CLASS, MAX_BYTES = 2000, 65536
#: Size of a dictionary, and of the blocks compressed with it.
DICTIONARY_BYTES, BLOCK_BYTES = 112_640, 4096
LEVEL = 3
FOLDS, HELD_OUT = 3, 1


def _blocks(text: bytes) -> list[bytes]:
    return [text[i : i + BLOCK_BYTES] for i in range(0, len(text), BLOCK_BYTES)]


def build_dictionary(texts: list[bytes]) -> bytes:
    samples = [b for t in texts for b in _blocks(t) if len(b) >= 64]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # too few samples to choose from: the text itself
        return b"\n".join(texts)[-DICTIONARY_BYTES:]


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False
    )


@dataclass
class QualityModel:
    good: bytes
    bad: bytes
    calibration: Logistic | None = None

    def features(self, texts: list[bytes]) -> np.ndarray:
        good, bad = _compressor(self.good), _compressor(self.bad)
        sizes = np.array(
            [(sum(len(good.compress(b)) for b in _blocks(t)), sum(len(bad.compress(b)) for b in _blocks(t)), len(t)) for t in texts],
            dtype=np.float64,
        ).reshape(-1, 3)
        with_good, with_bad, plain = sizes.T
        difference = (with_bad - with_good) / np.maximum(with_bad + with_good, 1)
        ratio = np.log((with_good + 20) / (plain + 20))
        return np.column_stack([difference, ratio, ratio * ratio, difference * ratio, difference * difference])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return self.calibration(self.features(texts))


def fit_quality(docs: DataFrame, labels: DataFrame) -> QualityModel:
    sample, _ = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, PER_CLASS, MAX_BYTES)
    texts = {value: [t for t, label in sample if label == value] for value in (1, 0)}
    model = QualityModel(*(build_dictionary(texts[value][::2]) for value in (1, 0)))
    unseen = [(t, value) for value in (1, 0) for t in texts[value][1::2]]
    truth = np.array([value for _, value in unseen], dtype=np.float64)
    model.calibration = fit_logistic(model.features([t for t, _ in unseen]), truth)
    return model


def quality_score(model: QualityModel, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores([t or b"" for t in texts]))

    return score(text.cast("string").cast("binary"))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, and row, the whole input row."""
    model = fit_quality(docs, labels)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        quality_score(model, F.col("text")).alias("score"),
        F.struct("*").alias("row"),
    ).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "row")

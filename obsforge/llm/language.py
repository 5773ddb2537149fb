"""Language proportions of documents: mixtures of n-gram models, by expectation-maximisation.

Each language has a distribution over hashed byte n-grams, counted in labelled texts. A document is a mixture: its
proportions maximise the likelihood of its n-grams. The set of languages grows from the best single one; the language
that would raise the likelihood fastest is added as long as that raises it, after EM over the larger set, by more than
a penalty that grows with the logarithm of the document's length. The prediction is the language with the largest
proportion, and the score that proportion.

The fit takes at most ``PER_CLASS`` documents of a language with at most ``MAX_BYTES`` each; every document is
judged on its whole text. Defined cases: null texts and texts without a letter are ``und`` with score 0, and so is
everything if there is nothing to learn from. A null ``doc_id`` is not held out. Ties go to the language that is first by
code point. Only ``doc_id``, ``text`` and, to learn, ``lang`` are read; equal rows get equal predictions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.llm.jaccard_join import BATCH_ROWS
from obsforge.llm.learning import held_out, labelled_sample
from obsforge.llm.text import batches_of
from obsforge.session import staged

#: Labelled documents of a language that the fit takes at most, and bytes of one.
PER_CLASS, MAX_BYTES = 500, 32768
FOLDS, HELD_OUT = 4, 2
#: Length of the n-grams in bytes, and bits of their hashes.
GRAM, BITS = 3, 15
#: Gain in log-likelihood that another language must bring, times the logarithm of the number of n-grams.
PENALTY = 6.0
EM_ROUNDS = 25
UNDETERMINED = "und"
#: Bytes whose n-grams are counted at once.
PIECE = 1 << 20

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[65:91] += 32
_ASCII_LETTER = re.compile(rb"[A-Za-z]")


def gram_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed n-grams of a text and how often each occurs."""
    if len(text) < 1 << BITS:
        return np.unique(_grams(text), return_counts=True)
    counts = np.zeros(1 << BITS, dtype=np.int64)
    for at in range(0, len(text), PIECE):
        counts += np.bincount(_grams(text[at : at + PIECE + GRAM - 1]), minlength=1 << BITS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _grams(text: bytes) -> np.ndarray:
    data = _LOWER[np.frombuffer(b" " + text + b" " * GRAM, dtype=np.uint8)]
    grams = np.zeros(len(data) - GRAM + 1, dtype=np.uint32)
    for i in range(GRAM):
        grams = grams * np.uint32(257) + data[i : len(data) - GRAM + 1 + i]
    return (grams * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def has_letter(text: bytes) -> bool:
    return bool(_ASCII_LETTER.search(text)) or (not text.isascii() and any(c.isalpha() for c in text.decode("utf-8", "replace")))


@dataclass
class LanguageModel:
    languages: list[str]
    log_likelihood: np.ndarray  # n-gram by language

    def proportions(self, text: bytes) -> np.ndarray:
        grams, counts = gram_counts(text)
        logs = self.log_likelihood[grams]
        top = logs.max(axis=1)
        likelihood = np.exp(logs - top[:, None])
        total = counts.sum()
        chosen = [int((counts @ logs).argmax())]
        shares = np.ones(1)
        mixed = likelihood[:, chosen[0]]
        best = float(counts @ np.log(mixed))
        while len(chosen) < len(self.languages):
            # how fast the likelihood rises if a language gets a first share
            slope = (counts / mixed) @ likelihood / total
            slope[chosen] = 0
            new = int(slope.argmax())
            if slope[new] <= 1:
                break
            trial = [*chosen, new]
            parts = likelihood[:, trial]
            weights = np.append(shares * 0.9, 0.1)
            for _ in range(EM_ROUNDS):
                blend = parts @ weights
                weights = weights * ((counts / blend) @ parts) / total
            blend = parts @ weights
            value = float(counts @ np.log(blend))
            if value - best <= PENALTY * np.log(total + 1):
                break
            chosen, shares, mixed, best = trial, weights, blend, value
        out = np.zeros(len(self.languages))
        out[chosen] = shares
        return out

    def predict(self, text: bytes | None) -> tuple[str, float]:
        if not text or not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0
        shares = self.proportions(text)
        at = int(shares.argmax())
        return self.languages[at], float(min(1.0, shares[at]))


def fit_languages(docs: DataFrame) -> LanguageModel:
    sample, _ = labelled_sample(docs, docs, "lang", FOLDS, HELD_OUT, PER_CLASS, MAX_BYTES)
    languages = sorted({str(label) for _, label in sample})
    counts = np.full((len(languages), 1 << BITS), 0.5)
    for text, label in sample:
        grams, n = gram_counts(text)
        counts[languages.index(str(label)), grams] += n
    logs = np.log(counts / counts.sum(axis=1, keepdims=True)) if languages else counts
    return LanguageModel(languages, np.ascontiguousarray(logs.T.astype(np.float32)))


def identify_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score."""
    model = docs.sparkSession.sparkContext.broadcast(fit_languages(docs))  # n-gram table: languages * 128 KB

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    with batches_of(docs.sparkSession, BATCH_ROWS):
        return staged(texts.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double"), "languages")

"""Removing repeated passages: runs of consecutive sentences that occur before, anywhere in the corpus.

Every sentence starts a run and every sentence ends one: the fewest consecutive sentences, ``sentences`` at least,
that hold ``min_words`` words. A text of fewer sentences is one run, if it has the words. All runs are hashed, the
hashes joined over the whole corpus, and a sentence goes if any run over it has an earlier equal one; earlier is by
doc_id, then position. A passage of that many sentences and words is covered whole: by runs from its first sentences
and to its last ones. A single long sentence that repeats between other ones stays.

A sentence is a run of words that ends with a word on ``.``, ``!`` or ``?`` or before a line break; the blanks after
it are its own. Runs are equal if their words are, A-Z lower-cased. Hashes are 128 bits wide.

Defined cases: a null or empty text, or one of blanks, has no sentence and stays as it is (null: empty). A null
``doc_id`` neither loses sentences nor makes others lose them. Rows that share a ``doc_id`` are told apart by their
texts; equal rows are one document. Other columns aren't read. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsforge.llm.hashing import mix, prefix_hash, span_hash, texts_of, word_hashes, word_spans
from obsforge.llm.jaccard_join import small_batches
from obsforge.llm.line_dedup import text_version
from obsforge.session import staged

#: Words and sentences that a run has at least.
MIN_WORDS, SENTENCES = 25, 2

_SECOND = np.uint64(0xD1342543DE82EF95)
_ENDS = np.zeros(256, dtype=bool)
_ENDS[list(b".!?")] = True


def sentence_starts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Numbers of the words that start a sentence."""
    if not len(starts):
        return starts
    breaks = np.concatenate(([0], np.cumsum(data == 0x0A)))
    closes = _ENDS[data[ends[:-1] - 1]] | (breaks[starts[1:]] > breaks[ends[:-1]])
    return np.concatenate(([0], np.flatnonzero(closes) + 1))


def runs_of(
    text: bytes, words: np.ndarray, min_words: int, sentences: int = SENTENCES
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and last sentence of each run, and its two hashes."""
    data = np.frombuffer(text, dtype=np.uint8)
    firsts = sentence_starts(data, *word_spans(data))
    n = len(firsts)
    more = min(sentences, n) - 1  # sentences of a run besides its first
    bounds = np.append(firsts, len(words))  # words before each sentence, and all
    at = np.arange(n)
    # the sentence that a run from i ends with, and the one that a run to j starts with
    last = np.maximum(np.searchsorted(bounds, bounds[:-1] + min_words) - 1, at + more)
    first = np.minimum(np.searchsorted(bounds, bounds[1:] - min_words, side="right") - 1, at - more)
    pairs = np.concatenate((np.stack([at, last], 1)[last < n], np.stack([first, at], 1)[first >= 0]))
    pairs = np.unique(pairs, axis=0) if len(pairs) else pairs.reshape(0, 2)
    low, high = bounds[pairs[:, 0]], bounds[pairs[:, 1] + 1]
    one, two = (span_hash(prefix_hash(mix(words ^ seed)), low, high) for seed in (np.uint64(0), _SECOND))
    return pairs[:, 0], pairs[:, 1], one, two


def _runs(docs: DataFrame, min_words: int, sentences: int) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch, "text")
            found = [runs_of(t, w, min_words, sentences) for t, w in zip(texts, word_hashes(texts), strict=True)]
            if not found:
                continue
            row = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
            first, last, one, two = (np.concatenate(x) for x in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(one.view(np.int64)),
                    pa.array(two.view(np.int64)),
                    batch.column("doc_id").take(pa.array(row)),
                    batch.column("version").take(pa.array(row)),
                    pa.array(first.astype(np.int32)),
                    pa.array(last.astype(np.int32)),
                ],
                names=["hash", "second", "doc_id", "version", "first", "last"],
            )

    schema = "hash long, second long, doc_id long, version long, first int, last int"
    return docs.where("doc_id is not null").mapInArrow(emit, schema)


def drop_repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, sentences: int = SENTENCES) -> DataFrame:
    """doc_id, n_sentences, n_removed, n_spans (maximal runs of removed sentences) and kept, the text that stays."""
    small_batches(docs.sparkSession)
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_version(F.col("text").cast("string")).alias("version"),
        F.col("text").cast("string").cast("binary").alias("text"),
    )
    runs = _runs(texts, min_words, sentences)
    repeated = staged(runs.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1").select("hash"), "hashes")
    rows = staged(runs.join(repeated, "hash", "left_semi"), "runs")
    earliest = F.min(F.struct("doc_id", "version", "first")).alias("origin")
    origins = staged(rows.groupBy("hash", "second").agg(earliest, F.count("*").alias("n")).where("n > 1").drop("n"), "origins")
    later = rows.join(origins, ["hash", "second"]).where(F.struct("doc_id", "version", "first") > F.col("origin"))
    covered = (
        later.select("doc_id", "version", "first", "last")
        .distinct()
        .groupBy(F.col("doc_id").alias("of_doc"), F.col("version").alias("of_version"))
        .agg(F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    )
    same = (F.col("doc_id") == F.col("of_doc")) & (F.col("version") == F.col("of_version"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            spans = zip(batch.column("firsts").to_pylist(), batch.column("lasts").to_pylist(), strict=True)
            for text, (firsts, lasts) in zip(texts_of(batch, "text"), spans, strict=True):
                data = np.frombuffer(text, dtype=np.uint8)
                starts, ends = word_spans(data)
                opens = starts[sentence_starts(data, starts, ends)]
                n = len(opens)
                if not firsts:
                    out.append((n, 0, 0, text))
                    continue
                change = np.zeros(n + 1, dtype=np.int64)
                np.add.at(change, firsts, 1)
                np.add.at(change, np.array(lasts) + 1, -1)
                gone = np.cumsum(change[:n]) > 0
                edges = [0, *opens[1:].tolist(), len(text)]
                kept = b"".join(text[edges[i] : edges[i + 1]] for i in np.flatnonzero(~gone))
                runs = int((gone & ~np.concatenate(([False], gone[:-1]))).sum())
                out.append((n, int(gone.sum()), runs, kept))
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
                names=["doc_id", "n_sentences", "n_removed", "n_spans", "kept"],
            )

    return (
        texts.join(covered, same, "left")
        .select("doc_id", "text", "firsts", "lasts")
        .mapInArrow(cut, "doc_id long, n_sentences long, n_removed long, n_spans long, kept binary")
        .withColumn("kept", F.col("kept").cast("string"))
    )

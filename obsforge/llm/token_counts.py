"""Token counts of documents by compiled finite-state transducers.

The tokenizer's file is read once, by the driver, and compiled in each Python worker (see ``transducer``): one machine
cuts texts into pieces, in chunks whose state maps compose by a prefix scan, and one counts the tokens of a piece from
the numbers on its transitions. Many short texts run as one stream with ends between them; a long one is cut before
spaces at which the first machine starts afresh. Counts of short pieces are remembered up to a bound.

Defined cases: null is empty, and an empty text has 0 bytes and 0 tokens. A string of the tokenizer's special tokens is
one token wherever it stands in a text. Rows with a null or repeated ``doc_id`` are counted like any other. Only
``doc_id`` and ``text`` are read. An empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from obsforge.llm.text import batches_of
from obsforge.llm.transducer import END, Compiled, class_table, piece_starts
from obsforge.session import staged

#: Tokens beyond which a document is over the limit.
LIMIT = 1024
#: Bytes that run as one stream; a longer text is cut at the first fit place after as many.
STREAM = 1 << 20
#: Rows of a batch that a task holds at once.
BATCH_ROWS = 512
#: Pieces whose counts a worker remembers at most, and bytes of one at most.
REMEMBERED, REMEMBERED_BYTES = 1 << 18, 48

# a sign before a space: the space begins a piece whatever came before
_FIT = re.compile(rb"[!-~] ")


class _Known(dict):
    def __init__(self, count):
        super().__init__()
        self.count = count

    def __missing__(self, piece: bytes) -> int:
        found = self.count(piece)
        if len(piece) <= REMEMBERED_BYTES:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = found
        return found


class TokenCounter:
    """Numbers of tokens of whole texts."""

    def __init__(self, source: str):
        compiled = Compiled(source)
        self.classes = class_table(pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str)
        self.known = _Known(compiled.count)
        special = [re.escape(s) for s in compiled.special]
        self.special = re.compile(b"|".join(special)) if special else None

    def _parts(self, texts: list[bytes], counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """Numbers of texts with the parts that are counted by themselves; special strings are counted here."""
        for number, text in enumerate(texts):
            at = 0
            for found in self.special.finditer(text) if self.special else ():
                counts[number] += 1
                yield from ((number, part) for part in _cut(text[at : found.start()]))
                at = found.end()
            yield from ((number, part) for part in _cut(text[at:]))

    def _stream(self, parts: list[bytes]) -> np.ndarray:
        """Number of tokens of each part."""
        data = b"\n".join(parts)
        if data.isascii():
            points = np.frombuffer(data, dtype=np.uint8)
            places = None
        else:
            points = np.frombuffer(data.decode().encode("utf-32-le"), dtype=np.uint32)
            places = np.zeros(len(points) + 1, dtype=np.int64)
            np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000).astype(np.int64), out=places[1:])
        kinds = self.classes(points)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        if places is not None:
            ends = np.searchsorted(places, ends)
        kinds[ends[:-1]] = END
        starts = piece_starts(kinds)
        bounds = np.sort(np.concatenate((starts, ends)))
        stops = bounds[np.searchsorted(bounds, starts, side="right")]
        whose = np.searchsorted(ends, starts)
        if places is not None:
            starts, stops = places[starts], places[stops]
        known = self.known
        found = [known[data[a:b]] for a, b in zip(starts.tolist(), stops.tolist(), strict=True)]
        return np.bincount(whose, weights=found, minlength=len(parts)).astype(np.int64)

    def __call__(self, texts: list[bytes]) -> np.ndarray:
        counts = np.zeros(len(texts), dtype=np.int64)
        held: list[tuple[int, bytes]] = []
        size = 0

        def flush() -> None:
            if held:
                np.add.at(counts, [n for n, _ in held], self._stream([part for _, part in held]))

        for number, part in self._parts(texts, counts):
            held.append((number, part))
            size += len(part) + 1
            if size >= STREAM:
                flush()
                held, size = [], 0
        flush()
        return counts


def _cut(text: bytes) -> Iterator[bytes]:
    at = 0
    while len(text) - at > STREAM:
        fit = _FIT.search(text, at + STREAM - 1)
        if fit is None:
            break
        yield text[at : fit.start() + 1]
        at = fit.start() + 1
    if at < len(text):
        yield text[at:] if at else text


@lru_cache(maxsize=1)
def _counter(source: str) -> TokenCounter:
    return TokenCounter(source)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit, one row per input row; ``tokenizer`` is a file the driver reads."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        source = spark.sparkContext.broadcast(file.read())  # a vocabulary file, whatever the data

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(source.value)
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            sound = [t if t.isascii() else t.decode("utf-8", "replace").encode() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), sizes, pa.array(counter(sound), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    with batches_of(spark, BATCH_ROWS):
        counted = staged(texts.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long"), "token-counts")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

"""Hashes of words and shingles of many texts at once, for use inside tasks.

All hashes are 64 bits wide and depend on the bytes alone, so every task and every run agrees on them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Texts are handled in pieces of about this many bytes, which bounds the working arrays.
PIECE_BYTES = 1 << 20

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit (the splitmix64 finalizer)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U64(_BASE))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]


def powers(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(20, int(n - 1).bit_length())
        have = np.ones(size, dtype=np.uint64)
        have[1:] = base
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """P with P[0] = 0, from which ``span_hash`` reads the hash of any span."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(_BASE, len(values)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((prefix[end] - prefix[start]) * powers(_INVERSE, len(prefix))[start])


def byte_hashes(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a text."""
    blank = np.concatenate(([True], _BLANK[data], [True]))
    edge = blank[1:] != blank[:-1]
    at = np.flatnonzero(edge)
    return at[::2], at[1::2]


def _pieces(texts: Iterable[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """Text numbers with texts, about PIECE_BYTES at a time; a longer text is cut before a blank."""
    held: list[tuple[int, bytes]] = []
    size = 0
    for number, text in enumerate(texts):
        while len(text) > PIECE_BYTES:
            cut = PIECE_BYTES
            while cut < len(text) and not _BLANK[text[cut]]:
                cut += 1
            yield [*held, (number, text[:cut])]
            held, size, text = [], 0, text[cut:]
        held.append((number, text))
        size += len(text) + 1
        if size >= PIECE_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def word_hashes(texts: list[bytes]) -> list[np.ndarray]:
    """Hashes of the words of each text, A-Z lower-cased."""
    parts: list[list[np.ndarray]] = [[] for _ in texts]
    for piece in _pieces(texts):
        data = np.frombuffer(b"\n".join(text for _, text in piece), dtype=np.uint8)
        starts, ends = word_spans(data)
        hashes = span_hash(prefix_hash(_BYTE_LOWER[data]), starts, ends)
        bounds = np.cumsum([len(text) + 1 for _, text in piece])[:-1]
        for (number, _), own in zip(piece, np.split(hashes, np.searchsorted(starts, bounds)), strict=True):
            parts[number].append(own)
    empty = np.zeros(0, dtype=np.uint64)
    return [p[0] if len(p) == 1 else np.concatenate(p) if p else empty for p in parts]


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each run of ``size`` words; of all words if there are fewer; none without words."""
    n = len(words)
    if n == 0:
        return words
    run = min(size, n)
    out = np.full(n - run + 1, run, dtype=np.uint64)
    for i in range(run):
        out = mix(out * _U64(_BASE) + words[i : n - run + 1 + i])
    return out


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """The column as UTF-8 bytes; null as empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]

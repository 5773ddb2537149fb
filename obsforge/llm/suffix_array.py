"""Suffix arrays by two-stage sorting, for texts that fit one task."""

from __future__ import annotations

import numpy as np

#: Ends every piece, and without end the last one. No byte of UTF-8.
END = 0xFF
#: Compared at once when adjacent suffixes are.
_ROWS = 4096


def smaller_than_next(symbols: np.ndarray) -> np.ndarray:
    """For each suffix, whether it is smaller than the one that starts a symbol later (the last one is)."""
    n = len(symbols)
    differs = np.append(symbols[:-1] != symbols[1:], True)
    # a run of equal symbols is decided where it ends
    ends = np.flatnonzero(differs)
    end = ends[np.searchsorted(ends, np.arange(n))]
    rises = np.append(symbols[:-1] < symbols[1:], True)
    return rises[end]


def two_stage_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by at least their first ``depth`` symbols (uint8; the last must be the end).

    Only suffixes that are smaller than their successor are sorted directly. Every other one follows its successor
    in the order, so scanning the buckets of first symbols from the lowest, each bucket's suffixes tell those before
    them their place in a later bucket, or further on in the same.
    """
    n = len(symbols)
    small = smaller_than_next(symbols)
    direct = np.flatnonzero(small)
    padded = np.concatenate((symbols, np.full(depth, END, dtype=np.uint8)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, depth)
    keys = np.ascontiguousarray(windows[direct]).view(f"S{depth}").ravel()
    direct = direct[np.argsort(keys, kind="stable")]
    bounds = np.searchsorted(symbols[direct], np.arange(257))

    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    order: list[np.ndarray] = []
    for symbol in range(256):
        placed = waiting[symbol]
        at = 0
        while at < len(placed):  # runs of one symbol grow from their end
            before = placed[at][placed[at] > 0] - 1
            before = before[symbols[before] == symbol]
            if len(before):
                placed.append(before)
            at += 1
        bucket = np.concatenate([*placed, direct[bounds[symbol] : bounds[symbol + 1]]])
        if not len(bucket):
            continue
        order.append(bucket)
        before = bucket[bucket > 0] - 1
        first = symbols[before]
        before, first = before[first > symbol], first[first > symbol]
        by_symbol = np.argsort(first, kind="stable")
        before, first = before[by_symbol], first[by_symbol]
        cuts = np.flatnonzero(np.diff(first)) + 1
        for group in np.split(before, cuts):
            if len(group):
                waiting[symbols[group[0]]].append(group)
    return np.concatenate(order) if n else direct


def common_prefixes(symbols: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each suffix in ``order`` with the one before it, up to ``depth``."""
    padded = np.concatenate((symbols, np.full(depth, END, dtype=np.uint8)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, depth)
    out = np.zeros(len(order), dtype=np.int64)
    for at in range(1, len(order), _ROWS):
        rows = order[at : at + _ROWS]
        same = windows[order[at - 1 : at - 1 + len(rows)]] == windows[rows]
        out[at : at + len(rows)] = np.where(same.all(axis=1), depth, same.argmin(axis=1))
    return out


def repeated_starts(pieces: list[bytes], depth: int) -> list[np.ndarray]:
    """For each piece, which of its strings of ``depth`` bytes also start anywhere else in the pieces."""
    lengths = np.array([len(p) for p in pieces], dtype=np.int64)
    symbols = np.frombuffer(b"".join(p + bytes([END]) for p in pieces), dtype=np.uint8)
    begins = np.concatenate(([0], np.cumsum(lengths + 1)))[:-1]
    whole = np.zeros(len(symbols) + 1, dtype=np.int64)
    room = np.maximum(lengths - depth + 1, 0)
    np.add.at(whole, begins, 1)
    np.add.at(whole, begins + room, -1)
    starts = np.cumsum(whole[:-1]) > 0
    order = two_stage_order(symbols, depth)
    order = order[starts[order]]
    same = common_prefixes(symbols, order, depth) >= depth
    found = np.zeros(len(symbols), dtype=bool)
    found[order[same | np.append(same[1:], False)]] = True
    return [found[b : b + r] for b, r in zip(begins, room, strict=True)]

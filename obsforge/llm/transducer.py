"""Deterministic transducers that count the tokens of a byte-level byte-pair tokenizer.

Two machines run one after the other. The first cuts a text into pieces, as the tokenizer's pattern does: its states say
what the open piece is made of, and each transition on a class of characters says which pieces begin. Chunks of a text
run in step, each from every state at once; their state maps compose in a prefix scan, which gives each chunk the state
it really starts in. The second machine reads the bytes of one piece. The encoding of a prefix ends in the one token that
goes together with the token before it, so its state needs no more than the last tokens of the prefixes a token can still
grow from, and each transition on a byte carries by how much the number of tokens changes. Both are deterministic; the
second is compiled as far as texts use it and starts anew when it has grown beyond a bound.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np

# Classes of characters. Fixed by the pattern: contractions 's 't 'm 'd, 're 've and 'll begin with an apostrophe.
LETTER, SINGLE, RV, L, E, NUMBER, OTHER, QUOTE, SPACE, BLANK, END = range(11)
# What the open piece is: nothing; letters; numbers; other signs; one or more blanks, the last a space or another one;
# an apostrophe that begins a piece, alone or with the first letter of a contraction of two.
_NONE, _LETTERS, _NUMBERS, _SIGNS, _SPACE, _BLANK, _SPACES, _BLANKS, _QUOTE, _QUOTE_RV, _QUOTE_L = range(11)
STATES, CLASSES = 11, 16
#: A piece begins at this character, at the one before it.
HERE, BEFORE = 1, 2

_LETTERS_CLASSES = (LETTER, SINGLE, RV, L, E)
#: Characters that a chunk has.
CHUNK = 512


def _fresh(kind: int) -> int:
    """The state after a character that begins a piece."""
    if kind in _LETTERS_CLASSES:
        return _LETTERS
    return {NUMBER: _NUMBERS, OTHER: _SIGNS, QUOTE: _QUOTE, SPACE: _SPACE, BLANK: _BLANK, END: _NONE}[kind]


def _step(state: int, kind: int) -> tuple[int, int]:
    begins = 0 if kind == END else HERE
    new = _fresh(kind)
    if state == _LETTERS and new == _LETTERS or state == _NUMBERS and new == _NUMBERS:
        return state, 0
    if state == _SIGNS and kind in (OTHER, QUOTE):
        return state, 0
    if state in (_SPACE, _BLANK, _SPACES, _BLANKS):
        if kind in (SPACE, BLANK):
            return (_SPACES if kind == SPACE else _BLANKS), 0
        if kind == END:
            return _NONE, 0
        # the last blank leaves the others; a space goes along with what follows
        last = BEFORE if state in (_SPACES, _BLANKS) else 0
        if state in (_SPACE, _SPACES):
            return (_SIGNS if kind == QUOTE else new), last
        return new, HERE | last
    if state == _QUOTE:
        if kind in (SINGLE, RV, L):
            return {SINGLE: _NONE, RV: _QUOTE_RV, L: _QUOTE_L}[kind], 0
        if kind in (OTHER, QUOTE):
            return _SIGNS, 0
    if (state, kind) in ((_QUOTE_RV, E), (_QUOTE_L, L)):
        return _NONE, 0
    if state in (_QUOTE_RV, _QUOTE_L):  # no contraction: the letter begins a piece
        return (_LETTERS, BEFORE) if new == _LETTERS else (new, begins | BEFORE)
    return new, begins


def _tables() -> tuple[np.ndarray, np.ndarray]:
    after = np.zeros(STATES * CLASSES, dtype=np.uint8)
    begins = np.zeros(STATES * CLASSES, dtype=np.uint8)
    for state in range(STATES):
        for kind in range(END + 1):
            after[state * CLASSES + kind], begins[state * CLASSES + kind] = _step(state, kind)
    return after, begins


AFTER, BEGINS = _tables()


def chunk_maps(kinds: np.ndarray) -> np.ndarray:
    """For each row of classes the state it ends in, by the state it starts in."""
    maps = np.broadcast_to(np.arange(STATES, dtype=np.uint8), (len(kinds), STATES)).copy()
    for column in kinds.T:
        maps = AFTER[maps.astype(np.intp) * CLASSES + column[:, None]]
    return maps


def scan(maps: np.ndarray) -> np.ndarray:
    """Maps of all chunks up to each one: log2 of their number rounds, each over all chunks at once."""
    maps, reach = maps.copy(), 1
    while reach < len(maps):
        maps[reach:] = np.take_along_axis(maps[reach:], maps[:-reach].astype(np.intp), axis=1)
        reach *= 2
    return maps


def piece_starts(kinds: np.ndarray) -> np.ndarray:
    """Where the pieces of a run of characters begin; ``END`` ends a text and is in no piece."""
    n = len(kinds)
    many = -(-(n + 1) // CHUNK)
    padded = np.full(many * CHUNK, END, dtype=np.uint8)
    padded[:n] = kinds
    rows = padded.reshape(many, CHUNK)
    state = np.zeros(many, dtype=np.uint8)
    state[1:] = scan(chunk_maps(rows[:-1]))[:, _NONE]
    said = np.zeros((CHUNK, many), dtype=np.uint8)
    for k, column in enumerate(rows.T):
        at = state.astype(np.intp) * CLASSES + column
        said[k] = BEGINS[at]
        state = AFTER[at]
    flat = said.T.ravel()
    starts = (flat & HERE).astype(bool)
    starts[:-1] |= (flat[1:] & BEFORE).astype(bool)
    return np.flatnonzero(starts[:n])


def byte_alphabet() -> dict[str, int]:
    """The sign that stands for each byte in the vocabulary: itself if it prints, else the next free one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


class _State(dict):
    """Transitions by byte: the next state and the change in the number of tokens; a missing one is compiled."""

    __slots__ = ("counter", "end", "prefixes")

    def __init__(self, counter: PieceCounter, end: bytes, prefixes: tuple):
        super().__init__()
        self.counter, self.end, self.prefixes = counter, end, prefixes

    def __missing__(self, byte: int) -> tuple[_State, int]:
        step = self[byte] = self.counter.compiled(self.end, self.prefixes, byte)
        return step


class PieceCounter:
    """Counts the tokens of single pieces by a transducer that is compiled on demand.

    A state is the longest end of what was read that a longer token begins with, and for each prefix that such a token can
    still grow from its last token and by how many tokens it is behind. ``merges`` are pairs of byte strings, best first;
    tokens are numbered by bytes, then merges.
    """

    #: Transitions and pairs of tokens that are kept at most.
    MOST = 1 << 19
    START = -1

    def __init__(self, merges: list[tuple[bytes, bytes]]):
        names = [bytes((b,)) for b in range(256)] + [a + b for a, b in merges]
        self.tokens = {name: i for i, name in reversed(list(enumerate(names)))}
        #: the two tokens that each token of more than a byte was merged from
        self.halves = [(i, i) for i in range(256)] + [(self.tokens[a], self.tokens[b]) for a, b in merges]
        self.merged = {pair: i for i, pair in reversed(list(enumerate(self.halves))) if i >= 256}
        #: tokens that the encoding of their own bytes is
        self.whole = [True] * 256
        for token, (left, right) in enumerate(self.halves[256:], 256):
            self.whole.append(self.whole[left] and self.whole[right] and self._stay_apart(left, right, token))
        self.tokens = {name: i for name, i in self.tokens.items() if self.whole[i]}
        self.grows = {name[:k] for name in self.tokens for k in range(1, len(name))}
        self._reset()

    def _reset(self) -> None:
        self.apart: dict[tuple[int, int], bool] = {}
        self.start = _State(self, b"", ((self.START, 0),))
        self.states: dict[tuple[bytes, tuple], _State] = {}
        self.size = 0

    def _stay_apart(self, left: int, right: int, before: int) -> bool:
        """Whether no merge above rank ``before`` joins two neighbours across their border.

        Merges are undone from the last one: while both are there, only a merge that comes before the one that ended this
        could have joined them. Among equal ranks the left one comes first.
        """
        while True:
            if self.merged.get((left, right), before) < before:
                return False
            if left < 256 and right < 256:
                return True
            if left > right:
                left, before = self.halves[left][1], left
            else:
                right, before = self.halves[right][0], right + 1

    def _follows(self, before: int, token: int) -> bool:
        """Whether a token stays whole after that one."""
        pair = (before, token)
        found = self.apart.get(pair)
        if found is None:
            found = self.apart[pair] = before == self.START or self._stay_apart(before, token, len(self.halves))
        return found

    def compiled(self, end: bytes, prefixes: tuple, byte: int) -> tuple[_State, int]:
        """The transition on a byte from the state with this end and these prefixes."""
        end += bytes((byte,))
        for start, held in enumerate(prefixes):  # the prefix that ends so many bytes into the end
            if held is None:
                continue
            token = self.tokens.get(end[start:])
            if token is not None and self._follows(held[0], token):
                change = 1 - held[1]
                break
        else:
            raise ValueError(f"no token for byte {byte}")
        kept = [(held[0], held[1] + change) if held and end[i:] in self.grows else None for i, held in enumerate(prefixes)]
        kept.append((token, 0))
        cut = 0
        while kept[cut] is None:
            cut += 1
        key = (end[cut:], tuple(kept[cut:]))
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = _State(self, *key)
        self.size += 1
        return state, change

    def __call__(self, piece: bytes) -> int:
        if self.size + len(self.apart) > self.MOST:
            self._reset()
        state, count = self.start, 0
        for byte in piece:
            state, change = state[byte]
            count += change
        return count


class Compiled:
    """A tokenizer file of one kind: byte-level byte-pair encoding with the usual pattern, no normalizer, no extras."""

    def __init__(self, source: str):
        given = json.loads(source)
        model, cutter = given["model"], given.get("pre_tokenizer") or {}
        fits = (
            model.get("type") == "BPE"
            and cutter.get("type") == "ByteLevel"
            and cutter.get("use_regex", True)
            and not cutter.get("add_prefix_space")
            and not given.get("normalizer")
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        )
        added = given.get("added_tokens", [])
        if not fits or any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in added):
            raise ValueError("only plain byte-level byte-pair tokenizers can be compiled")
        letters = byte_alphabet()
        spelled = lambda text: bytes(letters[c] for c in text)
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.count = PieceCounter([(spelled(a), spelled(b)) for a, b in pairs])
        #: strings that are one token wherever they stand, longest first
        self.special = sorted((t["content"].encode() for t in added), key=len, reverse=True)


def class_table(probe: Callable[[str], list[tuple[str, tuple[int, int]]]]) -> Callable[[np.ndarray], np.ndarray]:
    """Classes of code points as the library's own cutter sees them, asked for when first met."""
    table = np.full(0x110000, 255, dtype=np.uint8)

    def joins(points: np.ndarray, sign: str) -> np.ndarray:
        """Whether each character stays in one piece with a sign before it; a line feed cuts all pairs apart."""
        starts = np.zeros(3 * len(points) + 1, dtype=bool)
        for _, (start, _) in probe("".join(f"\n{sign}{chr(c)}" for c in points)):
            starts[start] = True
        return ~starts[2 : 3 * len(points) : 3]

    def learn(points: np.ndarray) -> None:
        kinds = np.full(len(points), BLANK, dtype=np.uint8)
        for sign, kind in (("a", LETTER), ("1", NUMBER), ("!", OTHER)):
            kinds[joins(points, sign)] = kind
        table[points] = kinds

    def classes(points: np.ndarray) -> np.ndarray:
        found = table[points]
        if (found == 255).any():
            learn(np.unique(points[found == 255]))
            found = table[points]
        return found

    learn(np.arange(128))
    for signs, kind in (("stmd", SINGLE), ("rv", RV), ("l", L), ("e", E), ("'", QUOTE), (" ", SPACE)):
        table[[ord(s) for s in signs]] = kind
    return classes

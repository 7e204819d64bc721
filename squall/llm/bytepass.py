"""One table-driven pass over the UTF-8 bytes of texts, and a table of their spans.

``CLASS`` gives each byte a class, ``NEXT`` the state after it (outside or inside
a word) and ``EMIT`` what the step from a state over a class puts out: a word's
start, a capital, a symbol, a code point. ``NEXT`` does not depend on the state
it leaves, so the state before every byte is known from the byte before it and
the whole pass is three table look-ups over an array, never a loop over bytes.

``first_equal`` inserts word (or line) spans into an open-addressing hash table.
Two spans count as equal only after their bytes are compared, so a collision of
hashes costs a probe and never a wrong count.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from squall.llm.common import strings

SPACE, NEWLINE, CAPITAL, SYMBOL, DIGIT, STOP, CONTINUED, OTHER = range(8)
OUTSIDE, INSIDE = 0, 1
START, UPPER, MARK, POINT, LINE, FIGURE, END_MARK = (1 << i for i in range(7))
SYMBOLS = b"#$%&*|"
LONG = 64        # bytes of a span compared in eights; what lies beyond is compared at once


def _classes() -> np.ndarray:
    table = np.full(256, OTHER, np.uint8)
    table[0x80:0xC0] = CONTINUED
    table[ord("A"):ord("Z") + 1] = CAPITAL
    table[ord("0"):ord("9") + 1] = DIGIT
    table[list(b".,;:!?")] = STOP
    table[list(SYMBOLS)] = SYMBOL
    table[[0x20, *range(0x09, 0x0E)]] = SPACE
    table[0x0A] = NEWLINE
    return table


def _emitted() -> np.ndarray:
    own = np.array([0, LINE, UPPER, MARK, FIGURE, END_MARK, 0, 0], np.uint8)
    own += np.where(np.arange(8) == CONTINUED, 0, POINT).astype(np.uint8)
    begins = own + np.where(NEXT == INSIDE, START, 0).astype(np.uint8)
    return np.concatenate([begins, own])  # by state * 8 + class


CLASS = _classes()
NEXT = np.array([OUTSIDE, OUTSIDE, INSIDE, INSIDE, INSIDE, INSIDE, INSIDE, INSIDE], np.uint8)
EMIT = _emitted()
_LOW = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


@dataclass
class Pass:
    """What the pass found in some texts: their bytes (eight more behind), where
    each text begins and ends, what every byte emitted, and the spans of words."""

    data: np.ndarray
    bounds: np.ndarray
    emitted: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def per_text(self, places: np.ndarray) -> np.ndarray:
        """How many of ascending places lie in each text."""
        return np.diff(np.searchsorted(places, self.bounds))

    def count(self, flag: int) -> np.ndarray:
        return self.per_text(np.flatnonzero(self.emitted & flag))

    def points(self) -> np.ndarray:
        """Code points of each text: every byte but continuations."""
        return np.diff(self.bounds) - self.per_text(np.flatnonzero((self.emitted & POINT) == 0))

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, places, side="right") - 1


def run(texts: pa.Array) -> Pass:
    """The pass over whole texts; nulls are empty."""
    column = strings(texts)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    size = int(bounds[-1] - bounds[0])
    padded = np.zeros(size + 8, np.uint8)
    if size:
        padded[:size] = np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]
    bounds = bounds - bounds[0]
    kind = CLASS[padded[:size]]
    after = NEXT[kind]
    before = np.empty_like(after)
    before[1:] = after[:-1]
    before[bounds[:-1][bounds[:-1] < size]] = OUTSIDE  # a text's first byte, the array's included
    emitted = EMIT[before * np.uint8(8) + kind]
    start = np.flatnonzero(emitted & START)
    # a word ends where the next byte is outside or begins a word of the next text
    last = after.astype(bool)
    last[:-1] &= (after[1:] == OUTSIDE) | (before[1:] == OUTSIDE)
    return Pass(padded, bounds, emitted, start, np.flatnonzero(last) + 1)


def lines(found: Pass) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the lines that hold anything."""
    size = len(found.emitted)
    breaks = np.flatnonzero(found.emitted & LINE)
    edges = found.bounds[:-1][found.bounds[:-1] < size]
    start = np.union1d(edges, breaks + 1)
    start = start[start < size]
    end = np.append(start[1:], size)[:len(start)]
    end = end - ((found.emitted[end - 1] & LINE) > 0)  # the break itself is not part of its line
    kept = end > start
    return start[kept], end[kept]


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number."""
    return np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def span_hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: np.ndarray) -> np.ndarray:
    eights = _eights(data)
    h = _mixed(seed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + size.astype(np.uint64))
    for at in range(0, LONG, 8):
        some = np.flatnonzero(size > at) if at else slice(None)
        if at and not len(some):
            return h
        h[some] = _mixed(h[some] ^ (eights[start[some] + at] & _LOW[np.minimum(size[some] - at, 8)]))
    for i in np.flatnonzero(size > LONG).tolist():
        rest = xxhash.xxh3_64_intdigest(data[start[i] + LONG:start[i] + size[i]])
        h[i] ^= np.uint64(rest)
    return h


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans of the same sizes at places a and b hold the same bytes."""
    eights = _eights(data)
    equal = ((eights[a] ^ eights[b]) & _LOW[np.minimum(size, 8)]) == 0
    for at in range(8, LONG, 8):
        some = np.flatnonzero(equal & (size > at))
        if not len(some):
            return equal
        low = _LOW[np.minimum(size[some] - at, 8)]
        equal[some] = ((eights[a[some] + at] ^ eights[b[some] + at]) & low) == 0
    for i in np.flatnonzero(equal & (size > LONG)).tolist():
        n = size[i]
        equal[i] = data[a[i] + LONG:a[i] + n].tobytes() == data[b[i] + LONG:b[i] + n].tobytes()
    return equal


def first_equal(data: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray) -> np.ndarray:
    """For each span, one span of the same text with the same bytes: the same
    one for all that are equal."""
    n = len(start)
    owner = np.arange(n)
    if not n:
        return owner
    size = end - start
    h = span_hashes(data, start, size, text)
    mask = (1 << (2 * n - 1).bit_length()) - 1
    table = np.full(mask + 1, -1, np.int64)
    slot = (h & np.uint64(mask)).astype(np.int64)
    todo = np.arange(n)
    while len(todo):
        at = slot[todo]
        free = table[at] < 0
        table[at[free]] = todo[free]
        held = table[at]
        same = (h[held] == h[todo]) & (text[held] == text[todo]) & (size[held] == size[todo])
        check = np.flatnonzero(same & (held != todo))
        same[check] = same_bytes(data, start[held[check]], start[todo[check]], size[todo[check]])
        owner[todo[same]] = held[same]
        todo = todo[~same]
        slot[todo] = (slot[todo] + 1) & mask
    return owner

"""Hashes of words and lines for whole batches of texts with numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

_GOLDEN = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text hashed at a time, unless one text alone is longer.
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_GOLDEN))
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LINE_END = np.zeros(256, bool)
_LINE_END[10] = True
_powers: dict[str, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    kept = _powers.get(base)
    if kept is None or len(kept) < n:
        steps = np.full(max(n, CHUNK_BYTES + 4096), base, np.uint64)
        steps[0] = 1
        kept = np.multiply.accumulate(steps)
        if n <= 4 * CHUNK_BYTES:
            _powers[base] = kept
    return kept[:n]


def _pieces(a: np.ndarray, begins: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A hash of each a[begins:ends], from differences of one running polynomial sum."""
    total = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(table[a] * _power(_BASE, len(a)), out=total[1:])
    own = (total[ends] - total[begins]) * _power(_INVERSE, len(a) + 1)[begins]
    return mix(own + (ends - begins).astype(np.uint64) * np.uint64(_GOLDEN))


def decoded(column: Iterable) -> Iterator[bytes]:
    """The texts of an Arrow column (null: empty) one at a time, so that only the chunk in work is held besides the column."""
    return ((text.as_py() or "").encode() for text in column)


def chunks(texts: Iterable[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, texts) of about CHUNK_BYTES each."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        if held and size + len(text) > CHUNK_BYTES:
            yield first, held
            first, held, size = i, [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield first, held


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z folded, parted by ASCII white space) and their number in each text."""
    a = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[a]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
    begins, ends = edge[::2], edge[1::2]
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return _pieces(a, begins, ends, _FOLDED), np.diff(np.searchsorted(begins, offsets))


def line_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all lines (parted by \\n), whether each has more than white space, and lines in each text."""
    a = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.flatnonzero(a == 10)
    begins = np.concatenate(([0], ends[:-1] + 1))
    solid = np.concatenate(([0], np.cumsum(~_SPACE[a])))
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return _pieces(a, begins, ends, _BYTES), solid[ends] > solid[begins], np.diff(np.searchsorted(begins, offsets))


def line_words(texts: list[bytes]) -> np.ndarray:
    """Words (parted by ASCII white space) of all lines, in the order of ``line_hashes``."""
    a = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[a]
    begun = np.concatenate(([0], np.cumsum(~space & np.concatenate(([True], space[:-1])))))
    ends = np.flatnonzero(a == 10)
    return np.diff(begun[ends], prepend=0)


def shingles(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``width`` words within a text, in order, and their number in each text.

    A text of fewer words has one shingle, its whole sequence; one without
    words has none.
    """
    texts = np.repeat(np.arange(len(counts)), counts)
    place = np.arange(len(words)) - np.repeat(np.cumsum(counts) - counts, counts)
    left = counts[texts] - place
    take = (left >= width) | (place == 0)
    length = np.minimum(left, width)[take]
    at = np.flatnonzero(take)
    padded = np.concatenate((words, np.zeros(width, np.uint64)))
    out = length.astype(np.uint64)
    for i in range(width):
        out = mix(out * np.uint64(_GOLDEN) + np.where(i < length, padded[at + i], np.uint64(0)))
    return out, np.where(counts == 0, 0, np.maximum(counts - width + 1, 1))

"""Words of whole texts as numpy arrays, for operators that count or compare words.

A word is a longest run of characters other than the space and U+0009 to U+000D; in UTF-8 these
six are single bytes, so words are found on bytes. Texts are handled in chunks of bounded size
(one text is never split), each chunk with a fixed number of vector operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

#: Bytes of text that are handled at once; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 19
SPACE_BYTES = b" \t\n\x0b\x0c\r"

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACE_BYTES)] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

#: A fixed random odd number for each byte.
BYTE_VALUES = np.random.default_rng(20_011).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _word_values(fold_case: bool) -> np.ndarray:
    values = BYTE_VALUES.copy()
    if fold_case:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    values[_IS_SPACE] = 0
    return values


_WORD_VALUES = {fold: _word_values(fold) for fold in (False, True)}
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _power(way: str, base: np.uint64, n: int) -> np.ndarray:
    if len(_powers[way]) < n:
        steps = np.full(n + n // 4, base, dtype=np.uint64)
        steps[0] = 1
        _powers[way] = np.multiply.accumulate(steps)
    return _powers[way][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """A 64-bit hash of each span of bytes from one start to the next; bytes of value 0 don't count at its end."""
    spread = values[data] * _power("up", _BASE, len(data))
    return mix(np.add.reduceat(spread, starts) * _power("down", _INVERSE, len(data))[starts])


@dataclass
class Words:
    """The words of several texts: a 64-bit hash each, and where each text's words begin.

    ``first`` has one entry more than there are texts; the words of text i are
    ``hashes[first[i]:first[i + 1]]``.
    """

    hashes: np.ndarray
    first: np.ndarray
    data: np.ndarray
    starts: np.ndarray

    def ends(self) -> np.ndarray:
        """Where each word ends in ``data``, in which each begins at its start."""
        space = np.flatnonzero(_IS_SPACE[self.data])
        return np.append(space, len(self.data))[np.searchsorted(space, self.starts)]

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i] : self.first[i + 1]]


def words_of(texts: list[bytes], fold_case: bool) -> Words:
    """Hashes of the words of UTF-8 texts; ``fold_case`` takes A-Z as a-z."""
    joined = np.frombuffer(b" ".join(texts), dtype=np.uint8)
    begins = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    inside = ~_IS_SPACE[joined]
    starts = np.flatnonzero(inside[1:] > inside[:-1]) + 1
    if len(inside) and inside[0]:
        starts = np.concatenate(([0], starts))
    first = np.searchsorted(starts, begins)
    if not len(starts):
        return Words(np.zeros(0, dtype=np.uint64), first, joined, starts)
    return Words(span_hashes(joined, starts, _WORD_VALUES[fold_case]), first, joined, starts)


def windows(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` neighbouring words; the whole sequence if there are fewer."""
    n = min(n, len(words))
    if n == 0:
        return words
    count = len(words) - n + 1
    total = np.full(count, n, dtype=np.uint64)
    for k in range(n):
        total = (total + words[k : k + count]) * (_BASE + np.uint64(2 * k))
        total ^= total >> np.uint64(29)
    return mix(total)


def chunks(texts: list[str | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts as bytes) for runs of about ``limit`` bytes; null as empty."""
    start, size, group = 0, 0, []
    for i, text in enumerate(texts):
        data = text.encode() if text else b""
        if group and size + len(data) > limit:
            yield start, group
            start, size, group = i, 0, []
        group.append(data)
        size += len(data) + 1
    if group:
        yield start, group

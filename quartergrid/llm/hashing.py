"""Word and window hashes of whole batches of texts, in numpy.

Words are runs of bytes that are no ASCII white space. A hash of any range of
bytes or words is a difference of two running sums of ``value * base ** place``
modulo 2**64, moved back to place zero by the inverse power, and mixed. Equal
sequences get equal hashes wherever they stand; no Python loop sees a word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np

#: Bytes of text that are hashed together; a longer text is a batch of its own.
BATCH_BYTES = 1 << 18

_U = np.uint64


def _odd(seed: int) -> int:
    """An odd multiplier that depends on the seed only."""
    return int(mix(np.array([seed * 2 + 1], _U))[0]) | 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (splitmix64)."""
    h = h + _U(0x9E3779B97F4A7C15)
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


#: Powers are tabled for so many places; those beyond are products of two.
PLACE_BITS = 16


@lru_cache(maxsize=32)
def _powers(base: int, size: int = 1 << PLACE_BITS) -> np.ndarray:
    """The first powers of ``base``."""
    held = np.full(size, base, _U)
    held[0] = 1
    return np.multiply.accumulate(held)


class Powers:
    """Powers of a base at any places, from a table of fixed size and one number per table length."""

    def __init__(self, base: int, size: int) -> None:
        self.low = _powers(base)
        self.high = np.full((size >> PLACE_BITS) + 1, pow(base, 1 << PLACE_BITS, 1 << 64), _U)
        self.high[0] = 1
        self.high = np.multiply.accumulate(self.high)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return self.low[at & ((1 << PLACE_BITS) - 1)] * self.high[at >> PLACE_BITS]


def sums(values: np.ndarray, seed: int) -> tuple[np.ndarray, Powers]:
    """Running sums that :func:`ranges` takes differences of."""
    base, size = _odd(seed), len(values) + 1
    up = Powers(base, size)
    total = np.zeros(size, _U)
    for at in range(0, len(values), 1 << PLACE_BITS):  # block by block: memory beyond the result is of fixed size
        part = values[at : at + (1 << PLACE_BITS)] * up.high[at >> PLACE_BITS]
        out = total[at + 1 : at + 1 + len(part)]
        np.cumsum(part * up.low[: len(part)], out=out)
        out += total[at]
    return total, Powers(pow(base, -1, 1 << 64), size)


def ranges(table: tuple[np.ndarray, Powers], start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values from ``start`` to before ``end`` of each range."""
    total, down = table
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(_U))


_BYTES = mix(np.arange(256, dtype=_U))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """The words of a batch: bounds in bytes, hashes and the first word of each text.

    ``first`` has one entry more than the texts: text ``i`` owns the words from
    ``first[i]`` to before ``first[i + 1]``.
    """

    def __init__(self, texts: list[bytes]) -> None:
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        solid = ~_SPACE[data]
        edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
        if len(solid) and solid[0]:
            edge = np.concatenate(([0], edge))
        self.start, self.end = edge[0::2], edge[1::2]
        self.hash = ranges(sums(_BYTES[data], 1), self.start, self.end)
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, int)
        self.first = np.concatenate(([0], np.searchsorted(self.start, ends))).astype(np.int64)

    def windows(self, size: int, seed: int = 2) -> np.ndarray:
        """Hash of the ``size`` words from each word on, across texts too."""
        at = np.arange(max(0, len(self.hash) - size + 1))
        return ranges(sums(self.hash, seed), at, at + size)


def batches(texts: Iterable[bytes], limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts) of batches of about ``limit`` bytes."""
    held: list[bytes] = []
    begun = size = 0
    for text in texts:
        if held and size + len(text) > limit:
            yield begun, held
            begun, held, size = begun + len(held), [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield begun, held

"""Hashes of words and of runs of words for whole batches of texts, in numpy.

A batch is cut into chunks of whole texts.  Polynomial sums over the bytes of a chunk give
the hash of every word, and sums over the word hashes the hash of every run of ``n``
words, without a loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

_CHUNK_BYTES = 1 << 20
_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
_R_INVERSE = pow(_R, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(0, 2**64, 256, dtype=np.uint64, endpoint=False)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _power(name: str, base: int, n: int) -> np.ndarray:
    known = _powers.get(name)
    if known is None or len(known) < n:
        size = max(n, 2 * _CHUNK_BYTES)
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        known = _powers[name] = np.multiply.accumulate(factors)
    return known[:n]


def _sums(values: np.ndarray) -> np.ndarray:
    """Running sums of ``values[i] * R ** i``, with a 0 in front."""
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _power("r", _R, len(values)), out=out[1:])
    return out


@dataclass
class WordChunk:
    """Words of some texts; ``first[d] : first[d + 1]`` are those of text ``d``."""

    rows: range
    data: bytes
    start: np.ndarray
    end: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def runs(self, n: int, seed: int = 0) -> np.ndarray:
        """Hash of the ``n`` words from each word on, across texts too: callers use the
        starts that lie within one text."""
        count = len(self.hashes) - n + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint64)
        sums = _sums(mix(self.hashes + np.uint64(seed)))
        return mix((sums[n:] - sums[:count]) * _power("inverse", _R_INVERSE, count) + np.uint64(n))


def _chunk(rows: range, texts: Sequence[bytes], lower_ascii: bool) -> WordChunk:
    data = b" ".join(texts)
    raw = np.frombuffer(data, dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    word = np.concatenate(([False], ~space, [False]))
    change = np.flatnonzero(word[1:] != word[:-1])
    start, end = change[0::2], change[1::2]
    table = _TABLE
    if lower_ascii:
        table = _TABLE.copy()
        table[65:91] = _TABLE[97:123]
    sums = _sums(table[raw])
    size = (end - start).astype(np.uint64)
    inverse = _power("inverse", _R_INVERSE, max(1, len(raw)))
    hashes = mix((sums[end] - sums[start]) * inverse[start] + size)
    return WordChunk(rows, data, start, end, hashes, np.searchsorted(start, begins))


def word_chunks(texts: Sequence[str | None], lower_ascii: bool = False) -> Iterator[WordChunk]:
    """Chunks of about a megabyte, each of whole texts; null counts as empty."""
    begin, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size >= _CHUNK_BYTES:
            yield _chunk(range(begin, i + 1), held, lower_ascii)
            begin, held, size = i + 1, [], 0
    if held:
        yield _chunk(range(begin, begin + len(held)), held, lower_ascii)

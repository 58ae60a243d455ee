"""Words and hashes of whole Arrow batches of texts, computed on their UTF-8 bytes with numpy.

A batch is cut into runs of rows of about ``RUN_BYTES`` bytes, so memory stays at
some 100 bytes per byte of a run; a longer text is a run of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 1 << 18
_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: [\x20\x09-\x0D]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def runs(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows; null is the empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    if len(texts) == 0:
        return
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + RUN_BYTES, "right")) - 1)
        last = min(last, len(texts))
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.full(max(n, 2 * RUN_BYTES), base, _U64)
        out[0] = 1
        np.multiply.accumulate(out, out=out)
        if n > 2 * RUN_BYTES:
            return out
        _powers[base] = out
    return _powers[base][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> _U64(30))
    h *= _U64(0xBF58476D1CE4E5B9)
    h ^= h >> _U64(27)
    h *= _U64(0x94D049BB133111EB)
    h ^= h >> _U64(31)
    return h


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of value * base**place before each place, one entry more than values."""
    out = np.zeros(len(values) + 1, _U64)
    np.cumsum((values.astype(_U64) + _U64(1)) * powers(_BASE, len(values)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans of the sequence behind ``sums``: equal spans, equal hashes."""
    inverse = powers(_BASE_INVERSE, len(sums))
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mixed(h ^ (ends - starts).astype(_U64))


@dataclass
class Words:
    """Words of a run: byte spans, their rows, and ``first[row]`` .. ``first[row + 1]`` per row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return span_hashes(prefix_sums(self.data), self.starts, self.ends)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, inside: np.ndarray | None = None) -> Words:
    """Maximal runs of bytes for which ``inside`` holds (default: no ASCII white space), within rows."""
    if lower:
        data = LOWER[data]
    kept = (~SPACE if inside is None else inside)[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = kept[1:] != kept[:-1]
    edge |= begins
    at = np.flatnonzero(edge)  # every change of kind and every start of a row, and the end
    starts, ends = at[:-1], at[1:]
    is_word = kept[starts] if len(starts) else np.zeros(0, bool)
    starts, ends = starts[is_word], ends[is_word]
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def shingle_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on; the last n - 1 of the run have none."""
    if len(word_hashes) < n:
        return np.zeros(0, _U64)
    out = word_hashes[: len(word_hashes) - n + 1].copy()
    for k in range(1, n):
        out = mixed(out * _U64(_BASE) + word_hashes[k : len(word_hashes) - n + 1 + k])
    return out


class HashSet:
    """Places of hashes in a sorted array of keys; a bit table skips most of those that are not in it."""

    BITS = 20

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        self.table = np.zeros(1 << self.BITS, bool)
        self.table[self._slot(keys)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & _U64((1 << self.BITS) - 1)).astype(np.int64)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash in ``keys``, -1 if it is none of them."""
        out = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.table[self._slot(hashes)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
            hit = self.keys[at] == hashes[maybe]
            out[maybe[hit]] = at[hit]
        return out

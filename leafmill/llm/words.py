"""Words of whole texts and rolling hashes over them, vectorised per Arrow batch.

A word is a maximal run of characters other than space and \\x09-\\x0D. All of these are single bytes in
UTF-8, so the batch is cut on its byte buffer. Hashes are polynomials modulo 2^64 over the bytes of a word, or over
the hashes of consecutive words, finished by a bijective mixer; two seeds give 128 independent bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_LENGTH = np.uint64(0xA0761D6478BD642F)
_STRETCH = 1 << 17
_powers: dict[tuple[int, bool], np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, seed: int, inverse: bool = False) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, or those of the inverse."""
    have = _powers.get((seed, inverse))
    if have is None or len(have) < n:
        base = int(_BASES[seed])
        steps = np.full(max(n, _STRETCH + 1), pow(base, -1, 1 << 64) if inverse else base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        _powers[seed, inverse] = have
    return have[:n]


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int, plus: int = 0) -> np.ndarray:
    """Hash of values[start:end] + plus for each span; equal contents give equal hashes wherever they lie.

    Starts and ends must not decrease; the spans are worked off in short stretches that stay in the CPU's cache.
    """
    out, lo = np.empty(len(starts), np.uint64), 0
    while lo < len(starts):
        base = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, base + _STRETCH, "right")))
        part = values[base : ends[hi - 1]].astype(np.uint64) + np.uint64(plus)
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * powers(len(part), seed), out=total[1:])
        a, b = starts[lo:hi] - base, ends[lo:hi] - base
        out[lo:hi] = (total[b] - total[a]) * powers(len(part) + 1, seed, True)[a] + (b - a).astype(np.uint64) * _LENGTH
        lo = hi
    return mix(out)


def gathered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about that many bytes: long enough for vectors, bounded in memory."""
    held, have = [], 0
    for whole in batches:
        step = max(1, whole.num_rows * size // max(whole.nbytes, 1))
        for batch in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
            held.append(batch)
            have += batch.nbytes
            if have >= size:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, have = [], 0
    for batch in pa.Table.from_batches(held).combine_chunks().to_batches() if held else ():
        yield batch


@dataclass
class Words:
    """The words of a batch of texts: byte spans in data, and for text i the words first[i] to first[i + 1]."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, seed, plus=1)

    def windows(self, length: int) -> np.ndarray:
        """Index of the first word of every run of that many words within one text."""
        last = np.repeat(self.first[1:], self.counts)
        at = np.arange(len(self.starts))
        return at[at + length <= last]


def split(texts: pa.Array | pa.ChunkedArray, lower: bool = False) -> Words:
    """Words of each text (null: none); lower folds A-Z only."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    word = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[0] = True
    edge[offsets] = True
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))

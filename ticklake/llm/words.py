"""Vectorised words of whole Arrow batches (shared by the operators on words).

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]``.  All texts of
a batch are handled as one byte buffer with NumPy: no per-word Python.  A
word's 64-bit hash is a polynomial over a random byte table (its multiplier is
odd, so a word's sum can be shifted to position 0 exactly), mixed afterwards;
hashes of word runs are sums over the mixed word hashes in the same way.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_rng = np.random.Generator(np.random.PCG64(20240117))
_TABLE = _rng.integers(1, 2**63 - 1, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_BYTE_MULT = 0x9E3779B97F4A7C15
_RUN_MULT = 0xD6E8FEB86659FD93
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(mult: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """mult**i and mult**-i modulo 2**64 for i < n (kept for the worker's life, grown by doubling)."""
    have = _POWERS.get(mult)
    if have is None or len(have[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        out = []
        for base in (mult, pow(mult, -1, 1 << 64)):
            p = np.ones(size, dtype=np.uint64)
            p[1:] = np.uint64(base)
            out.append(np.multiply.accumulate(p))
        have = _POWERS[mult] = (out[0], out[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finisher of 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_buffer(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets of length n + 1) of an Arrow string array; a null text is empty."""
    arr = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], pa.large_string())
    arr = arr.cast(pa.large_string())
    if arr.null_count:
        arr = arr.fill_null("")
    buffers = arr.buffers()
    off = np.frombuffer(buffers[1], dtype=np.int64, count=len(arr) + 1 + arr.offset)[arr.offset:] if len(arr) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


class Words:
    """Words of a batch of texts.

    ``start``/``end``: byte range of every word in ``data``; ``first``: index
    of each text's first word (length n_texts + 1).
    """

    def __init__(self, texts):
        self.data, self.off = text_buffer(texts)
        n = len(self.data)
        # a text's border splits words too: look at each byte's predecessor
        is_word = ~_SPACE[self.data]
        begin = is_word.copy()
        if n:
            begin[1:] &= ~is_word[:-1]
        inner = self.off[:-1][(self.off[:-1] < n)]
        begin[inner] = is_word[inner]
        finish = is_word.copy()
        if n:
            finish[:-1] &= ~is_word[1:]
        last = self.off[1:][self.off[1:] > 0] - 1
        finish[last] = is_word[last]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.start, self.off)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Index of the text that holds each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of every word; ``lower`` treats A-Z as a-z."""
        return span_hashes(self.data, self.start, self.end, lower)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of every byte range [start, end) of ``data``.

    The prefix sums run over blocks of a few MB, so temporary arrays stay
    small; a range longer than a block is summed on its own.
    """
    table = _LOWER if lower else _TABLE
    out = np.empty(len(start), dtype=np.uint64)
    lo, block = 0, 1 << 21
    while lo < len(start):
        base = start[lo]
        hi = max(lo + 1, int(np.searchsorted(end, base + block, "right")))
        part = data[base:end[hi - 1]]
        up, down = _powers(_BYTE_MULT, len(part) + 1)
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(table[part] * up[:len(part)], out=sums[1:])
        s = start[lo:hi] - base
        out[lo:hi] = (sums[end[lo:hi] - base] - sums[s]) * down[s]
        lo = hi
    return mix(out + (end - start).astype(np.uint64))


class Runs:
    """Hashes of runs of consecutive word hashes: ``run(i, n)`` covers words i .. i + n - 1."""

    def __init__(self, hashes: np.ndarray):
        up, self.down = _powers(_RUN_MULT, len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * up[:len(hashes)], out=self.sums[1:])

    def run(self, i, n) -> np.ndarray:
        return mix((self.sums[i + n] - self.sums[i]) * self.down[i] + np.asarray(n).astype(np.uint64))

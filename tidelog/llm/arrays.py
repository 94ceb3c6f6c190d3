"""Words of Arrow text columns as numpy arrays: boundaries, 64-bit hashes and rolling window hashes.

A batch is cut into slices of whole texts of about SLICE bytes, so that scratch memory does not follow the
batch size. Hashes are polynomials modulo 2^64 over a fixed random byte table, finished by a bit mixer.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
#: Multiplier (odd) and its inverse modulo 2^64.
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: ASCII that is neither letter nor digit: for words without punctuation.
PUNCT = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], np.uint8)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=np.uint64)


class _Powers:
    """Powers of BASE and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = _powers(BASE, 0)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = _powers(BASE, size), _powers(BASE_INV, size)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finisher of 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(texts: pa.Array | pa.ChunkedArray, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, offsets) of runs of texts; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    flat = pc.fill_null(texts.cast(pa.large_string()), "").cast(pa.large_binary())
    if not len(flat):
        return
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1]
    data = np.frombuffer(flat.buffers()[2], np.uint8) if flat.buffers()[2] is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(flat):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, text index) of maximal runs of true within each text."""
    n = len(inside)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    begins = np.zeros(n + 1, bool)
    begins[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | begins[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | begins[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def hash_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each data[start:end]; starts and ends ascend."""
    out = np.empty(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        lo = int(starts[a])
        b = max(a + 1, int(np.searchsorted(ends, lo + SLICE, "right")))
        hi = int(ends[b - 1])
        up, down = _POWERS(hi - lo + 1)
        sums = np.empty(hi - lo + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_TABLE[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        s, e = starts[a:b] - lo, ends[a:b] - lo
        out[a:b] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        a = b
    return mix(out)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Rabin-Karp hashes of each k neighbouring words; the window at i starts at word i."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _POWERS(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(hashes * up[:n], out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[: n - k + 1])


def whole(doc: np.ndarray, k: int) -> np.ndarray:
    """For each window of k words: true where it lies in one text. doc: each word's text."""
    return doc[k - 1 :] == doc[: len(doc) - k + 1] if len(doc) >= k else np.zeros(0, bool)


def give_back() -> None:
    """Hands memory that this process has freed back to the system, so that a worker between tasks holds little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library; others need no such call
    if trim is not None:
        trim(0)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

"""Words of a batch of texts as 64-bit hashes, by whole-array arithmetic.

A batch of UTF-8 texts is one byte buffer.  A 256-entry byte table lower-cases
A-Z and maps separators to space; word bounds and a polynomial hash of every
word then follow from array operations, with no Python object for each word.
Working memory is about 40 bytes for each byte of text, so callers cut batches
with :func:`slices`.

Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

SLICE_BYTES = 1 << 20
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_ROW = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers = {"n": 0}


def byte_table(separators: set[int]) -> bytes:
    """A-Z to a-z, ``separators`` (byte values below 128) to space."""
    return bytes(32 if b in separators else b + 32 if 65 <= b <= 90 else b for b in range(256))


SPACE_TABLE = byte_table({32, *range(9, 14)})
ALNUM_TABLE = byte_table({b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122)})


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, SLICE_BYTES + 1)
        for name, base in (("up", _P), ("down", _P_INV)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            _powers[name] = np.multiply.accumulate(x)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (new array)."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text (one row at least) and 20,000 rows."""
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0)).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        base = ends[at] - sizes[at]
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        to = min(to, at + 20_000)
        yield at, to
        at = to


class Words:
    """Words of some texts.

    ``start``/``end``: byte bounds in ``data`` (lower-cased); ``doc``: row of
    each word; ``first``: index of each row's first word (one more entry at the
    end); ``hash``: 64-bit hash of each word.  ``blank``: which further bytes of
    the buffer separate words.
    """

    def __init__(self, texts: pa.Array, table: bytes, blank: Callable[[np.ndarray], np.ndarray] | None = None):
        texts = pa.compute.fill_null(texts.cast(pa.large_string()), "")
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
        lo, hi = int(offsets[0]), int(offsets[-1])
        self.data = (data[lo:hi].to_pybytes() if data is not None else b"").translate(table)
        self.offsets = offsets - lo
        raw = np.frombuffer(self.data, np.uint8)
        if blank is not None:
            raw = np.where(blank(raw), np.uint8(32), raw)
            self.data = raw.tobytes()
        n = len(raw)
        solid = raw != 32
        begin, stop = solid.copy(), solid.copy()
        begin[1:] &= ~solid[:-1]
        stop[:-1] &= ~solid[1:]
        edge = self.offsets[1:-1]
        edge = edge[(edge > 0) & (edge < n)]
        begin[edge] = solid[edge]
        stop[edge - 1] = solid[edge - 1]
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(stop) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.first)
        up, down = _power_tables(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_ROW[raw] * up[:n], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * down[self.start]
                        + (self.end - self.start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]]


def run_sums(words: Words, value: np.ndarray, n: int) -> np.ndarray:
    """Sum of a value of each word over the runs of ``ngram_hashes(words, n, short=True)``, in its order."""
    sums = np.concatenate([[0], np.cumsum(value)])
    m = max(0, len(value) - n + 1)
    doc = words.doc
    whole = (sums[n:] - sums[:m])[doc[:m] == doc[n - 1:]] if m else np.zeros(0)
    few = np.flatnonzero((words.count > 0) & (words.count < n)) if n > 1 else np.zeros(0, np.int64)
    return np.concatenate([whole, sums[words.first[few + 1]] - sums[words.first[few]]])


def ngram_hashes(words: Words, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``n`` words inside a row.

    ``short``: a row of fewer words, but not none, gives its whole sequence,
    marked with its length (never equal to a run of ``n``).
    """
    h, doc = words.hash, words.doc
    if n == 1:
        return h.copy(), doc
    m = len(h) - n + 1
    if m > 0:
        acc = h[:m].copy()
        for k in range(1, n):
            acc *= _P
            acc += h[k:m + k]
        keep = doc[:m] == doc[n - 1:]
        out, rows = mix(acc[keep]), doc[:m][keep]
    else:
        out, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if short:
        few = np.flatnonzero((words.count > 0) & (words.count < n))
        if len(few):
            extra = np.empty(len(few), np.uint64)
            for i, r in enumerate(few):
                acc = words.count[r:r + 1].astype(np.uint64) * np.uint64(0x165667B19E3779F9)
                for x in h[words.first[r]:words.first[r + 1]]:
                    acc = acc * _P + x
                extra[i] = mix(acc)[0]
            out, rows = np.concatenate([out, extra]), np.concatenate([rows, few])
    return out, rows


def distinct_per_row(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (hash, row), ordered by row then hash."""
    if not len(hashes):
        return hashes, rows
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[keep], r[keep]


def distinct_words(words: Words, which: np.ndarray) -> pa.Array:
    """The words numbered ``which`` as strings, cut out of the buffer by whole-array arithmetic."""
    sizes = (words.end - words.start)[which]
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(words.start[which] - (ends - sizes), sizes)
    data = np.frombuffer(words.data, np.uint8)[at]
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(which), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))

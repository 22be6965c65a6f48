"""Byte-level text helpers on numpy: whole Arrow string columns at once, no Python object per token."""

import sys

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value

#: ASCII white space (space, tab, newline, return, form feed, vertical tab).
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes that are neither ASCII letters, digits nor part of a multi-byte character.
PUNCT = np.ones(256, bool)
PUNCT[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
#: ASCII lower case; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, element by element."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0..n-1 modulo 2 ** 64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    k = 1
    while k < n:
        m = min(k, n - k)
        np.multiply(out[:m], np.uint64(pow(base, k, 1 << 64)), out=out[k : k + m])
        k += m
    return out[:n]


def utf8(col) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its rows' offsets into them; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    n, at = len(col), col.offset
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64)[at : at + n + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


def pieces(batch: pa.RecordBatch, text: str, most: int = 4 << 20):
    """Slices of a batch of about ``most`` bytes of text; a row is never cut, so a longer one comes alone."""
    i = batch.schema.get_field_index(text)
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to


def spans(data: np.ndarray, offs: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each token (a run of bytes not in ``gap``, ended by its row's end), and the tokens' number before each row."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    solid = ~gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1] | edge[1:-1]
    end[:-1] &= ~solid[1:] | edge[1:-1]
    s = np.flatnonzero(start)
    return s, np.flatnonzero(end) + 1, np.searchsorted(s, offs)


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: polynomial modulo 2 ** 64 through prefix sums, then mixed."""
    if not len(s):
        return np.zeros(0, np.uint64)
    n = len(data)
    acc = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_INV, n), out=acc[1:])
    up = powers(_BASE, n)
    return mix((acc[e] - acc[s]) * up[s] + (e - s).astype(np.uint64))


register_pickle_by_value(sys.modules[__name__])

"""Vectorised helpers over UTF-8 buffers: words, polynomial hashes, windows.

All hashes are polynomials modulo 2**64 with an odd base, so the inverse of the
base exists and ``(P[j] - P[i]) * base**-i`` is the hash of ``[i, j)`` wherever
it stands. They only pick candidates; equality is settled on strong digests or
on the bytes themselves.
"""

from __future__ import annotations

import ctypes
import sys

import numpy as np
import pyarrow as pa


def _c_library():
    """The C library if it can give memory back, else None."""
    try:
        library = ctypes.CDLL("libc.so.6") if sys.platform == "linux" else None
    except OSError:
        return None
    return library if hasattr(library, "malloc_trim") else None


_libc = _c_library()

#: Word separators: space and \t \n \v \f \r.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Elements hashed at a time; bounds the temporary arrays.
SEGMENT = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits (in place)."""
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: A random-looking value for each byte, from its number.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))

_cache: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64; kept up to a segment's length."""
    have = _cache.get(base)
    if have is None or len(have) <= n:
        have = np.full(max(n, SEGMENT + 256) + 1, base, dtype=np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if len(have) <= 4 * SEGMENT:
            _cache[base] = have
    return have


def _prefix(values: np.ndarray) -> np.ndarray:
    out = np.empty(len(values) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(values * _powers(_BASE, len(values))[: len(values)], out=out[1:])
    return out


class PrefixHashes:
    """Hash of any substring of ``data`` in constant time."""

    def __init__(self, data: np.ndarray):
        self.prefix = _prefix(BYTE_VALUES[data])
        self.inverse = _powers(_INVERSE, len(data))

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]


def rolling(values: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` values, by prefix sums over bounded segments."""
    total = max(0, len(values) - n + 1)
    out = np.empty(total, dtype=np.uint64)
    for a in range(0, total, SEGMENT):
        b = min(total, a + SEGMENT)
        prefix = _prefix(values[a : b + n - 1])
        out[a:b] = (prefix[n:] - prefix[: b - a]) * _powers(_INVERSE, b - a)[: b - a]
    return mix(out)


def give_back() -> None:
    """Return memory that was freed to the system; Python workers live on over many tasks and stages."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other and their bounds (n + 1); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def fresh(columns: list[str], name: str) -> str:
    """A column name that none of ``columns`` has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def slices(bounds: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Cut texts into runs [a, b) of about ``most`` bytes, at least one text each."""
    out, a, n = [], 0, len(bounds) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + most, "right")) - 1)
        out.append((a, min(b, n)))
        a = out[-1][1]
    return out


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte and text number of every word; words never cross texts."""
    n = len(data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    inside = ~SPACE[data]
    first = np.empty(n, dtype=bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    edge = bounds[(bounds > 0) & (bounds < n)]
    first[edge] = True
    starts = np.flatnonzero(first & inside)
    last = np.empty(n, dtype=bool)
    last[-1] = True
    np.logical_not(inside[1:], out=last[:-1])
    last[edge - 1] = True
    ends = np.flatnonzero(last & inside) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    out = np.empty(len(starts), dtype=np.uint64)
    a = 0
    while a < len(starts):
        low = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, low + SEGMENT, "right")))
        prefix = _prefix(BYTE_VALUES[data[low : ends[b - 1]]])
        s, e = starts[a:b] - low, ends[a:b] - low
        out[a:b] = (prefix[e] - prefix[s]) * _powers(_INVERSE, int(s[-1]))[s] + (e - s).astype(np.uint64)
        a = b
    return mix(out)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; all other bytes as they are."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words joined by one space, and where each begins in the result."""
    if not len(starts):
        return b"", np.zeros(0, np.int64)
    lengths = ends - starts
    at = np.concatenate(([0], np.cumsum(lengths + 1)))
    out = np.full(int(at[-1]) - 1, 32, dtype=np.uint8)
    keep = np.ones(len(out), dtype=bool)
    keep[at[1:-1] - 1] = False
    inside = np.zeros(len(data) + 1, dtype=np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    out[keep] = data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    return out.tobytes(), at[:-1]


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` places lie in a run of ``length`` from one of ``starts``."""
    mark = np.zeros(n + 1, dtype=bool)
    mark[starts] = True
    at = np.flatnonzero(mark)
    apart = np.diff(at) > length
    step = np.zeros(n + 1, dtype=np.int8)
    if len(at):
        step[at[np.append(True, apart)]] = 1
        step[np.minimum(at[np.append(apart, True)] + length, n)] -= 1
    return np.cumsum(step[:-1], dtype=np.int8).view(bool)

"""Words of a block and hashes of them, by arithmetic on whole arrays of bytes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(size: int, base: int = _BASE) -> np.ndarray:
    """Powers of an odd number modulo 2^64; sizes are rounded up so that few arrays are kept."""
    return _powers(base, 1 << max(16, (size + 1).bit_length()))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words ``data[start:end]``, equal for equal bytes wherever they are.

    Prefix sums of a polynomial are taken over about ``CHUNK`` bytes at a time.
    """
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + CHUNK, "right")))
        base = starts[first]
        part = data[base:ends[last - 1]]
        prefix = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(len(part))[:len(part)], out=prefix[1:])
        a, b = starts[first:last] - base, ends[first:last] - base
        back = powers(len(part), pow(_BASE, -1, 1 << 64))
        out[first:last] = mix((prefix[b] - prefix[a]) * back[a] + (b - a).astype(np.uint64))
        first = last
    return out


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """The hash of the ``size`` bytes from each place of ``data``, as ``hashes`` has it."""
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data))[:len(data)], out=prefix[1:])
    wide = prefix[size:] - prefix[:-size]
    return mix(wide * powers(len(data), pow(_BASE, -1, 1 << 64))[:len(wide)] + np.uint64(size))


def split(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in a row with a blank after each; start, end and document of every word."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = _SPACE[data]
    edges = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edges[::2], edges[1::2]
    firsts = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])]) if texts else np.empty(0, np.int64)
    return data, starts, ends, np.searchsorted(firsts, starts, "right") - 1


def runs(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Starts of the runs of bytes that are ``inside``, and the runs themselves."""
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    return starts, pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])

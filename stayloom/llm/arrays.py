"""Texts of an Arrow batch as numpy arrays: words, rolling hashes, window minima, repeated stretches.

All hashes are 64-bit polynomials over random values (wrapping arithmetic, odd base), finished with
a bit mixer.  They are functions of content alone, so equal content hashes alike in every task.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK = 1 << 18  # bytes of text worked on at once, each some 150 bytes of arrays; a longer single text makes its own block

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_random = np.random.Generator(np.random.PCG64(20240229))
BYTES = _random.integers(1, 1 << 63, size=(2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
SEED = np.uint64(0xD1B54A32D192ED03)

#: Bytes outside words: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
INSIDE = ~SPACE

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def release() -> None:
    """Give back to the system what earlier tasks of this worker have freed; workers are used again by other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 2 * len(_powers[0]), BLOCK + 2), base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial; `spans` takes the hash of any stretch from them."""
    up, _ = powers(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return total


def spans(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end), lengths included."""
    _, down = powers(len(total))
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * SEED)


def windows(values: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all stretches of `length` values, by start."""
    if len(values) < length:
        return np.zeros(0, np.uint64)
    total = sums(values)
    _, down = powers(len(total))
    return mix((total[length:] - total[:-length]) * down[: len(total) - length])


def lowest(keys: np.ndarray, length: int) -> np.ndarray:
    """Minimum of every `length` consecutive keys."""
    span = 1
    while 2 * span <= length:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    rest = length - span
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def blocks(texts: pa.Array, limit: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts of about `limit` bytes: first row, bytes, offsets of the rows. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    kind = pa.binary() if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else pa.string()
    texts = pc.fill_null(texts, b"" if kind == pa.binary() else "").cast(
        pa.large_binary() if kind == pa.binary() else pa.large_string()
    )
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = INSIDE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and how many words lie before each row's end (with 0 first)."""
    marked = inside[data]
    begins, ends = marked.copy(), marked.copy()
    begins[1:] &= ~marked[:-1]
    ends[:-1] &= ~marked[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = marked[edges]
    ends[edges - 1] = marked[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets, "left")


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    return spans(sums(BYTES[seed][data]), start, end)


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each value, from the rows' bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


_AT = np.uint64((1 << 30) - 1)


def stretches(values: np.ndarray, bounds: np.ndarray, length: int, gram: int) -> dict[str, np.ndarray]:
    """Every window of `length` values belongs to one anchor: the gram in it with the least hash, the first of equals.

    Equal windows choose the same anchor, so a window can only be repeated where its anchor's hash
    is.  Consecutive windows of one anchor make a stretch.  Returns for each stretch its row, the
    anchor's place and hash, and the first and last window start; places count from the row's start.
    """
    names = ("row", "at", "lo", "hi", "anchor")
    if len(values) < length:
        return {k: np.zeros(0, np.uint64 if k == "anchor" else np.int64) for k in names}
    hashes = windows(values, gram)
    keys = hashes & ~_AT
    keys |= np.arange(len(keys), dtype=np.uint64)
    place = (lowest(keys, length - gram + 1) & _AT).astype(np.int64)
    del keys
    inside = np.ones(len(place), bool)
    for edge in bounds[1:-1]:  # windows over the edge of two rows
        inside[max(0, edge - length + 1) : edge] = False
    start = np.flatnonzero(inside)
    chosen = place[start]
    fresh = np.ones(len(start), bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | (start[1:] != start[:-1] + 1)
    lo = start[fresh]
    hi = start[np.append(np.flatnonzero(fresh)[1:], len(start)) - 1] if len(start) else lo
    at = place[lo]
    row = np.searchsorted(bounds, lo, "right") - 1
    base = bounds[row]
    return {"row": row, "at": at - base, "lo": lo - base, "hi": hi - base, "anchor": hashes[at]}


def lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list column from the number of values of each row and the values of all rows in order."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


def ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """All places of the ranges [start, end), one range after the other."""
    many = end - start
    return np.arange(many.sum()) + np.repeat(start - np.cumsum(many) + many, many)

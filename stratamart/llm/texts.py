"""Texts of an Arrow column as numpy arrays: bytes, words, hashes of words and word runs.

Columns are worked on in slices of a few megabytes, so that the arrays (8 bytes and more for
each byte of text) stay small however many rows a batch has. A slice holds whole texts, so a
single text is the lower bound of its size. Null counts as an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21

# White space between words, and the ASCII bytes that belong to plain words.
WHITE_SPACE = b" \t\n\v\f\r"
PLAIN_ASCII = b"0123456789abcdefghijklmnopqrstuvwxyz"

NOT_SPACE = np.array([byte not in WHITE_SPACE for byte in range(256)])
PLAIN_WORD = np.array([byte >= 128 or byte in PLAIN_ASCII for byte in range(256)])
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)

_FACTOR = 0x9E3779B97F4A7C15


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit (splitmix64)."""
    out = values ^ (values >> np.uint64(30))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


def numbered(start: int, count: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers, from a rule."""
    with np.errstate(over="ignore"):
        return mix((np.arange(count, dtype=np.uint64) + np.uint64(start)) * np.uint64(_FACTOR))


BYTE_VALUES = numbered(1, 256)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_table(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2**64 and of its inverse."""
    if len(_powers["up"]) < size:
        base = int(numbered(1000, 1)[0]) | 1
        for name, factor in (("up", base), ("down", pow(base, -1, 1 << 64))):
            factors = np.full(size + size // 4, factor, np.uint64)
            factors[0] = 1
            _powers[name] = np.cumprod(factors)
    return _powers["up"], _powers["down"]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins; the last entry is the end."""
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    _, offsets, data = texts.buffers()
    if len(texts) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def sliced(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, row after the last, bytes and text offsets of one slice after another."""
    data, offsets = utf8(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and how many words come before each text.

    ``inside`` tells for each byte value whether it belongs to words.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    mask = inside[data]
    begins, ends = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1]
    ends[:-1] &= ~mask[1:]
    # A word cannot run on from one text into the next.
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    begins[edges] = mask[edges]
    ends[edges - 1] = mask[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes give equal hashes."""
    up, down = _power_table(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    found = (sums[ends] - sums[starts]) * down[starts]
    found += (ends - starts).astype(np.uint64) * np.uint64(_FACTOR)
    return mix(found)


def run_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` consecutive values, text borders ignored."""
    count = max(len(values) - length + 1, 0)
    out = values[:count].copy()
    for step in range(1, length):
        out *= np.uint64(_FACTOR)
        out += values[step : step + count]
    out += np.uint64(length)
    return mix(out)


def run_starts(first: np.ndarray, length: int) -> np.ndarray:
    """Which positions begin a run of ``length`` values inside one text.

    ``first`` says how many values come before each text.
    """
    counts = np.maximum(np.diff(first) - length + 1, 0)
    return ranges(first[:-1], counts)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``start, start + 1, ...`` for each start, one after another."""
    total = int(counts.sum())
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(total)


def run_values(values: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all runs of ``length`` values, by doubling; cheaper than ``run_hashes`` for long runs.

    High bits depend on every value, low ones less so.
    """
    count = max(len(values) - length + 1, 0)
    out, reach, power = values, 1, _FACTOR
    while reach < length:
        step = min(reach, length - reach)
        size = len(out) - step
        if size <= 0:
            return np.zeros(0, np.uint64)
        # A run of ``reach`` values and the same run ``step`` further on; the overlap, which
        # only the last step has, is part of both.
        shifted = out[step : step + size]
        out = out[:size] * np.uint64(power)
        out += shifted
        power = power * power % (1 << 64)
        reach += step
    return out[:count]


def token_run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the values of each run; equal runs give equal hashes."""
    up, down = _power_table(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(_FACTOR))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the position of its leftmost smallest one.

    Values are compared by their high bits, as many as the positions leave free.
    """
    count = len(values) - width + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    bits = np.uint64(max(len(values).bit_length(), 1))
    best = values >> bits
    best <<= bits
    best |= np.arange(len(values), dtype=np.uint64)
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        best = np.minimum(best[:-step], best[step:])
        reach += step
    best &= (np.uint64(1) << bits) - np.uint64(1)
    return best[:count].view(np.int64)

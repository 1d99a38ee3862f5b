"""Vectorised word and line hashes over blocks of texts.

A block is the UTF-8 bytes of some texts end to end. All hashes are 64-bit multilinear hashes over random tables with a
final mix; equal byte strings have equal hashes on every worker.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; bounds a worker's memory. A longer text is worked on by itself.
BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(0x7E55E2A)
_odd = lambda n: _rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: For each of two independent hashes: a value per byte, a factor per step, factors for windows.
BYTE = [_odd(256), _odd(256)]
_STEP = [_odd(1)[0], _odd(1)[0]]
WINDOW = [_odd(64), _odd(64)]

IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int, which: int = 0) -> np.ndarray:
    """The first n powers of a hash's step factor."""
    have = _powers[which]
    while len(have) < n:
        up = np.uint64(pow(int(_STEP[which]), len(have), 2**64))
        have = _powers[which] = np.concatenate([have, have * up])
    return have[:n]


def text_blocks(batches: Iterator[pa.RecordBatch], text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the bytes of their texts and the offsets of each; null texts count as empty.

    Free memory goes back to the system at the end: a worker waits for other tasks then, beside those that work."""
    for batch in batches:
        col = pc.fill_null(batch.column(batch.schema.get_field_index(text_col)), "")
        big = pa.types.is_large_string(col.type)
        off = np.frombuffer(col.buffers()[1], np.int64 if big else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
        data = np.frombuffer(col.buffers()[2], np.uint8) if len(col) and col.buffers()[2] is not None else np.empty(0, np.uint8)
        at = 0
        while at < len(col):
            to = max(at + 1, int(np.searchsorted(off, off[at] + block_bytes, "right")) - 1)
            yield batch.slice(at, to - at), data[off[at] : off[to]], off[at : to + 1] - off[at]
            at = to
    batch = col = data = off = None
    give_back()


def give_back() -> None:
    """Returns what the C library holds of freed memory to the system, where it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def spans(mask: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of set bytes, cut at the texts' ends."""
    if not len(mask):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    edge = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(mask))]
    first[edge] = mask[edge]
    last[edge - 1] = mask[edge - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A hash of the bytes of each span; spans are in order and don't overlap. Empty spans hash to that of no bytes."""
    size = ends - starts
    out = np.zeros(len(starts), np.uint64)
    full = size > 0
    if full.any():
        n = size[full]
        first = np.cumsum(n) - n
        rel = np.arange(int(n.sum())) - np.repeat(first, n)
        at = rel + np.repeat(starts[full], n)
        out[full] = np.add.reduceat(BYTE[which][data[at]] * powers(int(n.max()), which)[rel], first)
    return mix(out + size.astype(np.uint64) * WINDOW[which][63])


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and the number of the first word of each text (and their count)."""
    starts, ends = spans(IS_WORD[data], off)
    return starts, ends, np.searchsorted(starts, off)


def windows(hashes: np.ndarray, first: np.ndarray, width: int, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each window of `width` words within one text, and the number of its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(width):
        total += hashes[k : k + n] * WINDOW[which][k]
    left = np.repeat(first[1:], np.diff(first))[:n] - np.arange(n)
    at = np.flatnonzero(left >= width)
    return mix(total[at]), at


def text_of(first: np.ndarray) -> np.ndarray:
    """For each word the number of its text."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All indexes of the ranges that begin at starts and have these sizes, one range after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)

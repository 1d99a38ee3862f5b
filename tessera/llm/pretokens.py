"""The pretoken pattern of byte-level BPE, worked out on arrays of code points.

Fixed pattern: 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
Whether a code point begins a match depends on its class, its neighbours' and the contractions, so all matches of a
block are found at once.
"""

from __future__ import annotations

import unicodedata

import numpy as np

from .textblock import hash_spans, mix

OTHER, LETTER, NUMBER, WHITE, EDGE, SPACE = range(6)


_UNKNOWN = 255
_classes = np.full(0x110000, _UNKNOWN, np.uint8)
_classes[[*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = WHITE
_classes[0x20] = SPACE


def classes(cp: np.ndarray) -> np.ndarray:
    """The class of each code point; those not met before are looked up."""
    out = _classes[cp]
    fresh = np.unique(cp[out == _UNKNOWN])
    if len(fresh):
        kinds = {"L": LETTER, "N": NUMBER}
        _classes[fresh] = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in fresh.tolist()]
        out = _classes[cp]
    return out


def pretokens(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the pretokens of a block of texts, and the number of the first one of each text."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(off), np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    c = classes(cp)
    edge = np.searchsorted(at, off[:-1][np.diff(off) > 0])  # the first code point of each text that has any
    before, after = np.empty_like(c), np.empty_like(c)
    before[1:], after[:-1], after[-1] = c[:-1], c[1:], EDGE
    before[edge] = EDGE
    after[edge[1:] - 1] = EDGE
    white = c >= WHITE
    start = np.where(white, (before < WHITE) | (before == EDGE) | (after < WHITE), (before != c) & (before != SPACE))
    quote = np.flatnonzero((cp == 0x27) & start & (after == LETTER))
    if len(quote):
        pad = np.concatenate([cp, np.zeros(3, np.uint32)])
        one = np.isin(pad[quote + 1], [ord(x) for x in "stmd"])
        two = np.zeros(len(quote), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (pad[quote + 1] == ord(a)) & (pad[quote + 2] == ord(b))
        two &= after[np.minimum(quote + 1, len(cp) - 1)] == LETTER
        for hit, n in ((quote[one], 2), (quote[two & ~one], 3)):
            for k in range(1, n):
                start[hit + k] = False
            go = hit[after[hit + n - 1] == LETTER] + n
            start[go] = True
    starts = at[start]
    return starts, np.append(starts[1:], len(data)), np.searchsorted(starts, off)


_ENDS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One index of each distinct span, and for each span the number of its representative.

    A span of 16 bytes or fewer is its first and last eight bytes and its length; longer ones have two hashes of all."""
    size = ends - starts
    cells = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))
    one = cells[starts] & _ENDS[np.minimum(size, 8)]
    two = np.where(size > 8, cells[np.maximum(ends - 8, 0)], np.uint64(0))
    long = np.flatnonzero(size > 16)
    if len(long):
        one[long], two[long] = (hash_spans(data, starts[long], ends[long], w) for w in (0, 1))
    key = mix(mix(one) + mix(two ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(3) + size.astype(np.uint64))
    _, rep, which = np.unique(key, return_index=True, return_inverse=True)
    other = rep[which]
    if not (np.array_equal(one, one[other]) and np.array_equal(two, two[other]) and np.array_equal(size, size[other])):  # two spans of one key
        _, rep, which = np.unique(np.stack([one, two, size.astype(np.uint64)], 1), axis=0, return_index=True, return_inverse=True)
    return rep, which.reshape(-1)

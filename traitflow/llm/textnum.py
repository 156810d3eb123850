"""Vectorised hashing of texts inside tasks (numpy on concatenated UTF-8 bytes)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_RNG = np.random.Generator(np.random.PCG64(20240607))   # fixed: hashes must agree between tasks and runs
BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
STEPS = [int(x) | 1 for x in _RNG.integers(1, 1 << 62, 16)]

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LOWER_TABLE = _LOWER.tobytes()
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True     # white space of the word rule


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective finaliser (64-bit)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


_POWERS = {"fwd": np.ones(1, dtype=np.uint64), "inv": np.ones(1, dtype=np.uint64)}
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64 for i < n at least."""
    if len(_POWERS["fwd"]) < n:
        for k, b in (("fwd", BASE), ("inv", _INVERSE)):
            full = np.full(max(n, 1 << 16), b, dtype=np.uint64)
            full[0] = 1
            _POWERS[k] = np.multiply.accumulate(full)
    return _POWERS["fwd"], _POWERS["inv"]


def concatenated(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array, one after another, and the offsets of its rows (null: empty)."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def blocks(texts: pa.Array, limit: int):
    """Ranges [i, j) of rows with about ``limit`` bytes together (a longer text is a block of its own)."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    i = 0
    ends = np.cumsum(lengths)
    while i < len(lengths):
        start = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, start + limit, side="right")))
        yield i, j
        i = j


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length (bytes) of the words of all rows. A word never spans two rows."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _SPACE[raw]
    begin = ~space
    begin[1:] &= space[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]      # a row starts a word whatever stands before
    begin[first] = ~space[first]
    end = ~space
    end[:-1] &= space[1:]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[last] = ~space[last]
    s = np.flatnonzero(begin)
    return s, np.flatnonzero(end) + 1 - s


_TAIL = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ (A-Z as a-z) of all rows in order, and the number of words
    of each row. Eight bytes of every word are mixed into its hash at a time, so no sum of byte values (of which
    long words can be made equal on purpose) decides."""
    s, length = word_spans(raw, offsets)
    counts = np.searchsorted(s, offsets[1:]) - np.searchsorted(s, offsets[:-1])
    h = mix(length.astype(np.uint64) * BASE)
    if len(s):
        eights = np.lib.stride_tricks.sliding_window_view(np.concatenate([_LOWER[raw], np.zeros(8, np.uint8)]), 8)
        live, at, left = np.arange(len(s)), s, length
        while len(live):
            lane = eights[at].view("<u8").ravel() & _TAIL[np.minimum(left, 8)]
            h[live] = mix(h[live] ^ lane)
            more = np.flatnonzero(left > 8)
            live, at, left = live[more], at[more] + 8, left[more] - 8
    return h, counts


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive entries of ``h``."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for j in range(n):
        out = out * np.uint64(STEPS[n]) + h[j:j + m]
        out ^= out >> np.uint64(29)
    return mix(out)

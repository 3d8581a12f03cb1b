"""Hashes of five-word shingles, computed for whole Arrow batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORDS = 5
PORTION_BYTES = 1_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        for name, factor in (("up", _STEP), ("down", _BACK)):
            steps = np.full(n, factor, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def portions(texts: pa.StringArray, limit: int = PORTION_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text each, or of one row, so that memory follows the longest text."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)))
    start = 0
    while start < len(sizes):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield start, stop
        start = stop


def shingles(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts, sorted within each text, and where each text's part ends.

    Words are runs of anything but ASCII white space. A text of one to four words has one shingle, all its
    words; a null text and a text without words have none. Repeated shingles stay repeated.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(texts), dtype=np.int64)
    inside = ~_SPACE[data]
    first = np.ones(len(data) + 1, dtype=bool)
    first[1:-1] = ~inside[:-1]
    first[offsets] = True
    starts = np.flatnonzero(inside & first[:-1])
    last = np.ones(len(data), dtype=bool)
    last[:-1] = ~inside[1:] | first[1:-1]
    ends = np.flatnonzero(inside & last) + 1
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    words = mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    count = np.bincount(owner, minlength=len(texts))
    total = np.zeros(max(0, len(words) - WORDS + 1), dtype=np.uint64)
    for k in range(WORDS):
        total += mixed(words[k:len(words) - WORDS + 1 + k] + np.uint64(k + 1)) if len(total) else 0
    whole = owner[:len(total)] == owner[WORDS - 1:] if len(total) else np.zeros(0, dtype=bool)
    values, owners = [mixed(total[whole])], [owner[:len(total)][whole]]
    short = np.flatnonzero((count > 0) & (count < WORDS))
    if len(short):
        begin = np.searchsorted(owner, short)
        joined = np.zeros(len(short), dtype=np.uint64)
        for k in range(WORDS - 1):
            has = count[short] > k
            joined[has] += mixed(words[begin[has] + k] + np.uint64(101 + k))
        values.append(mixed(joined + np.uint64(7)))
        owners.append(short)
    value, own = np.concatenate(values), np.concatenate(owners)
    order = np.lexsort((value, own))
    return value[order], np.cumsum(np.bincount(own, minlength=len(texts)))


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the multiset intersection of sorted arrays."""
    if len(a) > len(b):
        a, b = b, a
    nth = np.arange(len(a)) - np.searchsorted(a, a)
    return int((nth < np.searchsorted(b, a, side="right") - np.searchsorted(b, a)).sum())

"""Periodic runs of words by internal pattern matching.

The words of a text get a suffix array by doubling, which also names all blocks whose length is a power of two.
A block inside a run of period q occurs again q words later. So for each block on a grid, a wavelet matrix over the suffix array
gives the successors of its place among the suffixes that begin with it: its occurrences in neighbouring
windows, each window shorter than the block, where they form a progression. Each distance is a candidate period,
which is extended to both sides by comparing named blocks of falling length.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import portions

LEAST_LENGTH = 12
FIRST_BLOCK = 4
BATCH_ROWS = 200


class Blocks:
    """Names of all blocks of 1, 2, 4, ... words, equal for equal blocks: ``names[k][i]`` is the first place of the suffixes
    that begin with the block of 2**k words at i in the suffix array ``order``, and ``sizes[k][i]`` their number."""

    def __init__(self, words: np.ndarray):
        n = len(words)
        self.n = n
        _, first, name, size = np.unique(words, return_index=True, return_inverse=True, return_counts=True)
        starts = np.cumsum(size) - size
        self.names, self.sizes = [starts[name]], [size[name]]
        self.order = np.argsort(name, kind="stable")
        while True:
            step, rank, size = 1 << (len(self.names) - 1), self.names[-1], self.sizes[-1]
            tied = self.order[size[self.order] > 1]
            if not len(tied):
                break
            other = np.where(tied + step < n, rank[np.minimum(tied + step, n - 1)], -1)
            slots = np.flatnonzero(size[self.order] > 1)
            sort = np.lexsort((other, rank[tied]))
            tied, other = tied[sort], other[sort]
            self.order = self.order.copy()
            self.order[slots] = tied
            new = np.ones(len(tied), dtype=bool)
            new[1:] = (rank[tied[1:]] != rank[tied[:-1]]) | (other[1:] != other[:-1])
            at = np.flatnonzero(new)
            counts = np.diff(at, append=len(tied))
            rank, size = rank.copy(), size.copy()
            rank[tied], size[tied] = np.repeat(slots[at], counts), np.repeat(counts, counts)
            self.names.append(rank)
            self.sizes.append(size)

    def equal_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from places a and b on are equal."""
        total = np.zeros(len(a), dtype=np.int64)
        for k in reversed(range(len(self.names))):
            x, y = a + total, b + total
            same = (x < self.n) & (y < self.n)
            same[same] = self.names[k][x[same]] == self.names[k][y[same]]
            total += same.astype(np.int64) << k
        return total

    def equal_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words before places a and b are equal."""
        total = np.zeros(len(a), dtype=np.int64)
        for k in reversed(range(len(self.names))):
            x, y = a - total - (1 << k), b - total - (1 << k)
            same = (x >= 0) & (y >= 0)
            same[same] = self.names[k][x[same]] == self.names[k][y[same]]
            total += same.astype(np.int64) << k
        return total


class Wavelet:
    """A wavelet matrix over a permutation: for each bit from the highest, how many zeros come before each place."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.zeros, self.split = [], []
        for bit in reversed(range(self.bits)):
            zero = (values >> bit & 1) == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]))
            self.split.append(int(zero.sum()))
            values = np.concatenate([values[zero], values[~zero]])

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of the values at places low to high (exclusive) are smaller than bound."""
        low, high, count = low.copy(), high.copy(), np.zeros(len(low), dtype=np.int64)
        beyond = bound >= 1 << self.bits
        size = high - low
        for i, bit in enumerate(reversed(range(self.bits))):
            l0, h0 = self.zeros[i][low], self.zeros[i][high]
            one = (bound >> bit & 1) == 1
            count += np.where(one, h0 - l0, 0)
            low, high = np.where(one, self.split[i] + low - l0, l0), np.where(one, self.split[i] + high - h0, h0)
        return np.where(beyond, size, count)

    def nth(self, low: np.ndarray, high: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The n-th smallest (from 0) of the values at places low to high (exclusive)."""
        low, high, n, value = low.copy(), high.copy(), n.copy(), np.zeros(len(low), dtype=np.int64)
        for i, bit in enumerate(reversed(range(self.bits))):
            l0, h0 = self.zeros[i][low], self.zeros[i][high]
            one = n >= h0 - l0
            n = np.where(one, n - (h0 - l0), n)
            value += one.astype(np.int64) << bit
            low, high = np.where(one, self.split[i] + low - l0, l0), np.where(one, self.split[i] + high - h0, h0)
        return value


def candidates(blocks: Blocks, wavelet: Wavelet) -> tuple[np.ndarray, np.ndarray]:
    """Places i and periods q such that the block at i occurs again at i + q; every run holds such a block with its period.

    Blocks of b words on a grid of step g stand for the periods q for which any run, of max(LEAST_LENGTH, 2 q) words or more, has
    room for a grid place and the block there and q words later: length - q - b + 1 >= g. That holds for
    b = 4, g = 2 and q up to 14, and for b = g = 8, 16, ... and q from 2 b - 1 to 4 b - 2.
    """
    found = [(np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))]
    b, step, least, most = FIRST_BLOCK, 2, 1, 4 * FIRST_BLOCK - 2
    while True:
        k = b.bit_length() - 1
        if k >= len(blocks.names):
            break
        at = np.arange(0, blocks.n, step)
        at = at[blocks.sizes[k][at] > 1]
        low = blocks.names[k][at]
        high = low + blocks.sizes[k][at]
        for begin in range(least, most + 1, b):
            end = min(begin + b, most + 1)
            before = wavelet.below(low, high, at + begin)
            count = wavelet.below(low, high, at + end) - before
            hit = count > 0
            lo, hi, place, before, count = low[hit], high[hit], at[hit], before[hit], count[hit]
            if not len(place):
                continue
            first = wavelet.nth(lo, hi, before)
            second = wavelet.nth(lo, hi, np.minimum(before + 1, before + count - 1))
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            period = np.repeat(first - place, count) + nth * np.repeat(second - first, count)
            found.append((np.repeat(place, count), period))
        b, step, least, most = 2 * b, 2 * b, 4 * b - 1, 8 * b - 2
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def runs_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, length and smallest period of all runs of LEAST_LENGTH words or more, ordered by start and period.

    ``words`` are numbers, equal for equal words of one text and different between texts, so runs stay inside texts.
    """
    empty = np.zeros(0, dtype=np.int64)
    if len(words) < LEAST_LENGTH:
        return empty, empty, empty
    blocks = Blocks(words)
    if len(blocks.names) <= FIRST_BLOCK.bit_length() - 1:
        return empty, empty, empty
    place, period = candidates(blocks, Wavelet(blocks.order))
    if not len(place):
        return empty, empty, empty
    left, right = blocks.equal_before(place, place + period), blocks.equal_after(place, place + period)
    start, length = place - left, left + right + period
    ok = length >= np.maximum(LEAST_LENGTH, 2 * period)
    start, length, period = start[ok], length[ok], period[ok]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def stretch(words: list[bytes], h: int) -> list[bytes]:
    """The words with a periodic tail if h is divisible by 10, as the contract of the query lays down."""
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def collapse(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> list[bytes]:
    """The words without those that repeat a run's first period."""
    if not len(start):
        return words
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, start + period, 1)
    np.add.at(steps, start + length, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]


def _described(words: list[bytes], start: np.ndarray, length: np.ndarray, period: np.ndarray) -> tuple:
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in zip(start.tolist(), length.tolist(), period.tolist(), strict=True))
    best = (None,) * 4
    if len(start):
        i = int(np.lexsort((period, start, -length))[0])
        s, n, p = int(start[i]), int(length[i]), int(period[i])
        best = (s, n, p, 1000 * n // p)
    text = b" ".join(collapse(words, start, length, period))
    return len(start), *best, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(text).hexdigest(), text.decode()


def described(texts: list[list[bytes]]) -> list[tuple]:
    """For each text, given as words: n_runs, the longest run (start, length, period, exponent_milli), digests, collapsed text."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    flat = np.fromiter((numbers[w] for text in texts for w in text), dtype=np.int64)
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    start, length, period = runs_of(owner * (len(numbers) + 1) + flat)
    cut = np.searchsorted(start, ends) if len(ends) else []
    out, begin = [], 0
    for i, text in enumerate(texts):
        part = slice(begin, cut[i])
        out.append(_described(text, start[part] - (ends[i] - len(text)), length[part], period[part]))
        begin = cut[i]
    return out


SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string, collapsed string"
)


def find_runs(docs: DataFrame, stretched: bool = False) -> DataFrame:
    """The periodic runs of words of every whole text, and the text with each run cut to its first period.

    Words are what ASCII white space separates, numbered from 0. A run is a stretch with smallest period q and at least
    max(12, 2 q) words that no neighbouring word extends. Returns doc_id, n_runs, start, length, period and
    exponent_milli of the longest run (ties: smallest start, then period; null without runs), runs_sha256,
    collapsed_sha256 and collapsed. With ``stretched`` the words of a tenth of the documents, chosen by the crc32 of their doc_id (a
    null one counts as the empty text), first get a periodic tail. A null text counts as empty; every row gives one row,
    repeated and null doc_ids included; an empty table gives none; other columns are not looked at.
    """
    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    schema = pa.schema([
        ("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_runs", "start", "length", "period", "exponent_milli")),
        ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string()), ("collapsed", pa.string()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end in portions(batch.column(1)):
                part = batch.slice(begin, end - begin)
                words = [(t or "").encode().split() for t in part.column(1).to_pylist()]
                if stretched:
                    words = [stretch(w, x) for w, x in zip(words, part.column(2).to_pylist(), strict=True)]
                columns = zip(*described(words), strict=True)
                arrays = [part.column(0), *(pa.array(v, f.type) for v, f in zip(columns, list(schema)[1:], strict=True))]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", h.alias("h")).mapInArrow(run, SCHEMA)

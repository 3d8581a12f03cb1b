"""Phrase collocations by dynamic itemset counting.

The corpus is dealt into segments that are scanned in turn, round and round. Words are counted from the first segment
on. After each segment, phrases whose count has reached the threshold are noted; a longer phrase becomes active as
soon as both phrases it holds (without its last and without its first word) are noted, is counted from the next segment on,
and is done after one full cycle, wherever that began. So lengths are interleaved and most of the work is over after little more
than one pass, in place of one pass for each length.

Which phrases are noted is kept as bits by hash, a filter for each length and step that is sized for the phrases noted then. Two
phrases with the same bits can make a phrase active that need not be, never the reverse, so nothing is lost. Scans
count 64-bit hashes, which travel as sorted blocks, one for each part of the range of hashes; the phrases of several words
that reach the threshold are at last spelled out and counted as strings, which undoes any collision of their hashes.
"""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tabulary.session import scratch_path

from .bagminhash import kept
from .shingles import mixed

LONGEST = 4
THRESHOLD = 30
SEGMENTS = 3
SLOT_BITS = 22
KEY_SLOTS = 16
PART_BYTES = (1_000_000, 32_000_000)
MERGED = 500_000
NEVER = 255
TAG = 256
PORTION_BYTES = 6_000_000
CHUNK_BYTES = 250_000
SPELLED = 500_000
BATCH_ROWS = 500
BEST = 2_000
SCALE = 2_000_000
COVERED_PERCENT = 80

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[9, 32]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 2
_KINDS = _KIND.tobytes()
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of some texts: where they begin and end in the texts' bytes, hashes that depend on the language too, and the
    piece each lies in."""

    def __init__(self, texts: list[str], langs: list[int], seeds: np.ndarray):
        parts = [t.encode() for t in texts]
        whole = (b"\n".join(parts) + b"\n").lower()
        raw = np.frombuffer(whole, dtype=np.uint8)
        kind = np.frombuffer(whole.translate(_KINDS), dtype=np.uint8)
        inside = kind == 0
        self.raw, self.inside = raw, inside
        self.end = np.flatnonzero(inside[:-1] > inside[1:]) + 1
        self.start = np.flatnonzero(inside[1:] > inside[:-1]) + 1
        if inside[0]:
            self.start = np.concatenate([[0], self.start])
        breaks = np.zeros(len(self.start) + 1, dtype=np.int32)
        breaks[np.searchsorted(self.start, np.flatnonzero(kind == 2))] = 1
        self.piece = np.cumsum(breaks[:-1], dtype=np.int32)
        before = np.searchsorted(self.start, np.cumsum([len(p) + 1 for p in parts]))
        self.lang = np.repeat(np.array(langs, dtype=np.int64), np.diff(before, prepend=0))
        self.hash = mixed(self._hashes() + seeds[self.lang])
        self.text = None

    def _hashes(self) -> np.ndarray:
        """A hash of each word's bytes, taken in up to eight at a time."""
        padded = np.concatenate([self.raw, np.zeros(8, dtype=np.uint8)])
        eights = np.ndarray(shape=(len(self.raw),), dtype="<u8", buffer=padded, strides=(1,))
        size = self.end - self.start
        total, left, place, at = size.astype(np.uint64), size, self.start, np.arange(len(size))
        while len(at):
            used = np.uint64(8) * (np.uint64(8) - np.minimum(left, 8).astype(np.uint64))
            total[at] = mixed(total[at] * _STEP + (eights[place] << used))
            more = left > 8
            at, place, left = at[more], place[more] + 8, left[more] - 8
        return total

    def phrases(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each length the hashes of all runs of so many words, and which of them lie within one piece."""
        total, n = self.hash, len(self.hash)
        yield 1, total, np.ones(n, dtype=bool)
        for k in range(2, LONGEST + 1):
            if n < k:
                return
            total = mixed(total[:-1] * _STEP + self.hash[k - 1:] + np.uint64(k))
            yield k, total, self.piece[:n - k + 1] == self.piece[k - 1:]

    def spelled(self, first: np.ndarray, k: int) -> pa.Array:
        """The phrases of k words that begin with the given words."""
        if self.text is None:
            keep = self.inside.copy()
            keep[self.end] = True
            self.text = np.where(self.inside, self.raw, 32)[keep]
            self.place = np.concatenate([[0], np.cumsum(self.end - self.start + 1)])
        begin = self.place[first]
        size = self.place[first + k] - 1 - begin
        offsets = np.concatenate([[0], np.cumsum(size)])
        at = np.arange(offsets[-1]) + np.repeat(begin - offsets[:-1], size)
        return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.text[at])).cast(pa.string())


def _changes(ordered: np.ndarray) -> np.ndarray:
    new = np.ones(len(ordered), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.flatnonzero(new)


def counted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes and how often each occurs."""
    ordered = np.sort(hashes)
    at = _changes(ordered)
    return ordered[at], np.diff(at, append=len(ordered))


def located(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct hash and how often it occurs."""
    order = np.argsort(hashes)
    at = _changes(hashes[order])
    return order[at], np.diff(at, append=len(order))


def slots(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The two slots of each hash in a filter of so many bits, a power of two."""
    mask, bits = np.uint64(size - 1), np.uint64(size.bit_length() - 1)
    return hashes & mask, hashes >> bits & mask


def _set(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.flatnonzero(filter_[(at >> np.uint64(3)).view(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1))


def noted_at(filters: list[tuple[int, np.ndarray]], hashes: np.ndarray) -> np.ndarray:
    """The step after which each hash was noted at the earliest, NEVER if it was not, by the filters of the steps in order."""
    noted = np.full(len(hashes), NEVER, dtype=np.uint8)
    left, mine = None, hashes
    for step, filter_ in filters:
        size = 8 * len(filter_)
        at = _set(filter_, slots(mine, size)[0])
        at = at[_set(filter_, slots(mine[at], size)[1])]
        noted[at if left is None else left[at]] = step
        left = np.flatnonzero(noted == NEVER)
        if not len(left):
            break
        mine = hashes[left]
    return noted


def _portions(batches: Iterator[pa.RecordBatch], seeds: dict[str, int], limit: int) -> Iterator[tuple[Words, list[str]]]:
    """Words of about so many bytes of text at a time (or of one text), with the names of their languages."""
    texts, langs, size = [], [], 0

    def made() -> tuple[Words, list[str]]:
        names = sorted(set(langs))
        number = {name: i for i, name in enumerate(names)}
        for name in names:
            if name not in seeds:
                value = np.uint64(len(name) + 1)
                for byte in name.encode():
                    value = mixed(np.array([value * _STEP + np.uint64(byte)]))[0]
                seeds[name] = value
        return Words(texts, [number[x] for x in langs], np.array([seeds[x] for x in names], dtype=np.uint64)), names

    with np.errstate(over="ignore"):
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                texts.append(text)
                langs.append(lang)
                size += len(text)
                if size >= limit:
                    yield made()
                    texts, langs, size = [], [], 0
        if texts:
            yield made()


def shared(spark: SparkSession, filters: dict[int, list[tuple[int, np.ndarray]]]) -> Broadcast:
    """The filters as compressed bytes for all tasks: what is sent follows the phrases noted."""
    return spark.sparkContext.broadcast({k: [(step, zlib.compress(f.tobytes(), 1)) for step, f in of] for k, of in filters.items()})


def _opened(sent: Broadcast) -> dict[int, list[tuple[int, np.ndarray]]]:
    return {k: [(step, np.frombuffer(zlib.decompress(f), dtype=np.uint8)) for step, f in of] for k, of in sent.value.items()}


def _first(part: int, parts: int) -> int:
    """The hash at which a part of the range of hashes begins."""
    return (part << 64) // parts


def _blocks(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """The values between the edges as bytes."""
    offsets = (edges * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in one byte each if all fit, else in eight."""
    return counts.astype(np.uint8 if counts.max() < 256 else np.int64)


def packed(tag: int, value: np.ndarray, count: np.ndarray, parts: int) -> pa.RecordBatch:
    """Sorted hashes and their counts as rows (part, tag, seen, h, n), one for each part that has some."""
    edges = np.append(np.searchsorted(value, np.array([_first(i, parts) for i in range(parts)], dtype=np.uint64)), len(value))
    part = np.flatnonzero(np.diff(edges))
    edges = np.append(edges[part], len(value))
    rows = len(part)
    columns = [pa.array(part.astype(np.int32)), pa.array(np.full(rows, tag, dtype=np.int16)), pa.array(np.zeros(rows, dtype=bool))]
    return pa.RecordBatch.from_arrays([*columns, _blocks(value, edges), _blocks(_narrow(count), edges)], names=["part", "tag", "seen", "h", "n"])


def _unpacked(h: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(h, dtype=np.uint64), np.frombuffer(n, dtype=np.uint8 if len(n) < len(h) else np.int64)


def scan(segment: DataFrame, sent: Broadcast, step: int, parts: int) -> DataFrame:
    """Partial counts of the phrases that are active in this step, as packed rows; the tag is length times TAG plus the step since when.

    A phrase is taken for noted only if it is active, and not before it was: so its tag is the same in all scans.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, active, size = _opened(sent), defaultdict(list), 0

        def rows() -> Iterator[pa.RecordBatch]:
            for tag, hashes in active.items():
                yield packed(tag, *counted(np.concatenate(hashes)), parts)
            active.clear()

        for words, _ in _portions(batches, {}, CHUNK_BYTES):
            noted = None
            for k, hashes, whole in words.phrases():
                if k == 1:
                    groups = [(0, hashes)] if step < SEGMENTS else []
                    noted = noted_at(filters[k], hashes)
                else:
                    since = np.where(whole, np.maximum(noted[:-1], noted[1:]), NEVER)
                    groups = [(s + 1, hashes[since == s]) for s in range(max(0, step - SEGMENTS), step)]
                    if k < LONGEST:
                        at = np.flatnonzero(since != NEVER)
                        noted = np.full(len(hashes), NEVER, dtype=np.uint8)
                        noted[at] = np.maximum(noted_at(filters[k], hashes[at]), since[at])
                for begun, found in groups:
                    if len(found):
                        active[k * TAG + begun].append(found)
            size += len(words.raw)
            if size >= PORTION_BYTES:
                yield from rows()
                size = 0
        yield from rows()

    return segment.mapInArrow(run, "part int, tag short, seen boolean, h binary, n binary")


def merged(rows: DataFrame, step: int, parts: int) -> DataFrame:
    """The packed rows with one count for each hash, without those that are done below THRESHOLD; fresh ones reach it in this step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = defaultdict(list)
        for batch in batches:
            for part, tag, seen, h, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held[part, tag].append((*_unpacked(h, n), seen))
        for (part, tag), some in held.items():
            pieces = 1 + sum(len(value) for value, _, _ in some) // MERGED
            first, after = _first(part, parts), _first(part + 1, parts)
            cuts = np.array([first + (after - first) * i // pieces for i in range(1, pieces)], dtype=np.uint64)
            edges = [np.concatenate([[0], np.searchsorted(value, cuts), [len(value)]]) for value, _, _ in some]
            for i in range(pieces):
                mine = [(value[e[i]:e[i + 1]], count[e[i]:e[i + 1]], seen) for (value, count, seen), e in zip(some, edges, strict=True) if e[i] < e[i + 1]]
                if not mine:
                    continue
                value, count = np.concatenate([v for v, _, _ in mine]), np.concatenate([n for _, n, _ in mine]).astype(np.int64)
                earlier = np.concatenate([np.full(len(v), seen) for v, _, seen in mine])
                order = np.argsort(value)
                value, count, earlier = value[order], count[order], earlier[order]
                at = _changes(value)
                value, total, before = value[at], np.add.reduceat(count, at), np.add.reduceat(count * earlier, at)
                fresh = (total >= THRESHOLD) & (before < THRESHOLD)
                rest = ~fresh
                if tag % TAG + SEGMENTS - 1 <= step:
                    rest &= total >= THRESHOLD
                for new, chosen in ((True, fresh), (False, rest)):
                    if chosen.any():
                        columns = [[part], [tag], [new], [value[chosen].tobytes()], [_narrow(total[chosen]).tobytes()]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    names, kinds = ["part", "tag", "fresh", "h", "n"], [pa.int32(), pa.int16(), pa.bool_(), pa.binary(), pa.binary()]
    return rows.repartitionById(parts, "part").mapInArrow(run, "part int, tag short, fresh boolean, h binary, n binary")


def unpacked(rows: DataFrame) -> DataFrame:
    """Frames (k, h, n) of packed rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tag, h, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                value, count = _unpacked(h, n)
                k = pa.array(np.full(len(value), tag // TAG, dtype=np.int8))
                yield pa.RecordBatch.from_arrays([k, pa.array(value.view(np.int64)), pa.array(count.astype(np.int64))], names=["k", "h", "n"])

    return rows.select("tag", "h", "n").mapInArrow(run, "k byte, h long, n long")


def note(rows: DataFrame, step: int) -> dict[int, tuple[int, np.ndarray]]:
    """For each length the step and a filter of the hashes of packed rows, KEY_SLOTS bits or more for each; lengths without any are left out.

    The filters come to the driver as bits of words, 16 bytes for each word that has some.
    """
    counts = rows.groupBy(F.floor(F.col("tag") / TAG).alias("k")).agg(F.sum(F.octet_length("h") / 8).cast("long").alias("keys")).collect()
    sizes = {r.k: max(1 << SLOT_BITS, 1 << (KEY_SLOTS * r["keys"] - 1).bit_length()) for r in counts}
    if not sizes:
        return {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tag, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = np.sort(np.concatenate(slots(np.frombuffer(h, dtype=np.uint64), sizes[tag // TAG])))
                word = at >> np.uint64(6)
                first = _changes(word)
                bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
                k = pa.array(np.full(len(first), tag // TAG, dtype=np.int8))
                yield pa.RecordBatch.from_arrays([k, pa.array(word[first].astype(np.int64)), pa.array(bits.view(np.int64))], names=["k", "word", "bits"])

    words = rows.select("tag", "h").mapInArrow(run, "k byte, word long, bits long")
    arrow = words.groupBy("k", "word").agg(F.bit_or("bits").alias("bits")).toArrow()
    k, word, bits = (arrow.column(c).to_numpy() for c in ("k", "word", "bits"))
    made = {}
    for length, size in sizes.items():
        filter_ = np.zeros(size // 64, dtype=np.int64)
        filter_[word[k == length]] = bits[k == length]
        made[length] = step, filter_.view(np.uint8)
    return made


def frequent(segments: list[DataFrame], parts: int) -> DataFrame:
    """Dynamic counting over the segments: packed rows of all phrases that reach THRESHOLD."""
    filters = {k: [] for k in range(1, LONGEST)}
    open_, done, step, last = None, [], 0, 0
    ended = F.col("tag") % TAG + SEGMENTS - 1
    while step <= last + SEGMENTS - 1:
        sent = shared(segments[0].sparkSession, filters)
        rows = scan(segments[step % SEGMENTS], sent, step, parts)
        both = rows if open_ is None else rows.unionByName(open_)
        counts = kept(merged(both, step, parts), f"step{step}")
        sent.destroy()
        for k, made in note(counts.where("fresh").where(F.col("tag") < LONGEST * TAG), step).items():
            filters[k].append(made)
            last = step + 1
        done.append(counts.where(ended <= step))
        open_ = counts.where(ended > step).select("part", "tag", F.lit(True).alias("seen"), "h", "n")
        step += 1
    return reduce(DataFrame.unionByName, done)


def summed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One row for each phrase, with the sum of its counts; the columns are those of the first batch, n the last."""
    schema = held[0].schema
    table = pa.Table.from_batches(held).group_by(schema.names[:-1], use_threads=False).aggregate([("n", "sum")])
    return table.rename_columns({"n_sum": "n"}).select(schema.names).cast(schema).combine_chunks().to_batches()[0]


def spell(texts: DataFrame, sent: Broadcast, parts: int) -> DataFrame:
    """lang, k, phrase and count of the phrases of several words in the filters; k = 0 stands for the number of all words.

    Counts travel as blocks of rows, one for each part of the range of hashes, since equal phrases have equal hashes.
    """
    columns = [("lang", pa.string()), ("k", pa.int8()), ("phrase", pa.string()), ("n", pa.int64())]
    schema = pa.schema([("part", pa.int32()), *columns])
    starts = np.array([_first(i, parts) for i in range(parts)], dtype=np.uint64)

    def blocks(held: pa.RecordBatch) -> pa.RecordBatch:
        part = held.column("part").to_numpy()
        order = np.argsort(part, kind="stable")
        rows, edges = held.drop_columns(["part"]).take(pa.array(order)), np.append(_changes(part[order]), len(part))
        made = []
        for first, after in itertools.pairwise(edges):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as writer:
                writer.write_batch(rows.slice(first, after - first))
            made.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(part[order[edges[:-1]]]), pa.array(made, pa.binary())], names=["part", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, held = _opened(sent), []
        for words, names in _portions(batches, {}, PORTION_BYTES):
            langs = pa.array(names, pa.string())
            sizes = np.bincount(words.lang, minlength=len(names)).astype(np.int64)
            zero = np.zeros(len(names), np.int32)
            held.append(pa.RecordBatch.from_arrays([pa.array(zero), langs, pa.array(zero.astype(np.int8)), pa.array([""] * len(names)), pa.array(sizes)], schema=schema))
            inner = None
            for k, hashes, whole in words.phrases():
                if k == 1:
                    continue
                at = np.flatnonzero(whole if inner is None else whole & inner[:-1] & inner[1:])
                at = at[noted_at(filters[k], hashes[at]) != NEVER]
                inner = np.zeros(len(hashes), dtype=bool)
                inner[at] = True
                first, count = located(hashes[at])
                if len(first):
                    first = at[first]
                    part = np.searchsorted(starts, hashes[first], side="right").astype(np.int32) - np.int32(1)
                    found = [pa.array(part), langs.take(pa.array(words.lang[first])), pa.array(np.full(len(first), k, np.int8)), words.spelled(first, k), pa.array(count)]
                    held.append(pa.RecordBatch.from_arrays(found, schema=schema))
            if sum(map(len, held)) >= SPELLED:
                held = [summed(held)]
                if 2 * len(held[0]) >= SPELLED:
                    yield blocks(held.pop())
        if held:
            yield blocks(summed(held))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, most = [], SPELLED
        for batch in batches:
            for block in batch.column("block").to_pylist():
                held.extend(pa.ipc.open_stream(block))
                if sum(map(len, held)) >= most:
                    held = [summed(held)]
                    most = max(SPELLED, 2 * len(held[0]))
        if held:
            yield summed(held)

    rows = texts.mapInArrow(run, "part int, block binary").repartitionById(parts, "part").select("block")
    return rows.mapInArrow(meet, "lang string, k byte, phrase string, n long")


def hashed(words: DataFrame) -> DataFrame:
    """lang, phrase and h, the scan's hash, of single words (lang, phrase)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, names in _portions(batches, {}, PORTION_BYTES):
            langs = pa.array(names, pa.string()).take(pa.array(part.lang))
            columns = [langs, part.spelled(np.arange(len(part.hash)), 1), pa.array(part.hash.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "h"])

    return words.select("lang", "phrase").mapInArrow(run, "lang string, phrase string, h long")


def parts_for(size: int, usual: int) -> int:
    """Into how many parts hashes are dealt for so many bytes of text: the usual number, but not for few bytes and more for many."""
    least, most = PART_BYTES
    return max(min(usual, size // least + 1), size // most + 1)


def phrase_counts(docs: DataFrame) -> DataFrame:
    """lang, k, phrase, n: how often each phrase of 2 to LONGEST words occurs, of those that do THRESHOLD times.

    With k = 1 the words of these phrases, with k = 0 (and an empty phrase) all words of a language.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    rows = docs.where("text is not null").select(
        F.coalesce("lang", F.lit("und")).alias("lang"), "text", F.pmod(F.monotonically_increasing_id(), F.lit(SEGMENTS)).cast("int").alias("segment"))
    path, size = scratch_path(spark, "segments"), Observation()
    rows.observe(size, F.sum(F.octet_length("text")).alias("bytes")).write.partitionBy("segment").parquet(path)
    whole = spark.read.schema("lang string, text string, segment int").parquet(path)
    segments = [whole.where(F.col("segment") == i).select("lang", "text") for i in range(SEGMENTS)]
    parts = parts_for(size.get.get("bytes") or 0, int(spark.conf.get("spark.sql.shuffle.partitions")))
    found = frequent(segments, parts)
    made = note(found.where(F.col("tag") >= 2 * TAG), 0)
    sent = shared(spark, {k: [made[k]] if k in made else [] for k in range(2, LONGEST + 1)})
    counts = spell(whole.select("lang", "text"), sent, parts)
    long = kept(counts.where((F.col("k") == 0) | (F.col("n") >= THRESHOLD)), "phrases")
    sent.destroy()
    words = long.where("k > 1").select("lang", F.explode(F.split("phrase", " ")).alias("phrase")).distinct()
    single = hashed(words).join(unpacked(found.where(F.col("tag") < 2 * TAG)), "h").select("lang", "k", "phrase", "n")
    return long.unionByName(kept(single, "words"))


def _wide(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def collocations(docs: DataFrame) -> DataFrame:
    """The best phrases of each language, by the Dice coefficient of their weakest cut.

    Words are what blanks and tabs separate within pieces, which end at ``.,;:!?`` and line ends; A to Z count as lower case. A phrase of
    2 to LONGEST words that occurs a >= THRESHOLD times is cut after each word; l and r are the counts of
    both parts and the score is floor(SCALE a / (l + r)) of the lowest cut, the first one if cuts tie. Phrases go
    that lie inside a longer one with at least COVERED_PERCENT percent of their count. Returns lang (null:
    ``und``), rank, phrase, a, l, r, n (words of the language) and score of the first BEST by score, a (both
    descending) and phrase. Null and empty texts have no words; repeated rows count each; an empty table gives none; other columns are
    not looked at.
    """
    counts = phrase_counts(docs)
    words = counts.where("k > 0").select("lang", "phrase", F.col("n").alias("a"))
    long = counts.where("k > 1").select("lang", "phrase", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cut = F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut")
    halves = long.select("lang", "phrase", "a", "w", cut).select(
        "lang", "phrase", "a", "cut", F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("cut") + 1, F.size("w")), " ").alias("tail"))
    heads = words.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = words.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    scored = halves.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    scored = scored.withColumn("score", F.expr(f"cast({SCALE} as decimal(20,0)) * cast(a as decimal(18,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    lowest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("m"))
    part = F.explode(F.expr(
        "filter(flatten(transform(sequence(1, size(w)), i -> transform(sequence(2, size(w)), n -> if(i + n - 1 <= size(w) and n < size(w), array_join(slice(w, i, n), ' '), null)))), x -> x is not null)"))
    covers = long.where("size(w) > 2").select("lang", part.alias("phrase"), F.col("a").alias("longer")).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    covered = _wide(F.col("longer")) * 100 >= _wide(F.col("a")) * COVERED_PERCENT
    left = lowest.join(covers, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    left = left.select("lang", "phrase", "a", "m.l", "m.r", "m.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= BEST)
    totals = counts.where("k = 0").select("lang", F.col("n").alias("total"))
    return best.join(F.broadcast(totals) if totals.count() <= BEST else totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")

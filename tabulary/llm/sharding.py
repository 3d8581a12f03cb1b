"""Sharding by minimax contiguous partition over groups of equal texts.

Groups lie in the order of the MD5 of their text. The smallest feasible capacity of a shard is found by binary search; a
greedy walk over the group ends checks each candidate. Only sums of hash ranges come to the driver: the walk is done
once as if a range could be cut only at its ends and once as if it could be cut anywhere, which bounds the capacity
from both sides, and only the ranges between the two walks are split further, until both agree. A row then finds its
shard by comparing its MD5 with the cuts.

A group that is larger than an even share takes a shard of its own before the others are cut, so that one
group of copies does not leave other shards empty.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bagminhash import kept

SHARDS = 16
FIRST_DIGITS = 3
MORE_DIGITS = 2
ROW_FOLDS = 1024


@dataclass
class Ranges:
    """Consecutive ranges of the order: where each begins (as a prefix of the MD5), where it ends in bytes, its groups."""

    prefixes: list[str]
    ends: list[int]
    groups: list[int]

    @classmethod
    def of(cls, rows: list[tuple[str, int, int]]) -> Ranges:
        ends, total = [], 0
        for _, size, _ in rows:
            total += size
            ends.append(total)
        return cls([r[0] for r in rows], ends, [r[2] for r in rows])

    def below(self, position: int) -> int:
        """The last known end of a group at or before a position."""
        at = bisect_right(self.ends, position)
        return self.ends[at - 1] if at else 0

    def above(self, position: int) -> int:
        """The first known end of a group at or after a position."""
        return self.ends[bisect_left(self.ends, position)] if position > 0 else 0

    def open_at(self, position: int) -> int | None:
        """The number of the range of several groups that a position lies inside of."""
        at = bisect_right(self.ends, position)
        begin = self.ends[at - 1] if at else 0
        return at if at < len(self.ends) and begin < position and self.groups[at] > 1 else None

    def reach(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        """How far the greedy walk comes with each shard; hopeful walks cut ranges of several groups anywhere."""
        out, position = [], 0
        for _ in range(shards):
            target = position + capacity
            position = target if hopeful and self.open_at(target) is not None else self.below(target)
            out.append(position)
        return out

    def capacity(self, shards: int, low: int, hopeful: bool) -> int:
        """The smallest capacity from ``low`` on with which the walk takes in everything."""
        total = self.ends[-1]
        high = total
        while low < high:
            middle = (low + high) // 2
            if self.reach(middle, shards, hopeful)[-1] >= total:
                high = middle
            else:
                low = middle + 1
        return low

    def cuts(self, capacity: int, shards: int) -> tuple[list[int], set[int]]:
        """Where shards end under a capacity, as near below an even share as it allows, and the open ranges this depends on."""
        total, asked = self.ends[-1], set()
        least = [total]
        for _ in range(shards - 1):
            asked.add(self.open_at(least[0] - capacity))
            least.insert(0, self.above(least[0] - capacity))
        out, position = [], 0
        for k in range(shards):
            target = min(total * (k + 1) // shards, position + capacity)
            asked.add(self.open_at(target))
            position = max(least[k], self.below(target))
            out.append(position)
        return out, asked - {None}


def _sums(groups: DataFrame, prefixes: list[str] | None) -> list[tuple[str, int, int]]:
    """Rows (prefix, bytes, groups) of the ranges that split the given ones; of all groups if none are given."""
    if prefixes is None:
        chosen = groups.select(F.substring("key", 1, FIRST_DIGITS).alias("prefix"), "size")
    else:
        lengths = sorted({len(p) for p in prefixes})
        parts = []
        for n in lengths:
            wanted = [p for p in prefixes if len(p) == n]
            rows = groups.where(F.substring("key", 1, n).isin(wanted))
            parts.append(rows.select(F.substring("key", 1, n + MORE_DIGITS).alias("prefix"), "size"))
        chosen = reduce(DataFrame.unionByName, parts)
    found = chosen.groupBy("prefix").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("groups"))
    return sorted((r["prefix"], r["size"], r["groups"]) for r in found.collect())


def cut_keys(groups: DataFrame, shards: int, largest: int) -> list[str]:
    """The MD5 prefixes at which shards after the first begin: the minimax partition of groups (key, size).

    Brings sums of hash ranges to the driver: 16 to the power of FIRST_DIGITS at first, then those of the
    few ranges that cuts may lie in, so their number does not grow with the groups.
    """
    rows = _sums(groups, None)
    if not rows:
        return []
    while True:
        ranges = Ranges.of(rows)
        total = ranges.ends[-1]
        low = ranges.capacity(shards, max(largest, -(-total // shards)), hopeful=True)
        high = ranges.capacity(shards, low, hopeful=False)
        if low == high:
            ends, asked = ranges.cuts(high, shards)
            if not asked:
                break
        else:
            near, far = ranges.reach(low, shards, hopeful=False), ranges.reach(high, shards, hopeful=True)
            asked = set()
            for a, b in zip(near, far, strict=True):
                asked |= {i for i in range(bisect_left(ranges.ends, a), min(bisect_right(ranges.ends, b) + 1, len(rows))) if ranges.groups[i] > 1}
        finer = _sums(groups, [ranges.prefixes[i] for i in sorted(asked)])
        rows = sorted([r for i, r in enumerate(rows) if i not in asked] + finer)
    begins = [bisect_right(ranges.ends, e) for e in ends[:-1]]
    return [ranges.prefixes[i] if i < len(rows) else "g" for i in begins]


def plan(groups: DataFrame, shards: int) -> tuple[list[str], list[str]]:
    """Keys of the groups that get a shard of their own (largest first) and the cuts of the others."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    largest = [(r["key"], r["size"]) for r in groups.orderBy(F.desc("size"), "key").limit(shards).collect()]
    alone, left = [], shards
    for key, size in largest:
        if left > 1 and size * left > total:
            alone.append(key)
            total, left = total - size, left - 1
    rest = groups.where(~F.col("key").isin(alone)) if alone else groups
    biggest = max((size for key, size in largest if key not in alone), default=0)
    return alone, cut_keys(rest, left, biggest)


def shard_of(key: Column, alone: list[str], cuts: list[str]) -> Column:
    """The shard of a group: its own, or one more than the number of cuts at or before its key."""
    passed = reduce(lambda a, b: a + b, [(key >= F.lit(c)).cast("int") for c in cuts], F.lit(len(alone)))
    for i, name in enumerate(alone):
        passed = F.when(key == F.lit(name), F.lit(i)).otherwise(passed)
    return passed.cast("int")


def with_slots(rows: DataFrame) -> DataFrame:
    """``slot`` numbers the rows of a shard from 0 by (fold, key, doc_id), where the fold is a hash of doc_id and key.

    A window numbers the rows of one fold, so neither a shard nor a group of copies is sorted by one task.
    """
    word = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "key").cast("binary")
    rows = rows.withColumn("fold", F.pmod(F.crc32(word), F.lit(ROW_FOLDS)).cast("int"))
    sizes = rows.groupBy("shard", "fold").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("fold").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("shard", "fold", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "fold").orderBy("key", "doc_id"))
    numbered = rows.withColumn("inside", inside).join(F.broadcast(before), ["shard", "fold"])
    return numbered.withColumn("slot", F.col("before") + F.col("inside") - 1)


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Put every document into one of ``shards`` shards; equal texts stay together and the largest shard is as small as can be.

    Returns doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law (``bytes``), shard, slot (gapless
    from 0 in each shard) and grown_shard (null under this law). A null text counts as the empty text. Groups
    larger than an even share of what is left get shards 0, 1, ... of their own; the others are cut in
    the order of their MD5. Every row gives one row, repeated rows and null doc_ids included; an empty
    table gives none; other columns are not looked at. With fewer groups than shards some shards are empty.
    """
    text = F.coalesce("text", F.lit("")).cast("binary")
    rows = docs.select("doc_id", F.md5(text).alias("key"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = kept(rows, "sizes")
    groups = kept(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    alone, cuts = plan(groups, shards)
    placed = with_slots(rows.withColumn("shard", shard_of(F.col("key"), alone, cuts)))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

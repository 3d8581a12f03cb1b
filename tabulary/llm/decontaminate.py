"""Benchmark leaks: SimHash fingerprints of item-sized windows, block index, exact weighted-shingle check.

Only windows that begin at a shingle of an item are fingerprinted, and the last window of a text: a window that begins
elsewhere can move right without losing a common shingle. A fingerprint has 64 bits; its blocks are indexed, one more
than the radius, so every item fingerprint within the radius shares a block. Candidates within the radius are
checked by the weighted Jaccard similarity of window and item over five-word shingles, weights being counts.
Everything is a column expression; a text is the unit of work and no group of texts is gathered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bagminhash import kept
from .common import BROADCAST_ROWS, broadcast_below

WORDS = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCKS = [(3 * i, 3) for i in range(20)] + [(60, 4)]
_LANES = 0x0001000100010001


def with_shingles(df: DataFrame, name: str) -> DataFrame:
    """The frame with its text replaced by ``name``: the hashes of its five-word shingles in order.

    Words are lower-cased and split at ASCII white space; null texts and texts of fewer words have no shingles.
    The words are a column of their own, so that they are split once and not once for each shingle. For the same
    reason callers use outer generators and filter written tables: a filter on the hashes would be moved below the split.
    """
    rest = [c for c in df.columns if c != "text"]
    words = F.split(F.btrim(F.lower("text"), F.lit(" \t\n\v\f\r")), "[ \t\n\x0B\f\r]+")
    split = df.select(*rest, F.coalesce(words, F.array().cast("array<string>")).alias("words"))
    places = F.sequence(F.lit(0), F.size("words") - WORDS)
    hashes = F.transform(places, lambda i: F.xxhash64(*[F.get(F.col("words"), i + k) for k in range(WORDS)]))
    return split.select(*rest, F.when(F.size("words") >= WORDS, hashes).otherwise(F.array().cast("array<long>")).alias(name))


def with_fingerprint(df: DataFrame, hashes: str, name: str) -> DataFrame:
    """The frame with the 64-bit SimHash of an array column: each bit is the majority of that bit over the array.

    Four bits are counted at once, in lanes of 16 bits of a long; the counts are a column of their own.
    """

    def counted(low: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda total, h: total + F.shiftrightunsigned(h, low).bitwiseAND(F.lit(_LANES)))

    counts = df.withColumn("counts", F.array(*[counted(low) for low in range(16)]))
    bits = []
    for low in range(16):
        for lane in range(4):
            count = F.shiftrightunsigned(F.get("counts", F.lit(low)), 16 * lane).bitwiseAND(F.lit(0xFFFF))
            bits.append(F.when(2 * count > F.size(hashes), F.shiftleft(F.lit(1).cast("long"), 16 * lane + low)).otherwise(F.lit(0).cast("long")))
    return counts.withColumn(name, reduce(lambda a, b: a.bitwiseOR(b), bits)).drop("counts")


def block(bits: Column, start: int, width: int) -> Column:
    return F.shiftrightunsigned(bits, start).bitwiseAND(F.lit((1 << width) - 1))


def blocks(bits: Column) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("number"), block(bits, *b).alias("bits")) for i, b in enumerate(BLOCKS)])


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard of two arrays as multisets."""

    def times(values: Column, x: Column) -> Column:
        return F.size(F.filter(values, lambda y: y == x))

    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    counted = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda total, x: total + F.least(times(a, x), times(b, x)))
    common = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)
    return common.cast("double") / (F.size(a) + F.size(b) - common)


def windows_at_items(named: DataFrame, anchors: DataFrame) -> DataFrame:
    """doc_id, text_md5, item_key and window (hashes) for every item shingle in a text (doc_id, text_md5, text).

    The window begins at that shingle, or earlier where the text would end first. With few anchors they are
    broadcast and the text's hashes travel no further than the task; with many, hits are found first and meet their texts again.
    """
    hashed = with_shingles(named, "hashes")
    if anchors.count() <= BROADCAST_ROWS:
        placed = hashed.select("doc_id", "text_md5", "hashes", F.posexplode_outer("hashes").alias("at", "hash"))
        met = placed.join(F.broadcast(anchors), "hash")
    else:
        placed = hashed.select("text_md5", F.posexplode_outer("hashes").alias("at", "hash"))
        hits = placed.join(anchors, "hash").select("text_md5", "item_key", "size", "at").distinct()
        met = hashed.join(hits, "text_md5")
    last = F.greatest(F.lit(0), F.size("hashes") - F.col("size"))
    window = F.slice("hashes", F.least("at", last) + 1, F.col("size"))
    return met.select("doc_id", "text_md5", "item_key", window.alias("window"))


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Items that a text holds: some window of the item's size has a similarity of SIMILARITY or more with it.

    Returns doc_id, item_id, similarity (of the best window) and text_md5, once for each distinct doc_id, text and item. A
    text shorter than the item is one window. Null texts and texts or items of fewer than five words match nothing;
    repeated item rows count once, a null item_id is an item of its own. Other columns are not looked at.
    """
    items = kept(with_shingles(benchmark.select("item_id", "text"), "item"), "item_shingles").where(F.size("item") > 0).distinct()
    items = kept(with_fingerprint(items, "item", "item_bits").withColumn("item_key", F.xxhash64("item_id", "item")), "items")
    anchors = items.select("item_key", F.size("item").alias("size"), F.explode(F.array_distinct("item")).alias("hash"))
    named = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"), "text")
    windows = windows_at_items(named, kept(anchors, "anchors"))
    printed = with_fingerprint(windows, "window", "bits").withColumn("block", F.explode(blocks(F.col("bits"))))
    index = items.select("item_key", "item_id", "item", "item_bits", F.explode(blocks(F.col("item_bits"))).alias("block"))
    joined = printed.join(broadcast_below(kept(index, "index"), BROADCAST_ROWS // 10), ["item_key", "block"])
    apart = F.col("bits").bitwiseXOR(F.col("item_bits"))
    first = F.coalesce(*[F.when(block(apart, *b) == 0, F.lit(i)) for i, b in enumerate(BLOCKS)])
    close = joined.where((F.bit_count(apart) <= RADIUS) & (F.col("block.number") == first))
    scored = close.select("doc_id", "text_md5", "item_id", similarity(F.col("window"), F.col("item")).alias("similarity"))
    return scored.where(F.col("similarity") >= SIMILARITY).groupBy("doc_id", "text_md5", "item_id").agg(F.max("similarity").alias("similarity"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows whose text holds no item, with all their columns; rows with a null text stay."""
    leaks = kept(find_leaks(docs, benchmark).select(F.col("text_md5").alias("leak_md5")).distinct(), "leaks")
    key = F.coalesce(F.md5(docs["text"].cast("binary")), F.lit(""))
    return docs.join(broadcast_below(leaks), key == leaks["leak_md5"], "left_anti")

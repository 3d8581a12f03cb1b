"""Near-duplicates by BagMinHash signatures, banding, and verified multiset overlap.

A shingle that occurs w times owns Poisson processes over the weight intervals [0, 1), [1, 2), [2, 4), [4, 8), ...
up to w. Their points come in order of time; each carries a signature position and a weight mark, and counts if the
mark lies below w. A position keeps its earliest point, so two signatures agree in a position with the probability
of the weighted Jaccard similarity; a process ends once its time is past the latest point of the signature.

Bands of the signature form buckets, whose members are compared until each bucket lies in one class. Only classes are
wanted, so every round contracts what it has linked, and a bucket or group inside one class is done. First each bucket's
members meet a leader, which joins families of near copies at about one comparison a member. Members of buckets that are then
still open (mostly texts that share a passage) meet only in groups below a rare shingle: of two texts that link, the rarest
fifth of either's shingles hold a common one, from which on both hold as many as a link needs. Groups again meet leaders, GROWTH times as many each round, so a group of g
members is done after a few more than log(g) / log(GROWTH) rounds, and no link between two classes is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulary.session import scratch_path

from .common import BATCH_ROWS, BROADCAST_ROWS, broadcast_below
from .shingles import mixed, portions, shared, shingles

POSITIONS = 128
BAND_ROWS = 4
SIMILARITY = 0.8
BUCKET_ROUNDS = 2
GROWTH = 8


def signatures(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """BagMinHash signatures (times as floats) of multisets given as sorted values; an empty multiset has infinities."""
    sizes = np.diff(ends, prepend=0)
    owner = np.repeat(np.arange(len(ends)), sizes)
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(at, append=len(values))
    element, doc = values[at], owner[at]
    found = np.full((len(ends), POSITIONS), np.inf)
    level = 0
    parts = []
    while True:
        low = 0 if level == 0 else 1 << (level - 1)
        has = np.flatnonzero(weight > low)
        if not len(has):
            break
        parts.append((doc[has], mixed(element[has] + np.uint64(0x9E37 * (level + 1))), weight[has], np.full(len(has), low), np.full(len(has), max(1, low))))
        level += 1
    if not parts:
        return found
    doc, seed, weight, low, width = (np.concatenate(x) for x in zip(*parts, strict=True))
    time, step = np.zeros(len(doc)), 0
    flat = found.reshape(-1)
    while len(doc):
        step += 1
        draw = mixed(seed + np.uint64(step * 0xD1342543DE82EF95 % (1 << 64)))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / width
        other = mixed(draw + np.uint64(0x632BE59BD9B4E019))
        mark = low + width * ((other >> np.uint64(40)).astype(np.float64) / 2.0**24)
        place = doc * POSITIONS + (other & np.uint64(POSITIONS - 1)).astype(np.int64)
        ok = mark < weight
        np.minimum.at(flat, place[ok], time[ok])
        alive = time < found.max(axis=1)[doc]
        doc, seed, weight, low, width, time = (x[alive] for x in (doc, seed, weight, low, width, time))
    return found


def bands(found: np.ndarray) -> np.ndarray:
    """One hash for each run of BAND_ROWS positions, with the band's number in it."""
    bits = found.view(np.uint64).reshape(len(found), -1, BAND_ROWS)
    out = np.zeros(bits.shape[:2], dtype=np.uint64)
    for i in range(BAND_ROWS):
        out += mixed(bits[:, :, i] + np.uint64(i + 1))
    return mixed(out + np.arange(out.shape[1], dtype=np.uint64)).view(np.int64)


def node_of(text: Column) -> Column:
    """What identifies a text: the 16 bytes of its MD5."""
    return F.unhex(F.md5(text.cast("binary")))


def _batches(df: DataFrame) -> DataFrame:
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def _portions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop in portions(batch.column(1)):
            yield batch.slice(start, stop - start)


def sign(texts: DataFrame) -> DataFrame:
    """node, size (number of shingles) and band keys of texts (node, text); texts without shingles are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            values, ends = shingles(batch.column(1))
            full = np.diff(ends, prepend=0) > 0
            sizes = pa.array(np.diff(ends, prepend=0)[full].astype(np.int64))
            keys = bands(signatures(values, ends)[full])
            offsets = np.arange(len(keys) + 1, dtype=np.int32) * (POSITIONS // BAND_ROWS)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(full)), sizes, lists], names=["node", "size", "keys"])

    return _batches(texts).mapInArrow(run, "node binary, size long, keys array<long>")


def sets_of(texts: DataFrame) -> DataFrame:
    """node and its sorted shingle hashes as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _portions(batches):
            values, ends = shingles(batch.column(1))
            parts = [values[a:b].tobytes() for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(parts, pa.binary())], names=["node", "shingles"])

    return _batches(texts).mapInArrow(run, "node binary, shingles binary")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (node, leader) whose multiset similarity reaches SIMILARITY."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = (c.to_pylist() for c in batch.columns[2:])
            keep = []
            for x, y in zip(own, other, strict=True):
                a, b = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                common = shared(a, b) if min(len(a), len(b)) >= SIMILARITY * max(len(a), len(b)) else 0
                keep.append(common >= SIMILARITY * (len(a) + len(b) - common))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sets, "node").join(sets.select(F.col("node").alias("leader"), F.col("shingles").alias("other")), "leader")
    return _batches(joined.select("node", "leader", "shingles", "other")).mapInArrow(run, "node binary, leader binary")


def most_frequent(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """For each key the value that occurs most often; of equally frequent ones the least."""
    counts = df.groupBy(*keys, value).agg((-F.count(F.lit(1))).alias("times"))
    return counts.groupBy(*keys).agg(F.min(F.struct("times", value))[value].alias(value))


def to_leaders(members: DataFrame, families: bool) -> DataFrame:
    """Pairs (node, leader) from members (key..., node, size); a leader comes before its nodes by size and node.

    The first member by that order leads a bucket. With ``families``, a node follows whoever leads most of its
    buckets, and a bucket's leader is the one that most of its members follow, unless that one comes after a member: so all
    buckets of a family of near copies get one leader, whether it is in the bucket or not.
    """
    keys = [c for c in members.columns if c not in ("node", "size")]
    first = members.groupBy(*keys).agg(F.min(F.struct("size", "node")).alias("first"))
    led = members.join(first, keys)
    if families:
        followed = most_frequent(led.select("node", F.col("first").alias("chosen")), ["node"], "chosen")
        chosen = most_frequent(members.select(*keys, "node").join(followed, "node"), keys, "chosen")
        led = led.join(chosen, keys).withColumn("first", F.least("first", "chosen"))
    return led.where(F.col("node") != F.col("first.node")).select("node", F.col("first.node").alias("leader")).distinct()


def crowded(members: DataFrame, keys: list[str]) -> DataFrame:
    """Members of buckets that hold more than one."""
    sizes = members.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return members.join(sizes, keys)


def still_open(members: DataFrame, labels: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """Members, with their present component, of buckets that hold more than one component."""
    now = members.drop("component").join(hinted(labels, few), "node")
    several = now.groupBy(*keys).agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a != b").select(*keys)
    return now.join(several, keys)


def rare_groups(sets: DataFrame) -> DataFrame:
    """Members (shingle, node, size, rest) of groups of texts below their rarest shingles, for texts (node, shingles).

    The occurrences of a shingle count as different ones. Texts of sizes a and b that link have 0.8 (a + b) / 1.8 in common, no
    less than 0.8 a, so among the rarest a / 5 + 1 of the one and b / 5 + 1 of the other, by an order that all texts share,
    there is a common one. Shingles of one text only come first and form no group. ``rest`` is how many shingles of the text
    come from this one on: two texts have no more than the lesser rest in common if this is the first that they share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values = np.frombuffer(data, dtype=np.uint64)
                nth = np.arange(len(values)) - np.searchsorted(values, values)
                tokens = mixed(values + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)
                columns = [pa.array([node] * len(tokens), pa.binary()), pa.array(tokens), pa.array(np.full(len(tokens), len(tokens)))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "shingle", "size"])

    tokens = kept(_batches(sets.select("node", "shingles")).mapInArrow(run, "node binary, shingle long, size long"), "tokens")
    often = kept(tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "often")
    placed = tokens.join(often, "shingle")
    alone = F.col("size") - F.size("many")
    many = placed.groupBy("node", "size").agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("many"))
    room = F.floor((1 - SIMILARITY) * F.col("size") + 1e-6) + 1 - alone
    first = F.slice(F.col("many.shingle"), F.lit(1), F.least(room, F.size("many")).cast("int"))
    chosen = many.where(room > 0).select("node", "size", F.size("many").alias("most"), F.posexplode(first).alias("place", "shingle"))
    return crowded(chosen.select("shingle", "node", "size", (F.col("most") - F.col("place")).alias("rest")), ["shingle"])


def kept(df: DataFrame, label: str) -> DataFrame:
    """The frame as a written table in the shared folder, so that nothing before it is computed twice."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def to_some(members: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (node, leader) of each group's members with up to ``salts`` leaders of other components, and the members without these leaders.

    Members (shingle, node, size, rest, component); the first of each salt by size and node leads. A pair whose rests are less
    than a link needs is left to the group of the first shingle that both share, where they are enough if it links.
    """
    salted = members.withColumn("salt", F.pmod(F.xxhash64("node", "shingle"), F.lit(salts)))
    leaders = salted.groupBy("shingle", "salt").agg(F.min(F.struct("size", "node", "component", "rest")).alias("first")).select("shingle", "first.*")
    others = leaders.select("shingle", *(F.col(c).alias(f"b_{c}") for c in ("node", "size", "component", "rest")))
    alike = (1 + SIMILARITY) * F.least("rest", "b_rest") >= SIMILARITY * (F.col("size") + F.col("b_size")) - 1e-6
    met = members.join(others, "shingle").where(F.col("component") != F.col("b_component")).where(alike)
    pairs = met.select(F.greatest("node", "b_node").alias("node"), F.least("node", "b_node").alias("leader")).distinct()
    return pairs, members.join(leaders.select("shingle", "node"), ["shingle", "node"], "left_anti")


def relabel(labels: DataFrame, edges: DataFrame, few: bool) -> DataFrame:
    """Labels (node, component) after the links (node, leader); only components that meet are worked on.

    ``few`` says that labels have been counted and have at most BROADCAST_ROWS rows.
    """
    ends = [hinted(labels.select(F.col("node").alias(n), F.col("component").alias(c)), few) for n, c in (("node", "a"), ("leader", "b"))]
    met = kept(edges.join(ends[0], "node").join(ends[1], "leader").where("a != b").select(F.col("a").alias("node"), F.col("b").alias("leader")).distinct(), "met")
    if met.isEmpty():
        return labels
    joined = components(met, few).select(F.col("node").alias("component"), F.col("component").alias("new"))
    new = labels.join(hinted(joined, few), "component", "left").select("node", F.coalesce("new", "component").alias("component"))
    return kept(new, "labels")


def hinted(df: DataFrame, few: bool) -> DataFrame:
    """The frame, with a broadcast hint if its rows have been counted and are few."""
    return F.broadcast(df) if few else df


def classes_of(texts: DataFrame) -> DataFrame:
    """node and component of the texts (node, text) that share a bucket with another: chains of texts that reach SIMILARITY."""
    spark = texts.sparkSession
    signed = kept(sign(texts).dropDuplicates(["node"]), "signed")
    members = kept(crowded(signed.select(F.explode("keys").alias("key"), "node", "size"), ["key"]), "buckets")
    labels = kept(members.select("node", F.col("node").alias("component")).distinct(), "labels")
    few = labels.count() <= BROADCAST_ROWS
    sets = kept(sets_of(texts.join(hinted(labels.select("node"), few), "node", "left_semi").dropDuplicates(["node"])), "shingles")
    for step in range(BUCKET_ROUNDS):
        pairs = kept(to_leaders(members.select("key", "node", "size"), families=step == 0), "pairs")
        labels = relabel(labels, linked(pairs, sets), few)
        if step:
            first = members.groupBy("key").agg(F.min(F.struct("size", "node"))["node"].alias("node"))
            members = members.join(first, ["key", "node"], "left_anti")
        members = kept(still_open(members, labels, ["key"], few), "buckets")
    left = kept(members.select("node").distinct(), "nodes")
    if left.isEmpty():
        return labels
    sets = kept(sets.join(broadcast_below(left), "node", "left_semi"), "shingles")
    groups = kept(still_open(rare_groups(sets), labels, ["shingle"], few), "groups")
    tried, salts = [], 1
    while not groups.isEmpty():
        pairs, rest = to_some(groups, salts)
        if tried:
            pairs = pairs.join(spark.read.parquet(*tried), ["node", "leader"], "left_anti")
        tried.append(scratch_path(spark, "pairs"))
        pairs.write.parquet(tried[-1])
        labels = relabel(labels, linked(spark.read.parquet(tried[-1]), sets), few)
        groups, salts = kept(still_open(rest, labels, ["shingle"], few), "groups"), GROWTH * salts
    return labels


def components(edges: DataFrame, few: bool = False) -> DataFrame:
    """node and component (its smallest node) for all nodes of the written edges, by label spreading with pointer jumps."""
    both = edges.unionByName(edges.select(F.col("leader").alias("node"), F.col("node").alias("leader")))
    labels = kept(both.groupBy("node").agg(F.least(F.min("leader"), F.col("node")).alias("component")), "labels")
    while True:
        near = both.join(hinted(labels.select(F.col("node").alias("leader"), "component"), few), "leader").select("node", "component", F.lit(None).cast("binary").alias("old"))
        least = near.unionByName(labels.withColumn("old", F.col("component"))).groupBy("node").agg(F.min("component").alias("component"), F.max("old").alias("old"))
        jump = least.select(F.col("node").alias("component"), F.col("component").alias("far"))
        new = kept(least.join(jump, "component", "left").select("node", F.least("component", "far").alias("component"), "old"), "labels")
        labels = new.select("node", "component")
        if new.where("component != old").isEmpty():
            return labels


def _named(docs: DataFrame) -> DataFrame:
    text = F.col("text")
    return docs.where(F.trim(F.translate(text, "\t\n\v\f\r", "     ")) != "").select("doc_id", node_of(text).alias("node"), F.lower(text).alias("text"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """The class of every document: chains of texts with a multiset similarity of SIMILARITY over five-word shingles.

    Returns doc_id, class_id (the smallest doc_id of the class), class_size (rows in it). Words are lower-cased and
    split at ASCII white space; a text of one to four words is one shingle. Exact copies share a class, repeated rows
    and doc_ids included. Null texts and texts without words form classes of their own row; a class without any
    doc_id has the class_id null. Other columns are not looked at.
    """
    named = _named(docs)
    labels = classes_of(named.select("node", "text"))
    rows = named.select("doc_id", "node").join(labels, "node", "left")
    rows = rows.select("doc_id", F.coalesce("component", "node").alias("component"))
    classes = rows.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    bare = docs.where(F.coalesce(F.trim(F.translate("text", "\t\n\v\f\r", "     ")), F.lit("")) == "")
    alone = bare.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return rows.join(classes, "component").select("doc_id", "class_id", "class_size").unionByName(alone)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class with all its columns: the smallest doc_id (null last), of its texts the smallest node.

    Rows with a null text or without words are all kept.
    """
    named = _named(docs)
    labels = classes_of(named.select("node", "text"))
    rows = named.select("doc_id", "node").groupBy("doc_id", "node").agg(F.count(F.lit(1)).alias("n")).join(labels, "node", "left")
    group = F.coalesce("component", "node").alias("component")
    rows = rows.select("doc_id", "node", "n", group)
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")
    best = rows.groupBy("component").agg(F.min(order).alias("best"))
    chosen = kept(rows.join(best, "component").withColumn("stays", order == F.col("best")).where("not stays or n > 1"), "losers")
    losers = broadcast_below(chosen.select(F.col("doc_id").alias("lost_id"), F.col("node").alias("lost_node")))

    def lost(df: DataFrame, other: DataFrame) -> Column:
        return F.coalesce(node_of(df["text"]), F.lit("").cast("binary")).eqNullSafe(other["lost_node"]) & df["doc_id"].eqNullSafe(other["lost_id"])

    once = docs.join(losers, lost(docs, losers), "left_anti")
    repeated = chosen.where("stays").select(F.col("doc_id").alias("lost_id"), F.col("node").alias("lost_node"))
    if not repeated.isEmpty():
        again = docs.join(broadcast_below(repeated), lost(docs, repeated), "left_semi")
        once = once.unionByName(again.withColumn("lost_node", node_of(F.col("text"))).dropDuplicates(["doc_id", "lost_node"]).drop("lost_node"))
    return once

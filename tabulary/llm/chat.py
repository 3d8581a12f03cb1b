"""Chat formatting: collapse cumulative snapshots by rolling turn-prefix hashes, then render what is left.

Logs often hold a conversation again and again while it grows. Each turn is hashed with its position, and
running sums of these hashes identify every prefix. A conversation whose whole hash is a proper prefix of another
one goes; of equal ones the smallest conv_id stays. Sums run in chunks of turns, so a very long
conversation is spread over tasks, and the rendered text comes in parts of bounded length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bagminhash import kept

CHUNK = 256
SUMS = 3
BITS = 40


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with position (from 1) and chunk; repeated rows count once.

    Rows without conv_id or turn take no part; a null role or text counts as empty. Rows that share a turn follow each other by role and text.
    """
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")]
    rows = conversations.select("conv_id", "turn", *text).where("conv_id is not null and turn is not null").distinct()
    rows = rows.withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    sizes = rows.groupBy("conv_id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("conv_id", "chunk", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "chunk").orderBy("turn", "role", "text"))
    return rows.join(sizes, ["conv_id", "chunk"]).withColumn("position", F.col("before") + inside).drop("before")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id and position with the running hash up to there: SUMS sums of BITS-bit hashes of (position, role, text)."""
    names = [f"h{i}" for i in range(SUMS)]

    def hashed(i: int) -> Column:
        return F.xxhash64("position", "role", "text", F.lit(i)).bitwiseAND(F.lit((1 << BITS) - 1))

    rows = turns.select("conv_id", "chunk", "position", *[hashed(i).alias(n) for i, n in enumerate(names)])
    totals = rows.groupBy("conv_id", "chunk").agg(*[F.sum(n).alias(n) for n in names])
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("conv_id", "chunk", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias("before_" + n) for n in names])
    running = Window.partitionBy("conv_id", "chunk").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    joined = rows.join(totals, ["conv_id", "chunk"])
    return joined.select("conv_id", "position", *[(F.col("before_" + n) + F.sum(n).over(running)).alias(n) for n in names])


def maximal(prefixes: DataFrame) -> DataFrame:
    """conv_id, turns and copies of the conversations that are no proper prefix of another one, equal ones once."""
    names = ["position", *(f"h{i}" for i in range(SUMS))]
    sizes = prefixes.groupBy("conv_id").agg(F.max("position").alias("turns"))
    marked = prefixes.join(sizes, "conv_id")
    whole = marked.where("position = turns").groupBy(*names).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"))
    inner = marked.where("position < turns").select(*names).distinct()
    return whole.join(inner, names, "left_anti").select("conv_id", F.col("position").alias("turns"), "copies")


def render(conversations: DataFrame) -> DataFrame:
    """The maximal conversations as chat text.

    Returns conv_id, part (from 0), turns and copies (of the whole conversation) and text: for each turn
    ``<|role|>``, a line break, the text and ``<|end|>`` with a line break. A part holds the turns whose numbers share
    a multiple of CHUNK, so no conversation is gathered whole. An empty table gives no rows; other columns are not looked at.
    """
    turns = kept(turns_of(conversations), "turns")
    left = maximal(kept(prefix_hashes(turns), "prefixes"))
    line = F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>\n"))
    rows = turns.join(left, "conv_id").select("conv_id", "chunk", "turns", "copies", F.struct("position", line.alias("line")).alias("line"))
    parts = rows.groupBy("conv_id", "chunk", "turns", "copies").agg(F.array_sort(F.collect_list("line"))["line"].alias("lines"))
    return parts.select("conv_id", F.col("chunk").alias("part"), "turns", "copies", F.array_join("lines", "").alias("text"))

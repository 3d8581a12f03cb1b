"""Landing folder to published history, one micro-batch at a time.

Every batch is merged with the shards it touches and published; a file that is
delivered twice changes nothing, and a late complete row fills a partial one. The commit that publishes a batch holds
its number, so a batch that Spark runs again, because the stream ended between the commit and its own checkpoint,
is recognised and left out: every batch is published once. There is no watermark: late rows must always be admitted. The state is the store itself,
so it is bounded by the history and survives restarts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import combine_partial, enriching_merge
from ..plans.store import ShardStore
from ..plans.updates import RunMetrics, merge_and_publish


def merge_batch(
    store: ShardStore, batch: DataFrame, keys: list[str], values: list[str], number: tuple[str, int] | None = None,
) -> RunMetrics:
    """Merge one batch. Rows of one key inside it are united first: a null yields to a
    value, and two different values conflict. ``number`` names the stream and its batch."""
    rows = combine_partial(batch, keys, values).checked()
    return merge_and_publish(store, rows, lambda h, s: enriching_merge(h, s, keys, values), batch=number)


def batch_merger(
    store: ShardStore, decode: Callable[[DataFrame], DataFrame], keys: list[str], values: list[str], stream: str,
    replayed: list[int] | None = None,
) -> Callable[[DataFrame, int], None]:
    """What is done with each batch of a stream; numbers of batches that were published before go to ``replayed``."""
    def merge(batch: DataFrame, number: int) -> None:
        if number <= store.last_batch(stream):
            if replayed is not None:
                replayed.append(number)
            return
        cells = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not cells.isEmpty():
                merge_batch(store, decode(cells), keys, values, (stream, number))
        finally:
            cells.unpersist()

    return merge


def stream_feed(
    spark: SparkSession,
    landing: str,
    schema: str,
    decode: Callable[[DataFrame], DataFrame],
    store: ShardStore,
    keys: list[str],
    values: list[str],
    checkpoint: str,
    files_per_batch: int = 100,
    replayed: list[int] | None = None,
) -> StreamingQuery:
    """Start the stream over all files landed so far and stop when they are done.

    ``decode`` turns the text columns of the landing files into keys and values. The checkpoint names the stream.
    """
    cells = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(landing)
    )

    return (
        cells.writeStream.foreachBatch(batch_merger(store, decode, keys, values, checkpoint, replayed))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

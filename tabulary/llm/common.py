"""Shared pieces of the operators: table access, Arrow batches, sampling by hash."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructType

BATCH_ROWS = 500
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def map_rows(df: DataFrame, work: Callable[[Iterable[tuple]], Iterator[tuple]], schema: str | StructType) -> DataFrame:
    """Pass the rows of each Arrow batch to ``work`` as tuples and collect the tuples it yields.

    Batches hold few rows, so that a batch of long texts fits into a Python worker. ``work`` gets one
    iterable per batch and lives as long as the partition, so it can keep caches between batches.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    fields = list(to_arrow_schema(DataType.fromDDL(schema) if isinstance(schema, str) else schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(work(zip(*(c.to_pylist() for c in batch.columns), strict=True)))
            if rows:
                columns = zip(fields, zip(*rows, strict=True), strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for f, v in columns], names=[f.name for f in fields])

    return df.mapInArrow(run, schema)


def broadcast_below(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A written table with a broadcast hint if it has at most ``rows`` rows; beyond that Spark shuffles both sides.

    For tables of a few narrow columns, so that the bound on rows bounds the bytes.
    """
    return F.broadcast(df) if df.count() <= rows else df


def fraction(column: Column) -> Column:
    """A uniform number in [0, 1) that depends on the value alone, for samples that every run repeats."""
    return F.pmod(F.xxhash64(column.cast("string"), F.lit("sample")), F.lit(1 << 40)) / F.lit(float(1 << 40))


def fold(column: Column, parts: int) -> Column:
    """The fold of a document: crc32 of its id as text; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(parts))

"""Integrity of what was published: files, references and contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ContractError
from ..operators.aggregates import digest, file_digests
from ..operators.joins import reference_gaps, row_differences


def write_json_shards(df: DataFrame, shard: str, keys: list[str], path: str) -> None:
    """Records as JSON lines, one folder per shard, sorted by key."""
    (
        df.repartitionByRange(shard, *keys)
        .sortWithinPartitions(shard, *keys)
        .write.mode("overwrite")
        .partitionBy(shard)
        .option("ignoreNullFields", False)
        .json(path)
    )


def file_manifest(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Name, length and sha256 of every file below a path."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return file_digests(files, path)


def file_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Files that are missing, unlisted, or differ in length or digest."""
    e = expected.select("file", F.col("bytes").alias("expected_bytes"), F.col("sha256").alias("expected_sha256"))
    a = actual.select("file", "bytes", "sha256")
    same = F.col("expected_bytes").eqNullSafe(F.col("bytes")) & F.col("expected_sha256").eqNullSafe(F.col("sha256"))
    return e.join(a, "file", "full_outer").filter(~same).select(
        "file",
        F.when(F.col("sha256").isNull(), "missing_file").when(F.col("expected_sha256").isNull(), "unreferenced_file")
        .otherwise("digest_mismatch").alias("problem"),
    )


def read_verified(spark: SparkSession, path: str, expected: DataFrame, schema, pattern: str = "*.json") -> DataFrame:
    """Read JSON shards only when every file matches the manifest byte for byte."""
    wrong = file_differences(expected, file_manifest(spark, path, pattern)).limit(3).collect()
    if wrong:
        raise ContractError("digest_mismatch", ", ".join(f"{r['file']}: {r['problem']}" for r in wrong))
    return spark.read.schema(schema).json(path)


def manifest_gaps(manifest: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return reference_gaps(manifest, present, key)


def published_differences(lookups: DataFrame, canonical: DataFrame) -> DataFrame:
    """Lookup records that are not canonical records, or the reverse."""
    return row_differences(lookups.select(*canonical.columns), canonical)


def bucketed_differences(published: DataFrame, canonical: DataFrame, keys: list[str], buckets: int = 256) -> DataFrame:
    """Rows on one side only, with ``side``; only rows of buckets whose digests differ are compared.

    Both sides are reduced to one digest per bucket of keys, so equal tables cost one pass and no row is joined.
    """
    bucket = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int").alias("bucket")
    sides = [df.select(bucket, *canonical.columns) for df in (published, canonical)]
    digests = [digest(df, ["bucket"]).select("bucket", F.struct("record_count", "digest_xor", "digest_sum").alias(name)) for df, name in zip(sides, ("p", "c"), strict=True)]
    differing = digests[0].join(digests[1], "bucket", "full_outer").where(~F.col("p").eqNullSafe(F.col("c"))).select("bucket")
    # At most ``buckets`` rows.
    some = [df.join(F.broadcast(differing), "bucket", "left_semi").drop("bucket") for df in sides]
    return row_differences(*some)


def dangling_paths(named: DataFrame, present: DataFrame) -> DataFrame:
    """path named by an envelope, manifest or index that is not there."""
    return named.select("path").distinct().join(present.select("path"), "path", "left_anti")

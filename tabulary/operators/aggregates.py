"""Duplicate checks, manifests, digests and catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def row_hash(columns: list[str], tag: int = 0) -> Column:
    """64-bit row hash in which a null differs from every value and from its place."""
    parts = [F.lit(tag)]
    for name in columns:
        parts += [F.isnull(name), F.col(name)]
    return F.xxhash64(*parts)


def digest_columns(columns: list[str]) -> list[Column]:
    """Digest of a set of rows that does not depend on their order.

    The exclusive-or alone would lose pairs of equal rows; the sum of a second hash
    keeps them.
    """
    return [
        F.count(F.lit(1)).alias("record_count"),
        F.bit_xor(row_hash(columns)).alias("digest_xor"),
        F.sum(row_hash(columns, 1).cast("decimal(20,0)")).cast("decimal(38,0)").alias("digest_sum"),
    ]


def digest(df: DataFrame, by: list[str] = ()) -> DataFrame:
    columns = sorted(c for c in df.columns if c not in by)
    return df.groupBy(*by).agg(*digest_columns(columns))


def file_digests(files: DataFrame, root: str | None = None) -> DataFrame:
    """Length and sha256 of whole files read as ``binaryFile``.

    A file is named by its path below ``root``, or by its last component.
    """
    folder = None if root is None else "/" + root.rstrip("/").rsplit("/", 1)[-1] + "/"
    name = F.substring_index("path", "/" if folder is None else folder, -1)
    return files.select(
        name.alias("file"),
        "path",
        F.length("content").cast("bigint").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


def shard_manifest(df: DataFrame, shard: str, key: str) -> DataFrame:
    """Per shard: count, first and last key."""
    return df.groupBy(shard).agg(
        F.count(F.lit(1)).alias("record_count"), F.min(key).alias("first_key"), F.max(key).alias("last_key")
    )


def manifest_totals(manifest: DataFrame) -> DataFrame:
    """Whole-dataset line from the shard lines, so the data is read once."""
    return manifest.agg(
        F.sum("record_count").alias("record_count"),
        F.count(F.lit(1)).alias("shard_count"),
        F.min("first_key").alias("first_key"),
        F.max("last_key").alias("last_key"),
    )


def rate_manifest(df: DataFrame, rate: str) -> DataFrame:
    return df.groupBy(rate).agg(F.count(F.lit(1)).alias("record_count"))


def table_manifest(tables: DataFrame) -> DataFrame:
    """Number of select and ultimate values in each nested mortality table."""
    select_count = F.aggregate(
        F.map_values("select_rates"), F.lit(0), lambda total, values: total + F.size(values)
    )
    return tables.select(
        "table_id",
        select_count.cast("bigint").alias("select_rate_count"),
        F.size("ultimate_rates").cast("bigint").alias("ultimate_rate_count"),
    )


def table_manifest_from_rows(select_rows: DataFrame, ultimate_rows: DataFrame) -> DataFrame:
    """The same from the long form."""
    return (
        select_rows.select("table_id", F.lit(1).alias("s"), F.lit(0).alias("u"))
        .unionByName(ultimate_rows.select("table_id", F.lit(0).alias("s"), F.lit(1).alias("u")))
        .groupBy("table_id")
        .agg(F.sum("s").alias("select_rate_count"), F.sum("u").alias("ultimate_rate_count"))
    )


def catalog(manifests: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """One line per dataset over (name, layout, shard manifest) inputs."""
    lines = None
    for name, layout, manifest in manifests:
        line = manifest_totals(manifest).select(
            F.lit(name).alias("dataset_id"), F.lit(layout).alias("record_storage"), "record_count",
            "shard_count", F.col("first_key").cast("string"), F.col("last_key").cast("string"),
        )
        lines = line if lines is None else lines.unionByName(line)
    return lines


def lookup_statistics(df: DataFrame, by: list[str], key: str) -> DataFrame:
    """Record count, number of lookup keys, first and last key.

    Counting per key first keeps the distinct count a plain sum and lets copies of a
    busy key collapse before they travel.
    """
    per_key = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.groupBy(*by).agg(
        F.sum("n").alias("record_count"), F.count(F.lit(1)).alias("file_count"),
        F.min(key).alias("first_key"), F.max(key).alias("last_key"),
    )


def records_per_key(
    df: DataFrame, by: list[str], order: list[str], chunk: Column, record: Column, part_rows: int = 1_000,
) -> DataFrame:
    """Records of a key in order, as one array for each ``part`` (from 0) of at most ``part_rows`` records.

    A key may have any number of records: positions come chunk by chunk, and no array holds more than a part.
    """
    from .windows import sequence_number

    placed = sequence_number(df, by, order, chunk, "position")
    return (
        placed.groupBy(*by, F.floor((F.col("position") - 1) / part_rows).alias("part"))
        .agg(F.array_sort(F.collect_list(F.struct("position", record.alias("record"))))["record"].alias("records"))
    )


def period_union(df: DataFrame, by: str, periods: str) -> DataFrame:
    """Distinct (source, period) pairs over all entries of a source.

    Long form: a source may have any number of periods.
    """
    return df.select(by, F.explode(periods).alias("period")).distinct()

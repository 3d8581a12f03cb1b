"""Lookups: published envelopes, and queries against the stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ContractError
from ..functions.records import record_key, route_key
from ..operators.aggregates import duplicate_keys, lookup_statistics, records_per_key
from ..operators.windows import sequence_number
from ..registry import DATASETS, Dataset
from .store import ShardStore


def canonical_path(data: Dataset, key: Column) -> Column:
    """Where the canonical record is published."""
    slug = data.folder.rsplit("/", 1)[-1]
    if data.layout == "by_year":
        return F.concat(F.lit(f"{data.folder}/by-year/"), F.substring(key, 1, 4), F.lit(f"-{slug}.json"))
    return F.lit(f"{data.folder}/{data.name}.json")


def lookup_rows(df: DataFrame, data: Dataset, route: Column | None = None) -> DataFrame:
    """One row per record with its lookup key and the record as a struct."""
    key = record_key(df)
    route = route_key(key, data.route == "by-year") if route is None else route
    return df.select(
        F.lit(data.name).alias("dataset_id"),
        F.lit(data.folder).alias("dataset_path"),
        route.alias("record_key"),
        canonical_path(data, key).alias("canonical_record_path"),
        F.lit(f"{data.folder}/manifest.json").alias("canonical_manifest_path"),
        F.struct(*data.columns).alias("record"),
    )


def single_envelopes(df: DataFrame, data: Dataset) -> DataFrame:
    """One envelope per key for date and month routes; a repeated key is an error."""
    rows = lookup_rows(df, data)
    if not duplicate_keys(rows, ["record_key"]).isEmpty():
        raise ContractError("invalid_json", "repeated lookup key")
    return rows.select(*_header("api_record"), *rows.columns)


def grouped_envelopes(df: DataFrame, data: Dataset) -> DataFrame:
    """Envelopes per start year with the records in order: one for each part, of which a usual year has one."""
    rows = lookup_rows(df, data)
    paths = rows.groupBy("record_key").agg(F.sort_array(F.collect_set("canonical_record_path")).alias("canonical_record_paths"))
    by = ["dataset_id", "dataset_path", "record_key", "canonical_manifest_path"]
    placed = rows.withColumn("first_key", F.col(f"record.{data.keys[0]}"))
    grouped = records_per_key(placed, by, ["first_key", "record"], F.col("first_key"), F.col("record")).join(paths, "record_key")
    return grouped.select(*_header("api_records"), *by, "part", "canonical_record_paths", "records")


def grouped_rows(df: DataFrame, keys: list[str], order: list[str], chunk: Column) -> DataFrame:
    """Long form of grouped lookups for keys of any size: a position per record."""
    return sequence_number(df, keys, order, chunk, "position")


def latest_envelope(store: ShardStore, data: Dataset) -> DataFrame:
    """Newest record, keyed in full: date, month or the start date of the period."""
    newest = store.latest()
    rows = lookup_rows(newest.withColumn("full_key", record_key(newest)), data, F.col("full_key"))
    return rows.select(*_header("api_latest"), *rows.columns)


def _header(kind: str) -> list[Column]:
    return [F.lit(f"tabulary.{kind}.v1").alias("schema_id"), F.lit(1).alias("schema_version")]


def publish_envelopes(envelopes: DataFrame, path: str) -> None:
    """Envelopes as JSON text, partitioned by dataset and year, sorted by key."""
    header = ("schema_id", "schema_version", "dataset_id", "record_key")
    text = F.to_json(F.struct(*[c for c in envelopes.columns]), {"ignoreNullFields": "false"})
    (
        envelopes.select(*header, F.substring("record_key", 1, 4).alias("year"), text.alias("envelope"))
        .repartitionByRange("dataset_id", "year", "record_key")
        .sortWithinPartitions("dataset_id", "year", "record_key")
        .write.mode("overwrite")
        .partitionBy("dataset_id", "year")
        .parquet(path)
    )


def route_statistics(df: DataFrame, data: Dataset) -> DataFrame:
    return lookup_statistics(lookup_rows(df, data), ["dataset_id"], "record_key")


# Queries


def by_date(store: ShardStore, date: str, column: str = "date") -> DataFrame:
    """Record of a day; only that day's year shard is read."""
    return store.read([date[:4]]).filter(F.col(column) == F.lit(date).cast("date"))


def by_month(store: ShardStore, month: str, column: str = "effective_month") -> DataFrame:
    return store.read([month[:4]]).filter(F.col(column) == month)


def by_year(store: ShardStore, year: int, column: str = "period_start_date") -> DataFrame:
    """Records whose period starts in the year; later years of a period do not count."""
    return store.read().filter(
        F.col(column).between(F.lit(f"{year}-01-01").cast("date"), F.lit(f"{year}-12-31").cast("date"))
    )


def latest(store: ShardStore) -> DataFrame:
    return store.latest()


def factor(store: ShardStore, rate: int, **keys: int) -> DataFrame:
    """Factor row at a rate and an age, term or pair; one rate shard is read."""
    rows = store.read([f"{rate:05d}"])
    for name, value in keys.items():
        rows = rows.filter(F.col(name) == value)
    return rows


def select_rate(store: ShardStore, table_id: str, issue_age: int, duration: int) -> DataFrame:
    return store.read([table_id]).filter((F.col("issue_age") == issue_age) & (F.col("duration") == duration))


def ultimate_rate(store: ShardStore, table_id: str, attained_age: int) -> DataFrame:
    return store.read([table_id]).filter(F.col("attained_age") == attained_age)


def catalog(spark: SparkSession, stores: dict[str, ShardStore]) -> DataFrame:
    """Datasets with layout, counts, bounds and route, from the manifests alone."""
    lines = None
    for name, store in stores.items():
        data = DATASETS[name]
        line = store.totals().select(
            F.lit(name).alias("dataset_id"), F.lit(data.folder).alias("dataset_path"),
            F.lit(data.schema_id).alias("schema_id"), F.lit(data.schema_version).alias("schema_version"),
            F.lit(data.layout).alias("record_storage"), F.lit(data.route).cast("string").alias("route"),
            F.coalesce("record_count", F.lit(0)).alias("record_count"), "shard_count", "first_key", "last_key",
        )
        lines = line if lines is None else lines.unionByName(line)
    return lines

"""The published layout: named JSON files for shards, lookups, manifests and indexes, with digests.

    <dataset>/by-year/2016-slug.json, <dataset>/<dataset>.json, ...   canonical records, sorted, one array a file
    <dataset>/manifest.json                                          path, length, digest and bounds of each
    index.json                                                       the datasets and the digests of their manifests
    api/v1/datasets/<id>/<route>/<key>.json, latest.json, index.json lookups

Tasks write whole files below a staging folder and count and digest them on the way; each file yields one row. When
all are written, tasks compare each with what is published and move those that differ into place. Manifests are made from
the rows of the records, the indexes from those of the manifests, so a file is named only after it is there.
A task that runs again stages under a new name, and a move that was done already is recognised by the digest.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ContractError
from ..functions.records import record_key
from ..registry import DATASETS, Dataset
from ..session import scratch_path
from ..sources.files import files_below, opened, remove_paths
from . import lookup

API = "api/v1"
STAGING = ".staging"
ENTRY = "dataset_id string, path string, bytes long, sha256 string, record_count long, first_key string, last_key string"
ROW = ["dataset_id", "path", "listed", "key", "json"]
BATCH_ROWS = 2_000
PIECE = 1 << 20


def canonical_path(data: Dataset, key: Column | None = None, shard: Column | None = None) -> Column:
    """Where the record with this key (or in this rate or table shard) is published."""
    if data.layout == "by_rate":
        return F.concat(F.lit(f"{data.folder}/by-interest-rate/"), F.lpad(shard.cast("string"), 5, "0"), F.lit("-basis-points.json"))
    if data.layout == "by_table":
        return F.concat(F.lit(f"{data.folder}/by-table/"), shard, F.lit(".json"))
    return lookup.canonical_path(data, key)


def canonical_rows(df: DataFrame, data: Dataset) -> DataFrame:
    """(dataset_id, path, listed, key, json): the records of a dataset and the file each belongs to."""
    def text(columns: list[str]) -> Column:
        return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

    if data.layout == "by_rate":
        rest = [c for c in data.columns if c != data.rate_column]
        place = F.concat_ws("|", *[F.lpad(F.col(k).cast("string"), 12, "0") for k in data.keys])
        return df.select(F.lit(data.name).alias("dataset_id"), canonical_path(data, shard=F.col(data.rate_column)).alias("path"), F.lit(True).alias("listed"), place.alias("key"), text(rest).alias("json"))
    if data.layout == "by_table":
        return df.select(F.lit(data.name).alias("dataset_id"), canonical_path(data, shard=F.col("table_id")).alias("path"), F.lit(False).alias("listed"), F.col("table_id").alias("key"), text(data.columns).alias("json"))
    key = record_key(df) if {"date", "effective_month", "period_start_date"} & set(df.columns) else F.lpad(F.col(data.keys[0]).cast("string"), 12, "0")
    order = F.concat_ws("|", key, *[F.col(k).cast("string") for k in data.keys[1:]])
    return df.select(F.lit(data.name).alias("dataset_id"), canonical_path(data, key).alias("path"), F.lit(True).alias("listed"), order.alias("key"), text(data.columns).alias("json"))


def lookup_files(df: DataFrame, data: Dataset) -> DataFrame:
    """(dataset_id, path, listed, key, json) of a dataset's lookup files and of the newest record; without a route there are none."""
    made = lookup.grouped_envelopes(df, data) if data.route == "by-year" else lookup.single_envelopes(df, data)
    name = F.col("record_key")
    if data.route == "by-year":
        name = F.when(F.col("part") == 0, name).otherwise(F.concat(name, F.lit("-part-"), F.col("part")))
        made = made.withColumn("name", name).drop("part")
    else:
        made = made.withColumn("name", name)
    body = F.to_json(F.struct(*[c for c in made.columns if c != "name"]), {"ignoreNullFields": "false"})
    path = F.concat(F.lit(f"{API}/datasets/{data.name}/{data.route}/"), F.col("name"), F.lit(".json"))
    return made.select("dataset_id", path.alias("path"), F.lit(False).alias("listed"), F.col("record_key").alias("key"), body.alias("json"))


def latest_file(df: DataFrame, data: Dataset) -> DataFrame:
    """(dataset_id, path, listed, key, json) of the record with the greatest key."""
    newest = df.agg(F.max(F.struct(*data.keys, F.struct(*data.columns).alias("row"))).alias("m")).where("m is not null").select("m.row.*")
    made = lookup.lookup_rows(newest.withColumn("full_key", record_key(newest)), data, F.col("full_key"))
    made = made.select(F.lit("tabulary.api_latest.v1").alias("schema_id"), F.lit(1).alias("schema_version"), *made.columns)
    body = F.to_json(F.struct(*made.columns), {"ignoreNullFields": "false"})
    return made.select("dataset_id", F.lit(f"{API}/datasets/{data.name}/latest.json").alias("path"), F.lit(False).alias("listed"), F.col("record_key").alias("key"), body.alias("json"))


# Files, in tasks


class _File:
    """One file being written: canonical JSON, digested on the way."""

    def __init__(self, system: fs.FileSystem, folder: str, dataset_id: str, path: str, listed: bool):
        self.dataset_id, self.path, self.listed, self.staged = dataset_id, path, listed, uuid.uuid4().hex
        self.out = system.open_output_stream(f"{folder}/{self.staged}")
        self.sha, self.bytes, self.records, self.first, self.last = hashlib.sha256(), 0, 0, None, None

    def _put(self, text: str) -> None:
        data = text.encode()
        self.sha.update(data)
        self.bytes += len(data)
        self.out.write(data)

    def add(self, key: str, record: str) -> None:
        if self.records and not self.listed:
            raise ValueError(f"two records for {self.path}")
        text = json.dumps(json.loads(record), indent=2, ensure_ascii=False)
        if self.listed:
            text = (",\n  " if self.records else "[\n  ") + text.replace("\n", "\n  ")
        self._put(text)
        self.first = key if self.first is None else self.first
        self.records, self.last = self.records + 1, key

    def close(self) -> tuple:
        self._put("\n]\n" if self.listed else "\n")
        self.out.close()
        return self.dataset_id, self.path, self.bytes, self.sha.hexdigest(), self.records, self.first, self.last, self.staged


def _digest(system: fs.FileSystem, path: str) -> str | None:
    if system.get_file_info(path).type != fs.FileType.File:
        return None
    sha = hashlib.sha256()
    with system.open_input_stream(path) as source:
        while piece := source.read(PIECE):
            sha.update(piece)
    return sha.hexdigest()


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = {"bytes": pa.int64(), "record_count": pa.int64(), "changed": pa.bool_()}
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, columns, strict=True)], names=names)


def stage(rows: DataFrame, root: str, run: str) -> DataFrame:
    """Write the files of (dataset_id, path, listed, key, json) below the staging folder of a run: one row of ENTRY and ``staged`` for each.

    Records of a file follow each other by key. A file has one writer and is streamed, whatever its length.
    """
    names = [c.split()[0] for c in ENTRY.split(", ")] + ["staged"]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(root)
        folder, file, done = f"{base}/{STAGING}/{run}", None, []
        system.create_dir(folder, recursive=True)
        for batch in batches:
            for name, path, listed, key, record in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file is None or file.path != path:
                    if file is not None:
                        done.append(file.close())
                    file = _File(system, folder, name, path, listed)
                file.add(key, record)
            if len(done) >= BATCH_ROWS:
                yield _table(done, names)
                done = []
        if file is not None:
            done.append(file.close())
        if done:
            yield _table(done, names)

    placed = rows.select(*ROW).repartitionByRange("path").sortWithinPartitions("path", "key", "json")
    return placed.mapInArrow(write, f"{ENTRY}, staged string")


def move(staged: DataFrame, root: str, run: str) -> DataFrame:
    """Put staged files that differ from what is published into place; ENTRY with ``changed``."""
    names = [c.split()[0] for c in ENTRY.split(", ")] + ["changed"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(root)
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                path, sha, name = f"{base}/{row[1]}", row[3], f"{base}/{STAGING}/{run}/{row[7]}"
                there, waiting = _digest(system, path), system.get_file_info(name).type == fs.FileType.File
                if not waiting and there != sha:
                    raise OSError(f"{row[1]} is neither staged nor published")
                if waiting and there != sha:
                    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                    system.move(name, path)
                out.append((*row[:7], there != sha or not waiting))
            if out:
                yield _table(out, names)

    return staged.mapInArrow(work, f"{ENTRY}, changed boolean")


def write_files(rows: DataFrame, root: str) -> DataFrame:
    """Write and publish files; ENTRY and ``changed`` for each, as a written table."""
    spark, run = rows.sparkSession, uuid.uuid4().hex
    paths = [scratch_path(spark, "entries") for _ in range(2)]
    stage(rows, root, run).write.parquet(paths[0])
    move(spark.read.parquet(paths[0]), root, run).write.parquet(paths[1])
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{STAGING}/{run}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return spark.read.parquet(paths[1])


def unlisted(spark: SparkSession, root: str, entries: DataFrame, below: str = "") -> DataFrame:
    """path of the files below a folder of the root that no entry names."""
    return files_below(spark, root).where(F.startswith("path", F.lit(below))).join(entries.select("path"), "path", "left_anti")


# Manifests and indexes, as data

_LISTS = {"by_year": "years", "by_rate": "shards", "by_table": "tables", "single": "records"}


def _object(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def manifest_rows(entries: DataFrame, data: Dataset) -> DataFrame:
    """(dataset_id, path, listed, key, json) of a dataset's manifest, from the entries of its files; a bounded number by layout."""
    below = F.substring("path", len(data.folder) + 2, 1 << 20)
    line = F.struct(
        below.alias("path"), "bytes", "sha256", F.regexp_extract(F.substring_index("path", "/", -1), r"^(.*?)(-[a-z0-9-]+)?\.json$", 1).alias("shard"),
        "record_count", "first_key", "last_key")
    grouped = entries.agg(
        F.array_sort(F.collect_list(line)).alias(_LISTS[data.layout]), F.sum("record_count").alias("record_count"),
        F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key"))
    body = _object(
        dataset_id=F.lit(data.name), schema_id=F.lit(data.schema_id), schema_version=F.lit(data.schema_version),
        record_storage=F.lit(data.layout), record_count=F.coalesce("record_count", F.lit(0)), first_key=F.col("first_key"),
        last_key=F.col("last_key"), **{_LISTS[data.layout]: F.col(_LISTS[data.layout])})
    return grouped.select(F.lit(data.name).alias("dataset_id"), F.lit(f"{data.folder}/manifest.json").alias("path"), F.lit(False).alias("listed"), F.lit(data.name).alias("key"), body.alias("json"))


def _dataset_facts(spark: SparkSession, names: list[str]) -> DataFrame:
    rows = [(n, DATASETS[n].folder, DATASETS[n].schema_id, DATASETS[n].schema_version, DATASETS[n].layout, f"{DATASETS[n].folder}/manifest.json", DATASETS[n].route) for n in sorted(names)]
    schema = "dataset_id string, dataset_path string, schema_id string, schema_version int, record_storage string, manifest_path string, route string"
    return spark.createDataFrame(rows, schema)


def index_rows(records: DataFrame, manifests: DataFrame, lookups: DataFrame, names: list[str]) -> DataFrame:
    """(dataset_id, path, listed, key, json) of both indexes, from the entries of record files, manifests and lookups."""
    facts = _dataset_facts(records.sparkSession, names)
    counts = records.groupBy("dataset_id").agg(F.sum("record_count").alias("record_count"))
    digests = manifests.select(F.col("path").alias("manifest_path"), F.col("bytes").alias("manifest_bytes"), F.col("sha256").alias("manifest_sha256"))
    lines = facts.join(counts, "dataset_id", "left").join(digests, "manifest_path").withColumn("record_count", F.coalesce("record_count", F.lit(0)))
    shown = ["dataset_path", "dataset_id", "schema_id", "schema_version", "record_storage", "record_count", "manifest_path", "manifest_bytes", "manifest_sha256"]

    def file(path: str, kind: str, body: Column, rows: DataFrame) -> DataFrame:
        listed = rows.agg(F.array_sort(F.collect_list(body)).alias("datasets"))
        text = _object(schema_id=F.lit(kind), schema_version=F.lit(1), datasets=F.col("datasets"))
        return listed.select(F.lit("").alias("dataset_id"), F.lit(path).alias("path"), F.lit(False).alias("listed"), F.lit(kind).alias("key"), text.alias("json"))

    newest = F.endswith("path", F.lit("/latest.json"))
    latest = lookups.where(newest).select("dataset_id", F.struct("path", "bytes", "sha256", F.col("last_key").alias("record_key")).alias("latest"))
    routes = lookups.where(~newest).groupBy("dataset_id").agg(
        F.struct(F.count(F.lit(1)).alias("file_count"), F.min("first_key").alias("first_key"), F.max("last_key").alias("last_key")).alias("lookup"))
    api = lines.join(latest, "dataset_id", "left").join(routes, "dataset_id", "left")
    return file("index.json", "tabulary.index.v1", F.struct(*shown), lines).unionByName(
        file(f"{API}/index.json", "tabulary.api_index.v1", F.struct(*shown, "route", "latest", "lookup"), api))


def publish(spark: SparkSession, root: str, sets: dict[str, DataFrame]) -> DataFrame:
    """Publish datasets (name to records) as the whole content of a root; ENTRY and ``changed`` of every file that is there.

    Records and lookups are written first, then the manifests, then the indexes; last, files go that nothing names. Files
    that stay as they are are not touched. A dataset without records has a manifest only.
    """
    def union(parts: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, parts)

    data = {name: DATASETS[name] for name in sorted(sets)}
    repeated = [name for name, d in data.items() if not sets[name].groupBy(*d.keys).count().where("count > 1").isEmpty()]
    if repeated:
        raise ContractError("duplicate_key", ", ".join(repeated))
    routed = [name for name, d in data.items() if d.route]
    parts = [canonical_rows(sets[name], d) for name, d in data.items()]
    parts += [lookup_files(sets[name], data[name]) for name in routed] + [latest_file(sets[name], data[name]) for name in routed]
    entries = write_files(union(parts), root)
    served = F.startswith("path", F.lit(f"{API}/"))
    records, lookups = entries.where(~served), entries.where(served)
    manifests = write_files(union([manifest_rows(records.where(F.col("dataset_id") == n), d) for n, d in data.items()]), root)
    indexes = write_files(index_rows(records, manifests, lookups, list(data)), root)
    everything = union([entries, manifests, indexes])
    remove_paths(unlisted(spark, root, everything), root)
    return everything

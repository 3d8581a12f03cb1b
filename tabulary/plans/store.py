"""Published history as shards with a manifest; only changed shards are written.

Layout under the root:

    data/run=R/shard=S/*.parquet     rows of the shards that changed in run R
    manifest/run=R/*.parquet         one line per shard, naming the run that wrote it
    commits/0000000N.json            version N: the manifest of each store, the last batch of each stream

A run writes the changed shards and its manifest under names of its own and then creates the next commit file, which
only one writer can do; readers follow the newest commit, so they never see a half-written run, an unchanged
shard is not copied, and a stale shard disappears by not being listed. A writer that comes second puts its shards on top
of the newer version if that left them as they were, and is refused otherwise.
Several stores may share their commits: then all of them change at once.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import ContractError
from ..operators.aggregates import digest_columns, manifest_totals
from ..registry import Dataset
from ..sources.files import create_once, files_below, names_in, read_small, remove_paths
from ..sources.shards import empty, path_exists

MANIFEST = (
    "shard string, record_count bigint, first_key string, last_key string, "
    "digest_xor bigint, digest_sum decimal(38,0), written string"
)


@dataclass(frozen=True)
class Published:
    """What one publish did."""

    changed: bool
    version: int
    written: tuple[str, ...] = ()
    removed: tuple[str, ...] = ()


@dataclass(frozen=True)
class Prepared:
    """What a run has written and not yet committed."""

    run: str
    written: tuple[str, ...]
    removed: tuple[str, ...]
    lines: dict[str, tuple]


class ShardStore:
    """Shards of one dataset. ``shard`` and ``key`` default to the dataset's layout.

    ``commits`` names the folder of the commit files and ``member`` the store's name in them, for stores that change together.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType, keys: list[str], shard: Column,
        commits: str | None = None, member: str = "",
    ) -> None:
        self.spark, self.root, self.schema, self.keys = spark, root.rstrip("/"), schema, list(keys)
        self.shard = shard.cast("string")
        self.commits, self.member = commits or f"{self.root}/commits", member

    @classmethod
    def of(cls, spark: SparkSession, root: str, data: Dataset, schema: T.StructType | None = None) -> ShardStore:
        key = F.col(data.keys[0]).cast("string")
        shard = {
            "by_year": F.substring(key, 1, 4),
            "single": F.lit("all"),
            "by_rate": F.lpad(key, 5, "0"),
            "by_table": key,
        }[data.layout]
        return cls(spark, f"{root}/{data.folder}", schema or data.schema, list(data.keys), shard)

    # Reading

    def versions(self) -> list[int]:
        """Published versions, oldest first, by the names of their commit files."""
        return [int(name.removesuffix(".json")) for name in names_in(self.spark, f"{self.commits}/[0-9]*.json")]

    def commit_of(self, version: int) -> dict:
        """Manifest runs by store and last batches by stream, as a version has them."""
        if not version:
            return {"runs": {}, "batches": {}}
        return json.loads(read_small(self.spark, f"{self.commits}/{version:08d}.json"))

    def version(self) -> int:
        return max(self.versions(), default=0)

    def last_batch(self, stream: str) -> int:
        """The last batch of a stream that a version holds, -1 before the first."""
        return self.commit_of(self.version())["batches"].get(stream, -1)

    def lines(self, version: int | None = None) -> dict[str, Row]:
        """Manifest of a version (the newest by default) by shard. As many lines as shards: years, percentages or tables."""
        version = self.version() if version is None else version
        run = self.commit_of(version)["runs"].get(self.member)
        if run is None:
            return {}
        found = self.spark.read.schema(MANIFEST).parquet(f"{self.root}/manifest/run={run}")
        return {row["shard"]: row for row in found.withColumn("version", F.lit(version).cast("bigint")).collect()}

    def remove_stale(self, keep: int) -> DataFrame:
        """Delete what none of the newest ``keep`` versions lists: commit files, manifests and data folders; their paths.

        The data folders come from a distributed listing, those to go from an anti-join with the kept manifests, and
        tasks delete them. Call it when no reader uses an older version any more and no writer is at work.
        """
        if keep < 1:
            raise ValueError("at least one version stays")
        versions = self.versions()
        old, recent = versions[:-keep], versions[-keep:]
        runs = {v: self.commit_of(v)["runs"].get(self.member) for v in versions}
        kept = sorted({runs[v] for v in recent} - {None})
        found = files_below(self.spark, f"{self.root}/data", "*.parquet") if path_exists(self.spark, f"{self.root}/data") else None
        gone = [f"manifest/run={r}" for r in sorted({runs[v] for v in old} - {None} - set(kept))]
        own = self.commits == f"{self.root}/commits"
        gone += [f"commits/{v:08d}.json" for v in old if own]
        paths = self.spark.createDataFrame([(p,) for p in gone], "path string")
        if found is not None:
            folders = found.select(
                F.concat(F.lit("data/"), F.regexp_extract("path", "^(.*)/[^/]*$", 1)).alias("path"),
                F.regexp_extract("path", "^run=([^/]*)/", 1).alias("written"),
                F.url_decode(F.replace(F.regexp_extract("path", "/shard=([^/]*)/", 1), F.lit("+"), F.lit("%2B"))).alias("shard"),
            ).distinct()
            listed = empty(self.spark, T.StructType([T.StructField("written", T.StringType()), T.StructField("shard", T.StringType())]))
            if kept:
                manifests = self.spark.read.schema(MANIFEST).parquet(*[f"{self.root}/manifest/run={r}" for r in kept])
                listed = manifests.select("written", "shard").distinct()
            paths = paths.unionByName(folders.join(listed, ["written", "shard"], "left_anti").select("path"))
        return remove_paths(paths, self.root)

    def manifest(self) -> DataFrame:
        rows = [tuple(row)[:7] for row in self.lines().values()]
        return self.spark.createDataFrame(rows, MANIFEST)

    def totals(self) -> DataFrame:
        return manifest_totals(self.manifest())

    def read(self, shards: list[str] | None = None, lines: dict[str, Row] | None = None) -> DataFrame:
        """Rows of all or of the named shards, of the newest version or that of ``lines``; other shards are not even listed."""
        return self._read(self.lines() if lines is None else lines, shards)

    def _read(self, lines: dict[str, Row], shards: list[str] | None) -> DataFrame:
        wanted = [line for name, line in sorted(lines.items()) if shards is None or name in shards]
        if not wanted:
            return empty(self.spark, self.schema)
        by_run: dict[str, list[str]] = {}
        for line in wanted:
            by_run.setdefault(line["written"], []).append(line["shard"])
        stored = T.StructType(
            [*self.schema.fields, T.StructField("run", T.StringType()), T.StructField("shard", T.StringType())]
        )
        # Only directories of runs that still hold a wanted shard are listed, and the
        # partition filter leaves the wanted shards of each.
        holds = [
            (F.col("run") == run) & F.col("shard").isin(names) for run, names in by_run.items()
        ]
        return (
            self.spark.read.schema(stored)
            .option("basePath", f"{self.root}/data")
            .parquet(*[f"{self.root}/data/run={run}" for run in by_run])
            .filter(reduce(or_, holds))
            .select(*self.schema.fieldNames())
        )

    def latest(self) -> DataFrame:
        """Record with the greatest key, from the last shard only."""
        lines = self.lines()
        last = [max(lines)] if lines else []
        body = F.max(F.struct(*self.keys, F.struct(*self.schema.fieldNames()).alias("row")))
        return (
            self._read(lines, last)
            .agg(body.alias("m"))
            .filter(F.col("m").isNotNull())
            .select("m.row.*")
        )

    # Writing

    def shards_of(self, df: DataFrame) -> list[str]:
        """Names of the shards that rows belong to; a short list by layout."""
        return sorted(row[0] for row in df.select(self.shard.alias("s")).distinct().collect())

    def publish(
        self, df: DataFrame, touched: list[str] | None = None, base: int | None = None, batch: tuple[str, int] | None = None,
    ) -> Published:
        """Make ``df`` the content of the touched shards (all of them by default).

        ``base`` is the version that ``df`` was made from, the newest one by default; ``batch`` is a stream and the number of the batch.
        """
        base = self.version() if base is None else base
        prepared = self.prepare(df, touched, base)
        return commit_together([(self, prepared)], base, batch)[0]

    def prepare(self, df: DataFrame, touched: list[str] | None, base: int) -> Prepared:
        """Write the shards that differ from version ``base`` under a name of this run; nothing refers to them yet."""
        rows = df.select(*self.schema.fieldNames()).withColumn("shard", self.shard)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            return self._prepare(rows, self.lines(base), touched)
        finally:
            rows.unpersist()

    def _prepare(self, rows: DataFrame, lines: dict[str, Row], touched: list[str] | None) -> Prepared:
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in self.keys]) if len(self.keys) > 1 else F.col(self.keys[0]).cast("string")
        columns = sorted(self.schema.fieldNames())
        fresh = {
            row["shard"]: row
            for row in rows.groupBy("shard")
            .agg(*digest_columns(columns), F.min(key).alias("first_key"), F.max(key).alias("last_key"))
            .collect()
        }
        scope = set(lines) | set(fresh) if touched is None else set(touched)
        stray = set(fresh) - scope
        if stray:
            raise ValueError(f"rows outside the touched shards: {sorted(stray)[:5]}")
        digest = ("record_count", "digest_xor", "digest_sum")
        changed = sorted(
            s for s, row in fresh.items() if s not in lines or any(row[d] != lines[s][d] for d in digest)
        )
        removed = sorted(s for s in lines if s in scope and s not in fresh)
        run = uuid.uuid4().hex[:16]
        if changed:
            subset = rows if len(changed) == len(fresh) else rows.filter(F.col("shard").isin(changed))
            # Key ranges, so a shard of any size is written by as many tasks as it needs.
            (
                subset.repartitionByRange("shard", *self.keys)
                .sortWithinPartitions("shard", *self.keys)
                .write.partitionBy("shard")
                .parquet(f"{self.root}/data/run={run}")
            )
        added = {
            s: (s, fresh[s]["record_count"], fresh[s]["first_key"], fresh[s]["last_key"], fresh[s]["digest_xor"], fresh[s]["digest_sum"], run)
            for s in changed
        }
        return Prepared(run, tuple(changed), tuple(removed), added)

    def _write_manifest(self, lines: dict[str, Row], prepared: Prepared) -> str:
        """The manifest of a version with a prepared run on top of it; the run it is filed under."""
        run = uuid.uuid4().hex[:16]
        gone = {*prepared.written, *prepared.removed}
        rows = [tuple(line)[:7] for s, line in lines.items() if s not in gone] + list(prepared.lines.values())
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(f"{self.root}/manifest/run={run}")
        return run


def commit_together(
    work: list[tuple[ShardStore, Prepared]], base: int, batch: tuple[str, int] | None = None,
) -> list[Published]:
    """Make the prepared runs of stores that share their commits one new version, or none if they change nothing.

    If another run has committed since ``base`` and left the shards of these runs as they were, they go on top of its version;
    if it changed one of them, this run is refused and nothing of it is seen.
    """
    first = work[0][0]
    if not any(p.written or p.removed for _, p in work):
        return [Published(False, base) for _ in work]
    while True:
        newest = first.version()
        current = [store.lines(newest) for store, _ in work]
        if newest != base:
            for (store, prepared), now in zip(work, current, strict=True):
                before = store.lines(base)
                met = [s for s in (*prepared.written, *prepared.removed) if _content(before.get(s)) != _content(now.get(s))]
                if met:
                    raise ContractError("conflicting_version", f"version {newest} of another run changed {met[:5]}")
        state = first.commit_of(newest)
        for (store, prepared), now in zip(work, current, strict=True):
            if prepared.written or prepared.removed:
                state["runs"][store.member] = store._write_manifest(now, prepared)
        if batch is not None:
            state["batches"][batch[0]] = batch[1]
        if create_once(first.spark, f"{first.commits}/{newest + 1:08d}.json", json.dumps(state)):
            return [Published(bool(p.written or p.removed), newest + 1, p.written, p.removed) for _, p in work]


def _content(line: Row | None) -> tuple | None:
    return None if line is None else (line["record_count"], line["digest_xor"], line["digest_sum"])

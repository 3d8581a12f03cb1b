"""Queries over the published JSON layout: what is written, what is read back, and what is found when it was changed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import artifacts, verify
from ..registry import dataset
from ..session import scratch_path
from ..sources import shards
from ..sources.files import files_below, remove_paths
from .common import ABSENT, ORDER_DAY, Query, shown, table

_U1 = "adjusted_payout_rate_basis_points"


def _sets(spark, folder):
    """Orders a day as daily observations and as statutory periods, parts as factors by rate and age."""
    days = table(spark, folder, "orders").selectExpr(f"{ORDER_DAY} AS date").groupBy("date").agg(F.count(F.lit(1)).cast("int").alias("rate_basis_points"))
    periods = days.select(
        F.col("date").alias("period_start_date"), F.date_add("date", F.col("rate_basis_points")).alias("period_end_date"),
        F.col("rate_basis_points").cast("bigint").alias("exemption_amount_usd"))
    factors = table(spark, folder, "part").selectExpr(f"CAST(p_size * 20 AS INT) AS {_U1}", "CAST(p_partkey % 10 AS INT) AS age", "p_partkey")
    factors = factors.groupBy(_U1, "age").agg(F.max("p_partkey").alias("unitrust_remainder_factor_scaled_1e6"))
    return {"federal-funds": days, "gst-exemption": periods, "actuarial-table-u1": factors}


def published_layout(spark, folder):
    """Three datasets published twice: files and records by kind, files written again, and paths or digests that do not hold."""
    root, sets = scratch_path(spark, "layout"), _sets(spark, folder)
    artifacts.publish(spark, root, sets)
    entries = artifacts.publish(spark, root, sets)
    kind = (
        F.when(F.endswith("path", F.lit("/manifest.json")), "manifest").when(F.endswith("path", F.lit("index.json")), "index")
        .when(F.endswith("path", F.lit("/latest.json")), "latest").when(F.startswith("path", F.lit("api/")), "lookup").otherwise("records"))
    counted = entries.groupBy("dataset_id", kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("record_count").alias("record_count"), F.sum(F.col("changed").cast("int")).alias("written_again"))
    present = verify.file_manifest(spark, root)
    wrong = verify.file_differences(entries.select(F.col("path").alias("file"), "bytes", "sha256"), present)
    named = spark.read.schema("canonical_record_path string, canonical_record_paths array<string>, canonical_manifest_path string").option("multiLine", True).json(f"{root}/api/v1/datasets/*/*/*.json")
    paths = named.select(F.explode(F.array_compact(F.concat(F.array("canonical_record_path", "canonical_manifest_path"), F.coalesce("canonical_record_paths", F.array())))).alias("path"))
    lost = verify.dangling_paths(paths, files_below(spark, root))
    problems = [
        df.agg(F.lit("").alias("dataset_id"), F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("files"), F.lit(0).alias("record_count"), F.lit(0).alias("written_again"))
        for kind, df in (("wrong files", wrong), ("dangling paths", lost))
    ]
    return shown(counted.unionByName(problems[0]).unionByName(problems[1]))


LAYOUT_SQL = f"""
WITH o AS (SELECT {ORDER_DAY} AS d FROM orders), p AS (SELECT DISTINCT p_size, p_partkey % 10 AS age FROM part),
y AS (SELECT count(DISTINCT year(d)) AS y, count(DISTINCT d) AS n FROM o), r AS (SELECT count(DISTINCT p_size) AS y, count(*) AS n FROM p),
k AS (
  SELECT 'federal-funds' AS dataset_id, 'records' AS kind, y AS files, n AS record_count FROM y UNION ALL SELECT 'federal-funds', 'lookup', n, n FROM y
  UNION ALL SELECT 'gst-exemption', 'records', 1, n FROM y UNION ALL SELECT 'gst-exemption', 'lookup', y, y FROM y
  UNION ALL SELECT 'actuarial-table-u1', 'records', y, n FROM r
  UNION ALL SELECT v.d, v.k, v.f, v.f FROM (VALUES ('federal-funds', 'latest', 1), ('gst-exemption', 'latest', 1), ('federal-funds', 'manifest', 1), ('gst-exemption', 'manifest', 1),
    ('actuarial-table-u1', 'manifest', 1), ('', 'index', 2), ('', 'wrong files', 0), ('', 'dangling paths', 0)) v(d, k, f))
SELECT dataset_id, kind, files, CAST(record_count AS BIGINT) AS record_count, 0 AS written_again FROM k"""


def published_index(spark, folder):
    """The index and the manifests read back: bounds, files and digests of manifests as they lie there."""
    root = scratch_path(spark, "index")
    artifacts.publish(spark, root, _sets(spark, folder))
    line = (
        "dataset_id: string, dataset_path: string, schema_id: string, record_storage: string, record_count: bigint, manifest_path: string, "
        "manifest_sha256: string, latest: struct<record_key: string>, lookup: struct<file_count: bigint, first_key: string>")
    index = spark.read.schema(f"datasets array<struct<{line}>>").option("multiLine", True).json(f"{root}/api/v1/index.json")
    lines = index.select(F.explode("datasets").alias("d")).select("d.*")
    files = "array<struct<path: string, sha256: string, record_count: bigint>>"
    places = [f"{root}/*/manifest.json", f"{root}/actuarial/*/manifest.json"]
    manifests = spark.read.schema(f"dataset_id string, years {files}, shards {files}, records {files}").option("multiLine", True).json(places)
    listed = manifests.select("dataset_id", F.explode(F.coalesce("years", "shards", "records")).alias("f")).groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("files"), F.sum("f.record_count").alias("listed_records"))
    present = verify.file_manifest(spark, root).select(F.col("file").alias("manifest_path"), "sha256")
    joined = lines.join(listed, "dataset_id").join(present, "manifest_path")
    return shown(joined.select(
        "dataset_id", "dataset_path", "schema_id", "record_storage", "record_count", "files", "listed_records", F.col("latest.record_key").alias("latest_key"),
        F.col("lookup.file_count").alias("lookups"), F.col("lookup.first_key").alias("first_lookup"), (F.col("sha256") == F.col("manifest_sha256")).alias("digest_holds")))


INDEX_SQL = f"""
WITH o AS (SELECT {ORDER_DAY} AS d FROM orders), p AS (SELECT DISTINCT p_size, p_partkey % 10 AS age FROM part)
SELECT 'federal-funds' AS dataset_id, 'fed-funds' AS dataset_path, 'tabulary.federal_funds.v1' AS schema_id, 'by_year' AS record_storage, count(DISTINCT d) AS record_count,
  count(DISTINCT year(d)) AS files, count(DISTINCT d) AS listed_records, CAST(max(d) AS VARCHAR) AS latest_key, count(DISTINCT d) AS lookups, CAST(min(d) AS VARCHAR) AS first_lookup, 1 AS digest_holds FROM o
UNION ALL SELECT 'gst-exemption', 'gst-exemption', 'tabulary.gst_exemption.v1', 'single', count(DISTINCT d), 1, count(DISTINCT d), CAST(max(d) AS VARCHAR), count(DISTINCT year(d)), CAST(min(year(d)) AS VARCHAR), 1 FROM o
UNION ALL SELECT 'actuarial-table-u1', 'actuarial/table-u1', 'tabulary.actuarial_table_u1.v1', 'by_rate', count(*), count(DISTINCT p_size), count(*), '', {ABSENT}, '', 1 FROM p"""


def layout_readers(spark, folder):
    """Published shards through each reader, and one bad file each as a violation."""
    root, sets = scratch_path(spark, "readers"), _sets(spark, folder)
    artifacts.publish(spark, root, sets)
    funds, gst, u1 = dataset("federal-funds"), dataset("gst-exemption"), dataset("actuarial-table-u1")
    last = sets["federal-funds"].agg(F.max("date").alias("date"))

    def bad(name: str, path: str, body: str):
        return last.select(F.lit(name).alias("dataset_id"), F.lit(path).alias("path"), F.lit(True).alias("listed"), F.lit("k").alias("key"), F.expr(body).alias("json"))

    artifacts.write_files(
        bad("federal-funds", "bad/by-year/2030-fed-funds.json", "to_json(named_struct('date', date, 'rate_basis_points', 1))")
        .unionByName(bad("gst-exemption", "bad/gst.json", "to_json(named_struct('period_start_date', date, 'period_end_date', date, 'exemption_amount_usd', 1, 'note', 'x'))"))
        .unionByName(bad("actuarial-table-u1", "bad/by-interest-rate/20-basis-points.json", "to_json(named_struct('age', 3, 'unitrust_remainder_factor_scaled_1e6', 5))")), f"{root}-bad")

    def rows(reader: str, df, key, value):
        return df.select(F.lit(reader).alias("reader"), key.cast("string").alias("key"), F.col(value).cast("bigint").alias("value"), F.lit("").alias("rule"))

    def broken(reader: str, found):
        return found.select(F.lit(reader).alias("reader"), "key", F.lit(None).cast("bigint").alias("value"), "rule")

    year, start = F.col("date"), F.col("period_start_date")
    parts = [
        rows("years", shards.read_year_shards(spark, f"{root}/{funds.folder}", funds), year, "rate_basis_points"),
        rows("legacy", shards.read_year_shards(spark, f"{root}/nothing", gst, f"{root}/gst-exemption/gst-exemption.json"), start, "exemption_amount_usd"),
        rows("single", shards.read_single(spark, f"{root}/gst-exemption/gst-exemption.json", gst), start, "exemption_amount_usd"),
        rows("rates", shards.read_rate_shards(spark, f"{root}/{u1.folder}", u1), F.concat_ws("|", _U1, "age"), "unitrust_remainder_factor_scaled_1e6"),
        rows("lookups", shards.read_lookups(spark, f"{root}/api/v1/datasets/federal-funds/by-date/*.json", funds), F.col("record_key"), "rate_basis_points"),
        rows("lookups by year", shards.read_lookups(spark, f"{root}/api/v1/datasets/gst-exemption/by-year/*.json", gst), start, "exemption_amount_usd"),
        broken("years", shards.year_shard_rows(spark, f"{root}-bad/bad/by-year/*.json", funds)[1]),
        broken("single", shards.single_rows(spark, f"{root}-bad/bad/gst.json", gst)[1]),
        broken("rates", shards.rate_shard_rows(spark, f"{root}-bad/bad/by-interest-rate/*.json", u1)[1]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return shown(out)


READERS_SQL = f"""
WITH d AS (SELECT {ORDER_DAY} AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT r AS reader, CAST(d AS VARCHAR) AS key, n AS value, '' AS rule FROM d, (VALUES ('years'), ('legacy'), ('single'), ('lookups'), ('lookups by year')) v(r)
UNION ALL SELECT 'rates', (p_size * 20) || '|' || (p_partkey % 10), max(p_partkey), '' FROM part GROUP BY p_size, p_partkey % 10
UNION ALL SELECT 'years', '2030-fed-funds.json|' || max(d), {ABSENT}, 'shard year' FROM d
UNION ALL SELECT 'single', 'gst.json', {ABSENT}, 'record keys' UNION ALL SELECT 'rates', '20-basis-points.json', {ABSENT}, 'rate in name'"""


def layout_differences(spark, folder):
    """Lookups of which one was changed, one is missing and one is too many, against the canonical records."""
    root, data = scratch_path(spark, "differences"), dataset("federal-funds")
    days = _sets(spark, folder)["federal-funds"]
    artifacts.publish(spark, root, {data.name: days})
    ends = days.agg(F.min(F.struct("date", "rate_basis_points")).alias("first"), F.max("date").alias("last"))
    changed = ends.select(F.col("first.date").alias("date"), (F.col("first.rate_basis_points") + 1).alias("rate_basis_points"))
    surplus = ends.select(F.date_add("last", 30).alias("date"), F.lit(1).alias("rate_basis_points"))
    artifacts.write_files(artifacts.lookup_files(changed.unionByName(surplus), data), root)
    remove_paths(ends.select(F.concat(F.lit(f"api/v1/datasets/{data.name}/by-date/"), F.col("last").cast("string"), F.lit(".json")).alias("path")), root)
    served = shards.read_lookups(spark, f"{root}/api/v1/datasets/{data.name}/by-date/*.json", data).select(*data.columns)
    return shown(verify.bucketed_differences(served, shards.read_year_shards(spark, f"{root}/{data.folder}", data), list(data.keys)))


DIFFERENCES_SQL = f"""
WITH d AS (SELECT {ORDER_DAY} AS d, count(*) AS n FROM orders GROUP BY 1), a AS (SELECT * FROM d WHERE d = (SELECT min(d) FROM d)), z AS (SELECT * FROM d WHERE d = (SELECT max(d) FROM d))
SELECT CAST(d AS VARCHAR) AS date, n + 1 AS rate_basis_points, 1 AS left_rows, 0 AS right_rows FROM a UNION ALL SELECT CAST(d AS VARCHAR), n, 0, 1 FROM a
UNION ALL SELECT CAST(d AS VARCHAR), n, 0, 1 FROM z UNION ALL SELECT CAST(d + 30 AS VARCHAR), 1, 1, 0 FROM z"""


def cleaned_layout(spark, folder):
    """A layout published again with fewer years: the files that are left, by kind."""
    root, data = scratch_path(spark, "cleaned"), dataset("federal-funds")
    days = _sets(spark, folder)["federal-funds"]
    artifacts.publish(spark, root, {data.name: days})
    artifacts.publish(spark, root, {data.name: days.where("date < DATE'1997-01-01'")})
    left = files_below(spark, root)
    place = F.regexp_replace("path", "[^/]*$", "")
    return shown(left.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("files"), F.max(F.substring_index("path", "/", -1)).alias("last_file")))


CLEANED_SQL = f"""
WITH d AS (SELECT DISTINCT {ORDER_DAY} AS d FROM orders WHERE {ORDER_DAY} < DATE '1997-01-01')
SELECT 'fed-funds/by-year/' AS place, count(DISTINCT year(d)) AS files, max(year(d)) || '-fed-funds.json' AS last_file FROM d
UNION ALL SELECT 'api/v1/datasets/federal-funds/by-date/', count(*), max(d) || '.json' FROM d
UNION ALL SELECT * FROM (VALUES ('api/v1/datasets/federal-funds/', 1, 'latest.json'), ('api/v1/', 1, 'index.json'), ('', 1, 'index.json'), ('fed-funds/', 1, 'manifest.json')) v"""


QUERIES = {
    "published_layout": Query(published_layout, LAYOUT_SQL, ("SNK-1", "SNK-2", "SNK-3", "SNK-5", "SNK-7", "SNK-8", "SNK-9", "AGG-2", "AGG-3", "AGG-5")),
    "published_index": Query(published_index, INDEX_SQL, ("AGG-5", "AGG-6", "AGG-7", "AGG-8")),
    "layout_readers": Query(layout_readers, READERS_SQL, ("SRC-4", "SRC-5", "SRC-6", "SRC-8", "FLT-6", "FLT-12")),
    "layout_differences": Query(layout_differences, DIFFERENCES_SQL, ("JN-13",)),
    "cleaned_layout": Query(cleaned_layout, CLEANED_SQL, ("SNK-6", "SET-2")),
}

"""Queries over commits: writers that meet, batches that come twice, table sets that change together or not at all, clean-up."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..errors import ContractError
from ..plans import artifacts
from ..plans.updates import import_tables, table_stores
from ..registry import TABLE_SCHEMA, dataset
from ..session import scratch_path
from ..sources import shards
from ..sources.files import files_below, remove_paths
from ..streaming.feed import stream_feed
from .common import ORDER_DAY, Query, shown, table
from .published import ORDER_SCHEMA, ShardStore, _order_store, _orders


def concurrent_commits(spark, folder):
    """Three writers start from one version: the second goes on top of the first, the third would undo it and is refused."""
    store, rows = _order_store(spark, "writers"), _orders(spark, folder)
    base = store.publish(rows).version
    refused = 0
    for year, step in (("1998", 1), ("1999", 2), ("1998", 3)):
        changed = rows.where(F.year("date") == int(year)).withColumn("rate", F.col("rate") + step)
        try:
            store.publish(changed, [year], base)
        except ContractError as error:
            refused += error.code == "conflicting_version"
    years = store.read().groupBy(F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.sum("rate").alias("rate"))
    return shown(years.withColumn("version", F.lit(store.version())).withColumn("refused", F.lit(refused)))


WRITERS_SQL = """
SELECT year(o_orderdate) AS year, count(*) AS n, CAST(sum(o_custkey + CASE year(o_orderdate) WHEN 1998 THEN 1 WHEN 1999 THEN 2 ELSE 0 END) AS BIGINT) AS rate, 3 AS version, 1 AS refused
FROM orders GROUP BY 1"""


def replayed_batch(spark, folder):
    """A stream that ended after its batch was published and before its checkpoint said so: the batch comes again."""
    root, rows = scratch_path(spark, "replay"), _orders(spark, folder)
    landing, checkpoint, replayed = f"{root}/landing", f"{root}/checkpoint", []
    store = ShardStore(spark, f"{root}/store", ORDER_SCHEMA, ["date", "o_orderkey"], F.year("date").cast("string"))

    def run():
        stream_feed(
            spark, f"{landing}/*", "o_orderkey string, date string, rate string, status string",
            lambda c: c.selectExpr("CAST(o_orderkey AS BIGINT) AS o_orderkey", "CAST(date AS DATE) AS date", "CAST(rate AS BIGINT) AS rate", "status"),
            store, ["date", "o_orderkey"], ["rate", "status"], checkpoint, replayed=replayed).awaitTermination()

    rows.where("o_orderkey % 2 = 0").write.option("header", True).csv(f"{landing}/d=0")
    run()
    remove_paths(spark.createDataFrame([("commits/0",), ("commits/.0.crc",)], "path string"), checkpoint)
    run()
    rows.where("o_orderkey % 2 = 1").write.option("header", True).csv(f"{landing}/d=1")
    run()
    return shown(store.read().withColumn("version", F.lit(store.version())).withColumn("replayed", F.lit(len(replayed))))


REPLAY_SQL = f"""
SELECT o_orderkey, CAST({ORDER_DAY} AS VARCHAR) AS date, o_custkey AS rate, o_orderstatus AS status, 2 AS version, 1 AS replayed FROM orders"""

_TABLE = "concat('2015_vbt_relative_risk_tables__2015_male_non_smoker_rr', 50 + CAST(substr(p_brand, 7) AS INT), '_anb')"


def imported_tables(spark, folder):
    """Brands as mortality tables: published as files and read back, imported as one set, and a set with one bad table."""
    root, part = scratch_path(spark, "tables"), table(spark, folder, "part").withColumn("table_id", F.expr(_TABLE))
    select = part.selectExpr("table_id", "p_size AS issue_age", "CAST(p_partkey % 25 AS INT) AS duration", "CAST(p_size * 7 + p_partkey % 25 AS BIGINT) AS rate").distinct()
    ultimate = part.selectExpr("table_id", "p_size AS attained_age", "CAST(p_size * 9 AS BIGINT) AS rate").distinct()
    raw = shards.nest_table_rows(select, ultimate).select(
        F.concat("table_id", F.lit(".json")).alias("file_name"), F.lit("2015 VBT Relative Risk Tables").alias("source"), F.col("table_id").alias("table"),
        F.length("table_id").cast("bigint").alias("table_identity"), "select_rates", "ultimate_rates")
    expected, data = part.select("table_id").distinct().count(), dataset("valuation-basic-table-2015")
    tables = shards.normalise_tables(raw).select(*TABLE_SCHEMA.fieldNames())
    artifacts.write_files(artifacts.canonical_rows(tables, data), root)
    back = shards.read_table_shards(spark, f"{root}/{data.folder}")
    import_tables(spark, root, raw, expected)
    last = F.max("file_name").alias("file_name")
    bad = raw.join(F.broadcast(raw.agg(last).withColumn("bad", F.lit(True))), "file_name", "left").withColumn(
        "ultimate_rates", F.when(F.col("bad"), F.map_from_arrays(F.array(F.lit("1")), F.array(F.lit(100_001).cast("bigint")))).otherwise(F.col("ultimate_rates"))).drop("bad")
    try:
        import_tables(spark, root, bad, expected)
        refused = 0
    except ContractError:
        refused = 1
    stores = table_stores(spark, root)
    forms = {
        ("files", "select"): shards.select_rate_rows(back), ("files", "ultimate"): shards.ultimate_rate_rows(back),
        ("stores", "select"): stores["select"].read(), ("stores", "ultimate"): stores["ultimate"].read(),
    }
    parts = [
        df.groupBy("table_id").agg(F.count(F.lit(1)).alias("n"), F.sum("rate").alias("rate")).withColumn("form", F.lit(form)).withColumn("kind", F.lit(kind))
        for (form, kind), df in forms.items()
    ]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return shown(out.withColumn("refused", F.lit(refused)).withColumn("version", F.lit(max(s.version() for s in stores.values()))))


IMPORTED_SQL = f"""
WITH p AS (SELECT {_TABLE.replace("substr(p_brand, 7) AS INT", "substr(p_brand, 7) AS INTEGER")} AS table_id, p_size, p_partkey FROM part),
s AS (SELECT DISTINCT table_id, p_size, p_partkey % 25 AS d FROM p), u AS (SELECT DISTINCT table_id, p_size FROM p),
r AS (SELECT table_id, count(*) AS n, CAST(sum(p_size * 7 + d) AS BIGINT) AS rate, 'select' AS kind FROM s GROUP BY table_id
      UNION ALL SELECT table_id, count(*), CAST(sum(p_size * 9) AS BIGINT), 'ultimate' FROM u GROUP BY table_id)
SELECT table_id, n, rate, form, kind, 1 AS refused, 1 AS version FROM r, (VALUES ('files'), ('stores')) v(form)"""


def stale_removal(spark, folder):
    """Three versions, of which the newest stays: the data folders and commits that are left, and that it still reads whole."""
    store, rows = _order_store(spark, "stale"), _orders(spark, folder)
    store.publish(rows)
    store.publish(rows.withColumn("rate", F.when(F.year("date") == 1998, -1).otherwise(F.col("rate"))))
    store.publish(rows.where("date < DATE'2000-01-01'").withColumn("rate", F.when(F.year("date") == 1998, -2).otherwise(F.col("rate"))))
    store.remove_stale(1)
    left = files_below(spark, f"{store.root}/data", "*.parquet").select(F.regexp_extract("path", "/shard=([^/]*)/", 1).alias("year"), F.regexp_extract("path", "^run=([^/]*)/", 1).alias("run")).distinct()
    folders = left.groupBy("year").agg(F.count(F.lit(1)).alias("folders"))
    read = store.read().groupBy(F.year("date").cast("string").alias("year")).agg(F.count(F.lit(1)).alias("n"), F.sum("rate").alias("rate"))
    commits = files_below(spark, store.commits).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("commits").alias("year"), F.col("n").alias("folders"), F.lit(0).alias("n"), F.lit(0).alias("rate"))
    return shown(folders.join(read, "year", "full_outer").select("year", "folders", "n", "rate").unionByName(commits))


STALE_SQL = """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, 1 AS folders, count(*) AS n, CAST(sum(CASE WHEN year(o_orderdate) = 1998 THEN -2 ELSE o_custkey END) AS BIGINT) AS rate
FROM orders WHERE o_orderdate < DATE '2000-01-01' GROUP BY 1 UNION ALL SELECT 'commits', 1, 0, 0"""


QUERIES = {
    "concurrent_commits": Query(concurrent_commits, WRITERS_SQL, ("SNK-5",)),
    "replayed_batch": Query(replayed_batch, REPLAY_SQL, ("STR-1",)),
    "imported_tables": Query(imported_tables, IMPORTED_SQL, ("SNK-4", "SRC-7", "PRJ-29")),
    "stale_removal": Query(stale_removal, STALE_SQL, ("SNK-6",)),
}

"""Shards of published history: by year, single, by rate, by table, and lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import checks
from ..operators.aggregates import duplicate_keys
from ..registry import TABLE_SCHEMA, Dataset


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything on its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(where)
    return found is not None and len(found) > 0


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def _read_schema(schema: T.StructType) -> T.StructType:
    """Dates are read as text and cast, so that a bad date becomes a violation."""
    return T.StructType(
        [
            T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType) else f.dataType, True)
            for f in schema.fields
        ]
    )


def _typed(schema: T.StructType) -> list[Column]:
    return [
        F.try_to_date(F.col(f.name), "yyyy-MM-dd").alias(f.name) if isinstance(f.dataType, T.DateType) else F.col(f.name)
        for f in schema.fields
    ]


def read_json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON arrays of records with the file name each record came from."""
    return (
        spark.read.schema(_read_schema(schema))
        .option("multiLine", True)
        .json(path)
        .select(*_typed(schema), F.col("_metadata.file_name").alias("file_name"))
    )


def read_raw_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record as JSON text, and whether its file repeats a key somewhere.

    One row per shard file is read whole, so this suits shards of bounded size; it is
    the path for key checks and for migrating old shapes.
    """
    files = spark.read.option("wholetext", True).text(path)
    return files.select(
        F.col("_metadata.file_name").alias("file_name"),
        checks.has_repeated_json_key(F.col("value")).alias("repeated_key"),
        F.explode_outer(F.from_json("value", "array<string>")).alias("json"),
    )


CANONICAL_RECORD_END = "\n  }"


def read_record_pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, json) of every record of canonical JSON arrays; json is null for what is not exactly one record.

    In a canonical file (two blanks of indentation) a line that closes a record is the only one to begin with two blanks and a
    brace. Files are read as text with that as the line end, so a large one is cut into records by position and read by
    several tasks, and each record is parsed on its own: a repeated key or any other layout leaves json null, and so does
    a file that does not end with the array's one closing bracket.
    """
    pieces = spark.read.option("lineSep", CANONICAL_RECORD_END).text(path).select("value", F.col("_metadata.file_name").alias("file_name"))
    body = F.regexp_replace("value", r"^[\s\[,]+", "")
    whole = F.concat(body, F.lit("\n}"))
    sound = F.startswith(body, F.lit("{\n    ")) & ~checks.has_repeated_json_key(whole)
    # What follows the last record, or all of an empty array.
    closing = F.trim(F.translate("value", "\n\r[", "  ")) == "]"
    unclosed = pieces.groupBy("file_name").agg(F.count(F.when(closing, 1)).alias("closings")).where("closings != 1")
    records = pieces.where(~closing).select("file_name", F.when(sound, whole).alias("json"))
    return records.unionByName(unclosed.select("file_name", F.lit(None).cast("string").alias("json")))


def read_canonical_records(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Records of canonical JSON arrays with their file_name, and the violations of layout and keys."""
    pieces = read_record_pieces(spark, path)
    names = schema.fieldNames()
    rules = {
        "record layout": (F.col("json").isNull(), "invalid_json"),
        "record keys": (F.col("json").isNotNull() & checks.key_set_differs(F.col("json"), [names]), "invalid_json"),
    }
    read = _read_schema(schema)
    rows = pieces.where("json is not null").select("file_name", F.from_json("json", read).alias("r")).select("file_name", "r.*")
    return rows.select("file_name", *_typed(schema)), checks.violations(pieces, ["file_name"], rules)


def year_of_file(name: Column) -> Column:
    """``2016-series.json`` or ``2016.json``; '' when the name has no year."""
    return F.regexp_extract(name, r"^([0-9]{4})(?:-[a-z0-9-]+)?\.json$", 1)


def year_shard_rows(spark: SparkSession, path: str, data: Dataset) -> tuple[DataFrame, DataFrame]:
    """Records of year shards and their violations: each key must start with the year in its file name."""
    rows, broken = read_canonical_records(spark, path, data.schema)
    key = F.col(data.keys[0]).cast("string")
    year = year_of_file(F.col("file_name"))
    rules = {
        "shard year": (~F.coalesce(F.substring(key, 1, 4) == year, F.lit(False)), "invalid_json"),
        **checks.schema_rules(data.schema),
    }
    return rows.select(*data.columns), checks.all_violations(broken, checks.violations(rows, ["file_name", *data.keys], rules))


def read_year_shards(spark: SparkSession, folder: str, data: Dataset, legacy: str | None = None) -> DataFrame:
    """All year shards, or the legacy single file when there are none."""
    shards = f"{folder}/by-year/*.json"
    if not path_exists(spark, shards):
        return empty(spark, data.schema) if legacy is None else read_single(spark, legacy, data)
    rows, broken = year_shard_rows(spark, shards, data)
    checks.assert_clean(broken)
    return rows


def single_rows(spark: SparkSession, path: str, data: Dataset) -> tuple[DataFrame, DataFrame]:
    rows, broken = read_canonical_records(spark, path, data.schema)
    return rows.select(*data.columns), checks.all_violations(broken, checks.violations(rows, list(data.keys), checks.schema_rules(data.schema)))


def read_single(spark: SparkSession, path: str, data: Dataset) -> DataFrame:
    """One file with the whole history; a missing file is an empty history."""
    if not path_exists(spark, path):
        return empty(spark, data.schema)
    rows, broken = single_rows(spark, path, data)
    checks.assert_clean(broken)
    return rows


def rate_of_file(name: Column) -> Column:
    return F.regexp_extract(name, r"^([0-9]{5})-basis-points\.json$", 1).try_cast("int")


def rate_shard_rows(spark: SparkSession, path: str, data: Dataset) -> tuple[DataFrame, DataFrame]:
    """Records of factor shards and their violations; the rate is only in the file name."""
    stored = T.StructType([f for f in data.schema.fields if f.name != data.rate_column])
    rows, broken = read_canonical_records(spark, path, stored)
    rows = rows.withColumn(data.rate_column, rate_of_file(F.col("file_name")))
    rules = {"rate in name": (F.col(data.rate_column).isNull(), "invalid_json"), **checks.schema_rules(stored)}
    return rows.select(*data.columns), checks.all_violations(broken, checks.violations(rows, ["file_name"], rules))


def read_rate_shards(spark: SparkSession, folder: str, data: Dataset) -> DataFrame:
    rows, broken = rate_shard_rows(spark, f"{folder}/by-interest-rate/*.json", data)
    checks.assert_clean(broken)
    return rows


def table_shard_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nested mortality tables, one per file, and their violations."""
    rows = read_json_records(spark, path, TABLE_SCHEMA)
    return rows.select(*TABLE_SCHEMA.fieldNames()), checks.all_violations(
        checks.violations(rows, ["file_name"], table_rules()),
        checks.violations(
            rows, ["file_name"],
            {"file name": (~F.col("file_name").eqNullSafe(F.concat("table_id", F.lit(".json"))), "invalid_json")},
        ),
        duplicate_keys(rows, ["table_id"]).select(
            F.lit("repeated table").alias("rule"), F.col("table_id").alias("key"), F.lit("invalid_json").alias("code")
        ),
    )


def read_table_shards(spark: SparkSession, folder: str) -> DataFrame:
    rows, broken = table_shard_rows(spark, f"{folder}/by-table/*.json")
    checks.assert_clean(broken)
    return rows


def table_rules() -> dict[str, tuple[Column, str]]:
    def digits(values: Column) -> Column:
        return F.forall(F.map_keys(values), lambda k: k.rlike("^[0-9]+$"))

    def in_range(values: Column) -> Column:
        return F.forall(F.map_values(values), lambda v: F.coalesce(v.between(0, 100_000), F.lit(False)))

    def sound(values: Column) -> Column:
        return (F.size(values) > 0) & digits(values) & in_range(values)

    select, ultimate = F.col("select_rates"), F.col("ultimate_rates")
    return {
        "table id": (F.col("table_id").isNull() | (F.col("table_id") == ""), "invalid_json"),
        "select values": (
            ~F.coalesce(digits(select) & F.forall(F.map_values(select), sound), F.lit(False)), "invalid_json",
        ),
        "ultimate values": (~F.coalesce(sound(ultimate), F.lit(False)), "invalid_json"),
    }


def select_rate_rows(tables: DataFrame) -> DataFrame:
    """(table_id, issue_age, duration, rate)."""
    return (
        tables.select("table_id", F.explode("select_rates").alias("issue_age", "durations"))
        .select("table_id", "issue_age", F.explode("durations").alias("duration", "rate"))
        .select("table_id", F.col("issue_age").try_cast("int").alias("issue_age"),
                F.col("duration").try_cast("int").alias("duration"), "rate")
    )


def ultimate_rate_rows(tables: DataFrame) -> DataFrame:
    """(table_id, attained_age, rate)."""
    return tables.select("table_id", F.explode("ultimate_rates").alias("attained_age", "rate")).select(
        "table_id", F.col("attained_age").try_cast("int").alias("attained_age"), "rate"
    )


def nest_table_rows(select_rows: DataFrame, ultimate_rows: DataFrame) -> DataFrame:
    """Long rows back to the nested maps, keys in numeric order.

    A table holds at most a few thousand values by its ages and durations.
    """
    def ordered(key: str, value: str) -> Column:
        pairs = F.array_sort(
            F.collect_list(F.struct(F.col(key).alias("k"), F.col(value).alias("v"))), lambda a, b: (a["k"] - b["k"]).cast("int")
        )
        return F.map_from_entries(
            F.transform(pairs, lambda p: F.struct(p["k"].cast("string").alias("key"), p["v"].alias("value")))
        )

    by_age = select_rows.groupBy("table_id", "issue_age").agg(ordered("duration", "rate").alias("durations"))
    return by_age.groupBy("table_id").agg(ordered("issue_age", "durations").alias("select_rates")).join(
        ultimate_rows.groupBy("table_id").agg(ordered("attained_age", "rate").alias("ultimate_rates")), "table_id"
    )


def normalise_tables(raw: DataFrame) -> DataFrame:
    """Imported tables (file_name, source, table, table_identity, maps) to stored shape."""
    from ..functions.records import classify_table

    kind = classify_table(F.regexp_extract("file_name", r"^(.*)\.json$", 1), F.col("source"))
    # The constant columns of the published table set.
    return raw.withColumn("kind", kind).select(
        F.regexp_extract("file_name", r"^(.*)\.json$", 1).alias("table_id"), "table_identity", "source", "table",
        F.lit("2015 vbt").alias("family"), F.lit("vbt").alias("table_set"), F.lit("valuation_basic").alias("basis"),
        "kind.structure", "kind.sex", "kind.smoker", "kind.age_basis",
        F.lit("select_and_ultimate").alias("shape"), F.lit(2015).alias("year"), "kind.relative_risk_percent",
        "select_rates", "ultimate_rates",
    )


def envelope_schema(record: T.StructType) -> T.StructType:
    text = T.StringType()
    return T.StructType(
        [
            T.StructField("schema_id", text), T.StructField("schema_version", T.IntegerType()),
            T.StructField("dataset_id", text), T.StructField("dataset_path", text),
            T.StructField("record_key", text), T.StructField("canonical_record_path", text),
            T.StructField("canonical_record_paths", T.ArrayType(text)),
            T.StructField("canonical_manifest_path", text),
            T.StructField("record", _read_schema(record)),
            T.StructField("records", T.ArrayType(_read_schema(record))),
        ]
    )


def read_lookups(spark: SparkSession, path: str, data: Dataset) -> DataFrame:
    """Lookup envelopes back to (record_key, record columns).

    Many tiny files: the schema is given, so none is opened for inference, and Spark
    packs many into one task.
    """
    rows = spark.read.schema(envelope_schema(data.schema)).option("multiLine", True).json(path)
    items = F.coalesce(F.col("records"), F.array("record"))
    return rows.select("dataset_id", "record_key", F.inline(items)).select("dataset_id", "record_key", *_typed(data.schema))

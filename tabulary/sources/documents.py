"""The register of archived source documents and its Markdown index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import archive_name, subject_title
from ..functions.urls import ruling_document_allowed
from ..operators import checks
from ..operators.joins import keep_unarchived_rows
from ..operators.merge import MergeResult, upsert
from ..operators.ordering import descending_rows
from .shards import empty, path_exists

ENTRY = T.StructType(
    [
        T.StructField("year", T.StringType()),
        T.StructField("periods", T.ArrayType(T.StringType())),
        T.StructField("subjects", T.ArrayType(T.StringType())),
        T.StructField("path", T.StringType()),
        T.StructField("source_url", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("retrieved_date", T.StringType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("sha256", T.StringType()),
    ]
)
INDEX_COLUMNS = ["period", "rates_covered", "revenue_ruling", "link"]
# The register's own name and the subjects of a monthly ruling.
REGISTER_ID = "irs-revenue-rulings"
MONTHLY_SUBJECTS = ["afr", "section-7520-rates"]


def entry_rules() -> dict[str, tuple[Column, str]]:
    code = "bad_manifest"
    rules = {
        name: (F.col(name).isNull(), code) for name in ENTRY.fieldNames()
    }
    rules |= {
        "title text": (F.trim("title") == "", code),
        "retrieved date": (~F.col("retrieved_date").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), code),
        "sha256 shape": (~F.col("sha256").rlike("^[0-9a-f]{64}$"), code),
        "source url": (~ruling_document_allowed(F.col("source_url")), code),
    }
    return rules | checks.registry_argument_rules("year", "periods", "subjects")


def register_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Entries of the register files, and their violations of keys, types and values; a file holds one register."""
    raw = spark.read.option("wholetext", True).text(path).select(
        F.from_json("value", "archive_id string, entries array<string>").alias("r")
    ).select("r.archive_id", F.explode_outer("r.entries").alias("json"))
    rows = raw.withColumn("e", F.from_json("json", ENTRY)).select("archive_id", "json", "e.*")
    rules = {
        "register id": (~F.col("archive_id").eqNullSafe(F.lit(REGISTER_ID)), "bad_manifest"),
        "entry keys": (F.col("json").isNotNull() & checks.key_set_differs(F.col("json"), [ENTRY.fieldNames()]), "bad_manifest"),
    }
    entries = rows.filter(F.col("json").isNotNull())
    found = checks.all_violations(checks.violations(rows, ["path"], rules), checks.violations(entries, ["path"], entry_rules()))
    return entries.select(*ENTRY.fieldNames()), found


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """Entries of the register; keys, types and values are checked."""
    if not path_exists(spark, path):
        return empty(spark, ENTRY)
    entries, found = register_rows(spark, path)
    checks.assert_clean(found)
    return entries


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the Markdown table; header and separator lines are no rows."""
    return index_lines(spark.read.text(path), "value")


def index_lines(lines: DataFrame, column: str) -> DataFrame:
    line = F.trim(column)
    inner = F.regexp_replace(line, r"^\|+|\|+$", "")
    cells = F.transform(F.split(inner, r"\|"), lambda c: F.trim(c))
    return (
        lines.filter(line.startswith("|") & line.endswith("|"))
        .select(cells.alias("cells"))
        .filter((F.size("cells") == 4) & ~F.element_at("cells", 1).isin("Rate month", "---"))
        .select(*[F.element_at("cells", i + 1).alias(name) for i, name in enumerate(INDEX_COLUMNS)])
    )


def preserved_rows(index: DataFrame) -> DataFrame:
    """Rows that do not link into the archive itself."""
    return index.filter(~F.contains("link", F.lit("](by-year/")))


def entry_index_rows(entries: DataFrame) -> DataFrame:
    return entries.select(
        F.array_join("periods", ", ").alias("period"),
        F.array_join(F.transform("subjects", subject_title), ", ").alias("rates_covered"),
        F.col("title").alias("revenue_ruling"),
        F.concat(F.lit("[PDF]("), "path", F.lit(")")).alias("link"),
    )


def build_index(entries: DataFrame, index: DataFrame) -> DataFrame:
    """Published index, newest first; external links stay where nothing is archived."""
    rows = keep_unarchived_rows(preserved_rows(index), "period", entries, entry_index_rows(entries), "periods")
    return descending_rows(rows, INDEX_COLUMNS)


def register_entries(existing: DataFrame, new: DataFrame) -> MergeResult:
    return upsert(existing, new, "path", ["source_url", "bytes", "sha256"], ENTRY.fieldNames())


def entries_for_files(files: DataFrame, described: DataFrame) -> DataFrame:
    """Register entries for landed files.

    ``files`` is a ``binaryFile`` frame; ``described`` says what each file is.
    """
    hashed = files.filter(checks.is_pdf(F.col("content"))).select(
        F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.length("content").cast("bigint").alias("bytes"),
        F.sha2("content", 256).alias("sha256"),
    )
    name = archive_name(F.col("periods"), F.col("subjects"), F.col("title"), F.col("source_url"))
    return described.join(hashed, "file").select(
        "year", "periods", "subjects", F.concat(F.lit("by-year/"), "year", F.lit("/"), name).alias("path"),
        "source_url", "title", "retrieved_date", "bytes", "sha256",
    )

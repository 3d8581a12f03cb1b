"""Small frames that hold the awkward cases: nulls, empty and long texts, repeated rows, extra columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, node string, spans string"


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) or (doc_id, text, lang), with columns whose names clash with those the operators make."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, SCHEMA)


AWKWARD = [(1, None), (2, ""), (3, " \n\t "), (None, "a text without id"), (4, "same row twice"), (4, "same row twice"), (5, "wort " * 40_000), (6, "x" * 200_000)]

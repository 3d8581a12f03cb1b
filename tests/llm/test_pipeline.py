from __future__ import annotations

import os
from pathlib import Path

import duckdb
import public_tokenizers
import pytest

from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tabulary.llm import bagminhash, decontaminate, queries, secrets, toxicity
from tabulary.llm.common import table

from .fixtures import AWKWARD, documents

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    if not Path(FOLDER).exists():
        pytest.skip("no test data")
    connection = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_agrees_with_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    picked = ", ".join(f'"{c}"' for c in columns)
    want = sorted(repr(r) for r in duck.sql(f"SELECT {picked} FROM ({queries.ORACLE_SQL[name]})").fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == want


def test_one_query_for_each_operator():
    names = [n for n in __spark_entry__.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in __spark_entry__.queries()


def test_stages_do_what_their_operators_decide(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        out.write.parquet(str(tmp_path / name))
        seen[name] = (docs, docs := spark.read.parquet(str(tmp_path / name)))
    assert all(after.columns == columns for name, (_, after) in seen.items() if name != "bpe")

    def ids(df):
        return sorted(r.doc_id for r in df.select("doc_id").collect())

    before, after = seen["toxicity"]
    scores = toxicity.score_toxicity(before, table(spark, FOLDER, "labels")).select("doc_id", "predicted").collect()
    assert ids(after) == sorted(r.doc_id for r in scores if not r.predicted)
    before, after = seen["near_duplicates"]
    classes = {r.doc_id: r.class_id for r in bagminhash.near_duplicates(before).collect()}
    assert ids(after) == sorted(set(classes.values()))
    before, after = seen["decontamination"]
    leaks = {r.doc_id for r in decontaminate.find_leaks(before, table(spark, FOLDER, "benchmark")).collect()}
    assert ids(after) == [i for i in ids(before) if i not in leaks]
    before, after = seen["secrets"]
    assert ids(after) == ids(before)
    masked = {r.doc_id: r.text for r in after.collect()}
    for r in before.collect():
        assert masked[r.doc_id] == secrets.masked(r.text, secrets.all_spans(r.text, secrets.base_spans(r.text)))
    assert after.where("n_chars != length(text)").isEmpty()
    before, after = seen["bpe"]
    assert ids(after) == ids(before) and public_tokenizers.PATTERN


def test_stages_take_awkward_rows_and_clashing_names(spark, tmp_path):
    """Null, empty and long texts, repeated rows, null ids, and columns named like the operators' own or with blanks."""
    docs = documents(spark, AWKWARD).withColumn("a b", F.lit(1)).withColumn("leak_md5", F.lit("x")).withColumn("lost_id", F.lit(2))
    for start in (docs, docs.limit(0)):
        rows = start
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, rows, FOLDER)
            path = str(tmp_path / f"{name}-{start is docs}-{number}")
            out.write.parquet(path)
            rows = spark.read.parquet(path)
            if name != "bpe":
                assert rows.columns == docs.columns
        want = {r[0] for r in AWKWARD} if start is docs else set()
        assert {r.doc_id for r in rows.collect()} == want

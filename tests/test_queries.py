from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from tabulary.queries.catalog import QUERIES

FOLDER = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")
OPERATORS = (
    [f"SRC-{n}" for n in (1, 2, 3, 4, 5, 6, 7, 8, 10, 11, 12, 13, "14a", "14b", "14c", "14d", "14e", "14f", 15, 16, 17)]
    + [f"SNK-{n}" for n in range(1, 10)] + [f"PRJ-{n}" for n in range(1, 34)] + [f"FLT-{n}" for n in range(1, 16)]
    + [f"JN-{n}" for n in range(1, 14)] + [f"AGG-{n}" for n in range(12)] + [f"WIN-{n}" for n in range(1, 7)]
    + [f"SRT-{n}" for n in range(1, 5)] + [f"SET-{n}" for n in range(1, 4)] + ["GEN-1", "GEN-2"]
    + [f"QRY-{n}" for n in range(1, 8)] + ["STR-1"]
)


@pytest.fixture(scope="module")
def duck():
    if not Path(FOLDER).exists():
        pytest.skip("no test data")
    connection = duckdb.connect()
    for file in sorted(Path(FOLDER).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_operator_has_a_query():
    covered = {c for q in QUERIES.values() for c in q.covers}
    assert [o for o in OPERATORS if o not in covered] == []
    assert sorted(covered - set(OPERATORS)) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, duck, name):
    query = QUERIES[name]
    df = query.run(spark, FOLDER)
    columns = sorted(df.columns)
    assert all(kind in ("bigint", "double", "string") for _, kind in df.dtypes)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    relation = duck.sql(query.sql)
    assert sorted(relation.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    assert got == sorted(repr(r) for r in duck.sql(f"SELECT {picked} FROM ({query.sql})").fetchall())


def test_entry(spark):
    assert not __spark_entry__.entry(spark).isEmpty()
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

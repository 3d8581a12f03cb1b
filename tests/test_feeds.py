"""Feeds of more dates than the years of four digits hold."""

from __future__ import annotations

import duckdb
import pytest

from tabulary.errors import ContractError
from tabulary.queries.catalog import QUERIES
from tabulary.queries.readers import FEED_DAYS, WITHIN
from tabulary.sources import feeds

KEYS = [0, 1, 59, 149_999, FEED_DAYS - 1, FEED_DAYS, FEED_DAYS + 1, 2 * FEED_DAYS, 8_999_999, 99_999_999, 100_000_000, 600_000_000]


@pytest.mark.parametrize("name", ["curve_feed", "mixed_feed", "overnight_feed"])
def test_feed_of_many_orders_agrees_with_sql(spark, tmp_path, name):
    path = str(tmp_path / "orders.parquet")
    spark.createDataFrame([(k, k % 1234) for k in KEYS], "o_orderkey long, o_custkey long").write.parquet(path)
    df = QUERIES[name].run(spark, str(tmp_path))
    picked = ", ".join(sorted(df.columns))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW orders AS SELECT * FROM '{path}/*.parquet'")
    want = duck.sql(f"SELECT {picked} FROM ({QUERIES[name].sql})").fetchall()
    assert sorted(map(tuple, df.selectExpr(*sorted(df.columns)).collect())) == sorted(want)


def test_a_date_is_repeated_only_within_its_feed(spark, tmp_path):
    lines = ["Date,1 Mo", "03/04/2031,2.11"]
    for number, more in ((0, []), (1, ["3/5/2031,2.12"])):
        folder = tmp_path / f"feed={number}"
        folder.mkdir()
        (folder / "a.csv").write_text("\n".join(lines + more) + "\n")
    rows = feeds.read_curve(spark, str(tmp_path), WITHIN)
    assert sorted((r.feed, str(r.date)) for r in rows.collect()) == [(0, "2031-03-04"), (1, "2031-03-04"), (1, "2031-03-05")]
    (tmp_path / "feed=1/b.csv").write_text("\n".join(lines) + "\n")
    with pytest.raises(ContractError, match="duplicate_source_record"):
        feeds.read_curve(spark, str(tmp_path), WITHIN)

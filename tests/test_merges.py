from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tabulary.errors import ContractError
from tabulary.operators import joins, merge, windows

SCHEMA = "day string, rate int, volume int, source string"


def make(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def code(call):
    with pytest.raises(ContractError) as failure:
        call()
    return failure.value.code


def strict(history, feed):
    return merge.strict_merge(history, feed, ["day"], ["rate", "volume"], ["source"])


def test_strict_union_and_repeat(spark, rows):
    history, feed = make(spark, ("a", 1, 1, "h")), make(spark, ("a", 1, 1, "s"), ("b", 2, None, "s"))
    first = strict(history, feed)
    assert rows(first.checked()) == [("a", 1, 1, "h"), ("b", 2, None, "s")]
    assert tuple(first.metrics().first()) == (2, 1, 2, 1)
    again = strict(first.checked(), feed)
    assert tuple(again.metrics().first()) == (2, 2, 2, 0)


def test_strict_failures(spark):
    a, a2 = ("a", 1, 1, "h"), ("a", 9, 1, "h")
    empty = spark.createDataFrame([], SCHEMA)
    assert code(strict(make(spark, a), make(spark, a2)).checked) == merge.CONFLICT
    assert code(strict(make(spark, a, a), empty).checked) == merge.REPEATED_HISTORY
    assert code(strict(empty, make(spark, a, a)).checked) == merge.REPEATED_SOURCE


def enrich(history, feed):
    return merge.enriching_merge(history, feed, ["day"], ["rate", "volume"], ["source"])


def test_enrichment_is_all_or_nothing(spark, rows):
    partial, full = make(spark, ("a", None, 5, "h")), make(spark, ("a", 365, 5, "s"))
    assert rows(enrich(partial, full).checked()) == [("a", 365, 5, "s")]
    assert code(enrich(make(spark, ("a", 1, 5, "h")), make(spark, ("a", 1, None, "s"))).checked) == merge.CONFLICT
    assert code(enrich(make(spark, ("a", None, 5, "h")), make(spark, ("a", 1, None, "s"))).checked) == merge.CONFLICT
    assert rows(enrich(full, full).checked()) == [("a", 365, 5, "s")]


def test_tolerant(spark, rows):
    def tolerant(history, feed, **more):
        return merge.tolerant_merge(history, feed, ["day"], ["rate", "volume"], ["source"], **more)

    a = ("a", 1, 1)
    twice = make(spark, (*a, "1"), (*a, "2"))
    assert rows(tolerant(twice, spark.createDataFrame([], SCHEMA)).checked()) == [(*a, "2")]
    assert rows(tolerant(spark.createDataFrame([], SCHEMA), twice).checked()) == [(*a, "1")]
    assert code(tolerant(spark.createDataFrame([], SCHEMA), twice, repeated_source_fails=True).checked) == merge.REPEATED_SOURCE
    assert code(tolerant(make(spark, (*a, "1"), ("a", 2, 1, "2")), twice).checked) == merge.CONFLICT
    assert code(tolerant(twice, make(spark, ("a", 2, 1, "s"))).checked) == merge.CONFLICT


def test_combine_partial(spark, rows):
    parts = make(spark, ("a", 1, None, "s"), ("a", None, 2, "s"), ("b", None, None, "s"))
    assert rows(merge.combine_partial(parts, ["day"], ["rate", "volume"]).checked()) == [("a", 1, 2), ("b", None, None)]
    clash = make(spark, ("a", 1, None, "s"), ("a", 2, None, "s"))
    assert code(merge.combine_partial(clash, ["day"], ["rate"]).checked) == merge.CONFLICT


def test_overlap_against_pairs(spark):
    base = datetime.date(1990, 1, 1)
    def period(i, a, b):
        return (i, base + datetime.timedelta(days=a), base + datetime.timedelta(days=a + b))

    existing = [period(i, i * 37 % 1900, i * 11 % 400) for i in range(300)]
    source = [period(i, i * 101 % 2000, i * 7 % 30) for i in range(25)] + [existing[3], existing[7]]
    schema = "i int, s date, e date"
    kept = joins.drop_overlapped(spark.createDataFrame(existing, schema), spark.createDataFrame(source, schema), "s", "e")
    exact = {(s, e) for _, s, e in source}
    expected = {i for i, s, e in existing if (s, e) in exact or not any(s <= b and a <= e for _, a, b in source)}
    assert {r["i"] for r in kept.collect()} == expected
    assert 0 < len(expected) < 300


def test_life_expectancy(spark, rows):
    survivors = spark.createDataFrame([(0, 100000000), (1, 80000000), (2, 0)], "age int, survivors_per_100000_scaled_1e6 bigint")
    assert rows(windows.life_expectancy(survivors, [])) == [(0, 800000, 1300000), (1, 0, 500000), (2, 0, 0)]


def test_chunked_windows_equal_plain_ones_on_a_hot_group(spark):
    rows_ = [("hot", i, i % 13 if i % 50 == 0 else None) for i in range(2000)] + [(None, i, None if i % 3 else i) for i in range(60)]
    df = spark.createDataFrame(rows_, "g string, t int, m int")
    filled = windows.forward_fill(df, ["g"], ["t"], F.floor(F.col("t") / 64), F.col("m"), "f")
    last, expected = {}, {}
    for g, t, m in rows_:
        last[g] = m if m is not None else last.get(g)
        expected[g, t] = last[g]
    assert {(r["g"], r["t"]): r["f"] for r in filled.collect()} == expected
    summed = windows.suffix_sum(df, ["g"], ["t"], F.floor(F.col("t") / 64), F.col("t"), "later")
    assert {(r["g"], r["t"]): r["later"] for r in summed.collect()} == {
        (g, t): sum(x for h, x, _ in rows_ if h == g and x > t) for g, t, _ in rows_
    }
    numbered = windows.sequence_number(df, ["g"], ["t"], F.floor(F.col("t") / 64), "n")
    assert {(r["g"], r["t"]): r["n"] for r in numbered.collect()} == {(g, t): t + 1 for g, t, _ in rows_}


def test_containment_needs_one_entry(spark):
    registry = spark.createDataFrame([("u", ["1", "2"], ["a"]), ("u", ["3"], ["a", "b"])], "url string, periods array<string>, subjects array<string>")
    wanted = spark.createDataFrame([(0, "u", ["1"], ["a"]), (1, "u", ["1", "3"], ["a"]), (2, "u", ["3"], ["b"]), (3, "v", ["1"], ["a"])],
                                   "i int, url string, p array<string>, s array<string>")
    found = joins.contains_all(wanted, registry, "url", {"periods": ("p", "periods"), "subjects": ("s", "subjects")})
    assert sorted(r["i"] for r in found.collect()) == [0, 2]

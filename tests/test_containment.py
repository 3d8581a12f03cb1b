from __future__ import annotations

import random

import pytest

from tabulary.operators import joins

SETS = {"periods": ("want_periods", "periods"), "subjects": ("want_subjects", "subjects")}
WANTED = "id int, url string, want_periods array<string>, want_subjects array<string>"
HELD = "url string, periods array<string>, subjects array<string>"


def answered(rows, registry):
    return sorted(
        i for i, url, p, s in rows
        if url is not None and p is not None and s is not None and any(
            u == url and hp is not None and hs is not None and set(p) <= set(hp) and set(s) <= set(hs) for u, hp, hs in registry))


@pytest.mark.parametrize("part", [1000, 3])
def test_one_entry_holds_all_wanted_members(spark, monkeypatch, part):
    monkeypatch.setattr(joins, "PART_MEMBERS", part)
    draw = random.Random(4)

    def some(most, low=0):
        return [draw.choice(["a", "b", "c", "d", "e", "", None]) for _ in range(draw.randint(low, most))]

    def url():
        return draw.choice(["busy", "busy", "busy", "x", "y", None])

    registry = [(url(), ["common", *some(4)], some(3)) for _ in range(60)] + [("busy", None, ["a"]), ("busy", ["a"], None), ("only", [], [])]
    rows = [(i, url(), ["common"] * draw.randint(0, 2) + some(3), some(2)) for i in range(200)]
    rows += [(300, "only", [], []), (301, "missing", [], []), (302, "busy", None, ["a"]), (303, "busy", [], []), (304, "only", [None], []), rows[0]]
    got = joins.contains_all(spark.createDataFrame(rows, WANTED), spark.createDataFrame(registry, HELD), "url", SETS)
    assert got.columns == ["id", "url", "want_periods", "want_subjects"]
    want = answered(rows, registry)
    assert sorted(r.id for r in got.collect()) == want and 20 < len(want) < 200


def test_nothing_wanted_or_held(spark):
    rows, held = spark.createDataFrame([], WANTED), spark.createDataFrame([], HELD)
    assert joins.contains_all(rows, held, "url", SETS).count() == 0
    assert joins.contains_all(spark.createDataFrame([(1, "x", [], ["a"])], WANTED), held, "url", SETS).count() == 0


def test_a_busy_member_spreads(spark):
    registry = spark.range(5000).selectExpr("'busy' AS url", "array('common', CAST(id % 70 AS STRING)) AS periods", "array(CAST(id AS STRING)) AS subjects")
    rows = spark.range(3000).selectExpr("CAST(id AS INT) AS id", "'busy' AS url", "array('common', CAST(id % 90 AS STRING)) AS want_periods", "array(CAST(id + 4000 AS STRING)) AS want_subjects")
    got = joins.contains_all(rows, registry, "url", SETS)
    assert {r.id for r in got.collect()} == {i for i in range(1000) if i % 90 == (i + 4000) % 70}

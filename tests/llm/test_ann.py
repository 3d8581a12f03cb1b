from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tabulary.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, queries, k=5):
    """Exact nearest rows in double precision, ties to the smaller id."""
    out = {}
    for q in queries:
        a = np.array(dict(rows)[q], dtype=np.float32).astype(float)
        found = []
        for i, v in rows:
            b = np.array(v, dtype=np.float32).astype(float)
            if i != q and len(b) == len(a):
                found.append((-float((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), i))
        out[q] = [i for _, i in sorted(found)[:k]]
    return out


def test_recall_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 700)
    monkeypatch.setattr(ann, "QUERY_ROWS", 16)
    draw = np.random.default_rng(3)
    rows = [(i, draw.normal(size=32).tolist()) for i in range(2000)]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], SCHEMA)
    out = ann.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    want = brute(rows, range(0, 2000, 50))
    got = {q: [r.vec_id for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] for q in want}
    hits = sum(len(set(got[q]) & set(want[q])) for q in want)
    assert hits >= 0.95 * 5 * len(want)
    assert all([r["rank"] for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] == [1, 2, 3, 4, 5] for q in want)


def test_ties_copies_and_unusable_rows(spark):
    draw = np.random.default_rng(4)
    base = draw.normal(size=8).tolist()
    rows = [(i, base) for i in range(0, 40)] + [(i, draw.normal(size=8).tolist()) for i in range(40, 60)]
    odd = [(100, None), (150, [0.0] * 8), (200, [None, *base[1:]]), (250, [float("nan"), *base[1:]]), (300, [float("inf"), *base[1:]]), (350, []), (None, base), (400, [1.0, 2.0])]
    frame = spark.createDataFrame([(i, v, None, "x") for i, v in [*rows, *rows[:3], *odd]], SCHEMA)
    out = ann.nearest(frame, F.col("vec_id") % 50 == 0).collect()
    want = brute(rows, [0, 50])
    for q in (0, 50):
        assert [r.vec_id for r in sorted(out, key=lambda r: r["rank"]) if r.query_id == q] == want[q]
    assert want[0] == [1, 2, 3, 4, 5]
    assert {r.query_id for r in out} == {0, 50}


def test_few_candidates_and_empty_table(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 0, "x"), (1, [1.0, 1.0], 0, "x")], SCHEMA)
    assert [(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(few, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1)]
    assert ann.nearest(few.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_pruning_keeps_diverse_neighbours():
    unit = np.array([[1, 0], [0.999, 0.045], [0.998, 0.063], [0.9, -0.436]], dtype=np.float32)
    kept = ann.prune(unit, np.array([0]), np.array([[1, 2, 3, 3]]), 1.0)[0]
    assert sorted(kept[kept >= 0].tolist()) == [1, 3]


def test_scaled_copies_and_extremes_rank_by_exact_cosine_and_id(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=6)
    rows = [(i, (base * (i + 1)).tolist()) for i in range(60)] + [(100 + i, draw.normal(size=6).tolist()) for i in range(60)]
    rows += [(500, (base * 1e200).tolist()), (501, (base * 1e-200).tolist())]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0).collect()
    vectors = {i: ann.in_range(np.array([v]))[0] for i, v in rows}
    for query in (0, 50, 100, 150, 500):
        want = sorted((-ann.cosines(vectors[query][None], v[None])[0], i) for i, v in vectors.items() if i != query)[:5]
        assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank) if r.query_id == query] == [(i, -s) for s, i in want]

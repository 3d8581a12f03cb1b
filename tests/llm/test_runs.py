from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tabulary.llm import runs

from .fixtures import AWKWARD, documents


def brute_runs(words):
    """start, length, period of every run, by trying all periods."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute(doc_id, text):
    words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w]
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (
        doc_id, len(found), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(),
    )


def found(words):
    return list(zip(*(x.tolist() for x in runs.runs_of(np.array(words, dtype=np.int64))), strict=True))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=17), st.integers(1, 5)), max_size=6))
def test_runs_are_those_of_all_periods(parts):
    words = [w for unit, times in parts for w in unit * times]
    assert found(words) == brute_runs(words)


def test_runs_of_longer_repeats():
    draw = random.Random(3)
    for _ in range(60):
        words = []
        while len(words) < 400:
            unit = [draw.randrange(4) for _ in range(draw.randint(1, 70))]
            words += unit * draw.randint(1, 4)
            words += words[-draw.randint(1, len(words)):]
        assert found(words[:600]) == brute_runs(words[:600])


def test_long_texts_take_seconds():
    assert found([0] * 500_000) == [(0, 500_000, 1)]
    halves = [0, 1] * 100_000 + [2] + [0, 1] * 100_000
    assert set(found(halves)) == {(0, 200_000, 2), (200_001, 200_000, 2)}
    assert found(list(range(100_000)) * 3) == [(0, 300_000, 100_000)]


def test_queries_rows_are_those_of_brute_force(spark):
    draw = random.Random(5)
    texts = []
    for _ in range(120):
        unit = [draw.choice(["la", "li", "ü", "xyz"]) for _ in range(draw.randint(1, 9))]
        texts.append(" ".join([f"w{draw.randrange(50)}" for _ in range(draw.randint(0, 40))] + unit * draw.randint(1, 6)) + "\t end\r\n")
    rows = list(enumerate(texts)) + [r for r in AWKWARD if len(r[1] or "") < 1000]
    got = runs.find_runs(documents(spark, rows), stretched=True).drop("collapsed").collect()
    assert sorted(map(tuple, got), key=repr) == sorted((brute(*r) for r in rows), key=repr)
    assert sum(r.n_runs for r in got) > 20
    plain = {r.doc_id: r for r in runs.find_runs(documents(spark, [*AWKWARD, (90, "a b c " * 9 + "d")])).collect()}
    assert (plain[5].n_runs, plain[5].length, plain[5].collapsed) == (1, 40_000, "wort")
    assert plain[90].collapsed == "a b c d" and plain[1].collapsed == plain[2].collapsed == plain[3].collapsed == ""
    assert runs.find_runs(documents(spark, [])).collect() == []

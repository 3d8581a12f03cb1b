from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from tabulary.llm import collocations

from .fixtures import AWKWARD, documents


def brute(rows, best=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i:i + k])] += 1
    frequent = {p: a for p, a in f.items() if a >= 30 and len(p[1]) > 1}
    found = {}
    for (lang, p), a in frequent.items():
        longer = [b for (other, q), b in frequent.items() if other == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q)))]
        if any(100 * b >= 80 * a for b in longer):
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return [
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, rows in sorted(found.items()) for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:best], 1)
    ]


def corpus(seed):
    draw = random.Random(seed)
    phrases = ["New York City", "el niño", "one two three four five", "a b", "b a", "Äpfel und birnen", "x\ty"]
    rows = []
    for i in range(260):
        parts = []
        for _ in range(draw.randint(0, 12)):
            parts.append(draw.choice(phrases) if draw.random() < 0.5 else f"w{draw.randrange(30)}")
            parts.append(draw.choice(["  ", " ", ", ", ".\n", " ", "\r", "\t"]))
        rows.append((i, "".join(parts), draw.choice(["en", "de", None])))
    return rows


@pytest.mark.parametrize(("seed", "bits"), [(1, 22), (2, 7)])
def test_phrases_are_those_of_full_counts(spark, monkeypatch, seed, bits):
    monkeypatch.setattr(collocations, "SLOT_BITS", bits)
    rows = corpus(seed) + [(i, t, "en") for i, t in AWKWARD]
    got = collocations.collocations(documents(spark, rows))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 15


def test_no_phrases(spark):
    assert collocations.collocations(documents(spark, [])).collect() == []
    assert collocations.collocations(documents(spark, [(1, None), (2, "")])).collect() == []


def test_words_and_their_hashes():
    seeds = np.array([1, 2], dtype=np.uint64)
    words = collocations.Words(["One  two,three", "", " two three\tONE"], [0, 0, 1], seeds)
    found = dict((k, (h, w)) for k, h, w in words.phrases())
    assert words.spelled(np.arange(6), 1).to_pylist() == ["one", "two", "three", "two", "three", "one"]
    assert words.lang.tolist() == [0, 0, 0, 1, 1, 1]
    assert found[2][1].tolist() == [True, False, False, True, True]
    assert words.spelled(np.array([0, 3]), 2).to_pylist() == ["one two", "two three"]
    assert len(set(found[1][0].tolist())) == 6
    same = collocations.Words(["two one", "one two one"], [1, 1], seeds)
    assert same.hash[0] == words.hash[3] and same.hash[1] == words.hash[5]
    assert list(same.phrases())[1][1][0] == list(same.phrases())[1][1][3]


def test_filters_follow_the_phrases_noted(spark, monkeypatch):
    """Noted phrases in plenty are told from others, by filters that hold all of them."""
    monkeypatch.setattr(collocations, "SLOT_BITS", 8)
    draw = np.random.default_rng(3)
    hashes = np.unique(draw.integers(0, 1 << 64, 50_000, dtype=np.uint64))
    rows = spark.createDataFrame(collocations.packed(2 * collocations.TAG + 1, hashes, np.full(len(hashes), 30), 7).to_pandas())
    made = collocations.note(rows, 4)
    assert list(made) == [2] and made[2][0] == 4
    assert (collocations.noted_at([made[2]], hashes) == 4).all()
    others = draw.integers(0, 1 << 64, 50_000, dtype=np.uint64)
    assert (collocations.noted_at([made[2]], others) != collocations.NEVER).mean() < 0.03
    both = collocations.noted_at([(2, np.full(32, 255, dtype=np.uint8)), made[2]], hashes)
    assert (both == 2).all()


def test_counts_travel_as_blocks_of_the_range_of_hashes(spark):
    """A step deals out far fewer rows than phrases; equal hashes meet, whatever part and piece they are in."""
    draw = random.Random(4)
    frame = documents(spark, [(i, " ".join(f"w{draw.randrange(200)}" for _ in range(300)), "en") for i in range(40)]).select("lang", "text")
    words = Counter(w for row in frame.collect() for w in row.text.split(" "))
    sent = collocations.shared(spark, {k: [] for k in range(1, 4)})
    scanned = collocations.scan(frame.coalesce(2), sent, 0, 5)
    rows = scanned.collect()
    assert len(rows) <= 10 < len(words) and {r.part for r in rows} == set(range(5))
    got = collocations.unpacked(collocations.merged(scanned.unionByName(scanned), 0, 5)).collect()
    assert sorted(r.n for r in got) == sorted(2 * n for n in words.values())


def test_parts_and_pieces_do_not_change_the_phrases(spark, monkeypatch):
    """Many parts, pieces and filters full of others' bits give the same phrases."""
    for name, value in (("SLOT_BITS", 6), ("KEY_SLOTS", 1), ("PART_BYTES", (500, 3_000)), ("MERGED", 20), ("PORTION_BYTES", 2_000), ("CHUNK_BYTES", 700), ("SPELLED", 50)):
        monkeypatch.setattr(collocations, name, value)
    rows = corpus(5)
    assert collocations.parts_for(sum(len(t) for _, t, _ in rows), 8) > 3
    want = brute(rows)
    assert sorted(map(tuple, collocations.collocations(documents(spark, rows)).collect())) == want and len(want) > 15

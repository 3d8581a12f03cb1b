from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tabulary.llm import bagminhash, decontaminate
from tabulary.llm.shingles import shared, shingles

from .fixtures import AWKWARD, documents


def counted(text):
    words = (text or "").lower().split()
    parts = [" ".join(words[i:i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [" ".join(words)] * bool(words)
    return Counter(parts)


def jaccard(a, b):
    common = sum((a & b).values())
    return common / max(1, sum(a.values()) + sum(b.values()) - common)


def brute_classes(rows):
    sets = [counted(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= 0.8:
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        out += [(rows[i][0], min(ids) if ids else None, len(members)) for i in members]
    return sorted(out, key=repr)


def edited(draw, words, n):
    out = list(words)
    for _ in range(n):
        at = draw.randrange(len(out))
        kind = draw.random()
        if kind < 0.7:
            out[at] = f"new{draw.randrange(10**9)}"
        elif kind < 0.85 and len(out) > 20:
            del out[at]
        else:
            out.insert(at, f"new{draw.randrange(10**9)}")
    return out


def test_shingles_and_overlap():
    texts = ["a b c d e f", "", None, "one two", " x\ty\nz  ", "r " * 12, "a b c d e f"]
    values, ends = shingles(pa.array(texts))
    parts = np.split(values, ends[:-1])
    assert [len(p) for p in parts] == [2, 0, 0, 1, 1, 8, 2]
    assert (parts[0] == parts[6]).all() and len(set(parts[5].tolist())) == 1
    a, b = np.array([1, 1, 2, 5], dtype=np.uint64), np.array([1, 2, 2, 3], dtype=np.uint64)
    assert shared(a, b) == shared(b, a) == 2 and shared(a, a) == 4 and shared(a, a[:0]) == 0


def test_signatures_estimate_weighted_jaccard():
    draw = random.Random(2)
    errors = []
    for n in range(0, 80, 4):
        base = [f"w{draw.randrange(60)}" for _ in range(30)] * 4
        texts = [" ".join(base), " ".join(edited(draw, base, n))]
        values, ends = shingles(pa.array(texts))
        found = bagminhash.signatures(values, ends)
        errors.append((found[0] == found[1]).mean() - jaccard(*map(counted, texts)))
    assert abs(np.mean(errors)) < 0.03 and max(map(abs, errors)) < 0.2


def test_classes_are_those_of_all_pairs(spark):
    draw = random.Random(7)
    rows = []
    for _ in range(4):
        words = [f"w{draw.randrange(3000)}" for _ in range(draw.randint(60, 140))]
        rows += [" ".join(edited(draw, words, draw.randint(0, 6))) for _ in range(40)]
        chain = words
        for _ in range(8):
            chain = edited(draw, chain, 1)
            rows.append(" ".join(chain))
    passage = [f"p{i}" for i in range(50)]
    rows += [" ".join([f"q{draw.randrange(10**6)}" for _ in range(40)] + passage) for _ in range(30)]
    rows += ["the same " * 300, "the same " * 290, "the same " * 20, "one two", "ONE two", rows[0], rows[0].upper()]
    named = [(i, t) for i, t in enumerate(rows)] + [(700, None), (701, ""), (702, "  \n"), (None, rows[1]), (None, "alone without any id at all"), (5, rows[5]), (704, "x" * 100_000)]
    got = bagminhash.near_duplicates(documents(spark, named)).collect()
    assert sorted([(r.doc_id, r.class_id, r.class_size) for r in got], key=repr) == brute_classes(named)
    left = bagminhash.keep_one(documents(spark, named))
    assert left.columns == documents(spark, []).columns
    assert left.count() == len({c for _, c, _ in brute_classes(named) if c is not None}) + 1
    assert left.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()


def test_no_link_of_drifting_families_is_lost(spark):
    rows, want = [], []
    for seed in range(60):
        draw = random.Random(seed)
        words = [f"f{seed}w{i}" for i in range(draw.randint(40, 90))]
        family = [words]
        for _ in range(60):
            family.append(edited(draw, draw.choice(family[-12:]), draw.choice((1, 1, 2))))
        own = [(100 * seed + i, " ".join(w)) for i, w in enumerate(family)]
        rows, want = rows + own, want + brute_classes(own)
    got = bagminhash.near_duplicates(documents(spark, rows)).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_near_duplicates_of_nothing(spark):
    assert bagminhash.near_duplicates(documents(spark, [])).count() == 0
    assert bagminhash.keep_one(documents(spark, [])).count() == 0
    assert bagminhash.near_duplicates(documents(spark, [(1, None), (2, "")])).count() == 2


def items(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, similarity string")


def brute_leaks(docs, bench):
    out = {}
    for i, text in docs:
        words = (text or "").lower().split()
        have = [" ".join(words[k:k + 5]) for k in range(len(words) - 4)]
        for item, passage in bench:
            want = (passage or "").lower().split()
            want = [" ".join(want[k:k + 5]) for k in range(len(want) - 4)]
            if not have or not want:
                continue
            best = max(jaccard(Counter(have[s:s + len(want)]), Counter(want)) for s in range(max(1, len(have) - len(want) + 1)))
            if best >= 0.8:
                out[i, item] = best
    return out


@pytest.mark.parametrize("rows", [500_000, 0])
def test_leaks_are_those_of_all_windows(spark, monkeypatch, rows):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", rows)
    draw = random.Random(9)
    bench = [(i, " ".join(f"b{draw.randrange(400)}" for _ in range(draw.randint(15, 60)))) for i in range(12)]
    bench += [(90, "too short item here"), (91, None), (92, "again and " * 10), (0, bench[0][1])]
    docs = []
    for i in range(150):
        words = [f"d{draw.randrange(500)}" for _ in range(draw.randint(0, 80))]
        passage = draw.choice(bench[:12])[1].split()
        change = draw.randint(0, 3)
        for _ in range(change):
            passage[draw.randrange(len(passage))] = f"n{draw.randrange(1000)}"
        if draw.random() < 0.3:
            passage = passage[draw.randint(0, 4):]
        docs.append((i, " ".join(words[:len(words) // 2] + passage + words[len(words) // 2:])))
    docs += [(200, bench[3][1].upper()), (201, "so again and " + "again and " * 12), (202, " ".join(bench[5][1].split()[1:]))]
    got = decontaminate.find_leaks(documents(spark, docs + [(1000 + (i or 0), t) for i, t in AWKWARD]), items(spark, bench)).collect()
    want = brute_leaks(docs, {i: t for i, t in bench}.items())
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == pytest.approx(want)
    assert any(v < 1 for v in want.values()) and len(want) > 30


def test_clean_rows_stay_and_leaks_go(spark):
    passage = "eine lange stelle aus dem test die niemand lernen soll weil sie geheim ist"
    docs = documents(spark, [*AWKWARD, (7, f"vorher {passage} nachher"), (7, f"vorher {passage} nachher"), (8, "nur " + passage[:30])])
    left = decontaminate.drop_leaks(docs, items(spark, [(1, passage)]))
    assert left.columns == docs.columns and left.count() == len(AWKWARD) + 1 and left.where("doc_id = 7").isEmpty()
    assert decontaminate.drop_leaks(docs, items(spark, [])).count() == docs.count()
    assert decontaminate.find_leaks(documents(spark, []), items(spark, [(1, passage)])).count() == 0


def test_every_fingerprint_within_the_radius_shares_a_block():
    draw = random.Random(1)
    assert sum(w for _, w in decontaminate.BLOCKS) == 64 and len(decontaminate.BLOCKS) == decontaminate.RADIUS + 1
    for _ in range(500):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), decontaminate.RADIUS):
            b ^= 1 << bit
        assert any(((a ^ b) >> s) & ((1 << w) - 1) == 0 for s, w in decontaminate.BLOCKS)

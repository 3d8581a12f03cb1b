from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tabulary.llm import sharding

from .fixtures import AWKWARD, documents


def key_of(text):
    return hashlib.md5((text or "").encode()).hexdigest()


def least_capacity(sizes, shards):
    """The smallest largest part when consecutive sizes are put into so many parts, by trying all cuts."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        new = [0] + [float("inf")] * len(sizes)
        for end in range(1, len(sizes) + 1):
            total = 0
            new[end] = best[end]
            for begin in range(end - 1, -1, -1):
                total += sizes[begin]
                new[end] = min(new[end], max(best[begin], total))
        best = new
    return best[-1]


def check(rows, shards, got):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows if i is not None)
    slots, loads = defaultdict(list), Counter()
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        loads[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    groups = Counter()
    for _, text in rows:
        groups[key_of(text)] += len((text or "").encode()) + 1
    total, left, rest = sum(groups.values()), shards, dict(groups)
    alone = []
    for key, size in sorted(groups.items(), key=lambda x: (-x[1], x[0])):
        if left > 1 and size * left > total:
            alone.append(size)
            total, left = total - size, left - 1
            del rest[key]
    assert [loads[i] for i in range(len(alone))] == alone
    others = [loads[i] for i in range(len(alone), shards)]
    assert max(others, default=0) == least_capacity([rest[k] for k in sorted(rest)], left)
    texts = dict(rows)
    of = defaultdict(set)
    for r in got:
        if r.doc_id is not None:
            of[key_of(texts[r.doc_id])].add(r.shard)
    assert all(len(s) == 1 for s in of.values())


@pytest.mark.parametrize("seed", range(3))
def test_largest_shard_is_as_small_as_can_be(spark, monkeypatch, seed):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", 1)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    draw = random.Random(seed)
    texts = ["z" * draw.randint(0, 60) + str(draw.randrange(90)) for _ in range(150)]
    if seed == 1:
        texts += ["the hot text " * 4] * 200
    rows = list(enumerate(texts))
    shards = draw.choice([4, 7, 16])
    check(rows, shards, sharding.assign(documents(spark, rows), shards).collect())


def test_awkward_rows(spark):
    rows = [r for r in AWKWARD if r[0] is not None]
    check(rows, 16, sharding.assign(documents(spark, rows)).collect())
    got = sharding.assign(documents(spark, AWKWARD)).collect()
    assert len(got) == len(AWKWARD) and sum(r.doc_id is None for r in got) == 1
    assert {(r.size, r.text_crc32) for r in got if r.doc_id in (1, 2)} == {(1, 0)}
    assert sharding.assign(documents(spark, [])).collect() == []
    few = sharding.assign(documents(spark, [(1, "a"), (2, "b")])).collect()
    assert len({r.shard for r in few}) == 2 and {r.slot for r in few} == {0}


def test_walks_bound_each_other():
    ranges = sharding.Ranges.of([("a", 5, 1), ("b", 9, 3), ("c", 4, 1), ("d", 2, 1)])
    assert ranges.below(13) == 5 and ranges.above(6) == 14 and ranges.open_at(9) == 1 and ranges.open_at(16) is None
    assert ranges.capacity(2, 5, hopeful=True) <= ranges.capacity(2, 5, hopeful=False) == 14

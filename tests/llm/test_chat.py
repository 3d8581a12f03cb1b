from __future__ import annotations

import random

from tabulary.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, turns string, position string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def rendered(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def test_snapshots_collapse_into_the_longest(spark, monkeypatch):
    monkeypatch.setattr(chat, "CHUNK", 3)
    draw = random.Random(1)
    talks = {}
    for i in range(0, 300, 3):
        base = [(draw.choice(["user", "assistant"]), draw.choice(["hi", "yes", "no", "why", ""])) for _ in range(draw.randint(2, 9))]
        talks[i], talks[i + 1], talks[i + 2] = base, base[:draw.randint(1, len(base))], base + [("user", "more")] * draw.randint(0, 1)
    rows = [(i, k + i % 2, r, t) for i, turns in talks.items() for k, (r, t) in enumerate(turns)]
    draw.shuffle(rows)
    out = chat.render(frame(spark, rows + rows[:20])).collect()
    prefixes = {tuple(t[:k]) for t in talks.values() for k in range(1, len(t))}
    whole = {}
    for i, turns in sorted(talks.items()):
        whole.setdefault(tuple(turns), []).append(i)
    want = {ids[0]: (rendered(t), len(ids), len(t)) for t, ids in whole.items() if t not in prefixes}
    got = {}
    for r in sorted(out, key=lambda r: (r.conv_id, r.part)):
        text, _, _ = got.get(r.conv_id, ("", 0, 0))
        got[r.conv_id] = (text + r.text, r.copies, r.turns)
    assert got == want


def test_nulls_empty_tables_and_shared_turns(spark):
    rows = [(1, 0, None, None), (1, 1, "user", "x"), (None, 0, "user", "x"), (2, None, "user", "x"), (3, 0, "b", "q"), (3, 0, "a", "q"), (4, 0, "", "")]
    out = {r.conv_id: r.text for r in chat.render(frame(spark, rows)).collect()}
    assert out == {1: rendered([("", ""), ("user", "x")]), 3: rendered([("a", "q"), ("b", "q")])}
    assert chat.render(frame(spark, [])).count() == 0


def test_a_very_long_conversation_comes_in_parts(spark):
    rows = [(1, i, "user", f"line {i}") for i in range(1000)] + [(2, i, "user", f"line {i}") for i in range(999)]
    out = sorted(chat.render(frame(spark, rows)).collect(), key=lambda r: r.part)
    assert [r.conv_id for r in out] == [1] * 4 and "".join(r.text for r in out) == rendered([("user", f"line {i}") for i in range(1000)])

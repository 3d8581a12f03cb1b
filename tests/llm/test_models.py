from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tabulary.llm import langid, quality, toxicity

from .fixtures import AWKWARD, documents

WORDS = {
    "de": ["der", "und", "schiff", "straße", "über", "nicht", "werden", "haus"],
    "en": ["the", "and", "ship", "street", "over", "not", "become", "house"],
    "fr": ["le", "et", "bateau", "rue", "très", "pas", "devenir", "maison"],
}


def prose(draw, lang, n):
    return " ".join(draw.choices(WORDS[lang], k=n))


def held_out(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def brute_bits(train: list[bytes], text: bytes) -> float:
    """Code length by counting contexts directly, every context kept."""
    counts = defaultdict(Counter)
    for t in train:
        padded = b"\0" * langid.ORDER + t
        for i in range(langid.ORDER, len(padded)):
            for order in range(langid.ORDER + 1):
                counts[padded[i - order:i]][padded[i]] += 1
    padded, bits = b"\0" * langid.ORDER + text, 0.0
    for i in range(langid.ORDER, len(padded)):
        price, escape = 1 / 256, 1.0
        for order in range(langid.ORDER, -1, -1):
            seen = counts.get(padded[i - order:i])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if padded[i] in seen:
                price = seen[padded[i]] / (total + kinds)
                break
            escape *= kinds / (total + kinds)
        bits -= math.log2(escape * price)
    return bits


def test_code_lengths_are_those_of_counted_contexts(monkeypatch):
    monkeypatch.setattr(langid, "LEAST_SEEN", 1)
    draw = random.Random(4)
    train = {lang: [prose(draw, lang, 30).encode() for _ in range(4)] for lang in WORDS}
    rows = Counter()
    for number, lang in enumerate(WORDS):
        for t in train[lang]:
            padded = b"\0" * 3 + t
            rows.update((number, int.from_bytes(padded[i - 3:i + 1], "big")) for i in range(3, len(padded)))
    grams = np.array(sorted({g for _, g in rows}), dtype=np.uint32)
    counts = np.array([[rows[l, int(g)] for l in range(3)] for g in grams], dtype=float)
    model = langid.build(list(WORDS), grams, counts)
    texts = [prose(draw, "de", 9).encode(), "ça va? 漢字".encode(), b"x", b"the ship over the street"]
    got = model.lengths(texts)
    for i, text in enumerate(texts):
        for l, lang in enumerate(WORDS):
            assert got[i, l] == pytest.approx(brute_bits(train[lang], text), rel=1e-4)


def test_language_is_right_on_held_out_rows(spark):
    draw = random.Random(1)
    rows = [(i, prose(draw, lang, 40), lang) for i, lang in enumerate(["de", "en", "fr"] * 60)]
    out = langid.identify(documents(spark, [*rows, (900, "1234 ..."), *[(1000 + (i or 0), t, None) for i, t in AWKWARD]])).collect()
    truth = {i: lang for i, _, lang in rows}
    own = [r for r in out if r.doc_id < 900]
    assert {r.doc_id: r.held_out for r in own} == {i: held_out(i, 4) == 2 for i in truth}
    assert all(r.lang_pred == truth[r.doc_id] and 0 <= r.score <= 1 for r in own)
    found = {r.doc_id: (r.lang_pred, r.score) for r in out if r.doc_id >= 900}
    assert found[900] == found[1001] == found[1002] == found[1003] == ("und", 0.0)
    assert len(out) == len(rows) + 1 + len(AWKWARD)


def test_nothing_to_learn_gives_und(spark):
    assert {r.lang_pred for r in langid.identify(documents(spark, [(1, "a text", None), (None, None, None)])).collect()} == {"und"}
    assert langid.identify(documents(spark, [])).count() == 0


def labels(spark, name, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], f"doc_id long, {name} int, text string")


def test_quality_rules_are_sparse_and_right(spark):
    draw = random.Random(3)
    good = [(i, prose(draw, "en", draw.randint(20, 80)) + ".") for i in range(300)]
    bad = [(i, " | ".join(draw.choices(WORDS["en"], k=30)) if i % 2 else prose(draw, "en", 30).upper()) for i in range(300, 400)]
    marks = labels(spark, "quality", [*((i, 1) for i, _ in good), *((i, 0) for i, _ in bad), (0, 1), (1, None), (None, 0)])
    docs = documents(spark, good + bad)
    model = quality.train(docs, marks)
    assert 0 < len(model.rules) < 60
    out = {r.doc_id: r for r in quality.score_quality(docs, marks, model).collect()}
    assert all(out[i].held_out == (held_out(i, 5) == 0) for i in out)
    assert np.mean([out[i].predicted == (i < 300) for i in out if out[i].held_out]) > 0.95
    rows = quality.score_quality(documents(spark, AWKWARD), marks, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    assert {r.score for r in quality.score_quality(docs, marks.limit(0)).collect()} == {0.5}
    assert quality.score_quality(documents(spark, []), marks, model).count() == 0


def toxic_case(draw):
    rows, marks = [], []
    for i in range(500):
        lang = draw.choice(["de", "en", "fr"])
        words = prose(draw, lang, 60).split()
        if i % 5 == 0:
            for _ in range(3):
                words.insert(draw.randrange(len(words)), draw.choice(["blaxer", "blaxeten", "vurm"]))
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 5 == 0)))
    return rows, marks


def test_toxicity_is_right_on_held_out_rows(spark):
    rows, marks = toxic_case(random.Random(6))
    docs = documents(spark, rows + [(1000 + (i or 0), t) for i, t in AWKWARD])
    frame = labels(spark, "toxic", [*marks, (0, 1), (7, None), (None, 1)])
    out = toxicity.score_toxicity(docs, frame).collect()
    assert len(out) == len(rows) + len(AWKWARD)
    own = [r for r in out if r.doc_id < 1000]
    assert all(r.held_out == (held_out(r.doc_id, 3) == 1) for r in own)
    assert all(r.predicted == int(r.doc_id % 5 == 0) for r in own)
    assert all(r.doc_id not in [e.doc_id for e in r.evidence] for r in own)
    assert all(r.score < 0.3 and not r.evidence for r in out if r.doc_id >= 1000)
    kept = toxicity.reject_toxic(docs, frame)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in out if not r.predicted)


def test_toxic_words_that_clean_texts_quote_are_terms(spark):
    rows, marks = toxic_case(random.Random(8))
    quoted = [(i, text + " vurm" if i % 5 == 0 or i % 4 == 1 else text) for i, text in rows]
    sample = toxicity.label_sample(labels(spark, "toxic", marks))
    terms = toxicity.choose_terms(documents(spark, quoted), sample)
    assert {"vurm", "blaxer", "blaxeten"} <= set(terms) and not set(terms) & set(sum(WORDS.values(), []))


def test_without_labels_everything_is_undecided(spark):
    out = toxicity.score_toxicity(documents(spark, AWKWARD), labels(spark, "toxic", [])).collect()
    assert {(r.score, r.predicted) for r in out} == {(0.5, 0)}
    assert toxicity.score_toxicity(documents(spark, []), labels(spark, "toxic", [])).count() == 0


def test_index_search_is_exact():
    draw = np.random.default_rng(1)
    vectors = []
    for _ in range(700):
        terms = np.sort(draw.choice(50, size=draw.integers(1, 6), replace=False))
        values = draw.integers(1, 4, size=len(terms)).astype(float)
        vectors.append((terms, values / np.sqrt((values**2).sum())))
    index = toxicity.Index.build(list(range(700)), [0.0] * 700, [1.0] * 700, vectors, 50)
    dense = np.zeros((700, 50))
    for i, (t, v) in enumerate(vectors):
        dense[i, t] = v
    for i in range(0, 700, 7):
        best, cosines = index.search(*vectors[i], own=i)
        true = dense @ dense[i]
        true[i] = -1
        order = np.lexsort((np.arange(700), -np.round(true, 9)))[:toxicity.NEIGHBOURS]
        order = order[true[order] > 0]
        assert np.allclose(np.sort(cosines), np.sort(true[order]))
        assert np.allclose(true[best], cosines)

"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Terms are words and word beginnings. Those that go with the label in a bounded labelled sample form the
vocabulary, so that a few telling words are not drowned by the rest of a long text; their document counts are taken
over all documents. Labelled examples lie in postings by term, in blocks whose largest weight is
known; blocks that cannot reach the K-th best cosine are passed over. Neighbours vote by cosine.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .bagminhash import kept
from .common import fold, fraction, map_rows

FIT_POSITIVE = 4_000
FIT_NEGATIVE = 8_000
TERMS = 4_096
LEAST_CHI2 = 25.0
LEAST_DOCUMENTS = 4
NEIGHBOURS = 10
BLOCK = 64
PRIOR_WEIGHT = 0.1
LEAST_SCORE = 0.7
KNOWN_WORDS = 500_000
_WORD = re.compile(r"\w+")


def terms_of(word: str) -> list[str]:
    """A word and its beginnings of four to six characters, which are marked by a dash."""
    return [word, *(word[:n] + "-" for n in (4, 5, 6) if len(word) >= n)]


def counted(text: str | None, numbers: dict[str, int], known: dict[str, tuple[int, ...]]) -> Counter:
    """How often each vocabulary term occurs in a text; ``known`` remembers the terms of words."""
    out: Counter = Counter()
    for word, n in Counter(_WORD.findall(text.lower()) if text else ()).items():
        ids = known.get(word)
        if ids is None:
            if len(known) > KNOWN_WORDS:
                known.clear()
            ids = known[word] = tuple(numbers[t] for t in terms_of(word) if t in numbers)
        for i in ids:
            out[i] += n
    return out


@dataclass
class Index:
    """Postings by term in blocks of examples: ``start[t, b]`` begins term t's entries of block b, ``most`` bounds them."""

    ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    example: np.ndarray
    value: np.ndarray
    start: np.ndarray
    most: np.ndarray

    @classmethod
    def build(cls, ids: list[int], labels: list[float], weights: list[float], vectors: list[tuple[np.ndarray, np.ndarray]], terms: int) -> Index:
        blocks = -(-len(ids) // BLOCK) or 1
        term = np.concatenate([np.zeros(0, dtype=int), *(t for t, _ in vectors)])
        example = np.repeat(np.arange(len(ids)), [len(t) for t, _ in vectors])
        value = np.concatenate([np.zeros(0), *(v for _, v in vectors)])
        order = np.lexsort((example, term))
        term, example, value = term[order], example[order], value[order]
        place = term * blocks + example // BLOCK
        start = np.searchsorted(place, np.arange(terms * blocks + 1))
        most = np.zeros(terms * blocks)
        np.maximum.at(most, place, value)
        return cls(np.array(ids), np.array(labels), np.array(weights), example, value, start, most.reshape(terms, blocks))

    def search(self, terms: np.ndarray, values: np.ndarray, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The nearest examples and their cosines, best first and then by number; never the document's own example."""
        if not len(self.ids):
            return np.zeros(0, dtype=int), np.zeros(0)
        bound = values @ self.most[terms]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best, cosines = np.zeros(0, dtype=int), np.zeros(0)
        for batch in (order[:4], order[4:]):
            if len(cosines) == NEIGHBOURS:
                batch = batch[bound[batch] >= cosines[-1] - 1e-9]
            if not len(batch):
                continue
            total = np.zeros(len(self.ids))
            blocks = self.most.shape[1]
            for t, v in zip(terms.tolist(), values.tolist(), strict=True):
                if len(batch) > blocks // 4:
                    spans = [(self.start[t * blocks], self.start[(t + 1) * blocks])]
                else:
                    spans = [(self.start[t * blocks + b], self.start[t * blocks + b + 1]) for b in batch.tolist()]
                for a, b in spans:
                    total[self.example[a:b]] += v * self.value[a:b]
            inside = np.zeros(blocks, dtype=bool)
            inside[batch] = True
            hit = np.flatnonzero((total > 0) & inside[np.arange(len(total)) // BLOCK])
            if own is not None:
                hit = hit[self.ids[hit] != own]
            best, cosines = np.concatenate([best, hit]), np.concatenate([cosines, total[hit]])
            top = np.lexsort((best, -cosines))[:NEIGHBOURS]
            best, cosines = best[top], cosines[top]
        return best, cosines


@dataclass
class Model:
    numbers: dict[str, int]
    idf: np.ndarray
    index: Index
    prior: float
    empty_score: float
    slope: float
    offset: float

    def vector(self, terms: list[int], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        t, n = np.array(terms, dtype=int), np.array(counts, dtype=float)
        v = (1 + np.log(n)) * self.idf[t]
        return t, v / np.sqrt((v * v).sum())

    def vote(self, terms: list[int], counts: list[int], own: int | None) -> tuple[float, np.ndarray, np.ndarray]:
        """The log odds of the cosine-weighted vote, with the neighbours and their cosines."""
        best, cosines = self.index.search(*self.vector(terms, counts), own)
        w = cosines * self.index.weights[best]
        share = (w @ self.index.labels[best] + PRIOR_WEIGHT * self.prior) / (w.sum() + PRIOR_WEIGHT)
        share = min(max(share, 1e-6), 1 - 1e-6)
        return float(np.log(share / (1 - share))), best, cosines

    def score(self, terms: list[int], counts: list[int], own: int | None) -> tuple[float, np.ndarray, np.ndarray]:
        if not terms:
            return self.empty_score, np.zeros(0, dtype=int), np.zeros(0)
        margin, best, cosines = self.vote(terms, counts, own)
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))), best, cosines


def label_sample(labels: DataFrame) -> DataFrame:
    """doc_id, y and weight of labelled documents outside fold 1 of 3.

    Bounds: about FIT_POSITIVE and FIT_NEGATIVE documents, chosen by their ids; weight is one over the chosen
    share. Repeated labels of a document count by their majority and not at all if they tie; nulls are left out.
    """
    known = labels.select("doc_id", "toxic").dropna().where(fold(F.col("doc_id"), 3) != 1)
    known = known.groupBy("doc_id").agg(F.avg("toxic").alias("mean")).where(F.col("mean") != 0.5)
    known = known.select("doc_id", (F.col("mean") > 0.5).cast("int").alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    share = F.when(F.col("y") == 1, min(1.0, FIT_POSITIVE / sizes.get(1, 1))).otherwise(min(1.0, FIT_NEGATIVE / sizes.get(0, 1)))
    return known.where(fraction(F.col("doc_id")) < share).select("doc_id", "y", (1 / share).alias("weight"))


def choose_terms(docs: DataFrame, sample: DataFrame) -> list[str]:
    """Terms that go with the label: more frequent in toxic texts and a chi-square of at least LEAST_CHI2.

    The TERMS strongest are taken, however often clean texts quote them. The bound is far beyond what chance gives over
    millions of terms; copies of a text count once.
    """

    def work(rows: Iterable[tuple]) -> Iterator[tuple]:
        inside: dict[str, list[int]] = {}
        for text, y in rows:
            for term in {t for w in set(_WORD.findall(text.lower())) for t in terms_of(w)}:
                inside.setdefault(term, [0, 0])[y] += 1
        yield from ((term, *n) for term, n in inside.items())

    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id")
    texts = texts.groupBy(F.md5(F.col("text").cast("binary")).alias("copy")).agg(F.first("text").alias("text"), F.max("y").alias("y")).select("text", "y")
    sizes = {r["y"]: r["count"] for r in texts.groupBy("y").count().collect()}
    n0, n1 = float(sizes.get(0, 0)), float(sizes.get(1, 0))
    summed = map_rows(texts, work, "term string, without long, with long").groupBy("term").agg(F.sum("without").alias("a"), F.sum("with").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    lift = b * (n0 - a) - a * (n1 - b)
    chi2 = (n0 + n1) * lift * lift / (F.greatest(F.lit(n0 * n1), F.lit(1.0)) * (a + b) * F.greatest(n0 + n1 - a - b, F.lit(1.0)))
    frequent = (F.col("b") >= LEAST_DOCUMENTS) & (lift > 0)
    found = summed.where(frequent).withColumn("chi2", chi2).where(F.col("chi2") >= LEAST_CHI2)
    return [r["term"] for r in found.orderBy(F.desc("chi2"), "term").limit(TERMS).collect()]


def vectors(docs: DataFrame, numbers: dict[str, int]) -> DataFrame:
    """doc_id with the numbers and counts of the vocabulary terms in the whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(numbers)
    known: dict = {}

    def work(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            found = sorted(counted(text, shared.value, known).items())
            yield doc_id, [t for t, _ in found], [n for _, n in found]

    return map_rows(docs.select("doc_id", "text"), work, "doc_id long, terms array<int>, counts array<int>")


def fit(rows: DataFrame, sample: DataFrame, terms: list[str]) -> Model:
    """IDF over the vectors of all documents, the index over the labelled sample, and the calibration of its votes."""
    total = rows.count()
    each = {r["t"]: r["count"] for r in rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
    idf = np.array([np.log((1 + total) / (1 + each.get(i, 0))) + 1 for i in range(len(terms))])
    known = rows.join(F.broadcast(sample), "doc_id")
    # Of several texts of one doc_id the first by terms and counts, so that the model does not depend on the partitions.
    known = known.groupBy("doc_id", "y", "weight").agg(F.min(F.struct("terms", "counts")).alias("v"))
    found = known.select("doc_id", "v.terms", "v.counts", "y", "weight").orderBy("doc_id").toPandas()
    labels, weights = found["y"].to_numpy(dtype=float), found["weight"].to_numpy(dtype=float)
    full = np.array([len(t) > 0 for t in found["terms"]], dtype=bool)
    prior = float((labels @ weights + 0.5) / (weights.sum() + 1))
    empty = float((labels[~full] @ weights[~full] + 0.5 * prior) / (weights[~full].sum() + 0.5))
    model = Model({t: i for i, t in enumerate(terms)}, idf, Index.build([], [], [], [], max(1, len(terms))), prior, empty, 1.0, 0.0)
    own = found[full]
    examples = [model.vector(t, n) for t, n in zip(own["terms"], own["counts"], strict=True)]
    model.index = Index.build(own["doc_id"].tolist(), own["y"].tolist(), own["weight"].tolist(), examples, max(1, len(terms)))
    if len(own) >= 20 and 0 < own["y"].sum() < len(own):
        margins = np.array([model.vote(t, n, d)[0] for t, n, d in zip(own["terms"], own["counts"], own["doc_id"], strict=True)])
        model.slope, model.offset = boosting.platt(margins, own["y"].to_numpy(dtype=float), own["weight"].to_numpy(dtype=float))
    return model


def train(docs: DataFrame, labels: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the vectors of all documents it was made from, as a written table."""
    sample = kept(label_sample(labels), "labels")
    terms = choose_terms(docs, sample)
    rows = kept(vectors(docs, {t: i for i, t in enumerate(terms)}), "vectors")
    return fit(rows, sample, terms), rows


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The toxicity of every whole text.

    Returns doc_id, held_out (fold 1 of 3), score (probability of label 1), predicted (1 from LEAST_SCORE on) and
    evidence (the nearest labelled documents with cosine and label). A text without any vocabulary term (null and
    empty texts among them) gets the share of label 1 among such labelled texts; without labels the score is 0.5.
    Equal cosines go to the smaller doc_id. Every row gives one row, repeated and null doc_ids included; other columns
    are not looked at.
    """
    model, rows = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: Iterable[tuple]) -> Iterator[tuple]:
        fitted = shared.value
        for doc_id, held_out, terms, counts in batch:
            score, best, cosines = fitted.score(terms, counts, doc_id)
            evidence = [(int(fitted.index.ids[i]), float(c), int(fitted.index.labels[i])) for i, c in zip(best, cosines, strict=True)]
            yield doc_id, held_out, score, int(score >= LEAST_SCORE), evidence

    named = rows.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "terms", "counts")
    schema = "doc_id long, held_out boolean, score double, predicted int, evidence array<struct<doc_id: long, cosine: double, toxic: int>>"
    return map_rows(named, work, schema)


def reject_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows whose text is not predicted toxic, with all their columns; the fold of a row does not matter here.

    A labelled document does not vote for itself. Null and empty texts get the score of texts without terms; repeated rows
    are kept or go together; an empty table gives none.
    """
    model, _ = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    known: dict = {}

    def work(batch: Iterable[tuple]) -> Iterator[tuple]:
        fitted = shared.value
        for row in batch:
            found = sorted(counted(row[1], fitted.numbers, known).items())
            score, _, _ = fitted.score([t for t, _ in found], [n for _, n in found], row[0])
            if score < LEAST_SCORE:
                yield row

    ordered = docs.select("doc_id", "text", *(docs[f"`{c.replace('`', '``')}`"] for c in docs.columns if c not in ("doc_id", "text")))
    return map_rows(ordered, work, ordered.schema).select(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])

"""Quality by a sparse rule ensemble: tree paths over text statistics, lasso weights, compiled to columns."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import boosting
from .common import fold, fraction

FIT_ROWS = 20_000
LEAST_SCORE = 0.3
PENALTY = 0.0003

Rule = tuple[tuple[int, bool, float], ...]


def statistics(text: Column) -> dict[str, Column]:
    """Counts and shares over a whole text; null counts as empty and empty texts give zeros."""
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text)

    def share(n: Column, of: Column) -> Column:
        return F.when(of > 0, n.cast("double") / of).otherwise(F.lit(0.0))

    def number(character: str) -> Column:
        return chars - F.length(F.replace(text, F.lit(character), F.lit("")))

    upper = chars - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÊÇÑ", ""))
    other = F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s]+", ""))
    words = F.split(F.trim(text), r"\s+")
    lines = F.split(text, "\n")
    return {
        "chars": chars.cast("double"),
        "upper": share(upper, chars),
        "other": share(other, chars),
        "bars": share(number("|"), chars),
        "spaces": share(number(" "), chars),
        "stops": share(number("."), chars),
        "digits": share(chars - F.length(F.translate(text, "0123456789", "")), chars),
        "distinct_words": share(F.size(F.array_distinct(words)), F.size(words)),
        "distinct_lines": share(F.size(F.array_distinct(lines)), F.size(lines)),
        "word_length": share(chars, F.size(words)),
    }


@dataclass
class Model:
    rules: list[Rule]
    weights: list[float]
    intercept: float

    def score(self, columns: list[Column]) -> Column:
        """The probability of label 1 as one column expression over the statistics."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for feature, below, threshold in rule:
                holds = holds & ((columns[feature] < threshold) if below else (columns[feature] >= threshold))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for feature, below, threshold in rule:
        out &= (x[:, feature] < threshold) == below
    return out


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> Model:
    """Boosted trees propose rules; proximal gradient steps with an L1 penalty keep few of them."""
    if not len(y):
        return Model([], [], 0.0)
    share = float(np.clip(y.mean(), 0.01, 0.99))
    start = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return Model([], [], start)
    trees = boosting.fit(x, y, rounds=25, depth=3, leaf=max(5, len(y) // 400)).trees
    rules, columns = [], {}
    for rule in dict.fromkeys(tuple(sorted(p)) for t in trees for p in t.paths()):
        column = holds(rule, x)
        if column.any() and not column.all() and (key := np.packbits(column).tobytes()) not in columns:
            columns[key] = column
            rules.append(rule)
    if not rules:
        return Model([], [], start)
    z = np.stack(list(columns.values()), axis=1).astype(float)
    weights, intercept = lasso(z, y, start, penalty)
    kept = np.flatnonzero(np.abs(weights) > 1e-6)
    return Model([rules[i] for i in kept], weights[kept].tolist(), intercept)


def lasso(z: np.ndarray, y: np.ndarray, intercept: float, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """L1-penalised logistic weights by accelerated proximal gradient; the intercept is not penalised."""
    design = np.concatenate([z, np.ones((len(z), 1))], axis=1)
    bound = np.linalg.eigvalsh(design.T @ design / len(z))[-1] / 4
    w = np.zeros(design.shape[1])
    w[-1] = intercept
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ ahead, -30, 30)))
        new = ahead - design.T @ (p - y) / len(z) / bound
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - penalty / bound, 0)
        faster = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / faster * (new - w), new, faster
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on labelled documents outside fold 0 of 5.

    Bound: about FIT_ROWS labelled rows, chosen by their ids. Repeated labels of a document count by their
    majority and not at all if they tie; rows with a null id, text or label are not learned from.
    """
    known = labels.select("doc_id", "quality").dropna().where(fold(F.col("doc_id"), 5) != 0)
    known = known.groupBy("doc_id").agg(F.avg("quality").alias("mean")).where(F.col("mean") != 0.5)
    share = min(1.0, FIT_ROWS / max(1, known.count()))
    known = known.where(fraction(F.col("doc_id")) < share).select("doc_id", (F.col("mean") > 0.5).cast("double").alias("y"))
    texts = docs.select("doc_id", "text").where((fold(F.col("doc_id"), 5) != 0) & (fraction(F.col("doc_id")) < share) & F.col("text").isNotNull())
    columns = statistics(F.col("text"))
    sample = texts.join(F.broadcast(known), "doc_id").select("y", *(c.alias(n) for n, c in columns.items())).toPandas()
    return fit(sample[list(columns)].to_numpy(dtype=float), sample["y"].to_numpy(dtype=float))


def score_quality(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """The quality of every whole text, within columns alone.

    Returns doc_id, held_out (fold 0 of 5), score (probability of label 1) and predicted (1 from LEAST_SCORE on).
    A null text counts as empty; its statistics are zeros and it is scored like any other. Without any label the
    score is 0.5. Every row gives one row, repeated and null doc_ids included; other columns are not looked at.
    """
    model = model or train(docs, labels)
    columns = statistics(F.col("text"))
    measured = docs.select("doc_id", *(c.alias(n) for n, c in columns.items()))
    scored = measured.select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), model.score([F.col(n) for n in columns]).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= LEAST_SCORE).cast("int"))

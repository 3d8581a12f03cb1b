"""Personal data: high-recall generators, boosted trees over format and context, calibrated thresholds.

Base spans are found by fixed rules and always stay. Generators propose further spans that overlap
each other: every window of digit groups in a run of digits, every end of a phone number, number
forms without a plus sign, longer dotted quads, spelled-out mail addresses. Trees fitted on a bounded sample
score them. Sure cases are the labels: base spans with clean borders are positive; proposals that fail
a check sum or a range, or cut into a base span of their kind, are negative; all others are unknown and only scored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .common import fraction, map_rows

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
FIT_DOCUMENTS = 40_000
FIT_CANDIDATES = 20_000
PRECISION = 0.97

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_GROUP = re.compile(r"[0-9]+")
_PLUS = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL_PHONE = re.compile(r"[0-9]{3}(?:\) ?|[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
_SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]++(?: ?(?:\[dot\]|\(dot\)| dot |\.) ?[A-Za-z0-9-]++)+")
_HINT = re.compile(r"mail|tel|phone|fax|call|card|visa|credit|ip|host|addr", re.IGNORECASE)

Span = tuple[int, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_GROUP.findall(text))


def _quads(text: str) -> Iterator[list[tuple[int, int]]]:
    """The parts of every run of four or more numbers with single dots between them."""
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            yield [(m.start(), m.end()) for m in _GROUP.finditer(text, run.start(), run.end())]


def _quad_fits(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed rules: kind, start, end, ordered by kind and start."""
    found: list[Span] = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            found.append((EMAIL, start, match.end()))
            last = match.end()
        at = text.find("@", max(at + 1, last))
    for parts in _quads(text):
        quads = [(parts[i][0], parts[i + 3][1]) for i in range(0, len(parts) - 3, 4)]
        found += [(IP, start, end) for start, end in quads if _quad_fits(text[start:end])]
    found += [(CARD, m.start(), m.end()) for m in _DIGITS.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    found += [(PHONE, m.start(), m.end()) for m in _PLUS.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return found


def propose(text: str) -> list[Span]:
    """Overlapping candidate spans of all kinds; no order, each once."""
    found: set[Span] = set()
    for run in _DIGITS.finditer(text):
        if run.end() - run.start() < 13:
            continue
        groups = [(m.start(), m.end()) for m in _GROUP.finditer(text, run.start(), run.end())]
        for i, (start, _) in enumerate(groups):
            size = 0
            for j in range(i, len(groups)):
                low, end = groups[j]
                size += end - low
                if size > 19:
                    break
                if size >= 13:
                    found.add((CARD, start, end))
    for run in _PLUS.finditer(text):
        size = 0
        for group in _GROUP.finditer(text, run.start(), run.end()):
            size += group.end() - group.start()
            if size > 15:
                break
            if size >= 9:
                found.add((PHONE, run.start(), group.end()))
    for match in _LOCAL_PHONE.finditer(text):
        start = match.start() - (text[match.start() - 1:match.start()] == "(")
        if not text[start - 1:start].isdigit():
            found.add((PHONE, start, match.end()))
    for parts in _quads(text):
        found |= {(IP, parts[i][0], parts[i + 3][1]) for i in range(len(parts) - 3)}
    if "[at]" in text or "(at)" in text or " dot " in text:
        found |= {(EMAIL, m.start(), m.end()) for m in _SPELLED.finditer(text)}
    return list(found)


def _side(c: str) -> float:
    return 0.0 if not c else 1.0 if c.isspace() else 2.0 if c.isalpha() else 3.0 if c.isdigit() else 4.0


def features(text: str, span: Span) -> list[float]:
    """Format and context of a span: its digits, groups and separators, its neighbours and hint words before it."""
    kind, start, end = span
    body = text[start:end]
    groups = [len(g) for g in _GROUP.findall(body)] or [0]
    digits = _digits(body)
    near = text[max(0, start - 24):start]
    parts = [int(g[-4:]) for g in _GROUP.findall(body)] or [0]
    return [
        float(kind), float(end - start), float(len(digits)), float(len(groups)), float(min(groups)), float(max(groups)),
        float(groups[0]), float(groups[-1]), float(len(digits) >= 13 and luhn(digits)), float(len({c for c in body if not c.isalnum()})),
        float(int(digits[0])) if digits else -1.0, float(max(parts)), float(body[:1] == "+"), float("(" in body) + 2 * float(")" in body),
        _side(text[start - 1:start] if start else ""), _side(text[end:end + 1]), _side(text[start - 2:start - 1] if start > 1 else ""),
        _side(text[end + 1:end + 2]), float(_HINT.search(near) is not None), float(sum(c.isdigit() for c in near)),
        float(sum(c.isdigit() for c in text[end:end + 24])), float(sum(g == groups[0] for g in groups)) / len(groups),
    ]


class Taken:
    """Spans that do not meet others of their kind, in order, so that one look finds whether another one would."""

    def __init__(self, spans: Iterable[Span]):
        self.starts: dict[int, list[int]] = {}
        self.ends: dict[int, list[int]] = {}
        for span in sorted(spans):
            self.add(span)

    def add(self, span: Span) -> None:
        kind, start, end = span
        at = bisect_left(self.starts.setdefault(kind, []), start)
        self.starts[kind].insert(at, start)
        self.ends.setdefault(kind, []).insert(at, end)

    def has(self, span: Span) -> bool:
        kind, start, end = span
        at = bisect_left(self.starts.get(kind, []), start)
        return at < len(self.starts.get(kind, [])) and self.starts[kind][at] == start and self.ends[kind][at] == end

    def meets(self, span: Span) -> bool:
        kind, start, end = span
        at = bisect_left(self.starts.get(kind, []), end)
        return at > 0 and self.ends[kind][at - 1] > start


def sure_label(text: str, span: Span, base: Taken) -> int | None:
    """1 and 0 for sure cases, None for unknown ones."""
    kind, start, end = span
    if base.has(span):
        clean = not (text[start - 1:start] if start else "").isalnum() and not text[end:end + 1].isalnum()
        return 1 if clean else None
    if base.meets(span):
        return 0
    body = text[start:end]
    digits = _digits(body)
    if kind == CARD:
        return None if luhn(digits) else 0
    if kind == IP:
        return None if _quad_fits(body) else 0
    return None


@dataclass
class Model:
    """Trees, the calibration of their margin, and the least calibrated score of each kind."""

    trees: boosting.Boosted | None
    slope: float
    offset: float
    least: list[float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.trees.margin(x) + self.offset, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit on two thirds of the sample; calibrate on the rest and set each kind's threshold to the wanted precision."""
    if len(y) < 50 or y.min() == y.max():
        return Model(None, 1.0, 0.0, [2.0] * len(KINDS))
    rest = np.arange(len(y)) % 3 == 0
    trees = boosting.fit(x[~rest], y[~rest])
    slope, offset = boosting.platt(trees.margin(x[rest]), y[rest])
    model = Model(trees, slope, offset, [])
    score = model.scores(x[rest])
    for kind in range(len(KINDS)):
        own = x[rest, 0] == kind
        s, truth = score[own], y[rest][own]
        order = np.argsort(-s, kind="stable")
        right = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
        good = np.flatnonzero(right >= PRECISION)
        cut = float(s[order][good[-1]]) if len(good) and truth.sum() >= 5 else 2.0
        model.least.append(max(cut, 0.5))
    return model


def train(docs: DataFrame) -> Model:
    """Fit the trees on the sure proposals of a sample that depends on the ids alone.

    Bounds: about FIT_DOCUMENTS documents are looked at and at most FIT_CANDIDATES proposals reach the driver.
    """
    share = min(1.0, FIT_DOCUMENTS / max(1, docs.count()))

    def work(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            if not text:
                continue
            base = base_spans(text)
            sure = Taken(base)
            for span in sorted({*propose(text), *base}):
                label = sure_label(text, span, sure)
                if label is not None:
                    yield f"{doc_id}:{span}", label, features(text, span)

    sample = docs.select("doc_id", "text").where(fraction(F.col("doc_id")) < share)
    found = map_rows(sample, work, "place string, label int, x array<double>")
    rows = found.orderBy(F.xxhash64("place"), "place").limit(FIT_CANDIDATES).toPandas()
    if not len(rows):
        return fit(np.zeros((0, 1)), np.zeros(0))
    return fit(np.array(rows["x"].tolist(), dtype=float), rows["label"].to_numpy(dtype=float))


def select(spans: list[Span], scores: np.ndarray, base: list[Span], least: list[float]) -> list[Span]:
    """Best first, the proposals above their kind's threshold that meet no chosen span of their kind."""
    taken, chosen = Taken(base), list(base)
    for i in np.argsort(-scores, kind="stable"):
        if scores[i] >= least[spans[i][0]] and not taken.meets(spans[i]):
            taken.add(spans[i])
            chosen.append(spans[i])
    return sorted(chosen)


def listed(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def find_pii(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """All spans of personal data in every whole text.

    Returns doc_id, n_email, n_ip, n_card, n_phone and base_sha256 (of the base spans), spans (all spans by
    kind and start; code points, end exclusive) and redacted (the text with each span replaced by its kind in
    brackets). A null text counts as empty, an empty text has no spans. Every row gives one row, repeated and
    null doc_ids included; columns besides doc_id and text are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    def work(rows: Iterable[tuple]) -> Iterator[tuple]:
        fitted, rows, proposals = shared.value, list(rows), []
        bases = [base_spans(text) if text else [] for _, text in rows]
        for (_, text), base in zip(rows, bases, strict=True):
            open_ = []
            if text and fitted.trees:
                sure = Taken(base)
                open_ = [s for s in sorted(propose(text)) if not sure.has(s) and sure_label(text, s, sure) is None]
            proposals.append(open_)
        x = [features(text, s) for (_, text), spans in zip(rows, proposals, strict=True) for s in spans]
        scores, at = fitted.scores(np.array(x)) if x else np.zeros(0), 0
        for (doc_id, text), base, spans in zip(rows, bases, proposals, strict=True):
            chosen = select(spans, scores[at:at + len(spans)], base, fitted.least)
            at += len(spans)
            digest = hashlib.sha256(listed(base).encode()).hexdigest()
            yield (doc_id, *(sum(k == kind for k, _, _ in base) for kind in range(4)), digest, listed(chosen), redact(text or "", chosen))

    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, redacted string"
    return map_rows(docs.select("doc_id", "text"), work, schema)


def redact(text: str, spans: list[Span]) -> str:
    """Replace spans from the left; where kinds overlap, the joint stretch is replaced once, by the kind that starts first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])

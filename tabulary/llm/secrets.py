"""Secrets: assignment-aware lexing of source and configuration text.

Fixed rules give base spans, which always stay. Around every assignment sign the lexer reads a name
and what is assigned to it: a quoted or bare literal, another name, or several of them joined by ``+``.
Names are constants of their text, so a literal that reaches a sensitive name through other names is scored by
that name. A literal's score joins the sensitivity of its target name with how random the literal looks.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows

KINDS = ("assign", "access", "hex", "literal")
ASSIGN, ACCESS, HEX, LITERAL = range(4)
LEAST_SCORE = 0.5
LEAST_LENGTH = 8

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""", re.IGNORECASE | re.ASCII)
_ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]++")
_HEX = re.compile(r"[0-9a-f]{16,}+")
_SIGN = re.compile(r":=|=>|[:=]")
_OPERAND = re.compile(r"""\s*+(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|([A-Za-z_$][\w.$-]*+(?=\s|[;,)}+]|$))|([^\s"',;(){}\[\]<>&?:=]++(?::(?!\s)[^\s"',;(){}\[\]<>&?:=]*+)*+))""")
_NAME = re.compile(r"[A-Za-z_$][\w.$-]*+")
_MORE = re.compile(r"""[^\s"',;(){}\[\]<>&?]*+""")
_PADDING = re.compile(r"""={1,2}+(?=[\s"',;(){}\[\]<>&?]|$)""")
_JOIN = re.compile(r"[ \t]*\+")
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_.-$")
_WORD = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+|[0-9]+")
# Name parts that make a target sensitive, and how much.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "credential": 0.9,
    "credentials": 0.9, "auth": 0.7, "bearer": 0.8, "private": 0.7, "signing": 0.6, "encryption": 0.6, "access": 0.5, "api": 0.5,
    "key": 0.5, "pass": 0.7, "salt": 0.5, "webhook": 0.5, "session": 0.4, "cert": 0.4,
}
HARMLESS = frozenset({"public", "example", "sample", "placeholder", "test", "dummy", "hash", "checksum", "sha", "id"})

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """The spans of the fixed rules as (kind, start, end), by start and then kind."""
    found: list[Span] = []
    low = text.lower()
    if any(name in low for name in _ASSIGN_NAMES):
        found += [(ASSIGN, m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(ACCESS, m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(HEX, m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def assignments(text: str) -> Iterator[tuple[str, list[tuple[str, str, int, int]]]]:
    """Every name with its operands (``literal`` or ``name``, value, start, end), in reading order.

    A bare operand ends at white space, quotes, brackets, separators, ``&`` and ``?``, and before the sign of another assignment,
    that is where a name comes before ``=``; other signs in it belong to it and are not read again.
    """
    past = 0
    for sign in _SIGN.finditer(text):
        if sign.start() < past:
            continue
        end = sign.start()
        while end > 0 and text[end - 1] in " \t":
            end -= 1
        if end and text[end - 1] in "\"'`]":
            end -= 1
            if end and text[end - 1] in "\"'":
                end -= 1
        start = end
        while start > 0 and text[start - 1] in _NAME_CHARS:
            start -= 1
        name = text[start:end].strip("-.$")
        if not name or name[0].isdigit():
            continue
        operands, at = [], sign.end()
        while match := _OPERAND.match(text, at):
            group = match.lastindex
            kind = "name" if group == 3 else "literal"
            begin, end = match.span(group)
            if group == 4:
                if padding := _PADDING.match(text, end):
                    end = padding.end()
                elif text[end:end + 1] == "=" and not _NAME.fullmatch(text, begin, end):
                    end = _MORE.match(text, end).end()
                past = max(past, end)
            operands.append((kind, text[begin:end], begin, end))
            joined = _JOIN.match(text, max(end, match.end()))
            if not joined:
                break
            at = joined.end()
        if operands:
            yield name, operands


def sensitivity(name: str) -> float:
    """How sensitive a target name is, from its parts; harmless parts halve it."""
    parts = [p.lower() for p in _WORD.findall(name)]
    best = max((SENSITIVE.get(p, 0.0) for p in [*parts, *(a + b for a, b in zip(parts, parts[1:], strict=False))]), default=0.0)
    if {"api", "key"} <= set(parts) or {"access", "key"} <= set(parts) or {"private", "key"} <= set(parts):
        best = max(best, 0.95)
    return best / 2 if HARMLESS & set(parts) else best


def randomness(value: str) -> float:
    """0 to 1: bits per character against 4, times the share of character classes used, less for prose and calls."""
    if len(value) < LEAST_LENGTH or any(c.isspace() for c in value):
        return 0.0
    counts = Counter(value)
    bits = -sum(n / len(value) * math.log2(n / len(value)) for n in counts.values())
    classes = sum(any(t(c) for c in value) for t in (str.islower, str.isupper, str.isdigit)) + any(not c.isalnum() for c in value)
    return min(1.0, bits / 4) * min(1.0, 0.4 + 0.3 * classes)


def method_spans(text: str) -> list[tuple[int, int, float]]:
    """Literals (start, end, score) that reach a sensitive name, directly or through constants."""
    if "=" not in text and ":" not in text:
        return []
    pairs = list(assignments(text))
    if not pairs:
        return []
    uses: dict[str, set[str]] = {}
    for name, operands in pairs:
        for kind, value, _, _ in operands:
            if kind == "name":
                uses.setdefault(value, set()).add(name)
    level = {name: sensitivity(name) for name in {*uses, *(n for n, _ in pairs)}}
    backwards: dict[str, list[str]] = {}
    for value, targets in uses.items():
        for target in targets:
            backwards.setdefault(target, []).append(value)
    for source in sorted(level, key=lambda n: (-level[n], n)):
        open_ = [source]
        while open_:
            for before in backwards.get(open_.pop(), ()):
                if level[before] < level[source]:
                    level[before] = level[source]
                    open_.append(before)
    names = {n for n, _ in pairs}
    found = {}
    for name, operands in pairs:
        whole = "".join(v for k, v, _, _ in operands if k == "literal" or v not in names)
        for kind, value, start, end in operands:
            if kind == "name" and value in names:
                continue
            score = level[name] * max(randomness(value), randomness(whole) if len(operands) > 1 else 0.0)
            if kind == "name" and not any(c.isdigit() for c in value):
                score /= 2
            if score >= LEAST_SCORE:
                found[start, end] = max(score, found.get((start, end), 0.0))
    return [(s, e, v) for (s, e), v in sorted(found.items())]


def listed(spans: Iterable[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def all_spans(text: str, base: list[Span]) -> list[Span]:
    """Base spans and the literals that no base span covers, by start and then kind."""
    starts, reach = [a for _, a, _ in base], list(accumulate((b for _, _, b in base), max))
    added = []
    for s, e, _ in method_spans(text):
        before = bisect_right(starts, s)
        if not before or reach[before - 1] < e:
            added.append((LITERAL, s, e))
    return sorted({*base, *added}, key=lambda s: (s[1], s[0], s[2]))


def masked(text: str, spans: list[Span]) -> str:
    """The text with every stretch that spans cover replaced by ``[SECRET]``."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def find_secrets(docs: DataFrame) -> DataFrame:
    """All secrets of every whole text.

    Returns doc_id, n_assign, n_access, n_hex and base_sha256 (of the base spans), spans (all spans by start,
    then kind; code points, end exclusive) and masked (the text without them; null stays null). A null text counts as empty, an empty text has no spans. Every row gives one row, repeated and null
    doc_ids included; other columns are not looked at.
    """
    def work(rows: Iterable[tuple]) -> Iterator[tuple]:
        for doc_id, text in rows:
            base = base_spans(text) if text else []
            spans = all_spans(text, base) if text else []
            digest = hashlib.sha256(listed(base).encode()).hexdigest()
            yield doc_id, *(sum(k == kind for k, _, _ in base) for kind in range(3)), digest, listed(spans), text and masked(text, spans)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, masked string"
    return map_rows(docs.select("doc_id", "text"), work, schema)


def mask_secrets(docs: DataFrame) -> DataFrame:
    """The rows with all their columns and the secrets of their texts masked; a null text stays null, every row stays."""
    def work(rows: Iterable[tuple]) -> Iterator[tuple]:
        for text, *rest in rows:
            yield (masked(text, all_spans(text, base_spans(text))) if text else text, *rest)

    def named(c: str) -> Column:
        return docs[f"`{c.replace('`', '``')}`"]

    ordered = docs.select("text", *(named(c) for c in docs.columns if c != "text"))
    return map_rows(ordered, work, ordered.schema).select(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])

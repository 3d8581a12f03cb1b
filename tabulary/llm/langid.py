"""Language by prediction by partial matching: per-language byte context trees, frozen, score exact code lengths.

A tree holds contexts of up to ORDER bytes. In a context, a byte that was seen n times costs n / (total +
kinds); any other byte costs the escape, kinds / (total + kinds), times its price in the context shortened by
its oldest byte; below the empty context every byte costs 1/256. Contexts are kept while they are frequent, so the
order varies. All prices of all languages are worked out once into one table; a text then needs one look-up per byte.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, fraction, map_rows

ORDER = 3
FIT_DOCUMENTS = 2_000
CONTEXTS = 8_192
LEAST_SEEN = 4
CHUNK = 1 << 20
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    """languages; code of each byte (0: before a text, 1: never seen); context number by the last three codes; prices."""

    languages: list[str]
    codes: np.ndarray
    size: int
    context: np.ndarray
    bits: np.ndarray

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Code length in bits of every text under every language."""
        out = np.zeros((len(texts), len(self.languages)))
        joined = (b"\0" * ORDER).join([b"", *texts])
        starts = np.cumsum([ORDER] + [len(t) + ORDER for t in texts])[:-1]
        owner_ends = starts + [len(t) for t in texts]
        raw = np.frombuffer(joined, dtype=np.uint8)
        for low in range(ORDER, len(raw), CHUNK):
            high = min(len(raw), low + CHUNK)
            c = self.codes[raw[low - ORDER:high]]
            last = [a for a in range(ORDER)]
            place = np.zeros(high - low, dtype=np.int64)
            for a in last:
                place = place * self.size + c[a:a + high - low]
            prices = self.bits[self.context[place] * self.size + c[ORDER:]]
            first, after = np.clip(starts, low, high) - low, np.clip(owner_ends, low, high) - low
            for i in np.flatnonzero(after > first):
                out[i] += prices[first[i]:after[i]].sum(axis=0, dtype=np.float64)
        return out


def build(languages: list[str], grams: np.ndarray, counts: np.ndarray) -> Model:
    """Trees from counts[g, l] of the byte strings grams[g] = (oldest, ..., newest), four bytes each."""
    seen = np.zeros(256, dtype=bool)
    for byte in range(ORDER + 1):
        seen[(grams >> np.uint32(8 * byte)) & np.uint32(255)] = True
    seen[0] = False
    codes = np.ones(256, dtype=np.int64)
    codes[0] = 0
    codes[seen] = np.arange(2, seen.sum() + 2)
    size = int(seen.sum()) + 2
    parts = [codes[(grams >> np.uint32(8 * (ORDER - i))) & np.uint32(255)] for i in range(ORDER + 1)]
    symbol, found = parts[ORDER], []
    for order in range(1, ORDER + 1):
        key = sum(parts[ORDER - 1 - i] * size**i for i in range(order))
        names, at = np.unique(key, return_inverse=True)
        total = np.bincount(at, counts.sum(axis=1))
        found += [(-t, order, n) for t, n in zip(total.tolist(), names.tolist(), strict=True) if t >= LEAST_SEEN]
    chosen = sorted(found)[:CONTEXTS]
    number = {(order, name): i + 1 for i, (_, order, name) in enumerate(chosen)}
    bits = np.zeros((len(chosen) + 1, size, len(languages)))
    bits[0] = _prices(np.full((size, len(languages)), 1 / 256), _table(symbol, counts, size))
    context = np.zeros(size**ORDER, dtype=np.int32)
    for order in range(1, ORDER + 1):
        key = sum(parts[ORDER - 1 - i] * size**i for i in range(order))
        sort = np.argsort(key, kind="stable")
        names, first = np.unique(key[sort], return_index=True)
        spans = dict(zip(names.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(key)], strict=True), strict=True))
        for (o, name), row in number.items():
            if o == order:
                shorter = number.get((order - 1, name % size ** (order - 1)), 0)
                rows = sort[slice(*spans[name])]
                bits[row] = _prices(bits[shorter], _table(symbol[rows], counts[rows], size))
                context[name::size**order] = row
    return Model(languages, codes, size, context, -np.log2(bits).reshape(-1, len(languages)).astype(np.float32))


def _table(symbol: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(symbol, counts[:, l], size) for l in range(counts.shape[1])], axis=1)


def _prices(shorter: np.ndarray, n: np.ndarray) -> np.ndarray:
    total, kinds = n.sum(axis=0), (n > 0).sum(axis=0)
    base = np.maximum(total + kinds, 1)
    return np.where(total == 0, shorter, np.where(n > 0, n / base, kinds / base * shorter))


def train(docs: DataFrame) -> Model | None:
    """Count byte strings of labelled documents and build the trees; None if no row has both text and language.

    Learns from documents outside fold 2 of 4. Bound: about FIT_DOCUMENTS documents for each language, chosen
    by their ids, with their whole texts; scoring has no such bound.
    """
    rows = docs.select("doc_id", "text", "lang").where((fold(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for l in languages for x in (l, min(1.0, FIT_DOCUMENTS / sizes[l]))])
    number = {l: i for i, l in enumerate(languages)}

    def work(batch: Iterable[tuple]) -> Iterator[tuple]:
        texts: dict[str, list[bytes]] = {}
        for text, lang in batch:
            texts.setdefault(lang, []).append(b"\0" * ORDER + text.encode("utf-8"))
        for lang, parts in texts.items():
            raw = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint32)
            if len(raw) <= ORDER:
                continue
            grams = sum(raw[i:len(raw) - ORDER + i] << np.uint32(8 * (ORDER - i)) for i in range(ORDER + 1))
            values, n = np.unique(grams[raw[ORDER:] != 0], return_counts=True)
            yield from zip([number[lang]] * len(values), values.tolist(), n.tolist(), strict=True)

    sample = rows.where(fraction(F.col("doc_id")) < share[F.col("lang")]).select("text", "lang")
    counted = map_rows(sample, work, "language int, gram long, n long").groupBy("language", "gram").agg(F.sum("n").alias("n")).toPandas()
    if not len(counted):
        return None
    grams, at = np.unique(counted["gram"].to_numpy().astype(np.uint32), return_inverse=True)
    counts = np.zeros((len(grams), len(languages)))
    counts[at, counted["language"].to_numpy()] = counted["n"].to_numpy()
    return build(languages, grams, counts)


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """The language of every whole text, by the shortest code.

    Returns doc_id, held_out (fold 2 of 4), lang_pred, score (the share of the best language when each weighs
    2 to the power of minus its code length) and bits_per_byte under the best. A text that is null or has no letter, and
    any text if nothing could be learned, is ``und`` with score 0. Equal lengths go to the language first in order.
    Every row gives one row, repeated and null doc_ids included; lang is used to learn only, other columns not at all.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model or train(docs))

    def work(rows: Iterable[tuple]) -> Iterator[tuple]:
        fitted, rows = shared.value, list(rows)
        known = [bool(fitted and text and _LETTER.search(text)) for _, _, text in rows]
        texts = [text.encode("utf-8") for (_, _, text), k in zip(rows, known, strict=True) if k]
        lengths = fitted.lengths(texts) if texts else np.zeros((0, 1))
        best = lengths.argmin(axis=1).tolist()
        least = lengths.min(axis=1, initial=np.inf)
        scores = (1 / np.exp2(np.maximum(least[:, None] - lengths, -1000)).sum(axis=1)).tolist()
        each = zip(best, scores, least.tolist(), texts, strict=True)
        for (doc_id, held_out, _), k in zip(rows, known, strict=True):
            if k:
                b, score, bits, text = next(each)
                yield doc_id, held_out, fitted.languages[b], score, bits / len(text)
            else:
                yield doc_id, held_out, UNKNOWN, 0.0, None

    rows = docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "text")
    return map_rows(rows, work, "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double")

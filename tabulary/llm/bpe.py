"""Byte-level BPE encoding and decoding over length-bucketed numpy matrices.

Distinct pieces of a batch are merged together: pieces of similar length form the rows of a padded
matrix, and in each round every row merges its leftmost pair of lowest rank. Pairs are found in an
open-addressed hash table; merged rows are compacted to the left.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame

from .common import map_rows

NO_PAIR = np.int32(2**31 - 1)
CELLS = 1 << 17
CACHE_PIECES = 60_000
PORTION_CHARS = 1 << 19
SLOT_BITS = 20


@dataclass
class MergeTable:
    """Vocabulary and hashed pair table, built from ranks.

    ``pieces[i]`` are the bytes of id i. ``keys`` and ``ranks`` form an open-addressed table from
    ``left << 32 | right`` to the id of the joined bytes. ``steady[i]`` says that no pair with token i
    in it ranks below i: then merging several occurrences of that pair at once gives what merging
    the leftmost one again and again would give.
    """

    pieces: list[bytes]
    whole: dict[bytes, int]
    single: np.ndarray
    keys: np.ndarray
    ranks: np.ndarray
    probes: int
    steady: np.ndarray

    @classmethod
    def load(cls, path: str) -> MergeTable:
        with open(path, "rb") as file:
            return cls.build({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})

    @classmethod
    def build(cls, vocabulary: dict[bytes, int]) -> MergeTable:
        pieces = [b""] * (max(vocabulary.values()) + 1)
        left, right, made = [], [], []
        for token, rank in vocabulary.items():
            pieces[rank] = token
            for cut in range(1, len(token)):
                a, b = vocabulary.get(token[:cut]), vocabulary.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    made.append(rank)
        a, b, r = (np.array(x, dtype=np.int64) for x in (left, right, made))
        steady = np.ones(len(pieces), dtype=bool)
        steady[a[r < a]] = False
        steady[b[r < b]] = False
        single = np.array([vocabulary[bytes([i])] for i in range(256)], dtype=np.int32)
        keys, ranks = np.full(1 << SLOT_BITS, -1, dtype=np.int64), np.full(1 << SLOT_BITS, NO_PAIR, dtype=np.int32)
        pending, slot, probes = a << 32 | b, cls.slots(a << 32 | b), 0
        value = r.astype(np.int32)
        while len(pending):
            probes += 1
            free = np.flatnonzero(keys[slot] == -1)
            _, first = np.unique(slot[free], return_index=True)
            placed = free[first]
            keys[slot[placed]], ranks[slot[placed]] = pending[placed], value[placed]
            rest = np.ones(len(pending), dtype=bool)
            rest[placed] = False
            pending, value, slot = pending[rest], value[rest], (slot[rest] + 1) & ((1 << SLOT_BITS) - 1)
        return cls(pieces, vocabulary, single, keys, ranks, probes, steady)

    @staticmethod
    def slots(keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joined pairs, NO_PAIR where a pair cannot be joined (or holds padding, -1)."""
        shape, key = left.shape, (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        out = np.full(key.shape, NO_PAIR, dtype=np.int32)
        todo = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self.slots(key[todo])
        for _ in range(self.probes):
            there = self.keys[slot]
            hit = there == key[todo]
            out[todo[hit]] = self.ranks[slot[hit]]
            more = ~hit & (there != -1)
            todo, slot = todo[more], (slot[more] + 1) & ((1 << SLOT_BITS) - 1)
            if not len(todo):
                break
        return out.reshape(shape)

    def encode(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece, as rank-ordered merging gives them; the empty piece has none."""
        out: list[list[int]] = [[] for _ in pieces]
        todo = []
        for i, piece in enumerate(pieces):
            whole = self.whole.get(piece)
            if whole is not None:
                out[i] = [whole]
            elif piece:
                todo.append(i)
        todo.sort(key=lambda i: len(pieces[i]))
        start = 0
        while start < len(todo):
            shortest, end = len(pieces[todo[start]]), start + 1
            while end < len(todo) and (n := len(pieces[todo[end]])) <= max(8, 2 * shortest) and n * (end - start + 1) <= CELLS:
                end += 1
            rows = todo[start:end]
            for i, ids in zip(rows, self._merge([pieces[i] for i in rows]), strict=True):
                out[i] = ids
            start = end
        return out

    def _merge(self, pieces: list[bytes]) -> list[list[int]]:
        sizes = np.array([len(p) for p in pieces])
        width = int(sizes.max())
        tokens = np.full((len(pieces), width), -1, dtype=np.int32)
        tokens[np.arange(width) < sizes[:, None]] = self.single[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        rank = np.full(tokens.shape, NO_PAIR, dtype=np.int32)
        rank[:, :-1] = self.lookup(tokens[:, :-1], tokens[:, 1:])
        done: list[list[int]] = [[] for _ in pieces]
        rows = np.arange(len(pieces))
        while len(rows):
            lowest = rank.min(axis=1)
            over = lowest == NO_PAIR
            if 2 * over.sum() >= len(over):
                flat, size = tokens[over], (tokens[over] >= 0).sum(axis=1)
                ids, ends = flat[flat >= 0].tolist(), np.cumsum(size).tolist()
                for i, n, end in zip(rows[over].tolist(), size.tolist(), ends, strict=True):
                    done[i] = ids[end - n:end]
                tokens, rows, rank, lowest = tokens[~over], rows[~over], rank[~over], lowest[~over]
                over = over[~over]
            chosen = (rank == lowest[:, None]) & ~over[:, None]
            several = np.flatnonzero(chosen.sum(axis=1) > 1)
            if len(several):
                chosen[several] = self._in_turn(tokens[several], chosen[several], lowest[several])
            k, at = np.nonzero(chosen)
            if not len(k):
                continue
            tokens[k, at], rank[k, at] = lowest[k], NO_PAIR
            tokens[k, at + 1] = -1
            rank[k, at + 1] = NO_PAIR
            keep = tokens >= 0
            size = keep.sum(axis=1)
            nth = np.arange(len(k)) - np.searchsorted(k, k)
            tokens, rank = self._compact(tokens, keep, size, -1), self._compact(rank, keep, size, NO_PAIR)
            at -= nth
            for place in (at, at - 1):
                inside = (place >= 0) & (place + 1 < tokens.shape[1])
                r, c = k[inside], place[inside]
                rank[r, c] = self.lookup(tokens[r, c], tokens[r, c + 1])
        return done

    @staticmethod
    def _compact(values: np.ndarray, keep: np.ndarray, size: np.ndarray, fill: int) -> np.ndarray:
        packed = np.full((len(values), int(size.max())), fill, dtype=np.int32)
        packed[np.arange(packed.shape[1]) < size[:, None]] = values[keep]
        return packed

    def _in_turn(self, tokens: np.ndarray, chosen: np.ndarray, joined: np.ndarray) -> np.ndarray:
        """Which of a row's equal pairs merging the leftmost one again and again would take first.

        Of neighbouring pairs that share a token the first, third, ... are taken. A steady token's pairs
        are all taken; another token's pairs up to the first one that makes a pair of lower rank.
        """
        at = np.arange(chosen.shape[1])
        chosen = chosen & ((at - np.maximum.accumulate(np.where(chosen, -1, at), axis=1)) % 2 == 1)
        k, c = np.nonzero(chosen & ~self.steady[joined][:, None])
        new = joined[k]
        before = np.where(c > 0, tokens[k, c - 1], -1)
        after = np.where(c + 2 < tokens.shape[1], tokens[k, np.minimum(c + 2, tokens.shape[1] - 1)], -1)
        lower = np.minimum(np.minimum(self.lookup(before, new), self.lookup(new, after)), self.lookup(new, new)) < new
        stop = np.full(len(chosen), chosen.shape[1])
        np.minimum.at(stop, k[lower], c[lower])
        return chosen & (at <= stop[:, None])


def portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in turn, in lists that end with the text that fills the portion."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text or "")
        if size >= PORTION_CHARS:
            yield some
            some, size = [], 0
    yield some


def encoder(merges: MergeTable, pattern: str):
    """A function from texts to (ids, their decimals, decoded bytes) of each piece of each text, with a cache of pieces.

    Pieces of a portion of texts are learnt together. When ``CACHE_PIECES`` pieces were met, those not met since the time
    before are dropped, so common pieces stay and the cache is bounded by twice that and a portion. All ids are shared
    numbers, which else take more than the rest of an entry.
    """
    split = regex.compile(pattern).findall
    number = list(range(len(merges.pieces)))
    recent: dict[str, tuple[tuple[int, ...], str, bytes]] = {}
    older: dict[str, tuple[tuple[int, ...], str, bytes]] = {}

    def learn(pieces: set[str]) -> None:
        nonlocal recent, older
        if len(recent) > CACHE_PIECES:
            recent, older = {}, recent
        new = []
        for piece in pieces:
            if piece in recent:
                continue
            entry = older.pop(piece, None)
            if entry is None:
                new.append(piece)
            else:
                recent[piece] = entry
        for piece, ids in zip(new, merges.encode([p.encode("utf-8") for p in new]), strict=True):
            recent[piece] = tuple([number[i] for i in ids]), " ".join(map(str, ids)), b"".join([merges.pieces[i] for i in ids])

    def encode(texts: list[str | None]) -> Iterator[list[tuple[tuple[int, ...], str, bytes]]]:
        for some in portions(texts):
            parts = [split(t) if t else [] for t in some]
            learn(set().union(*parts))
            for pieces in parts:
                yield [recent[p] for p in pieces]

    return encode


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """Encode and decode every whole text.

    Returns doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space), decoded_sha256 (of
    the bytes the ids stand for), and with ``with_ids`` the ids and the decoded text. A null text counts
    as empty and has no tokens. Each match of the pattern is encoded on its own and there are no special
    tokens. Every row gives one row, repeated and null doc_ids included; other columns are not looked at.
    """
    merges = docs.sparkSession.sparkContext.broadcast(MergeTable.load(rank_path))
    state: dict = {}

    def work(rows: Iterable[tuple]) -> Iterator[tuple]:
        if "encode" not in state:
            state["encode"] = encoder(merges.value, pattern)
        rows = list(rows)
        for (doc_id, _), found in zip(rows, state["encode"]([t for _, t in rows]), strict=True):
            decoded = b"".join([f[2] for f in found])
            row = (
                doc_id, sum(len(f[0]) for f in found),
                hashlib.sha256(" ".join([f[1] for f in found]).encode()).hexdigest(), hashlib.sha256(decoded).hexdigest(),
            )
            yield (*row, [i for f in found for i in f[0]], decoded.decode("utf-8")) if with_ids else row

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * with_ids
    return map_rows(docs.select("doc_id", "text"), work, schema)

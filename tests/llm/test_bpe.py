from __future__ import annotations

import hashlib
import random
import tracemalloc

import public_tokenizers
import pytest
import tiktoken

from tabulary.llm import bpe

from .fixtures import AWKWARD, documents

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def merges():
    return bpe.MergeTable.load(RANKS)


@pytest.fixture(scope="module")
def library(merges):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges.whole, special_tokens={})


def test_ids_are_those_of_the_library(merges, library):
    draw = random.Random(5)
    texts = ["a" * 5000, "ab" * 3000, " " * 3000, "\n" * 999, "é" * 700, "aaab" * 500, "日本語" * 300, "😀" * 100, "", "<|endoftext|>"]
    texts += ["".join(draw.choices("abcdeth in\n0123.'é", k=draw.randint(1, 60))) for _ in range(2000)]
    texts += ["".join(draw.choices("abcdethiou", k=2000)) for _ in range(3)]
    for text, found in zip(texts, bpe.encoder(merges, public_tokenizers.PATTERN)(texts), strict=True):
        assert [i for f in found for i in f[0]] == library.encode_ordinary(text)
        assert b"".join(f[2] for f in found) == text.encode()


def test_a_pair_that_makes_a_lower_pair_is_merged_alone():
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 400, b"aba": 300}
    merges = bpe.MergeTable.build(ranks)
    own = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    for text in ("ababab", "abab", "aabba", "abaabab"):
        assert merges.encode([text.encode()]) == [own.encode_ordinary(text)]


def test_documents_with_awkward_rows(spark, library):
    rows = bpe.encode_documents(documents(spark, AWKWARD), RANKS, public_tokenizers.PATTERN, with_ids=True).collect()
    assert len(rows) == len(AWKWARD)
    want = sorted((i is None, i or 0, len(library.encode_ordinary(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in AWKWARD)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.decoded_sha256) for r in rows) == want
    for r in rows:
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()


def test_empty_table(spark):
    out = bpe.encode_documents(documents(spark, []), RANKS, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.count() == 0


def test_cache_stays_bounded_within_a_batch(merges, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 1000)
    monkeypatch.setattr(bpe, "PORTION_CHARS", 10_000, raising=False)
    draw = random.Random(7)
    texts = [" ".join("".join(draw.choices("abcdefghij", k=9)) for _ in range(400)) for _ in range(100)]
    tracemalloc.start()
    try:
        encode = bpe.encoder(merges, public_tokenizers.PATTERN)
        for text, found in zip(texts, encode(texts), strict=True):
            assert b"".join(f[2] for f in found) == text.encode()
        del found
        kept = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert kept < 6e6
    again = [[list(f[0]) for f in found] for found in encode(texts[:3])]
    assert again == [[list(f[0]) for f in found] for found in bpe.encoder(merges, public_tokenizers.PATTERN)(texts[:3])]

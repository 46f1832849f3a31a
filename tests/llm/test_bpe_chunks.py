"""Chunks as rows, and merges, against the library."""

import random

import public_tokenizers
import pytest
import tiktoken

from corvina.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_merges_against_the_library(encoding, monkeypatch):
    ranks, rng = bpe.read_ranks(RANKS), random.Random(4)
    letters = "abcdefghiklmnoprstuéñ日0123 "
    raws = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))).encode() for _ in range(3000)]
    raws += [bytes(rng.randrange(256) for _ in range(rng.randint(1, 60))) for _ in range(1000)] + [b"a" * n for n in (1, 2, 255, 256, 257, 5000)]
    raws += ["".join(rng.choice("aabcd") for _ in range(n)).encode() for n in (300, 3000)]
    want = [encoding._encode_single_piece(r) for r in raws]
    ids = lambda: [[ranks[t] for t in bpe.merged(r, ranks)] for r in raws]
    assert ids() == want
    monkeypatch.setattr(bpe, "HEAP_BYTES", 1)
    assert ids() == want


def test_pieces_are_held_in_bounds(encoding, monkeypatch):
    monkeypatch.setattr(bpe, "HELD", 50)
    rng, pieces = random.Random(2), bpe.Pieces(bpe.read_ranks(RANKS))
    words = [f" word{i}" for i in range(300)]
    for _ in range(3000):
        w = words[min(299, int(rng.expovariate(0.02)))]
        assert pieces[w] == b"".join(i.to_bytes(4, "little") for i in encoding.encode_ordinary(w)) and len(pieces) <= 50 and len(pieces.aside) <= 50


def test_rows_of_chunks_against_the_library(spark, encoding):
    rng = random.Random(7)
    parts = [*"ab1 '\n\t!é日s", "  ", "\n\n", "'s", "aaaa" * 4, " " * 9, "!!!'s", "'re'll", " word", " and"]
    texts = [None, "", "x"] + ["".join(rng.choice(parts) for _ in range(rng.randint(0, 400))) for _ in range(120)]
    texts += ["a" * 300, " " * 200 + "b", "word " * 100, "word " * 100, "x" * 64, "x " * 32, "ab " * 30 + "z" * 90 + " cd" * 40]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id bigint, text string, tokens string").repartition(3)
    for chunk, overlap in ((64, 16), (64, 63), (16, 4), (1000, 50)):
        for spread in (0, 100, 10**9):
            got = {r.doc_id: list(r.tokens) for r in bpe.encode(df, RANKS, chunk=chunk, overlap=overlap, spread=spread).collect()}
            assert got == {i: encoding.encode_ordinary(t or "") for i, t in enumerate(texts)}


def test_chunks_of_one_text_are_spread_over_tasks(spark, encoding):
    text = "Some words, and more of them: 12 apples! " * 8000
    rows = spark.createDataFrame([(0, text)], "row bigint, text string")
    cut = rows.mapInArrow(bpe._chunks(bpe.CHUNK, bpe.OVERLAP), "row bigint, n bigint, start bigint, last boolean, chunk string")
    assert cut.count() == -(-len(text) // bpe.CHUNK) > 16
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string")
    got = {r.doc_id: list(r.tokens) for r in bpe.encode(df, RANKS, spread=100_000).collect()}
    assert got == {1: encoding.encode_ordinary(text), 2: []}

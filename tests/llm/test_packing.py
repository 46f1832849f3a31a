"""Packing: ids as the library tells them, sequences whole and as few as best fit needs."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corvina.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")


def library(texts):
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return [[*e.ids, 0] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


ODD = [
    "Don't; she'll... we've 'sing '. 'S. word's, x'. a'.", "J̌ ǰ Å Å İstanbul ΣΑΣ. ὈΔΥΣΣΕΎΣ, ﬁ ﬃ", " é ́x á. é.", "1234 12.5, 3rd. ٣٤٥. Ⅷ.", "你好。世界, 日本語. 한국어!", "👩‍👩‍👧. a‍b", "tab\tnew\nline\x0b\x0c\r\x1c\x85  end",
    "<|endoftext|> <|startoftext|>. <|ENDOFTEXT|>", "a\x00b.", "....;;;!", "x.y.z:;", "Ünter. ÉCOLE! ß? ẞ.", "ab" * 40_000, "α.", "ǆ. ʰ. ɐ.", "word️. a̸.", "''s 's's. 'll'd.",
]


def test_ids_are_those_of_the_library(corpus):
    words = packing.Words(FILE)
    import pyarrow as pa

    texts = [t or "" for _, t, _ in corpus] + ODD
    for _ in range(2):  # the second time from what is held
        flat, n = words.encode(pa.array(texts))
        ends = np.cumsum(n)
        assert [flat[e - k : e].tolist() for e, k in zip(ends, n, strict=True)] == [x[:-1] for x in library(texts)]


def test_held_words_are_set_aside(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(packing, "HELD", 20)
    words = packing.Words(FILE)
    rng = random.Random(1)
    for _ in range(20):
        texts = [" ".join(rng.choice(["alpha.", "beta", "gamma", f"w{rng.randint(0, 99)}"]) for _ in range(30)) for _ in range(3)]
        flat, n = words.encode(pa.array(texts))
        assert flat.tolist() == [i for x in library(texts) for i in x[:-1]]
        assert len(words.held) + len(words.aside) < 300


def test_long_texts_are_tokenised_in_stretches(monkeypatch):
    import pyarrow as pa

    texts = ["a b", "one two " * 300 + "x" * 3000 + " end\n" * 100, "", "y" * 2500, "last"]
    monkeypatch.setattr(packing, "CHARS", 1000)
    got = [x for *_, flat, n in packing._encoded(pa.array(texts), packing.Words(FILE)) for x in np.split(flat, np.cumsum(n)[:-1])]
    assert [x.tolist() for x in got] == [x[:-1] for x in library(texts)]


def one_by_one(lengths, size):
    """Best fit, longest first, item by item."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(size - n)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(12))
def test_best_fit_in_steps_is_best_fit_one_by_one(seed):
    rng = random.Random(seed)
    size = rng.choice([7, 30, 100])
    lengths = [min(size, 1 + int(rng.random() ** rng.choice([1, 3]) * size)) for _ in range(rng.randint(1, 300))]
    order, bins = packing.best_fit(np.array(lengths), size)
    fill = np.bincount(bins, weights=np.array(lengths)[order])
    assert sorted(order.tolist()) == list(range(len(lengths)))
    assert sorted((size - fill).astype(int).tolist()) == one_by_one(lengths, size)


def check(rows, size, length="length"):
    """Offsets without a gap, no sequence too long; the number of sequences."""
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r[length]))
    for items in by.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= size
    return len(by)


def test_query_pieces(spark, corpus):
    rows = [(i, t, "x") for i, t, _ in corpus] + [(300 + i, t, "y") for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, piece string").repartition(5)
    cut = packing.pieces(df.withColumn("a.b", F.col("doc_id")), FILE)
    packed = packing.pack(cut).collect()
    want = Counter()
    for (i, _, _), ids in zip(rows, library([t for _, t, _ in rows]), strict=True):
        for p in range(-(-len(ids) // 2048)):
            part = ids[p * 2048 : p * 2048 + 2048]
            want[i, p, p * 2048, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert Counter((r["a.b"], r.piece, r.start, r.length, r.ids_crc32, tuple(r.ids)) for r in packed) == want
    lengths = [r.length for r in packed]
    assert check(packed, 2048) == len(one_by_one(lengths, 2048))


def test_sequences_hold_the_ids(spark):
    df = spark.createDataFrame([(i, f"number {i} " * (i % 40)) for i in range(200)], "doc_id bigint, text string")
    packed = packing.pack(packing.pieces(df, FILE, size=64), size=64).persist()
    got = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert got[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert sum(map(len, got.values())) == sum(r.length for r in packed.collect())
    packed.unpersist()


def test_the_tree_merges_what_partitions_leave_over(spark, monkeypatch):
    rng = random.Random(4)
    lengths = [rng.choice([rng.randint(1, 100), rng.randint(30, 60), 51]) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(lengths)), "id int, length int").repartition(40)
    rows = packing.pack(df, size=100).collect()
    assert Counter((r.id, r.length) for r in rows) == Counter(enumerate(lengths))
    whole = len(one_by_one(lengths, 100))
    assert check(rows, 100) <= whole * 1.01 + 1
    monkeypatch.setattr(packing, "GROUP", 300)  # several groups, then several levels
    monkeypatch.setattr(packing, "LOCAL", 50)
    rows = packing.pack(df, size=100).collect()
    assert Counter((r.id, r.length) for r in rows) == Counter(enumerate(lengths))
    assert check(rows, 100) <= whole * 1.05 + 1


@pytest.mark.parametrize("length", [51, 100, 1])
def test_items_of_one_length(spark, length, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 100)
    df = spark.createDataFrame([(i, length) for i in range(1001)], "id int, length int").repartition(8)
    assert check(packing.pack(df, size=100).collect(), 100) == -(-1001 // (100 // length))


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 0, "b"), (3, 101, "c"), (4, 100, "d"), (4, 100, "d"), (5, 1, None)], "id int, length int, offset string")
    rows = {(r.id, r["offset"] is None) for r in packing.pack(df, size=100).collect()}
    assert rows == {(1, True), (2, True), (3, True), (4, False), (5, False)}
    assert packing.pack(df.limit(0), size=100).count() == 0
    none = spark.createDataFrame([(1, None)], "doc_id int, text string")
    (row,) = packing.pack(packing.pieces(none, FILE)).collect()
    assert (row.length, row.ids, row.offset) == (1, [0], 0)
    assert packing.pack(packing.pieces(none.limit(0), FILE)).count() == 0

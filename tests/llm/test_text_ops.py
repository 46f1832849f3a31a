import hashlib
import random
import re

import pytest
import public_tokenizers
import tiktoken

from corvina.llm import bpe, decontam, licenses, pii

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_chunks_are_stitched_as_if_whole(encoding):
    rng = random.Random(1)
    parts = [*"ab1 '\n\t!é日s", "  ", "\n\n", "'s", "aaaa" * 30, " " * 40, "!!!'s", "'re'll"]
    pieces = bpe.Pieces(bpe.read_ranks(RANKS))
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 300)))
        cut = bpe.Cutter(public_tokenizers.PATTERN, rng.choice([5, 16, 64]), rng.choice([2, 4, 8]))
        assert bpe.encode_text(text, pieces, cut) == encoding.encode_ordinary(text)


def test_bpe_round_trip(spark, corpus, encoding):
    rows = [(d, t) for d, t, _ in corpus] + [(400, "日本 <|endoftext|> é\x00 " + "long " * 20_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, tokens string, decoded int")
    both = bpe.decode(bpe.encode(df, RANKS), RANKS)
    for r in bpe.digests(both.withColumn("raw", both.text)).collect():
        ids = encoding.encode_ordinary(r.raw or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((r.raw or "").encode()).hexdigest()
    assert bpe.encode(df.limit(0), RANKS).count() == 0


BENCH = [
    (1, "A train leaves Paris at 10:30 with 120 passengers and travels 300 km to Lyon. How many passengers does the train carry per km?"),
    (2, "Name the largest moon of the planet that was found by William Herschel in the year 1781 with his own telescope."),
    (3, "too short"),
    (4, None),
]


def leaked(spark, docs):
    df = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    return {(r.id, r.item_id): r for r in decontam.contaminated(df, bench).collect()}


def test_reparameterised_questions_are_found(spark):
    filler = "Some other words stand before the question and are of no interest. " * 3
    docs = [
        (1, filler + BENCH[0][1] + " " + filler),
        (2, filler + BENCH[0][1].replace("Paris", "Berlin").replace("Lyon", "Bonn").replace("120", "77").replace("300", "550") + " And on."),
        (3, BENCH[1][1].lower()),
        (4, filler),
        (5, None),
        (6, ""),
        (7, "too short"),
        (8, "A train leaves Paris. " + filler + "How many passengers does the train carry per km?"),
    ]
    found = leaked(spark, docs)
    assert set(found) == {(1, 1), (2, 1), (3, 2), (7, 3)}  # an item of few tokens is one window of all of them
    assert found[(1, 1)].n_changed == 0 and found[(2, 1)].n_changed >= 4


def test_slots_must_be_consistent(spark):
    item = "If there are 12 boxes with 7 apples in each then the 12 boxes hold how many apples in all of the 12 boxes together"
    bench = spark.createDataFrame([(9, item)], "item_id bigint, text string")
    same, other = item.replace("12", "30").replace("7", "5"), item.replace("12", "30", 1)
    df = spark.createDataFrame([(1, same), (2, other)], "doc_id bigint, text string")
    assert [r.id for r in decontam.contaminated(df, bench).collect()] == [1]


def test_decontaminate_keeps_the_rest(spark):
    df = spark.createDataFrame([(1, BENCH[0][1], "a"), (2, "clean", "b"), (2, "clean", "b"), (3, None, "c")], "doc_id bigint, text string, item_id string")
    bench = spark.createDataFrame(BENCH, "item_id bigint, text string")
    assert sorted(r.doc_id for r in decontam.decontaminate(df, bench).collect()) == [2, 2, 3]
    assert decontam.decontaminate(df, bench.limit(0)).count() == 4 and decontam.contaminated(df.limit(0), bench).count() == 0
    assert decontam.contaminated(df, bench.limit(0)).count() == 0


def test_license_scan_against_brute_force(spark, corpus):
    texts = [
        "Licensed under the Apache License, Version 2.0. MIT License! CC BY-NC 4.0",
        "gnu GENERAL  public\nLicense v3 xgnu general public license gnu general public licensees",
        "SPDX-License-Identifier: (Apache-2.0 OR MIT) AND GPL-2.0-only WITH Classpath-exception-2.0 */ code",
        "SPDX-License-Identifier: AND (",
        "ccéby cc by",
    ]
    rows = [(d, t) for d, t, _ in corpus] + [(500 + i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "doc_id bigint, text string, score int")
    got = licenses.joined_labels(licenses.license_scan(df.withColumn("raw", df.text))).collect()
    for r in got:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.raw or "")
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = sorted((i, label) for p, label in licenses.BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
        assert (r.n_words, r.n_base) == (len(w), len(at))
        assert (r.first_word, r.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in at})) and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    by = {r.doc_id: r for r in got}
    assert by[500].labels == "apache,apache-2.0,cc-by,cc-by-nc,mit"
    assert by[502].labels == "apache-2.0,gpl-2.0-only with classpath-exception-2.0,mit" and by[502].score == 1
    assert by[503].labels == "" and by[503].expressions == []


def test_shunting_yard():
    assert licenses.parse("a OR b AND c WITH d".split()) == ("or", "a", ("and", "b", ("with", "c", "d")))
    assert licenses.parse("( a OR b ) AND c".split()) == ("and", ("or", "a", "b"), "c")
    for bad in ("", "a b", "a OR", "( a", "a )", "OR a", "( )"):
        assert licenses.parse(bad.split()) is None


def base_brute(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m[0])
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_against_plain_patterns():
    rng = random.Random(2)
    parts = [*"a1.@-+ (é", "4539578763621486", "1.2.3.4", "a@b.cd", "@@", "+1 (555) 555-1234", "999.", "00001.", " 255.255.255.255 "]
    for _ in range(6000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))
        assert pii.base_spans(t) == base_brute(t), t
    assert pii.base_spans("9" * 200_000) == [] and pii.base_spans("a" * 200_000 + "@") == []


def test_bootstrapping_discovers_identifiers(spark, corpus):
    rows = [(i, f"Please write to contact: user{i}@mail.example.com today and wait.") for i in range(20)]
    rows += [(50 + i, f"Please write to contact: agent_{i}77 today and wait.") for i in range(5)]
    rows += [(90, "In release build20240101 nothing changed."), (91, None), (92, "")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, base string, spans int")
    got = {r.doc_id: r for r in pii.digest(pii.personal_data(df.repartition(3))).collect()}
    assert all(got[i].n_email == 1 and got[i].spans.startswith("email:") for i in range(20))
    assert all(got[50 + i].spans == "id:25:34" for i in range(5))
    assert got[90].spans == "" and got[91].spans == "" and got[92].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii.personal_data(df.limit(0)).count() == 0
    plain = spark.createDataFrame([(d, t) for d, t, _ in corpus], "doc_id bigint, text string")
    assert pii.personal_data(plain).count() == len(corpus)

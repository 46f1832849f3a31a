"""Every stage over a few hundred documents, each held against plain Python on its own input."""

import random
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import tiktoken

import corpus_pipeline
from corvina.llm import bpe
from test_decontam import brute as leaks
from test_minhash import brute as copies

ITEMS = [(1, "If there are 12 boxes with 7 apples in each then how many apples are in all of the 12 boxes together."), (2, "Which of the rivers near the old town carries more water in spring than in autumn every year.")]


def documents():
    rng = random.Random(21)
    words = ["".join(rng.choice("abcdeghilmnorstu") for _ in range(rng.randint(3, 8))) for _ in range(3000)]
    line = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(9, 15))) + "."
    text = lambda: "\n".join(line() for _ in range(rng.randint(5, 9)))
    rows = []
    for _ in range(220):  # a third of all rows come from one source, where one line stands on many pages
        source = "hot" if len(rows) % 3 == 0 else f"s{len(rows) % 7}"
        rows.append((text() + ("\nThis line of the page stands on many of them." if source == "hot" and rng.random() < 0.5 else ""), source))
    base = text()
    rows += [(base, "hot")] * 25  # exact copies
    for _ in range(40):  # near copies
        ws = base.split(" ")
        for _ in range(rng.randint(1, 3)):
            ws[rng.randrange(len(ws))] = rng.choice(words)
        rows.append((" ".join(ws), f"n{len(rows) % 12}"))  # few of a source, or their lines would be its boilerplate
    for _, item in ITEMS:
        rows += [(text() + "\n" + item, "s2"), (text() + "\n" + item.replace("12", "40").replace("7", "9"), "s3"), (text() + "\n" + item.replace("12", "40", 1), "s3")]
    rows += [(None, "s1"), ("", None), ("too short.", "s2"), (text() + "\n" + "word " * 30_000 + ".", "s4"), ("Home | About | Help\n" * 40, "s4"), (text(), None)]
    rng.shuffle(rows)
    return [(i, t, "en", s, len(t or "")) for i, (t, s) in enumerate(rows)]


def test_stages_on_their_own_inputs(spark, tmp_path):
    rows = documents()
    pq.write_table(pa.table({"item_id": pa.array([i for i, _ in ITEMS], pa.int64()), "text": [t for _, t in ITEMS]}), tmp_path / "benchmark.parquet")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        given = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, str(tmp_path))
        got = out.collect()
        done[name] = given, {r.doc_id: r for r in got}
        assert len(got) == len(done[name][1])
        docs = spark.createDataFrame(got, out.schema).repartition(5)
    before, after = done["quality rules"]
    assert len(after) > 250 and not {r.doc_id for r in before.values() if len((r.text or "").split()) < 50 or (r.text or "").startswith("Home")} & set(after)
    before, after = done["line dedup"]
    pages = {(r.source, r.text) for r in before.values()}
    total, counts = Counter(s for s, _ in pages), Counter((s, x) for s, t in pages for x in {x.strip(" \t\r") for x in t.split("\n")} if x)
    bad = {k for k, n in counts.items() if n >= 5 and n > 0.02 * total[k[0]]}
    assert any(s == "hot" and "stands on many" in x for s, x in bad)
    assert {d: r.text for d, r in after.items()} == {d: "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" \t\r")) not in bad) for d, r in before.items()}
    before, after = done["near-dedup"]
    assert set(after) == {d for d, _, _, kept in copies(sorted((d, r.text) for d, r in before.items()), 5, 80) if kept} and len(after) < len(before) - 24
    before, after = done["decontamination"]
    gone = {d for d, _ in leaks(ITEMS, [(d, r.text) for d, r in before.items()])}
    assert set(after) == set(before) - gone and 3 <= len(gone) <= 5
    before, after = done["tokens"]
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    assert {d: (list(r.tokens), r.round_trip) for d, r in after.items()} == {d: (encoding.encode_ordinary(r.text), True) for d, r in before.items()}


def test_stages_on_an_empty_table(spark, tmp_path):
    pq.write_table(pa.table({"item_id": pa.array([], pa.int64()), "text": pa.array([], pa.string())}), tmp_path / "benchmark.parquet")
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.count() == 0

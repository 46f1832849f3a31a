import hashlib
import io
import random
from collections import Counter

from pyspark.sql import functions as F

from corvina.llm import sharding, toxicity, warc


def test_shards_match_the_mixture(spark):
    rows = [(i, "big" if i % 3 else "mid" if i % 2 else None, f"t{i % 11}") for i in range(1000)] + [(5, "big", "t5")] * 3
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id bigint, source string, text string, slot int")
    got = sharding.interleave(df.repartition(5), shards=24).collect()
    again = sharding.interleave(df.repartition(2), shards=24).collect()
    assert Counter(map(str, got)) == Counter(map(str, again)) and len(got) == len(rows)
    sizes, mix, total = Counter(r.shard for r in got), Counter((r.shard, r.source) for r in got), Counter(r.source for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(24):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
        for source, n in total.items():
            assert abs(mix[(s, source)] - n * sizes[s] / len(rows)) <= 2
    assert sharding.interleave(df.limit(0)).count() == 0
    assert sorted(r.slot for r in sharding.interleave(df.limit(3), shards=24).collect()) == [0, 0, 0]


def test_shard_ranks_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 7)
    df = spark.createDataFrame([(i, f"s{i % 4}") for i in range(301)], "doc_id bigint, source string")
    got = sharding.interleave(df, shards=5)
    hashed = df.selectExpr("doc_id", "source", "md5(concat_ws('|', '42', cast(doc_id as string), cast(doc_id as string), source)) AS h").collect()
    by = {}
    for r in hashed:
        by.setdefault(r.source, []).append((r.h, r.doc_id))
    order = sorted((((2 * k + 1) / (2 * len(v))), s, k, d) for s, v in by.items() for k, (_, d) in enumerate(sorted(v)))
    want = {d: at * 5 // 301 for at, (_, _, _, d) in enumerate(order)}
    assert {r.doc_id: r.shard for r in got.collect()} == want


def sample(n, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = []
    for i in range(n):
        ws = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(3):
                ws[rng.randrange(len(ws))] = rng.choice(["vilebad", "vilebadly", "nastyone"])
        out.append((" ".join(ws) + ".", toxic))
    return out


def test_field_finds_toxic_tokens_on_held_out_texts(spark):
    field = toxicity.train(sample(400, 1))
    held = sample(300, 2)
    df = spark.createDataFrame([(i, t, "x") for i, (t, _) in enumerate(held)] + [(900, None, "x"), (901, "", "x"), (902, "a" * 90_000 + " vilebad", "x"), (None, "w1 vilebad", "x")], "doc_id bigint, text string, score string")
    got = {r.doc_id: r for r in toxicity.toxicity(df.repartition(3), field).collect()}
    right = sum(got[i].predicted == y for i, (_, y) in enumerate(held))
    assert right >= 0.97 * len(held)
    hit = next(i for i, (_, y) in enumerate(held) if y)
    assert any(held[hit][0][s.start : s.end].startswith(("vilebad", "nasty")) for s in got[hit].toxic_spans)
    assert got[900].score == 0 == got[901].score and got[902].predicted == 1 and got[None].predicted == 1
    assert toxicity.toxicity(df.limit(0), field).count() == 0


def test_marginals_against_enumeration():
    import itertools

    import numpy as np

    field = toxicity.Field()
    field.t = np.array([[0.3, -1.0], [0.2, 0.9]])
    e = np.array([[0.5, -1.0, 2.0, 0.1], [1.0, 0.2, 0.0, 0.0]])
    n = np.array([4, 2])
    p, _, _ = field.marginals(e, n)
    for s in range(2):
        total, ones = 0.0, np.zeros(4)
        for y in itertools.product((0, 1), repeat=int(n[s])):
            score = sum(e[s, i] * y[i] for i in range(n[s])) + sum(field.t[a, b] for a, b in zip(y, y[1:], strict=False))
            total += np.exp(score)
            ones[: n[s]] += np.exp(score) * np.array(y)
        assert np.allclose(p[s], ones / total)


def test_held_out_rows_are_never_fitted(spark):
    from zlib import crc32

    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(50)] + [(None, 1, 1), (3, 1, None)], "doc_id bigint, quality int, toxic int")
    got = toxicity.labelled_sample(docs, labels, "doc_id", "text", 100, 1000)
    assert sorted(got) == sorted((f"text {i}", i % 2) for i in range(50) if crc32(str(i).encode()) % 5)
    assert len(toxicity.labelled_sample(docs, labels, "doc_id", "text", 4, 1000)) <= 8
    assert toxicity.train([]).w.any() == False and toxicity.train([("a", 1)]).w.any() == False  # noqa: E712


PAGES = [(i, f"http://h/{i}", "<html>" + "payload " * 20 + str(i % 7) + "</html>") for i in range(40)]
PAGES += [(200, "http://h/a b", "x"), (201, "", "y"), (202, "h t\tt%20p\r\nX: é", "z"), (203, "http://h/é?q=%20#a", "z"), (100, None, None), (101, "u", ""), (102, "u", "short"), (103, "u", "short"), (104, "u", "é" * 60), (105, "u", "é" * 60), (None, "u", "é" * 60), (7, "u", PAGES[7][2])]


def test_archives_are_read_back_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)
    df = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id bigint, url string, html string, payload string").repartition(3)
    folder = f"file://{tmp_path}/w"
    written = warc.write_warc(df, folder)
    got = warc.read_warc(written, folder).collect()
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    want = Counter()
    for i, _, h in PAGES:
        raw = (h or "").encode()
        again = len(raw) >= 100 and i != first[h or ""]
        want[(i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", first[h or ""] if again else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all((r.payload or b"").decode() == dict((p[0], p[2] or "") for p in PAGES)[r.page_id] for r in got if r.record_type == "response")
    assert written.agg({"records": "sum"}).first()[0] == len(PAGES) and written.count() > 3
    assert {(r.page_id, r.url) for r in got} == {(i, u) for i, u, _ in PAGES}
    assert warc.read_warc(warc.write_warc(df.limit(0), folder + "0"), folder + "0").count() == 0


def test_archive_has_its_dictionary_in_front():
    records = [warc.record(i, f"http://h/{i}", (f"<p>page {i} of many alike</p>" * 20).encode(), "d", 10, None) for i in range(300)]
    out = io.BytesIO()
    warc.write_archive(records, out)
    raw = out.getvalue()
    assert int.from_bytes(raw[:4], "little") == warc.DICT_MAGIC
    assert list(warc.read_archive(io.BytesIO(raw))) == records and len(raw) < sum(map(len, records)) / 4
    few = io.BytesIO()
    warc.write_archive(records[:2], few)
    assert list(warc.read_archive(io.BytesIO(few.getvalue()))) == records[:2]


def test_ids_are_of_any_type_and_records_are_told_apart(spark, tmp_path):
    long = "payload " * 200_000
    df = spark.createDataFrame([("a/1", "u", long), ("b 2", "u", long), ("b 2", "u", "other"), ("", "u", "no id"), (None, "u", "null id")], "page_id string, url string, html string")
    folder = f"file://{tmp_path}/ids"
    written = warc.write_warc(df, folder)
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.read_warc(written, folder, "string").collect())
    assert got == Counter([("a/1", "response", None), ("b 2", "revisit", "a/1"), ("b 2", "response", None), ("", "response", None), (None, "response", None)])
    ids = [warc.parse(raw)["fields"]["WARC-Record-ID"] for f in (tmp_path / "ids").iterdir() if f.suffix == ".zst" for raw in warc.read_archive(io.BytesIO(f.read_bytes()))]
    assert len(set(ids)) == 5


def test_two_attempts_of_a_task_never_share_a_file(spark, tmp_path):
    df = warc.plan(spark.createDataFrame(PAGES, "page_id bigint, url string, html string")).withColumns({"page_id": F.col("page_id").cast("string"), "refers_to": F.col("refers_to").cast("string")})
    run, batches = warc._writer(f"file://{tmp_path}/w"), df.toArrow().to_batches()
    first, second = (next(run(iter(batches))).column(0).to_pylist() for _ in range(2))
    assert first and not set(first) & set(second)


def test_many_repeated_payloads_are_dealt_out(spark, tmp_path, monkeypatch):
    from corvina.llm import common

    monkeypatch.setattr(warc, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(warc, "HOT", 3)
    test_archives_are_read_back_whole(spark, tmp_path, monkeypatch)


def test_shards_are_written_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 20)
    df = spark.createDataFrame([(i, f"s{i % 3}") for i in range(200)], "doc_id bigint, source string")
    sharding.write_shards(df, f"{tmp_path}/s", 4)
    back = spark.read.parquet(f"{tmp_path}/s").collect()
    assert Counter((r.doc_id, r.shard, r.slot) for r in back) == Counter((r.doc_id, r.shard, r.slot) for r in sharding.interleave(df, 4).collect())
    assert {p.name for p in (tmp_path / "s").iterdir() if p.is_dir()} == {f"shard={i}" for i in range(4)}
    sharding.write_shards(df.limit(0), f"{tmp_path}/none", 4)

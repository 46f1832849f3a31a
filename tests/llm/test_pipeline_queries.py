import random
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from corvina.llm import queries
from test_minhash import brute


@pytest.fixture(scope="module")
def small(tmp_path_factory):
    d = tmp_path_factory.mktemp("sf")
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeghilmnorstu") for _ in range(6)) for _ in range(2000)]
    texts = [None, "", "short"] + ["".join(" ".join(rng.choice(words) for _ in range(15)) + ".\n" for _ in range(6)) for _ in range(30)]
    texts += [texts[5], texts[6].replace(texts[6].split()[40], "changed", 1)]
    item = "Which of the rivers that flow through the old town carries more water in spring than in autumn every single year?"
    texts.append(texts[7] + item + "\n")
    n = len(texts)
    pq.write_table(pa.table({"doc_id": pa.array(range(n), pa.int64()), "text": texts, "lang": ["en"] * n, "source": [f"s{i % 2}" for i in range(n)], "n_chars": pa.array([len(t or "") for t in texts], pa.int64())}), d / "documents.parquet")
    pq.write_table(pa.table({"item_id": pa.array([1], pa.int64()), "text": [item]}), d / "benchmark.parquet")
    pq.write_table(pa.table({"doc_id": pa.array(range(n), pa.int64()), "quality": pa.array([1] * n, pa.int32()), "toxic": pa.array([0] * n, pa.int32())}), d / "labels.parquet")
    pq.write_table(pa.table({"page_id": pa.array(range(n), pa.int64()), "url": ["u"] * n, "html": texts}), d / "pages.parquet")
    pq.write_table(pa.table({"conv_id": pa.array([i // 2 for i in range(n)], pa.int64()), "turn": pa.array([i % 2 for i in range(n)], pa.int64()), "role": ["user", "assistant"] * (n // 2), "text": texts}), d / "conversations.parquet")
    return str(d)


def test_stages_against_plain_python(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    seen = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        seen.append(rows)
    quality, lines, dedup, clean, tokens = seen
    assert {r.doc_id for r in quality} == set(range(3, 36)) and {r.doc_id for r in lines} == {r.doc_id for r in quality}
    assert {r.doc_id for r in dedup} == {d for d, _, _, kept in brute([(r.doc_id, r.text) for r in lines], 5, 80) if kept}
    assert {r.doc_id for r in dedup} - {r.doc_id for r in clean} <= {35} and 35 not in {r.doc_id for r in clean}
    assert all(r.round_trip for r in tokens) and {r.doc_id for r in tokens} == {r.doc_id for r in clean}
    assert all(list(r.asDict()) == list(corpus_pipeline.COLUMNS) and r.n_chars == len(r.text) for r in clean)
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, small).collect()) == sorted(r.doc_id for r in tokens)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_every_query_runs_over_its_whole_table(spark, small, name):
    rows = queries.QUERIES[name](spark, small).collect()
    if name.startswith("op3"):
        assert {r.doc_id for r in rows} == {35}
    elif name.startswith("op11"):
        assert sorted(r.conv_id for r in rows) == list(range(18))
    else:
        key = "page_id" if name.startswith("op10") else "doc_id"
        assert Counter(r[key] for r in rows) == Counter(range(36))


def test_no_local_checkpoints_and_native_quality_rules():
    here = Path(corpus_pipeline.__file__).parent
    sources = {p.name: p.read_text() for p in (here / "corvina" / "llm").glob("*.py")}
    assert not any("localCheckpoint(" in s for s in sources.values())
    assert not any(x in sources["quality.py"] for x in ("pandas", "pyarrow", "udf", "mapIn", ".rdd"))

import random
import re
from pathlib import Path

import numpy as np
import pytest

from corvina.llm import minhash
from corvina.llm.components import components, union_find


def brute(rows, size, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset())
    edges = [(i, i) for i in range(len(rows))]
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                edges.append((i, j))
    root = union_find(edges)
    least = {}
    for i, r in root.items():
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(root[i]) if sets[i] else d
        out.append((d, len(sets[i]), c, True if c is None else d == c))
    return sorted(out, key=str)


def found(spark, rows, size, percent=80):
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "doc_id bigint, text string, kept string, n int")
    got = minhash.near_dedup(df.repartition(3), size=size, percent=percent)
    assert got.columns == ["doc_id", "text", "n", "n_shingles", "component_id", "kept"]
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got.collect()), key=str)


@pytest.mark.parametrize("size", [4, 5])
def test_against_all_pairs(spark, corpus, size):
    rows = [(d, t) for d, t, _ in corpus]
    assert found(spark, rows, size) == brute(rows, size, 80)


def test_chains_of_copies_that_miss_their_hub(spark):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(3000)]
    rows, ws = [], [rng.choice(words) for _ in range(120)]
    for i in range(120):  # each a few edits from the one before, far from the first
        if i % 3 == 0:
            ws = list(ws)
            ws[rng.randrange(len(ws))] = rng.choice(words)
        own = list(ws)
        own[rng.randrange(len(own))] = rng.choice(words)
        rows.append((i, " ".join(own)))
    rows += [(200 + i, " ".join(ws[:n])) for i, n in enumerate(range(60, 120, 3))]  # cut off at different lengths
    assert found(spark, rows, 4) == brute(rows, 4, 80)


def test_empty_table(spark):
    assert found(spark, [], 5) == []


def test_signature_equals_the_sequential_algorithm():
    m, rng = 32, np.random.default_rng(1)
    elements = rng.integers(0, 2**63, 50).astype(np.uint64)
    doc = np.repeat([0, 1, 2], [1, 9, 40])
    got = minhash.superminhash(elements, doc, 4, m)
    for d in range(3):
        want = np.full(m, np.inf)
        for x in elements[doc == d]:
            p = list(range(m))
            for j in range(m):
                a = minhash.mix(np.array([x]) + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
                r = float((a >> np.uint64(11)).astype(float)[0]) * 2.0**-53
                k = j + int((minhash.mix(a ^ np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(32))[0]) * (m - j) // 2**32
                p[j], p[k] = p[k], p[j]
                want[p[j]] = min(want[p[j]], r + j)
        assert np.array_equal(got[d], want)
    assert np.isinf(got[3]).all()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    errors = []
    for _ in range(40):
        pool = rng.integers(0, 2**63, 300).astype(np.uint64)
        a, b = pool[:200], pool[50:250]
        sig = minhash.superminhash(np.concatenate([a, b]), np.repeat([0, 1], 200), 2)
        errors.append((sig[0] == sig[1]).mean() - 150 / 250)
    assert abs(np.mean(errors)) < 0.02


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)]
    df = spark.createDataFrame([*edges, (None, 3)], "a bigint, b bigint").repartition(5)
    assert dict(components(df).collect()) == union_find(edges)
    assert components(df.limit(0)).collect() == []


def test_recall_of_pairs_without_a_common_hub(spark):
    """Pairs around the least similarity, each with words of its own: none has a third text to meet over."""
    rng = random.Random(12)
    words = [f"u{i}" for i in range(50_000)]
    rows = []
    for i in range(0, 3000, 2):
        ws = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        other = list(ws)
        for _ in range(rng.randint(1, 1 + len(ws) // 40)):
            other[rng.randrange(len(other))] = rng.choice(words)
        rows += [(i, " ".join(ws)), (i + 1, " ".join(other))]
    got = {d: c for d, _, c, _ in found(spark, rows, 4)}
    sets = [{tuple(w[j : j + 4]) for j in range(len(w) - 3)} for w in (t.split() for _, t in rows)]
    linked = [i for i in range(0, len(rows), 2) if 100 * len(sets[i] & sets[i + 1]) >= 80 * len(sets[i] | sets[i + 1])]
    assert 300 < len(linked) < 1400 and all(got[i + 1] == (i if i in linked else i + 1) for i in range(0, len(rows), 2) if i not in linked)
    assert sum(got[i + 1] == i for i in linked) >= 0.999 * len(linked)


def test_hot_nodes_and_buckets_are_dealt_out(spark, corpus, monkeypatch):
    from corvina.llm import common, components as parts

    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(parts, "HOT", 2)
    monkeypatch.setattr(minhash, "HOT", 2)
    rows = [(d, t) for d, t, _ in corpus]
    assert found(spark, rows, 4) == brute(rows, 4, 80)
    rng = random.Random(6)
    edges = [(0, i) for i in range(1, 60)] + [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    df = spark.createDataFrame(edges, "a bigint, b bigint").repartition(5)
    assert dict(components(df).collect()) == union_find(edges)


def test_a_size_estimate_does_not_grow_from_join_to_join(spark):
    """Spark multiplies the sizes of joined tables; the number that comes of it would fill the driver's memory."""
    texts = [" ".join(f"w{j}" for j in range(i % 10, i % 10 + 30)) for i in range(40)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string")
    told = minhash.near_dedup(docs, size=4)._jdf.queryExecution().optimizedPlan().stats().simpleString()
    assert int((re.search(r"E\+(\d+)", told) or [0, 0])[1]) < 200


def test_components_of_a_long_chain_leave_no_files_behind(spark):
    before = {p.name for p in _checkpoints(spark)}
    edges = [(f"n{i}", f"n{i + 1}") for i in range(0, 300)] + [("loop", "loop"), (None, "x")]
    df = spark.createDataFrame(edges, "a string, b string").repartition(40)
    want = union_find([e for e in edges if e[0]])
    assert dict(components(df).collect()) == want
    assert not [p for p in {p.name for p in _checkpoints(spark)} - before if p.startswith("components-")]


def _checkpoints(spark):
    return Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).iterdir() if spark.sparkContext.getCheckpointDir() else []

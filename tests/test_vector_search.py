"""Exact search by blocks against all scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvina.operators import vectors


def table(spark, m, ids=None):
    return spark.createDataFrame([(i, None if r is None else [float(x) for x in r]) for i, r in zip(ids or range(len(m)), m, strict=True)], "vec_id bigint, embedding array<float>")


def brute(m, queries, k, floor):
    m32 = np.array([r for r in m if r is not None], np.float32).astype(float)
    ids = [i for i, r in enumerate(m) if r is not None]
    out = set()
    for q in queries:
        s = np.round(m32 @ m32[ids.index(q)], 6)
        for rank, (score, i) in enumerate(sorted(zip(-s, ids, strict=True))[:k], 1):
            if floor is None or -score >= floor:
                out.add((q, i, round(-score, 6), rank))
    return out


@pytest.mark.parametrize(("k", "floor"), [(5, None), (20, 0.2), (400, None)])
def test_blocks_give_what_all_vectors_give(spark, k, floor, monkeypatch):
    monkeypatch.setattr(vectors, "VECTORS_EACH", 40)
    monkeypatch.setattr(vectors, "CONCEPTS_EACH", 7)
    rng = np.random.default_rng(k)
    centres = rng.normal(size=(6, 8))
    m = [c / np.linalg.norm(c) for c in centres[rng.integers(0, 6, 300)] + 0.1 * rng.normal(size=(300, 8))]
    m = [*m, *[m[0]] * 60, None]  # a group of copies, one without an embedding
    m += [rng.normal(size=8) * 5] * (k > 5)  # a long one
    df = table(spark, m).repartition(5)
    queries = [i for i in range(len(m)) if i % 9 == 0 and m[i] is not None]
    concepts = df.where(F.col("vec_id").isin(queries)).withColumnRenamed("vec_id", "concept_id")
    best, work = vectors.Search(concepts, df, k, floor).best_and_work()
    assert {(r.concept_id, r.vec_id, r.score, r["rank"]) for r in best.collect()} == brute(m, queries, k, floor)
    share = work.agg(F.sum("scored") / F.sum("n_vectors")).first()[0]
    assert share <= 1 and (k != 5 or share < 0.6)
    assert best.count() == vectors.top_k(concepts, df, k, floor).count()


def test_many_concepts_are_searched_by_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 3)
    rng = np.random.default_rng(1)
    df = table(spark, rng.normal(size=(50, 4)))
    concepts = df.withColumnRenamed("vec_id", "concept_id")
    by_blocks = sorted(map(tuple, vectors.top_k(concepts, df, 4).collect()))
    monkeypatch.setattr(vectors, "BLOCK", 256)
    assert by_blocks == sorted(map(tuple, vectors.top_k(concepts, df, 4).collect()))


def test_nothing_to_search(spark):
    df = table(spark, [[1.0, 0.0]])
    concepts = df.withColumnRenamed("vec_id", "concept_id")
    assert vectors.Search(concepts, df.limit(0), 3).best().count() == 0 and vectors.top_k(concepts.limit(0), df, 3).count() == 0
    assert vectors.Search(concepts.limit(0), df, 3).best().count() == 0

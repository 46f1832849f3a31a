"""Positions, evenly spaced rows and a generator's samples, against lists; streams that remember."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corvina.operators import goldset, ordering, scoring
from corvina.streaming import incremental


@pytest.fixture(scope="module")
def rows(spark):
    made = [(i % 5 if i % 11 else None, i, f"t{i}") for i in range(230)]
    random.Random(1).shuffle(made)
    return made, spark.createDataFrame(made, "a int, b int, t string").repartition(6)


def in_order(made):
    return sorted(made, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_positions(rows):
    made, df = rows
    got = sorted((r.at, r.b) for r in ordering.positions(df, "at", "a", "b").collect())
    assert got == [(i, r[1]) for i, r in enumerate(in_order(made))]
    assert ordering.positions(df.limit(0), "at", "a").count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 229, 230, 500])
def test_evenly_spaced(rows, n):
    made, df = rows
    places = range(230) if n >= 230 else np.linspace(0, 229, n).astype(int)
    assert sorted(r.b for r in ordering.evenly_spaced(df, n, "a", "b").collect()) == sorted(in_order(made)[p][1] for p in places)


def test_one_generator_from_table_to_table(rows):
    made, df = rows
    strata = [None, 0, 1, 2, 3, 4]
    mine, theirs = random.Random(42), random.Random(42)
    for a, target in zip(strata, (3, 10, 500, 0, 21, 5), strict=True):
        pool = [r for r in in_order(made) if r[0] == a]
        want = theirs.sample(pool, target) if len(pool) > target else pool
        got = scoring.generator_sample(df.where(F.col("a").eqNullSafe(a)), target, mine, "b").collect()
        assert sorted(r.b for r in got) == sorted(r[1] for r in want)
    assert mine.random() == theirs.random()  # neither drew more than the other


def test_the_gold_set_of_a_generator(spark):
    """All five strata are drawn, one after the other, from lists in the order of their files."""
    accepted = [(f"P{i}", f"Microbe {i}", "vat", "B", f"PMID P{i}: s{i}", "f", i) for i in range(30)]
    rejected = [(f"R{i}", f"microbe {i}", "vat", "N", f"r{i}", "f", i) for i in range(20)]
    sentences = [(f"S{i}", s + f" {i}", [(f"m{i}",), (f"n{i}",)], "f", i) for i, s in enumerate(["psoas muscle and x", "liver weight", "fat here", "bone of it"] * 8)]
    a = spark.createDataFrame(accepted, "pmid string, source_node string, target_node string, target_node_type string, evidence string, source_file string, ord int").repartition(4)
    r = spark.createDataFrame(rejected, "pmid string, microbe string, feature_canonical string, feature_node_type string, sentence string, source_file string, ord int").repartition(3)
    s = spark.createDataFrame(sentences, "pmid string, sentence string, microbes array<struct<text:string>>, source_file string, ord int").repartition(5)
    targets = {"accepted_edge": 7, "gemini_rejected": 5, "vocab_excluded": 6, "recall_probe": 9, "random_co_occurrence": 4}
    got = goldset.build(a, r, s, targets, seed=3, generator=True).collect()
    rng = random.Random(3)
    strata = {k: sorted(df.collect(), key=lambda x: (x.ord, x["at"])) for k, df in goldset.candidates(a, r, s)}
    assert all(len(strata[k]) > n for k, n in targets.items())
    want, used = {}, set()
    for name, pool in strata.items():
        if name == "recall_probe":
            pool = [x for x in pool if (x.pmid, x.microbe, x.sentence[:80]) not in used]
        chosen = rng.sample(pool, targets[name]) if len(pool) > targets[name] else pool
        used |= {(x.pmid, x.microbe, (x.sentence or "")[:80]) for x in chosen}
        for x in chosen:
            want.setdefault(x.record_id, name)
    assert {x.record_id: x.stratum for x in got} == want and len(got) == len(want)


def test_keys_are_remembered_for_a_time(spark, tmp_path):
    like = spark.createDataFrame([], "k int, ts timestamp, v string")

    def run(*rows):
        df = spark.createDataFrame(list(rows), "k int, ts string, v string").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = incremental.file_stream(spark, f"{tmp_path}/in", like)
        incremental.ingest_unseen(stream, f"{tmp_path}/out", f"{tmp_path}/c", "k", time="ts", remembered="10 days").awaitTermination()
        return sorted((r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run((1, "2024-01-01", "a"), (2, "2024-01-02", "b")) == [(1, "a"), (2, "b")]
    assert run((1, "2024-01-05", "again"), (3, "2024-01-08", "c")) == [(1, "a"), (2, "b"), (3, "c")]
    assert run((4, "2024-01-07", "late"), (5, "2024-02-20", "d")) == [(1, "a"), (2, "b"), (3, "c"), (4, "late"), (5, "d")]
    assert run((6, "2024-01-20", "too late"), (1, "2024-02-21", "anew")) == [(1, "a"), (1, "anew"), (2, "b"), (3, "c"), (4, "late"), (5, "d")]


def test_keys_are_remembered_from_when_they_arrive(spark, tmp_path):
    like = spark.createDataFrame([], "k int")
    for k in (1, 2, 1):
        spark.createDataFrame([(k,), (k,)], "k int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        incremental.ingest_unseen(incremental.file_stream(spark, f"{tmp_path}/in", like), f"{tmp_path}/out", f"{tmp_path}/c", "k").awaitTermination()
    assert sorted(r.k for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2]

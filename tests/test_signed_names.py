"""A name of signed edges is cleaned once, however many rows have it."""

from pyspark.sql import functions as F

from corvina import storage
from corvina.functions import spans
from corvina.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_each_different_name_is_cleaned_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    clean = spans.clean_subject

    @F.udf("string")
    def told(name):
        seen.add(1)
        return name

    want = QUERIES["g11_record_signed"](spark, SF).collect()
    monkeypatch.setattr(spans, "clean_subject", lambda name, kind: clean(told(name), kind))
    got = QUERIES["g11_record_signed"](spark, SF).collect()
    names = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_suppkey").distinct().count()
    assert sorted(got) == sorted(want) and len(got) > 20
    assert 0 < seen.value <= 2 * names  # the rows are thousands


def test_many_names_are_dealt_over_tasks_with_the_same_edges(spark, monkeypatch):
    want = QUERIES["e4_signed_edges"](spark, SF).collect()
    monkeypatch.setattr(storage, "BROADCAST_ROWS", 2)
    got = QUERIES["e4_signed_edges"](spark, SF)
    assert "_part#" in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want))

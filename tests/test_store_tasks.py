"""A store's rows are told apart in tasks of bounded rows."""

from pyspark.sql import functions as F

from corvina.sources import graph_store


def test_rows_of_a_store_are_dealt_by_their_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(graph_store, "TASK_ROWS", 50, raising=False)
    at = f"file://{tmp_path}/store"
    row = lambda n, c: spark.range(n).coalesce(1).select(F.lit("M").alias("source_node_type"), F.col("id").cast("string").alias("source_node"),
        F.lit("r").alias("rel_type"), F.lit("D").alias("target_node_type"), F.lit("d").alias("target_node"), F.lit("").alias("pmid"), F.lit(c).alias("confidence"))
    for load, n, c in (("a", 1000, 0.5), ("b", 400, 1.0)):
        graph_store.prepare(row(n, c), at, load, "relationships")
        graph_store.publish(at, load, parts=("relationships",))
    got = graph_store.read(spark, at, "relationships")
    assert {r["confidence"]: r["count"] for r in got.groupBy("confidence").count().collect()} == {0.5: 600, 1.0: 400}
    tasks = got.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in tasks) == 1000 and max(r["count"] for r in tasks) < 120

"""Image paths are looked up in tasks of bounded rows, without sorts by text."""

from pyspark.sql import functions as F

from corvina import storage
from corvina.operators import figures


def test_lists_of_paths_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(storage, "TASK_ROWS", 50, raising=False)
    rows = spark.range(1000).coalesce(1).select("id", F.concat(F.lit("f"), "id").alias("figure_id"))
    files = rows.where("id % 2 = 0").select(F.concat("figure_id", F.lit(".png")).alias("path"))
    files = files.unionByName(rows.where("id % 3 = 0").select(F.concat("figure_id", F.lit(".jpg")).alias("path")))
    found = figures.figure_files(rows, files, kinds=("png", "jpg"))
    want = {i: f"f{i}.png" if i % 2 == 0 else f"f{i}.jpg" if i % 3 == 0 else None for i in range(1000)}
    assert {r["id"]: r["resolved_path"] for r in found.collect()} == want
    assert max(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()) < 120

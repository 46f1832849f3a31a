"""Bundles and graph stores: published whole or not at all."""

import glob
import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvina.functions import vocab
from corvina.sources import bundles, graph_store


@pytest.fixture
def rels(spark):
    base = dict.fromkeys(vocab.RELATIONSHIP_COLUMNS, "")
    rows = [base | {"source_node_type": "Microbe", "source_node": f"m'{i}", "target_node_type": "Disease", "target_node": "d", "rel_type": "R"} for i in range(3)]
    return spark.createDataFrame(rows).select(*vocab.RELATIONSHIP_COLUMNS)


def test_bundles_are_held_against_their_manifest(spark, rels, tmp_path):
    path = f"file://{tmp_path}/b"
    two = rels.where("source_node <> 'm''2'")
    said = bundles.write_bundle(spark, two, rels.subtract(two), path, "2024", command="run")
    assert said["counts"]["pre_audit_by_rel"] == {"R": 3} and (said["counts"]["post_total"], said["counts"]["dropped"], said["command"]) == (2, 1, "run")
    nodes, back, lines, manifest = bundle = bundles.read_bundle(spark, path)
    assert (nodes.count(), back.count(), manifest) == (3, 2, said) and bundles.load_plan(bundle, wipe=True) == [("wipe", 1), ("constraints", 2), ("nodes", 3), ("relationships", 2)]
    assert bundles.write_explorer(spark, bundle, f"{path}-explorer") == 2 and bundles.read_explorer(spark, f"{path}-explorer").count() == 2
    with pytest.raises(graph_store.Mismatch, match="3 written, 3 read back, 2 in the manifest"):
        bundles.write_explorer(spark, (nodes, rels, lines, manifest), f"{path}-explorer")
    assert bundles.read_explorer(spark, f"{path}-explorer").count() == 2
    with pytest.raises(graph_store.Mismatch, match="relationships: 3 held"):
        bundles.load_plan((nodes, rels, lines, manifest))
    with pytest.raises(FileNotFoundError, match="nothing is published"):
        bundles.read_bundle(spark, f"file://{tmp_path}/none")


def test_a_wrong_total_leaves_what_is_published(spark, rels, tmp_path):
    path = f"file://{tmp_path}/b"
    first = bundles.write_bundle(spark, rels, rels.limit(0), path, "1")
    for expected in ({"relationships": 4}, {"nodes": 3}):
        with pytest.raises(graph_store.Mismatch, match="expected"):
            bundles.write_bundle(spark, rels, rels.limit(0), path, "2", expected=expected)
    broken = rels.withColumn("pmid", F.when(F.col("source_node") == "m'1", F.raise_error(F.lit("broken"))).otherwise(""))
    with pytest.raises(Exception, match="broken"):
        bundles.write_bundle(spark, broken, rels.limit(0), path, "3")
    assert bundles.read_bundle(spark, path)[3] == first
    assert len(glob.glob(f"{tmp_path}/b/*/")) == 1  # nothing of the others is left
    second = bundles.write_bundle(spark, rels.limit(1), rels.limit(0), path, "4", expected={"relationships": 1, "nodes": 2})
    assert bundles.read_bundle(spark, path)[3] == second and second["counts"]["post_total"] == 1


def edges(spark, names, confidence=0.5):
    rows = [("Microbe", f"m{i}", "R", "Disease", "d", "", confidence) for i in names]
    return spark.createDataFrame(rows, "source_node_type string, source_node string, rel_type string, target_node_type string, target_node string, pmid string, confidence double")


def held(spark, path):
    return {r.source_node: r.confidence for r in graph_store.read(spark, path, "relationships").collect()}


def test_loads_are_merged_and_idempotent(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    assert graph_store.read(spark, path, "nodes").count() == 0
    for _ in range(2):
        graph_store.prepare(edges(spark, range(5)).repartition(3), path, "a", "relationships", expected=5)
        assert graph_store.publish(path, "a", parts=("relationships",))["number"] == 1
    graph_store.prepare(edges(spark, [3, 7], 0.9), path, "b", "relationships")
    assert held(spark, path) == dict.fromkeys([f"m{i}" for i in range(5)], 0.5)  # prepared is not published
    graph_store.publish(path, "b", parts=("relationships",))
    assert held(spark, path) == {"m0": 0.5, "m1": 0.5, "m2": 0.5, "m3": 0.9, "m4": 0.5, "m7": 0.9}
    graph_store.prepare(edges(spark, [9]), path, "c", "relationships")
    assert graph_store.publish(path, "c", wipe=True, parts=("relationships",))["loads"] == ["c"] and held(spark, path) == {"m9": 0.5}
    assert len(glob.glob(f"{tmp_path}/s/data/*")) == 1


def test_a_failed_task_or_commit_leaves_nothing(spark, tmp_path):
    path = f"file://{tmp_path}/s"
    broken = edges(spark, range(2000)).repartition(4).withColumn("confidence", F.when(F.col("source_node") == "m1234", F.raise_error(F.lit("broken")).cast("double")).otherwise(0.1))
    with pytest.raises(Exception, match="broken"):
        graph_store.prepare(broken, path, "a", "relationships")
    with pytest.raises(Exception, match="2 relationships were written, 3 were expected"):
        graph_store.prepare(edges(spark, range(2)), path, "a", "relationships", expected=3)
    assert not glob.glob(f"{tmp_path}/s/**/*.parquet", recursive=True) and not glob.glob(f"{tmp_path}/s/**/*.json", recursive=True)
    with pytest.raises(graph_store.Mismatch, match="has no relationships"):
        graph_store.publish(path, "a", parts=("relationships",))
    graph_store.prepare(edges(spark, range(2)), path, "a", "relationships", expected=2)
    with pytest.raises(graph_store.Mismatch, match="has no nodes"):
        graph_store.publish(path, "a")
    assert graph_store.read(spark, path, "relationships").count() == 0
    graph_store.publish(path, "a", parts=("relationships",))
    assert graph_store.read(spark, path, "relationships").count() == 2


def test_a_task_that_runs_again_counts_once(tmp_path):
    writer = graph_store.GraphStore({"path": f"file://{tmp_path}/s", "load": "a", "part": "nodes", "expected": "2"}).writer(None, False)
    batch = pa.RecordBatch.from_pylist([{"label": "A", "name": "x"}, {"label": "A", "name": "y"}])

    def breaks():
        yield batch
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        writer.write(breaks())
    abandoned, told = writer.write(iter([batch])), writer.write(iter([batch]))  # the first attempt's executor is lost after it wrote
    assert abandoned.files != told.files
    writer.commit([told, graph_store.Written(), None])
    graph_store.publish(f"file://{tmp_path}/s", "a", parts=("nodes",))
    state = json.loads(open(glob.glob(f"{tmp_path}/s/manifests/*.json")[0]).read())
    assert state["parts"]["nodes"] == {"files": told.files, "rows": 2}
    with pytest.raises(ValueError, match="a part is one of"):
        graph_store.GraphStore({"path": "x", "load": "a", "part": "edges"}).writer(None, False)


def test_a_bundle_is_loaded(spark, rels, tmp_path):
    path = f"file://{tmp_path}"
    bundles.write_bundle(spark, rels, rels.limit(0), f"{path}/b", "1")
    bundle = bundles.read_bundle(spark, f"{path}/b")
    assert graph_store.load(spark, bundle, f"{path}/s", "one") == {"load": "one", "number": 1, "nodes": 4, "relationships": 3, "as_told": True}
    assert graph_store.load(spark, bundle, f"{path}/s", "one")["number"] == 1
    nodes, back, lines, said = bundle
    with pytest.raises(Exception, match="2 relationships were written, 3 were expected"):
        graph_store.load(spark, (nodes, back.limit(2), lines, said), f"{path}/s", "two", wipe=True)
    assert graph_store.manifest(f"{path}/s")["loads"] == ["one"] and graph_store.read(spark, f"{path}/s", "relationships").count() == 3

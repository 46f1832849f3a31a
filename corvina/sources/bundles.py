"""Bundles of a graph, published in one step once their counts reconcile.

A bundle is written to a folder of its own first. The job that writes a part
counts its rows; only if what was written, what can be read back and what was
expected agree does the name CURRENT move to it, by one rename. Otherwise the
folder goes, and what was published before stays.

The folder: CURRENT, and in each version nodes, relationships, import and
manifest, or records and manifest for an explorer.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vocab
from ..operators import graph
from . import files
from .graph_store import Mismatch

PARTS = ("nodes", "relationships", "import", "manifest")


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def current(spark: SparkSession, path: str) -> str:
    """The folder of the published version."""
    if not files._exists(spark, f"{path}/CURRENT"):
        raise FileNotFoundError(f"nothing is published at {path}")
    return f"{path}/{spark.read.text(f'{path}/CURRENT').first().value}"


def _publish(spark: SparkSession, path: str, version: str) -> None:
    """Lets CURRENT name a version, by a rename over what it was."""
    jvm = spark.sparkContext._jvm
    aside, fs = _path(spark, f"{path}/.CURRENT-{version}")
    out = fs.create(aside, True)
    out.write(bytearray(version.encode()))
    out.close()
    target, _ = _path(spark, f"{path}/CURRENT")
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(aside, target, options)


def _remove(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def _reconcile(**counts: dict[str, int | None]) -> None:
    """For each name, all counts that are known must be the same."""
    odd = {k: v for k, v in counts.items() if len({n for n in v.values() if n is not None}) > 1}
    if odd:
        raise Mismatch("counts don't reconcile: " + "; ".join(f"{k}: " + ", ".join(f"{n} {how}" for how, n in v.items() if n is not None) for k, v in odd.items()))


def _observed_csv(df: DataFrame, path: str, columns: tuple[str, ...]) -> int:
    counted, seen = files.with_metrics(df, n=F.count(F.lit(1)))
    files.write_csv(counted, path, columns)
    return seen.get["n"]


def write_bundle(spark: SparkSession, rels: DataFrame, dropped: DataFrame, path: str, at: str, sources: Mapping[str, str] | None = None, command: str = "", expected: Mapping[str, int] | None = None) -> dict:
    """Nodes, relationships, import statements and a manifest, published under a folder; returns the manifest.

    rels is computed once; nodes, statements and counts come from what was
    written. expected may say how many nodes and relationships there must be.
    """
    expected, version = dict(expected or {}), uuid.uuid4().hex
    stage = f"{path}/{version}"
    try:
        kept = rels.select(*[F.col(c) if c in rels.columns else F.lit("").alias(c) for c in vocab.RELATIONSHIP_COLUMNS])
        n_rels = _observed_csv(kept, f"{stage}/relationships", vocab.RELATIONSHIP_COLUMNS)
        back = files.read_relationships(spark, f"{stage}/relationships")
        n_nodes = _observed_csv(graph.nodes(back), f"{stage}/nodes", ("label", "name"))
        lines = graph.import_statements(back).repartitionByRange("section", "line").sortWithinPartitions("section", "line").select("line")
        lines.write.mode("overwrite").text(f"{stage}/import")
        by = lambda df: {r.rel_type: r.n for r in graph.count_by_type(df).collect()}
        after, gone = by(back), by(dropped)
        before = {k: after.get(k, 0) + gone.get(k, 0) for k in {*after, *gone}}
        _reconcile(
            relationships={"written": n_rels, "read back": sum(after.values()), "expected": expected.get("relationships")},
            nodes={"written": n_nodes, "read back": _read_nodes(spark, stage).count(), "expected": expected.get("nodes")},
        )
        counts = {
            "pre_audit_by_rel": before, "post_audit_by_rel": after, "pre_total": sum(before.values()), "post_total": n_rels,
            "nodes": n_nodes, "dropped": sum(gone.values()),
        }
        manifest = {"stage": "graph_export", "generated_at": at, "sources": dict(sources or {}), "counts": counts, "command": command,
            "outputs": {p: f"{stage}/{p}" for p in PARTS[:3]}}
        _write_manifest(spark, stage, manifest)
        _publish(spark, path, version)
    except BaseException:
        _remove(spark, stage)
        raise
    return manifest


def _write_manifest(spark: SparkSession, stage: str, manifest: Mapping) -> None:
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{stage}/manifest")


def _read_nodes(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("label string, name string").option("header", True).csv(f"{folder}/nodes")


def read_bundle(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, dict]:
    """(nodes, relationships, statements, manifest) of the published version; an error names the parts that are missing."""
    folder = current(spark, path)
    missing = [p for p in PARTS if not files._exists(spark, f"{folder}/{p}")]
    if missing:
        raise FileNotFoundError(f"the bundle at {folder} has no {', '.join(missing)}")
    manifest = json.loads(spark.read.text(f"{folder}/manifest").first().value)
    return _read_nodes(spark, folder), files.read_relationships(spark, f"{folder}/relationships"), statements(spark.read.text(f"{folder}/import")), manifest


def statements(lines: DataFrame) -> DataFrame:
    """Statements of an import script, one per line, without comments, blank lines and the mark at their end."""
    return lines.select(F.trim("value").alias("line")).where("line <> '' AND NOT startswith(line, '//')").select(F.regexp_replace("line", r";+$",
        "").alias("statement")).where("statement <> ''")


def write_explorer(spark: SparkSession, bundle: tuple[DataFrame, DataFrame, DataFrame, dict], path: str) -> int:
    """Explorer records of a bundle, published under a folder as JSON lines, if there are as many as its manifest says; how many."""
    _, rels, _, manifest = bundle
    version = uuid.uuid4().hex
    stage = f"{path}/{version}"
    try:
        n = files.write_jsonl(graph.records(rels), f"{stage}/records")
        _reconcile(records={"written": n, "read back": spark.read.text(f"{stage}/records").count(), "in the manifest": manifest["counts"]["post_total"]})
        _write_manifest(spark, stage, {"stage": "explorer_export", "records": n, "of": manifest["generated_at"]})
        _publish(spark, path, version)
    except BaseException:
        _remove(spark, stage)
        raise
    return n


def read_explorer(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.json(f"{current(spark, path)}/records")


def load_plan(bundle: tuple[DataFrame, DataFrame, DataFrame, dict], wipe: bool = False) -> list[tuple[str, int]]:
    """What a load of a bundle would do, in order, with counts; nothing is sent anywhere."""
    nodes, rels, lines, manifest = bundle
    kinds = lines.groupBy(F.when(F.col("statement").startswith("CREATE"), "constraints").when(F.col("statement").startswith("MERGE"),
        "nodes").otherwise("relationships").alias("k")).count()
    by = {r.k: r["count"] for r in kinds.collect()}
    _reconcile(nodes={"held": nodes.count(), "in the manifest": manifest["counts"]["nodes"]}, relationships={"held": rels.count(), "in the manifest": manifest["counts"]["post_total"]})
    return ([("wipe", 1)] if wipe else []) + [(k, by.get(k, 0)) for k in ("constraints", "nodes", "relationships")]

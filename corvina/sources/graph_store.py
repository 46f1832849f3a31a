"""A graph store in a folder, and a data source that writes to it with commit and abort.

Tasks write files of their own, which no reader knows of. The driver's commit
holds their counts against what was expected and prepares the part; a failed
task or commit is aborted, and its files go. publish() makes prepared parts
visible in one step, by a manifest that names every file. Nodes and
relationships are merged by their keys when the store is read, so loading a
batch again changes nothing.

The folder: data/<load>/<part>/*.parquet, prepared/<load>/<part>.json, and
manifests/<number>.json, of which the last counts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..storage import TASK_ROWS

FORMAT = "graph_store"
#: What tells one node or relationship from another.
KEYS = {"nodes": ("label", "name"), "relationships": ("source_node_type", "source_node", "rel_type", "target_node_type", "target_node", "pmid")}


class Mismatch(ValueError):
    """Counts that don't reconcile."""


def _fs(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path.rstrip("/"))


def _write_json(fs: pyarrow.fs.FileSystem, path: str, value: object) -> None:
    """By way of another name, so that no reader sees half of it."""
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    aside = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(aside) as f:
        f.write(json.dumps(value, sort_keys=True).encode())
    fs.move(aside, path)


def _read_json(fs: pyarrow.fs.FileSystem, path: str):
    with fs.open_input_stream(path) as f:
        return json.loads(f.read())


def _listed(fs: pyarrow.fs.FileSystem, path: str) -> list[str]:
    return sorted(f.path for f in fs.get_file_info(pyarrow.fs.FileSelector(path, allow_not_found=True)) if f.path.endswith(".json"))


def _remove(fs: pyarrow.fs.FileSystem, path: str) -> None:
    if fs.get_file_info(path).type == pyarrow.fs.FileType.Directory:
        fs.delete_dir(path)
    elif fs.get_file_info(path).type == pyarrow.fs.FileType.File:
        fs.delete_file(path)


@dataclass
class Written(WriterCommitMessage):
    """What a task has written."""

    files: list[str] = field(default_factory=list)
    rows: int = 0


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: Mapping[str, str]):
        self.path, self.load, self.part = options["path"], options["load"], options["part"]
        self.expected = int(options["expected"]) if "expected" in options else None
        if self.part not in KEYS:
            raise ValueError(f"a part is one of {', '.join(KEYS)}, not {self.part!r}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file for each attempt of a task; one that fails leaves none."""
        fs, root = _fs(self.path)
        context = TaskContext.get()
        folder = f"{root}/data/{self.load}/{self.part}"
        name = f"{folder}/{context.partitionId() if context else 0:05d}-{uuid.uuid4().hex}.parquet"
        writer, rows = None, 0
        try:
            for b in iterator:
                if not b.num_rows:
                    continue
                if writer is None:
                    fs.create_dir(folder, recursive=True)
                    writer = pa.parquet.ParquetWriter(name, b.schema, filesystem=fs)
                writer.write_batch(b)
                rows += b.num_rows
        except BaseException:
            if writer is not None:
                writer.close()
                _remove(fs, name)
            raise
        if writer is None:
            return Written()
        writer.close()
        return Written([name.removeprefix(f"{root}/")], rows)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        rows = sum(m.rows for m in messages if m)
        if self.expected is not None and rows != self.expected:
            raise Mismatch(f"{rows} {self.part} were written, {self.expected} were expected")
        fs, root = _fs(self.path)
        named = sorted(f for m in messages if m for f in m.files)
        _write_json(fs, f"{root}/prepared/{self.load}/{self.part}.json", {"load": self.load, "part": self.part, "files": named, "rows": rows})

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        """All files of this part of the load go, those of tasks that didn't get to tell of them too."""
        fs, root = _fs(self.path)
        _remove(fs, f"{root}/data/{self.load}/{self.part}")


class GraphStore(DataSource):
    """df.write.format("graph_store").options(path=, load=, part=nodes or relationships, expected=).mode("append").save()"""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(self.options)


def manifest(path: str) -> dict:
    """The published state: its number, the loads it holds, and for each part its files and the rows they hold."""
    fs, root = _fs(path)
    found = _listed(fs, f"{root}/manifests")
    return _read_json(fs, found[-1]) if found else {"number": 0, "loads": [], "parts": {p: {"files": [], "rows": 0} for p in KEYS}}


def prepare(df: DataFrame, path: str, load: str, part: str, expected: int | None = None) -> None:
    """Writes a part of a load, unseen until it is published. Of an earlier attempt at the load nothing is left."""
    spark = df.sparkSession
    spark.dataSource.register(GraphStore)
    fs, root = _fs(path)
    if load in manifest(path)["loads"]:
        return
    for x in (f"{root}/prepared/{load}/{part}.json", f"{root}/data/{load}/{part}"):
        _remove(fs, x)
    options = {"path": path, "load": load, "part": part} | ({} if expected is None else {"expected": str(expected)})
    df.write.format(FORMAT).options(**options).mode("append").save()


def publish(path: str, load: str, wipe: bool = False, parts: tuple[str, ...] = tuple(KEYS)) -> dict:
    """Makes the prepared parts of a load visible, all in one step; with wipe, nothing else stays visible.

    A load that has been published already changes nothing. One that lacks a
    part is refused.
    """
    fs, root = _fs(path)
    before = manifest(path)
    if load in before["loads"]:
        return before
    found = {}
    for part in parts:
        if fs.get_file_info(f"{root}/prepared/{load}/{part}.json").type != pyarrow.fs.FileType.File:
            raise Mismatch(f"the load {load} has no {part}")
        found[part] = _read_json(fs, f"{root}/prepared/{load}/{part}.json")
    old = {p: {"files": [], "rows": 0} if wipe else before["parts"][p] for p in KEYS}
    new = {p: found.get(p, {"files": [], "rows": 0}) for p in KEYS}
    after = {
        "number": before["number"] + 1,
        "loads": ([] if wipe else before["loads"]) + [load],
        "parts": {p: {"files": old[p]["files"] + new[p]["files"], "rows": old[p]["rows"] + new[p]["rows"]} for p in KEYS},
    }
    _write_json(fs, f"{root}/manifests/{after['number']:012d}.json", after)
    _remove(fs, f"{root}/prepared/{load}")
    if wipe:
        for other in before["loads"]:
            _remove(fs, f"{root}/data/{other}")
    return after


def read(spark: SparkSession, path: str, part: str, schema: StructType | str | None = None) -> DataFrame:
    """Published rows of a part, one for each key; of several the last load's counts. Without any load the schema tells the columns.

    Rows are dealt by their keys over as many tasks as the manifest's count
    needs: equal texts make files so small that a task would read millions of rows.
    """
    state = manifest(path)
    named = state["parts"][part]["files"]
    if not named:
        return spark.createDataFrame([], schema or ", ".join(f"{k} string" for k in KEYS[part]))
    rows = spark.read.parquet(*[f"{path.rstrip('/')}/{f}" for f in named])
    tasks = max(spark.sparkContext.defaultParallelism, -(-state["parts"][part]["rows"] // TASK_ROWS))
    load = F.regexp_extract(F.col("_metadata.file_path"), r"/data/([^/]+)/[^/]+/[^/]+$", 1)
    at = F.array_position(F.array(*map(F.lit, state["loads"])), load)
    keys = list(KEYS[part])
    rest = [c for c in rows.columns if c not in keys]
    if not rest or len(state["loads"]) == 1:
        return rows.repartition(tasks, *keys).dropDuplicates(keys)
    told = rows.withColumn("_at", at).repartition(tasks, *keys)
    by = F.struct("_at", *rest)
    return told.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def load(spark: SparkSession, bundle: tuple[DataFrame, DataFrame, DataFrame, dict], path: str, load: str, wipe: bool = False) -> dict:
    """Applies a bundle: both parts are written, held against the bundle's manifest and published together; what the store then holds is counted.

    A bundle that doesn't hold what its manifest says leaves the store as it was.
    """
    nodes, rels, _, said = bundle
    prepare(nodes, path, load, "nodes", said["counts"]["nodes"])
    prepare(rels, path, load, "relationships", said["counts"]["post_total"])
    state = publish(path, load, wipe)
    held = {p: read(spark, path, p).count() for p in KEYS}
    return {"load": load, "number": state["number"], "nodes": held["nodes"], "relationships": held["relationships"], "as_told": held["nodes"] == said["counts"]["nodes"]}

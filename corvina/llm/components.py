"""Connected components by union-find within partitions and star contraction between them."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import met_where_hot, remove_folder, scratch, settled, shared_folder

#: Edges that a task reads, about; a node of more than HOT edges is dealt out.
EDGES, HOT = 100_000, 500


def union_find(edges: list[tuple]) -> dict:
    """Each node's smallest reachable node."""
    root: dict = {}

    def find(x):
        top = x
        while root.setdefault(top, top) != top:
            top = root[top]
        while root[x] != top:
            root[x], x = top, root[x]
        return top

    for a, b in edges:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


def _contract(batches):
    """The forest of a partition's edges, as (node, root) with node > root."""
    edges, kind = [], None
    for b in batches:
        kind = b.schema.field(0).type
        edges += zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
        if len(edges) > 500_000:  # what is known so far, in its shortest form
            edges = [(x, r) for x, r in union_find(edges).items() if x != r]
    found = [(x, r) for x, r in union_find(edges).items() if x != r]
    if found:
        x, r = zip(*found, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(x, kind), pa.array(r, kind)], ["u", "v"])


def _with_least(edges: DataFrame, own: bool) -> DataFrame:
    """edges(u, v) with m, the smallest v of each u, or u itself if own and smaller."""
    least = F.least("u", F.min("v")) if own else F.min("v")
    nodes = scratch(edges.groupBy("u").agg(least.alias("m"), F.count("*").alias("n")), EDGES)
    return met_where_hot(edges, nodes, ["u"], "v", F.col("n") > HOT).drop("n")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges(a, b), root the smallest node reachable.

    Edges with a null end are ignored; loops and repeated edges change nothing;
    no edges give no rows. Partitions are contracted by union-find in bounded
    chunks, then large-star and small-star rounds run until every node hangs on
    a root; each round is written to shared storage, as files with their true
    size, and removed at the end. Nothing but counts reaches the driver.
    """
    folder = shared_folder(edges.sparkSession, "components")
    kind = edges.schema["a"].dataType.simpleString()
    e = edges.where("a IS NOT NULL AND b IS NOT NULL").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    loops = settled(e.where("u = v").select(F.col("u").alias("node")).distinct(), folder)
    e = settled(e.where("u <> v").mapInArrow(_contract, f"u {kind}, v {kind}"), folder, EDGES)
    while True:
        deep = e.select("v").distinct().join(e.select(F.col("u").alias("v")).distinct(), "v", "left_semi").limit(1).count()
        many = 0 if deep else e.groupBy("u").agg(F.min("v").alias("lo"), F.max("v").alias("hi")).where("lo <> hi").limit(1).count()
        if not deep and not many:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        e = _with_least(both, True).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Each larger neighbour of a node hangs on the smallest one; the node does too.
        e = _with_least(e, False).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        e = settled(e.where("u <> v").mapInArrow(_contract, f"u {kind}, v {kind}"), folder, EDGES)
    # Every node but the roots hangs on its root; a node with nothing but loops is its own.
    both = e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")))
    found = scratch(both.unionByName(loops.select("node", F.col("node").alias("root"))).groupBy("node").agg(F.min("root").alias("root")), EDGES)
    remove_folder(edges.sparkSession, folder)
    return found

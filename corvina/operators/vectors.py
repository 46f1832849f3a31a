"""Retrieval by inner product in double precision, as matrix products: few concepts against all vectors, many against the blocks that can matter."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..storage import scratch

#: Concepts that every task holds at most.
BLOCK = 256
#: Scores that are nearer than this may be equal once rounded.
MARGIN = 2e-6


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    length = F.sqrt(dot(a, a))
    return F.when(length > 0, F.transform(a, lambda x: x / length)).otherwise(a)


def _best_of_partition(ids: list, queries: np.ndarray, k: int):
    """Scores batches by one matrix product each and keeps, per concept, what can still be among its k best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vectors = b.column(1)
            rows = np.flatnonzero(~np.asarray(vectors.is_null()))
            flat = np.asarray(vectors.drop_null().flatten(), np.float64)
            if not len(rows):
                continue
            scores = queries @ flat.reshape(len(rows), -1).T
            if len(rows) > k:  # rounding may make equal what isn't: a margin below the k-th
                least = np.partition(scores, len(rows) - k, axis=1)[:, len(rows) - k, None] - MARGIN
                which, at = np.nonzero(scores >= least)
            else:
                which, at = np.nonzero(np.ones_like(scores, bool))
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i in which], b.schema.field(2).type), b.column(0).take(pa.array(rows[at])), pa.array(scores[which, at])],
                    ["concept", "vector", "score"]
            )

    return run


def _kinds(concepts: DataFrame, vectors: DataFrame, concept: str, vector: str) -> T.StructType:
    kinds = {f.name: f.dataType for f in (*concepts.schema, *vectors.schema)}
    return T.StructType([T.StructField("concept", kinds[concept]), T.StructField("vector", kinds[vector]), T.StructField("score", T.DoubleType())])


def _ranked(scored: DataFrame, k: int, floor: float | None, concept: str, vector: str, decimals: int) -> DataFrame:
    rounded = scored.select(F.col("concept").alias(concept), F.col("vector").alias(vector), F.round("score", decimals).alias("score"))
    ranked = rounded.withColumn("rank", F.row_number().over(Window.partitionBy(concept).orderBy(F.col("score").desc(), vector)))
    best = ranked.where(F.col("rank") <= k)  # a limit per group, which Spark applies before the shuffle too
    return best if floor is None else best.where(F.col("score") >= floor)


def top_k(concepts: DataFrame, vectors: DataFrame, k: int = 20, floor: float | None = None, concept: str = "concept_id", vector: str = "vec_id",
    decimals: int = 6) -> DataFrame:
    """(concept, vector, score, rank): the k best vectors of each concept, then those from the floor on.

    Up to BLOCK concepts are held by every task, and one pass over all vectors is
    one matrix product per batch. More of them are searched for by blocks of
    vectors, see Search. Both are exact. Vectors without an embedding score
    nothing; all have one length. Scores are rounded to decimals, ties go to the
    smaller id.
    """
    if concepts.limit(BLOCK + 1).count() > BLOCK:
        return Search(concepts, vectors, k, floor, concept, vector, decimals).best()
    schema = _kinds(concepts, vectors, concept, vector)
    plain = vectors.select(F.col(vector), F.col("embedding").cast("array<double>").alias("e"), F.lit(None).cast(schema["concept"].dataType).alias("like"))
    few = concepts.where("embedding IS NOT NULL").select(concept, "embedding").collect()
    if not few:
        return _ranked(concepts.sparkSession.createDataFrame([], schema), k, floor, concept, vector, decimals)
    best = plain.mapInArrow(_best_of_partition([r[0] for r in few], np.array([r[1] for r in few], float), k), schema)
    return _ranked(best, k, floor, concept, vector, decimals)


#: Pivots at most, all of which every task holds; vectors and concepts that a task compares with one another.
PIVOTS, VECTORS_EACH, CONCEPTS_EACH = 1024, 8192, 4096


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


class Search:
    """Exact search by blocks of vectors around pivots, the most promising first.

    Every vector goes to its nearest pivot; a block's radius is how far its
    farthest vector is from the pivot. A concept q scores at most q.p + |q| r
    in the block of pivot p and radius r. It first looks at the blocks of the
    largest bounds, until they have k vectors; the k-th score there is a floor
    that blocks of smaller bounds can't reach. Those are skipped, all others are
    scored. Blocks of many vectors, and concepts that meet in one block, are
    dealt into parts.
    """

    def __init__(self, concepts: DataFrame, vectors: DataFrame, k: int, floor: float | None = None, concept: str = "concept_id", vector: str = "vec_id", decimals: int = 6):
        self.k, self.floor, self.concept, self.vector, self.decimals = k, floor, concept, vector, decimals
        self.schema = _kinds(concepts, vectors, concept, vector)
        self.concepts = concepts.where("embedding IS NOT NULL").select(F.col(concept).alias("concept"), F.col("embedding").cast("array<double>").alias("e"))
        plain = vectors.where("embedding IS NOT NULL").select(F.col(vector).alias("vector"), F.col("embedding").cast("array<double>").alias("e"))
        self.n = plain.count()
        # Pivots are vectors by the order of a hash, about as many as the root of all; a bounded number is collected.
        chosen = plain.orderBy(F.xxhash64("vector"), "vector").limit(min(PIVOTS, max(1, round(self.n**0.5)))).collect()
        self.pivots = np.array([r.e for r in chosen], float)
        self.dealt = scratch(self._dealt(plain)) if self.n else None

    def _dealt(self, plain: DataFrame) -> DataFrame:
        pivots = self.pivots
        half = (pivots**2).sum(1) / 2

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                m = _matrix(b.column(1))
                if not len(m):
                    continue
                block = (m @ pivots.T - half).argmax(axis=1)
                off = np.sqrt(((m - pivots[block]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(block.astype(np.int32)), pa.array(off)], ["vector", "e", "block", "off"])

        return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField("block", T.IntegerType()), T.StructField("off", T.DoubleType())]))

    def _wanted(self, told: DataFrame, radius: np.ndarray, count: np.ndarray) -> DataFrame:
        """(concept, e, block) that are to be compared: of told(concept, e, least) the first blocks where least is null, else the others that can reach it."""
        pivots, k, floor = self.pivots, self.k, self.floor

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo in range(0, b.num_rows, 256):
                    part = b.slice(lo, 256)
                    q = _matrix(part.column(1))
                    long = np.linalg.norm(q, axis=1)[:, None]
                    bound = q @ pivots.T + long * radius + 1e-9 * (1 + long)
                    order = np.argsort(-bound, axis=1, kind="stable")
                    before = np.cumsum(count[order], axis=1) - count[order]
                    first = np.empty_like(order, bool)
                    np.put_along_axis(first, order, before < k, axis=1)
                    least = np.asarray(part.column(2).to_numpy(zero_copy_only=False), float)[:, None]
                    keep = np.where(np.isnan(least), first, ~first & (bound >= least - MARGIN)) & (count > 0)
                    if floor is not None:
                        keep &= bound >= floor - MARGIN
                    which, block = np.nonzero(keep)
                    at = pa.array(which)
                    yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(block.astype(np.int32))], ["concept", "e", "block"])

        return told.mapInArrow(run, T.StructType([*told.schema.fields[:2], T.StructField("block", T.IntegerType())]))

    def _scored(self, wanted: DataFrame, count: np.ndarray) -> DataFrame:
        """The k best vectors of each concept and part of a block."""
        spark, k = wanted.sparkSession, self.k
        meet = {r.block: r["count"] for r in wanted.groupBy("block").count().collect()}  # a row for each pivot at most
        tiles = [(int(b), -(-int(count[b]) // VECTORS_EACH), -(-n // CONCEPTS_EACH)) for b, n in meet.items()]
        tiled = F.broadcast(spark.createDataFrame(tiles, "block int, n_v int, n_c int"))
        whole = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        c = wanted.join(tiled, "block").withColumn("part_c", F.pmod(F.xxhash64("concept"), F.col("n_c")).cast("int")).withColumn("part_v", whole("n_v"))
        v = self.dealt.join(tiled, "block").withColumn("part_v", F.pmod(F.xxhash64("vector"), F.col("n_v")).cast("int")).withColumn("part_c", whole("n_c"))

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            m, ids = _matrix(right["e"].combine_chunks()), right["vector"].combine_chunks()
            out = []
            for lo in range(0, len(left) if len(m) else 0, 256):
                part = left.slice(lo, 256).combine_chunks()
                s = _matrix(part["e"].combine_chunks()) @ m.T
                least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k, None] - MARGIN if s.shape[1] > k else -np.inf
                which, at = np.nonzero(s >= least)
                out.append(pa.table([part["concept"].take(pa.array(which)), ids.take(pa.array(at)), pa.array(s[which, at])], names=["concept", "vector", "score"]))
            return pa.concat_tables(out) if out else pa.table([left["concept"].slice(0, 0), ids.slice(0, 0), pa.array([], pa.float64())], names=["concept", "vector", "score"])

        by = ["block", "part_v", "part_c"]
        return c.select("concept", "e", *by).groupBy(*by).cogroup(v.select("vector", "e", *by).groupBy(*by)).applyInArrow(run, self.schema)

    def _run(self) -> tuple[DataFrame, DataFrame]:
        told = self.dealt.groupBy("block").agg(F.max("off").alias("r"), F.count("*").alias("n")).collect()  # a row for each pivot at most
        radius, count = np.zeros(len(self.pivots)), np.zeros(len(self.pivots), np.int64)
        for r in told:
            radius[r.block], count[r.block] = r.r, r.n
        first = scratch(self._wanted(self.concepts.withColumn("least", F.lit(None).cast("double")), radius, count))
        window = Window.partitionBy("concept").orderBy(F.col("score").desc())
        some = scratch(self._scored(first, count).withColumn("_n", F.rank().over(window)).where(F.col("_n") <= self.k).drop("_n"))
        kth = some.groupBy("concept").agg(F.when(F.count("*") >= self.k, F.min("score")).otherwise(F.lit(float("-inf"))).alias("least"))
        none = F.coalesce("least", F.lit(float("-inf")))
        second = scratch(self._wanted(self.concepts.join(kth, "concept", "left").select("concept", "e", none.alias("least")), radius, count))
        sizes = F.broadcast(self.concepts.sparkSession.createDataFrame([(b, int(n)) for b, n in enumerate(count)], "block int, n bigint"))
        work = first.unionByName(second).select("concept", "block").join(sizes, "block").groupBy("concept").agg(F.sum("n").alias("scored"))
        return some.unionByName(self._scored(second, count)), work

    def best(self) -> DataFrame:
        """(concept, vector, score, rank) of the k best from the floor on."""
        found = self._run()[0] if self.n else self.concepts.sparkSession.createDataFrame([], self.schema)
        return _ranked(found, self.k, self.floor, self.concept, self.vector, self.decimals)

    def best_and_work(self) -> tuple[DataFrame, DataFrame]:
        """The same, and (concept, scored, n_vectors): how many vectors each concept was compared with, of how many."""
        found, work = self._run()
        best = _ranked(found, self.k, self.floor, self.concept, self.vector, self.decimals)
        return best, work.select(F.col("concept").alias(self.concept), "scored", F.lit(self.n).alias("n_vectors"))


def centroids(vectors: DataFrame, label: str = "label") -> DataFrame:
    """(label, embedding): normalised means, by one aggregation over positions."""
    at = vectors.select(label, F.posexplode("embedding").alias("i", "x")).groupBy(label, "i").agg(F.avg("x").alias("x"))
    mean = at.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("m"))
    return mean.select(label, norm(F.col("m")).alias("embedding"))

"""Shards by proportional stratified interleaving.

Rows are shuffled by a seeded hash and ranked within their source; sorted by
fractional rank, every stretch of the sequence holds the sources in their
proportions, and equal cuts of it are the shards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import extra_columns, quoted, scratch

#: Rows that are ranked in one task, about; more rows mean more buckets.
BUCKET_ROWS = 20_000


def _ranked(df: DataFrame, key: str | None, bucket: Column, order: list[str], rank: str) -> DataFrame:
    """df with the 0-based rank of each row within key, by bucket and then order.

    Only a bucket's rows meet in a task. The rows before a bucket are known from
    the counts of the buckets, which are few.
    """
    keys = [key] if key else []
    df = df.withColumn("_cv_b", bucket)
    counts = df.groupBy(*keys, "_cv_b").agg(F.count("*").alias("_cv_n"))
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_cv_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_cv_before", F.coalesce(F.sum("_cv_n").over(before), F.lit(0))).drop("_cv_n")
    renamed = counts.select(*[F.col(k).alias("_cv_of") for k in keys], F.col("_cv_b").alias("_cv_c"), "_cv_before")
    within = Window.partitionBy(*keys, "_cv_b").orderBy(*order)
    ranked = df.withColumn("_cv_r", F.row_number().over(within))
    on = F.col("_cv_b") == F.col("_cv_c")
    if key:
        on &= F.col(key).eqNullSafe(F.col("_cv_of"))
    return ranked.join(renamed, on).withColumn(rank, F.col("_cv_before") + F.col("_cv_r") - 1).drop("_cv_b", "_cv_c", "_cv_of", "_cv_before", "_cv_r")


def interleave(df: DataFrame, shards: int = 24, source: str = "source", doc_id: str = "doc_id", seed: int = 42) -> DataFrame:
    """df with shard (int, from 0) and slot (long, gapless from 0 within a shard).

    A row's place in its source is decided by md5 of the seed, the id and all
    columns as text, joined by |, nulls as empty; its fractional rank is (rank + 0.5) / rows of the source, and ties
    between sources go by the source's name, nulls first. Shards differ by one
    row at most, and each holds every source in its share of all rows to within
    one row. Null sources are one source; rows that are equal in all columns are
    exchangeable. An empty table gives an
    empty result. Columns shard and slot are replaced.
    """
    rest = extra_columns(df, "shard", "slot")
    told = [F.coalesce(quoted(c).cast("string"), F.lit("")) for c in (doc_id, *rest)]
    hashed = F.md5(F.concat_ws("|", F.lit(str(seed)), *told))
    rows = scratch(df.select(*[quoted(c) for c in rest], quoted(source).alias("_cv_s"), hashed.alias("_cv_h")))
    totals = rows.groupBy(F.col("_cv_s").alias("_cv_t")).agg(F.count("*").alias("_cv_total"))
    n = rows.count()
    buckets = max(64, -(-n // BUCKET_ROWS))
    part = F.pmod(F.conv(F.substring("_cv_h", 1, 7), 16, 10).cast("long") * F.lit(buckets) / F.lit(16**7), F.lit(buckets)).cast("long")
    ranked = _ranked(rows, "_cv_s", part, ["_cv_h"], "_cv_rank")
    share = ranked.join(totals, F.col("_cv_s").eqNullSafe(F.col("_cv_t"))).withColumn("_cv_f", (F.col("_cv_rank") * 2 + 1) / (F.col("_cv_total") * 2))
    share = share.drop("_cv_t", "_cv_total")
    placed = _ranked(share, None, F.floor(F.col("_cv_f") * buckets).cast("long"), ["_cv_f", "_cv_s", "_cv_rank"], "_cv_at")
    # The first place of a shard is the least that falls into it; integers, so that no rounding can move a cut.
    shard = F.expr(f"(_cv_at * {shards}L) div {max(n, 1)}L")
    first = F.expr(f"((_cv_at * {shards}L) div {max(n, 1)}L * {max(n, 1)}L + {shards - 1}L) div {shards}L")
    return placed.select(*[quoted(c) for c in rest], shard.cast("int").alias("shard"), (F.col("_cv_at") - first).alias("slot"))


def write_shards(df: DataFrame, path: str, shards: int = 24, **how) -> None:
    """The rows of df in one folder per shard, in files of about BUCKET_ROWS rows in the order of their slots, names included.

    Nulls, ties, repeated rows and clashing names are as in interleave(); an empty table writes a folder without shards.
    """
    placed = interleave(df, shards, **how).withColumn("_cv_part", F.floor(F.col("slot") / BUCKET_ROWS))
    files = max(1, -(-placed.count() // BUCKET_ROWS) + shards)
    dealt = placed.repartitionByRange(files, "shard", "_cv_part").sortWithinPartitions("shard", "slot").drop("_cv_part")
    dealt.write.partitionBy("shard").parquet(path)

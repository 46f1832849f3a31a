"""Global positions without a single task: counts per range, then ranks within ranges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import scratch

#: Rows of a range, about, and ranges at most.
RANGE_ROWS, RANGES = 10_000, 4096


def ordinals(df: DataFrame, order: str, name: str) -> DataFrame:
    """df with the 0-based position of each row in the order of a numeric column that is a total order.

    Ranges of about as many rows each come from approximate quantiles, so that
    clustered numbers make no hot range; a position is the rows of smaller
    ranges plus the rank within the range. Null comes first. An empty table gives
    an empty result.
    """
    n = df.count()
    k = max(1, min(RANGES, n // RANGE_ROWS))
    cuts = df.approxQuantile(order, [i / k for i in range(1, k)], 1 / (4 * k)) if k > 1 else []
    bounds = np.unique(np.array(cuts, float))

    @F.pandas_udf("long")
    def range_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series(np.searchsorted(bounds, s.to_numpy(float), "right"))

    dealt = df.withColumn("_b", F.when(F.col(order).isNull(), -1).otherwise(range_of(F.coalesce(F.col(order).cast("double"), F.lit(0.0)))) if len(bounds) else F.lit(0))
    counts = dealt.groupBy("_b").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # one row for each range
    within = Window.partitionBy("_b").orderBy(order)
    ranked = dealt.withColumn("_r", F.row_number().over(within)).join(F.broadcast(counts), "_b")
    return ranked.withColumn(name, F.col("_before") + F.col("_r") - 1).drop("_b", "_r", "_before")


def positions(df: DataFrame, name: str, *order: str) -> DataFrame:
    """df with the 0-based position of each row in the order of some columns, which should be a total one; nulls come first.

    The rows are sorted in ranges, written once, and numbered by the counts of
    the ranges before theirs: no task sees more than a range, and only a count
    for each range goes to all of them.
    """
    ranged = scratch(df.repartitionByRange(*order).sortWithinPartitions(*order)).withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftright("_id", 33)
    counts = ranged.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = ranged.join(F.broadcast(counts), part == F.col("_p"))
    return placed.withColumn(name, F.col("_before") + F.col("_id") - F.shiftleft("_p", 33)).drop("_id", "_p", "_before")


def evenly_spaced(df: DataFrame, n: int, *order: str) -> DataFrame:
    """n rows of df, evenly spaced in the order of some columns, the first and the last among them; all of a table of no more."""
    total = df.count()
    if total <= n:
        return df
    places = np.unique(np.linspace(0, total - 1, n).astype(np.int64)) if n else np.array([], np.int64)
    wanted = df.sparkSession.createDataFrame([(int(p),) for p in places], "_at bigint")  # as many rows as are asked for
    return positions(df, "_at", *order).join(F.broadcast(wanted), "_at").drop("_at")

"""The folder that all executors share, and tables that are written to it in between."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a big table that a task sorts or tells apart, about; rows of a broadcast side, such of one number each, and parts that a key is dealt into.
TASK_ROWS, BROADCAST_ROWS, BROADCAST_KEYS, SALT = 500_000, 50_000, 400_000, 32


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir; on one machine without one, a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="corvina-")
    return base.rstrip("/")


def scratch(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df written to the shared checkpoint folder and read from there; a lost executor costs nothing that was written before.

    With rows, it is read by as many tasks as its count needs at that many rows
    each, and not by one for each partition that wrote it: otherwise a small
    table would leave a file per pair of partitions in every later shuffle.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    out = df.checkpoint(eager=True)
    if rows is None:
        return out
    return out.coalesce(max(spark.sparkContext.defaultParallelism, -(-out.count() // rows)))


def spread(df: DataFrame, rows: int) -> DataFrame:
    """df dealt over as many tasks as its count needs at that many rows each.

    Short rows lie in a file or two, which would be as many tasks, however much
    is then made of each row.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows)))


def tasks_for(*tables: DataFrame) -> int:
    """As many tasks as the largest of the tables needs at TASK_ROWS each; they are counted, so they are tables as they are stored."""
    return max(tables[0].sparkSession.sparkContext.defaultParallelism, *(-(-t.count() // TASK_ROWS) for t in tables))


def dealt_join(big: DataFrame, small: DataFrame, left: str, right: str, tasks: int, how: str = "inner", rows: int | None = None) -> DataFrame:
    """big joined with small on left = right; a task sorts its share of tasks of either side, however large they are.

    By itself Spark puts as many rows into a task as 64 MB hold when they are
    compressed, which may be millions. small goes to all tasks instead if its
    rows, as counted, are few.
    """
    on = F.col(left) == F.col(right)
    if rows is not None and rows <= (BROADCAST_KEYS if len(small.columns) == 1 else BROADCAST_ROWS):
        return big.join(F.broadcast(small), on, how)
    return big.repartition(tasks, left).join(small.repartition(tasks, right), on, how)


def looked_up(big: DataFrame, small: DataFrame, key: str, by: str) -> DataFrame:
    """big joined with small on key, whatever share of big one key holds; small, of short rows, is counted, so it is a table as it is stored.

    If its rows are few, small goes to all tasks; else the rows of a key are dealt
    into SALT parts by the hash of the column by, and small is repeated for each.
    """
    if small.count() <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), key)
    parts = small.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALT - 1).cast("bigint"))))
    return big.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(SALT))).join(parts, [key, "_part"]).drop("_part")


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder or file by Spark's own file systems; one that isn't there is no error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

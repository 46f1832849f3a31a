"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The ASCII white space that separates words, as in [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df written to the shared checkpoint folder and read from there.

    With rows, it is read by as many tasks as its count needs at that many rows
    each, and not by one for each partition that wrote it: otherwise a small
    table would leave a file per pair of partitions in every later shuffle.

    The folder is the one that the session names in spark.checkpoint.dir; a
    session without one gets a temporary folder if it runs on one machine, else
    an error. A lost executor costs nothing that was written before.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        named, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
        if named is None and (not master.startswith("local") or master.startswith("local-cluster")):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        spark.sparkContext.setCheckpointDir(named or tempfile.mkdtemp(prefix="corvina-"))
    out = df.checkpoint(eager=True)
    if rows is None:
        return out
    return out.coalesce(max(spark.sparkContext.defaultParallelism, -(-out.count() // rows)))


def shared_folder(spark: SparkSession, kind: str = "warc") -> str:
    """A new folder, by URI, below the checkpoint folder that all executors share."""
    scratch(spark.range(0))  # sets the folder where a session has none
    base = spark.sparkContext.getCheckpointDir()
    if "://" not in base:
        base = "file://" + base.removeprefix("file:")
    return f"{base.rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def settled(df: DataFrame, folder: str, rows: int | None = None) -> DataFrame:
    """df written to a new place in folder as Parquet and read from there: scratch() that forgets how large its plan was thought to be.

    Spark takes a join to be as large as the product of its sides, and what
    checkpoint() gives keeps that number. From join to join it has twice as many
    digits, so in a loop of joins the number alone fills the driver's memory.
    What is read from files has the size of the files.
    """
    spark, path = df.sparkSession, f"{folder}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if rows is None:
        return out
    return out.coalesce(max(spark.sparkContext.defaultParallelism, -(-out.count() // rows)))


def extra_columns(df: DataFrame, *made: str) -> list[str]:
    """Columns of df that an operator passes on: all but those that it makes itself."""
    own = {m.lower() for m in made}
    return [c for c in df.columns if c.lower() not in own]


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def with_made(df: DataFrame, **made: Column) -> DataFrame:
    """df with the columns made, which replace columns of the same name."""
    return df.select(*[quoted(c) for c in extra_columns(df, *made)], *[v.alias(k) for k, v in made.items()])


def word_array(text: Column) -> Column:
    """The words [^\\x20\\x09-\\x0D]+ of a text, in order."""
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def without(text: Column, characters: str) -> Column:
    """A text without some characters; replacing bytes is far cheaper than translate()."""
    for c in characters:
        text = F.replace(text, F.lit(c))
    return text


def n_word_chars(text: Column) -> Column:
    return F.length(without(text, SPACES)).cast("long")


def content_key(text: Column) -> Column:
    """128 bits of a text's content as a struct of two longs; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(whole).alias("k1"), F.xxhash64(F.lit(1), whole, F.lit(7)).alias("k2"))


#: Rows that a broadcast side has at most, rows of one number each, and parts that a hot key is dealt into beyond that.
BROADCAST_ROWS, BROADCAST_KEYS, SALT = 50_000, 400_000, 32


def met(big: DataFrame, small: DataFrame, keys: list[str], spread: str, how: str = "inner", weight: int | None = None) -> DataFrame:
    """big joined with small on keys, whatever share of big one key holds.

    small, of short rows, is counted, unless its weight in such rows is known. Up
    to BROADCAST_ROWS it goes to all tasks; else big's rows are dealt into SALT
    parts by the hash of the column spread, and small is repeated for each part.
    """
    if (small.count() if weight is None else weight) <= BROADCAST_ROWS:
        return big.join(F.broadcast(small), keys, how)
    dealt = big.withColumn("_s", F.pmod(F.xxhash64(spread), F.lit(SALT)))
    parts = small.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALT - 1).cast("bigint"))))
    return dealt.join(parts, [*keys, "_s"], how).drop("_s")


def met_where_hot(big: DataFrame, small: DataFrame, keys: list[str], spread: str, hot: Column, how: str = "inner") -> DataFrame:
    """big joined with small on keys; the rows of small where hot holds, of keys that many rows of big may have, by met()."""
    few = small.where(hot)
    n = few.count()
    if not n:
        return big.join(small, keys, how)
    told = met(big, few.withColumn("_hot", F.lit(True)), keys, spread, "left", weight=n)
    rest = told.where("_hot IS NULL").select(*big.columns).join(small.where(~hot), keys, how)
    return told.where("_hot").drop("_hot").unionByName(rest)

"""Incremental ingestion: new files of a folder, each id once, and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: How long an id is remembered after it was seen.
REMEMBERED = "30 days"


def unseen(stream: DataFrame, *key: str, time: str | None = None, remembered: str = REMEMBERED) -> DataFrame:
    """Rows of a stream whose key wasn't seen before, by keyed state that forgets.

    With time, an event time, a key is remembered until the newest event is that
    much later than the key's; rows that come later still are left out, as
    nobody can tell then whether they were seen. Without it a key is remembered
    that long after it arrived. Of rows of one key one stays, of the first batch
    that has any; rows of one batch should differ in nothing but the key's copies.
    """
    if time is None:
        timed = stream.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", remembered)
        return timed.dropDuplicatesWithinWatermark(list(key)).drop("_arrived")
    return stream.withWatermark(time, remembered).dropDuplicatesWithinWatermark(list(key))


def ingest_unseen(source: DataFrame, sink: str, checkpoint: str, *key: str, time: str | None = None, remembered: str = REMEMBERED) -> StreamingQuery:
    """Appends the unseen rows of a stream to a parquet sink.

    What was seen is state beside the checkpoint, dealt by key, and not read from
    the sink; the sink's own log lets a batch that is repeated add nothing.
    """
    rows = unseen(source, *key, time=time, remembered=remembered)
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start(sink)


def ingest_new(source: DataFrame, sink: str, checkpoint: str, key: str) -> StreamingQuery:
    """Appends the rows of a stream to a parquet sink, but for keys that it has already, however old. A batch that is repeated adds nothing.

    Of rows of one key in a batch the first in the order of all columns stays.
    Where ids come again within a known time, ingest_unseen() spares reading the
    sink. Of the sink only the key column is read, and of that only where a row group
    may hold a key between the batch's smallest and largest.
    """

    def write(batch: DataFrame, _: int) -> None:
        fresh = batch.dropDuplicates([key]) if batch.columns == [key] else _first(batch, key)
        try:
            seen = batch.sparkSession.read.parquet(sink).select(key)
        except Exception as e:  # the sink is not there yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        else:
            least, most = batch.agg(F.min(key), F.max(key)).first()
            fresh = fresh.join(seen.where(F.col(key).between(F.lit(least), F.lit(most))), key, "left_anti")
        fresh.write.mode("append").parquet(sink)

    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _first(batch: DataFrame, key: str) -> DataFrame:
    rest = [c for c in batch.columns if c != key]
    return batch.groupBy(key).agg(F.min(F.struct(*rest)).alias("_r")).select(key, "_r.*").select(*batch.columns)


def file_stream(spark: SparkSession, folder: str, like: DataFrame, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def windowed_counts(stream: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    """Counts per window and keys; rows later than late behind the newest are left out once their window is closed."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n"))


def new_only(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not done yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")

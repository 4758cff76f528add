"""Incremental runs: new files are picked up once, duplicates dropped, results appended; a rerun adds nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quillstone.operators.promote import first_of


def file_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def append_new(spark: SparkSession, key: str, order: list[str], target: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that appends the first row of each key that the target does not hold yet.

    A batch that is run again after a failure finds its keys in the target and adds nothing.
    """

    def write(batch: DataFrame, _: int) -> None:
        fresh = first_of(batch, [key], order)
        try:
            held = spark.read.parquet(target).select(key)
            fresh = fresh.join(held, key, "left_anti")
        except Exception as e:  # noqa: BLE001 - the target is not there before the first batch
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
        fresh.write.mode("append").parquet(target)

    return write


def run_available(stream: DataFrame, writer: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Processes all files that are there and stops; progress is kept in the checkpoint folder."""
    stream.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def events_per_window(events: DataFrame, window: str = "1 day", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total) of a stream or a table of events; on a stream, later than `late` is dropped."""
    from pyspark.sql import functions as F

    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    grouped = timed.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return grouped.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")

"""Log folders as streams: new files, work on new keys, and windows of event time. Reductions of logs are in `keyed`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.sources.records import path_exists

from . import keyed


def stream_log(spark: SparkSession, folder: str, schema: str, files_a_batch: int = 100) -> DataFrame:
    """New files of a log folder; malformed lines are left out, as writers may be at work."""
    return spark.readStream.schema(schema).option("mode", "DROPMALFORMED").option("maxFilesPerTrigger", files_a_batch).json(folder)


def process_new(stream: DataFrame, done_path: str, key: str, work: Callable[[DataFrame], None]):
    """Works on keys not processed before and then marks them, so a run can be resumed.

    Keys of the run itself are keyed state; those that other runs marked are read once, when the state begins.
    """
    spark = stream.sparkSession
    done = spark.read.parquet(done_path).select(key) if path_exists(spark, f"{done_path}/batch=*") else None

    def run(batch: DataFrame, number: int) -> None:
        fresh = batch.persist()
        work(fresh)
        fresh.select(key).write.mode("overwrite").parquet(f"{done_path}/batch={number}")
        fresh.unpersist()

    return keyed.new_keys(stream, key, done).writeStream.outputMode("update").foreachBatch(run)


def event_windows(events: DataFrame, *, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Counts and sums of events by type and window of event time, with a watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))

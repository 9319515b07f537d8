"""The attempt log as a stream: first sight of each URL, counts by time, and resumable commits.

State is bounded by the watermark: a URL is remembered for as long as late copies of it may come.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from siltstone.functions.scalars import is_blank
from siltstone.sources.tables import ATTEMPTS


def read_attempts(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """JSON lines that appear below ``path``, with ``event_time`` from their ``ts``."""
    raw = spark.readStream.schema(ATTEMPTS).option("maxFilesPerTrigger", files_per_batch).json(path)
    return raw.withColumn("event_time", F.to_timestamp(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ssX"))


def first_seen(attempts: DataFrame, group: str = "species", late: str = "1 hour") -> DataFrame:
    """The first attempt of each URL of a group."""
    known = attempts.where(~is_blank(F.col("url")) & F.col("event_time").isNotNull())
    return known.withWatermark("event_time", late).dropDuplicatesWithinWatermark([group, "url"])


def status_by_window(attempts: DataFrame, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    counted = attempts.withWatermark("event_time", late).groupBy(F.window("event_time", width), "status").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), "status", "n")


def run(df: DataFrame, checkpoint: str, commit: Callable[[DataFrame, int], None], once: bool = True) -> StreamingQuery:
    """Each micro-batch goes to ``commit(batch, batch_id)``; a restart continues after the last committed one.

    ``commit`` may see a batch again after a crash, so it should write by ``batch_id``.
    """
    writer = df.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

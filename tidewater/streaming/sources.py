"""Streaming sources (S7-S11). File-based: the source's own log of seen
files gives exactly-once per file; Kafka is the production transport for
topics and queues (package not bundled here)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewater.streaming.message_queue import FORMAT, QueueSource


def stream_files(spark: SparkSession, path: str, schema: StructType | str | None = None,
                 glob: str | None = None, fmt: str = "json", max_files: int | None = None) -> DataFrame:
    """S7. New files under ``path`` (optionally only ``glob``) as rows.
    ``fmt="binaryFile"`` gives file events (path, size, modification time)."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def stream_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """S8. One JSON message per line, kept as raw text (``value``) so that a
    missing field and an explicit ``null`` stay distinguishable."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def stream_queue(spark: SparkSession, path: str, max_per_batch: int = 5) -> DataFrame:
    """S9. Queue drained in batches of at most ``max_per_batch`` messages (lines
    of the files below ``path``, in the order of file time and name)."""
    spark.dataSource.register(QueueSource)
    return spark.readStream.format(FORMAT).option("path", path).option("maxMessages", max_per_batch).load()


def stream_logs(spark: SparkSession, path: str, contains: str | None = None) -> DataFrame:
    """S10. Log tail: JSON log rows, optionally only messages containing
    ``contains`` (e.g. ``"ERROR"``)."""
    df = spark.readStream.schema("log_group string, log_stream string, timestamp bigint, message string").json(path)
    return df.filter(F.col("message").contains(contains)) if contains else df


def trigger_kwargs(trigger: str | None) -> dict:
    """T9. ``"availableNow"`` (scheduler-driven run), ``"once"``, or an
    interval such as ``"5 minutes"`` / ``"1 hour"``."""
    if trigger in (None, "availableNow"):
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}

"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import checkpoint_dir, ship_by_value

__all__ = ["stored", "shared_path", "small_batches", "table", "ship_by_value"]

BATCH_ROWS = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage: a lost executor re-reads files every executor can
    reach instead of recomputing, and the rows (with any order-dependent
    choice in them) are fixed once.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding the session's Arrow batches to ``BATCH_ROWS`` rows of whole texts (a smaller setting stays)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key, "10000")) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df

"""Keyed tables written by streams: Parquet in hash buckets of the key.

A batch of puts, updates and deletes is merged with the buckets it touches
and these alone are replaced (dynamic partition overwrite), so a batch
costs work in proportion to its buckets, and a read is a plain scan.

Replay. Replacing several partitions is not atomic, so the new buckets are
first written beside the table and marked complete under (writer, batch id);
a batch that is run again finds its mark and replaces the buckets from there
instead of merging into a half-replaced table. Without the mark the table still
is as the batch before left it. One writer at a time; batches in order.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.keyed import DELETE, OP, PUT, SEQ, UPDATE, as_changes, merge_changes

BATCH = "_batch"
BUCKETS = 64                     # of a new table; an existing one keeps its number
COUNT, BUCKET, LIVE = "_buckets", "_bucket", "_live"


MARK = f"writer string, {BATCH} long"


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """All rows below ``path`` (with the columns of all its files, or of ``schema``), or None where nothing has been written."""
    try:
        return spark.read.schema(schema).parquet(path) if schema else spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def changes(df: DataFrame, op: str = PUT, set_cols: Sequence[str] | None = None, order_col: str | None = None) -> DataFrame:
    """Tag ``df`` as change rows of one batch. ``order_col`` orders rows of the same key (else the row position)."""
    seq = F.struct((F.col(order_col) if order_col else F.monotonically_increasing_id()).alias("r"))
    out = as_changes(df, op, seq, set_cols)
    return out.drop(order_col) if order_col else out


def write_changes(ch: DataFrame, path: str, keys: Sequence[str], batch_id: int, writer: str = "", buckets: int = BUCKETS) -> None:
    """Apply all change rows of one batch to the table at ``path`` (see module notes).

    ``writer`` names who counts the batches: a stream's checkpoint.
    """
    spark, keys = ch.sparkSession, list(keys)
    table, staged, mark = (os.path.join(path, x) for x in ("table", "staged", "mark"))
    done, schema = _read(spark, mark, MARK), None
    if done is None or done.where((F.col("writer") == writer) & (F.col(BATCH) == int(batch_id))).isEmpty():
        current = _read(spark, table)
        n = buckets if current is None else current.select(COUNT).first()[0]
        ch = ch.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(int(n))).cast("int"))
        touched = sorted(r[0] for r in ch.select(BUCKET).distinct().collect())  # numbers of buckets: at most n
        if not touched:
            return
        log = ch
        if current is not None:
            old = current.where(F.col(BUCKET).isin(touched)).where(LIVE).drop(COUNT, LIVE)
            old = as_changes(old, PUT, F.lit(None).cast(ch.schema[SEQ].dataType)).withColumn(OP, F.lit("base"))
            log = old.unionByName(ch, allowMissingColumns=True)
            # what is in the table comes before every change: its sequence is NULL, and NULLs are no maximum
            log = log.withColumn(SEQ, F.struct((F.col(OP) != "base").alias("new"), F.col(SEQ).alias("seq"))).withColumn(
                OP, F.when(F.col(OP) == "base", F.lit(PUT)).otherwise(F.col(OP)))
        rows = merge_changes(log, [BUCKET, *keys]).withColumn(LIVE, F.lit(True))
        # a row that is no row in every touched bucket: one that has lost its last key is replaced too
        ends = spark.createDataFrame([(b, False) for b in touched], f"{BUCKET} int, {LIVE} boolean")
        rows = rows.unionByName(ends, allowMissingColumns=True).withColumn(COUNT, F.lit(int(n)))
        schema = rows.schema
        rows.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(COUNT, BUCKET).parquet(staged)
        (spark.createDataFrame([(writer, int(batch_id))], MARK).coalesce(1)
         .write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(mark))
    new = spark.read.schema(schema).parquet(staged) if schema else spark.read.parquet(staged)
    (new.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(COUNT, BUCKET).parquet(table))


def put(df, path, keys, batch_id, order_col=None, writer="", buckets=BUCKETS):
    write_changes(changes(df, PUT, order_col=order_col), path, keys, batch_id, writer, buckets)


def update(df, path, keys, batch_id, set_cols, order_col=None, writer="", buckets=BUCKETS):
    write_changes(changes(df, UPDATE, set_cols, order_col), path, keys, batch_id, writer, buckets)


def delete(df, path, keys, batch_id, writer="", buckets=BUCKETS):
    write_changes(changes(df, DELETE), path, keys, batch_id, writer, buckets)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Current rows of the keyed table at ``path``."""
    rows = _read(spark, os.path.join(path, "table"))
    if rows is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    return rows.where(LIVE).drop(COUNT, BUCKET, LIVE)


def get_rows(spark: SparkSession, path: str, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose keys are in the (bounded) ``keys_df``: only their buckets are read."""
    rows, keys = _read(spark, os.path.join(path, "table")), list(keys)
    if rows is None:
        raise FileNotFoundError(f"no keyed table at {path}")
    n = rows.select(COUNT).first()[0]
    asked = keys_df.select(*keys).distinct()
    wanted = [r[0] for r in asked.select(F.pmod(F.xxhash64(*keys), F.lit(int(n))).cast("int")).distinct().collect()]
    return rows.where(F.col(BUCKET).isin(wanted)).where(LIVE).drop(COUNT, BUCKET, LIVE).join(asked, keys, "left_semi")

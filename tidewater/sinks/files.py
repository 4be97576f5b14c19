"""File sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
                  dynamic: bool = True) -> None:
    """K1. Parquet; with ``partition_by`` and ``dynamic`` only the partitions
    present in ``df`` are replaced (re-running a batch is idempotent)."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
        if dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def write_json_docs(df: DataFrame, path: str, id_col: str, mode: str = "overwrite") -> None:
    """K5. One JSON document per record under ``<path>/<id_col>=<id>/``; the
    id-derived folder makes a rewrite of the same record replace it."""
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(id_col).json(path))


def to_metrics(df: DataFrame, namespace: str, name: str, value: str | Column, ts: str,
               unit: str = "Count", dims: Mapping[str, str | Column] | None = None) -> DataFrame:
    """K7. Metric rows: namespace, metric_name, value, unit, timestamp, dimensions."""
    v = F.col(value) if isinstance(value, str) else value
    if dims:
        kv = []
        for k, c in dims.items():
            kv += [F.lit(k), (F.col(c) if isinstance(c, str) else c).cast("string")]
        dm = F.create_map(*kv)
    else:
        dm = F.create_map().cast("map<string,string>")
    return df.select(F.lit(namespace).alias("namespace"), F.lit(name).alias("metric_name"),
                     v.cast("double").alias("value"), F.lit(unit).alias("unit"),
                     F.col(ts).alias("timestamp"), dm.alias("dimensions"))


def to_log_rows(df: DataFrame, group: str, stream: str, message: str | Column, ts: str,
                source: str = "tidewater") -> DataFrame:
    """K8. Log rows: group, stream, epoch-ms timestamp and a JSON message
    ``{"timestamp": iso, "message": ..., "source": ...}``. A timestamp
    without a zone is UTC, whatever the session's zone."""
    m = F.col(message) if isinstance(message, str) else message
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        millis = F.expr(f"timestampdiff(MILLISECOND, timestamp_ntz'1970-01-01 00:00:00', `{ts}`)").cast("bigint")
    else:
        millis = F.unix_millis(F.col(ts).cast("timestamp"))
    iso = F.date_format(F.col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return df.select(F.lit(group).alias("log_group"), F.lit(stream).alias("log_stream"),
                     millis.alias("timestamp"),
                     F.to_json(F.struct(iso.alias("timestamp"), m.cast("string").alias("message"),
                                        F.lit(source).alias("source"))).alias("message"))


def write_metadata(df: DataFrame, path: str, max_rows: int = 1000) -> None:
    """K9. Small result frames (model metrics, run metadata) as JSON: one file
    up to ``max_rows`` rows, which is checked; a larger frame keeps its partitions."""
    small = df.limit(max_rows + 1).count() <= max_rows
    (df.coalesce(1) if small else df).write.mode("overwrite").json(path)

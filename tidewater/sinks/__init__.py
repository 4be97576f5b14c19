"""Batch sinks and record shaping for metric / log outputs (K1, K5, K7-K9).
Keyed writes (K2-K4) are in :mod:`tidewater.operators.keyed`; the stream
fan-out (K6) is in :mod:`tidewater.streaming.jobs`."""

from tidewater.sinks.files import to_log_rows, to_metrics, write_json_docs, write_metadata, write_parquet

__all__ = ["write_parquet", "write_json_docs", "to_metrics", "to_log_rows", "write_metadata"]

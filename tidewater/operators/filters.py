"""Filters and predicates (F1-F10). All are plain ``filter`` expressions so
Catalyst pushes them into the Parquet scan (``PushedFilters``)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import mqtt_filter
from tidewater.functions.time import as_ts, ts_type


def get_item(df: DataFrame, **key) -> DataFrame:
    """F1. Point lookup by the full key, e.g. ``get_item(t, id="u1", ts=5)``."""
    cond = None
    for k, v in key.items():
        c = F.col(k) == F.lit(v)
        cond = c if cond is None else cond & c
    return df if cond is None else df.filter(cond)


def query_key(df: DataFrame, key_col: str, value) -> DataFrame:
    """F2. All items of one partition key (prunes when the table is
    partitioned by ``key_col``)."""
    return df.filter(F.col(key_col) == F.lit(value))


def where_eq(df: DataFrame, col: str, value) -> DataFrame:
    """F3. Equality on a non-key attribute."""
    return df.filter(F.col(col) == F.lit(value))


def where_recent(df: DataFrame, ts: str, hours: float, as_of=None) -> DataFrame:
    """F4. Rows newer than ``hours`` before ``as_of`` (exclusive), not after it."""
    ref = F.current_timestamp() if as_of is None else as_ts(as_of, ts_type(df, ts))
    lo = ref - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(hours) * 3600.0))
    c = F.col(ts)
    return df.filter((c > lo) & (c <= ref))


def where_contains(df: DataFrame, col: str, s: str, ignore_case: bool = False) -> DataFrame:
    """F5. Substring test."""
    c = F.col(col)
    if ignore_case:
        return df.filter(F.lower(c).contains(s.lower()))
    return df.filter(c.contains(s))


def where_prefix(df: DataFrame, col: str, s: str, ignore_case: bool = False) -> DataFrame:
    """F5. Prefix test (pushed to Parquet as ``StringStartsWith``)."""
    c = F.col(col)
    if ignore_case:
        return df.filter(F.lower(c).startswith(s.lower()))
    return df.filter(c.startswith(s))


def where_topic(df: DataFrame, topic_col: str, pattern: str) -> DataFrame:
    """F6. MQTT-style topic filter (``sensors/#``, ``sensors/+/temp``)."""
    return df.filter(mqtt_filter(topic_col, pattern))


def tag_valid(df: DataFrame, rules: Sequence[tuple[str, Column]],
              reason_col: str = "reject_reason") -> DataFrame:
    """F7 in one pass: ``rules = [(reason, condition_that_must_hold), ...]``.

    ``reason_col`` holds the first failed rule, NULL when the row is valid.
    A rule whose condition is NULL counts as failed.
    """
    expr = None
    for reason, cond in rules:
        failed = ~F.coalesce(cond, F.lit(False))
        expr = F.when(failed, F.lit(reason)) if expr is None else expr.when(failed, F.lit(reason))
    if expr is None:
        expr = F.lit(None).cast("string")
    if reason_col in df.columns:
        expr = F.coalesce(F.col(reason_col), expr)
    return df.withColumn(reason_col, expr)


def split_valid(df: DataFrame, rules: Sequence[tuple[str, Column]],
                reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """F7. ``(good, rejected)``; ``rejected`` keeps the reason column.

    Both halves come from one tagged plan; a sink that writes both should
    persist it (``foreachBatch`` does) or write one table partitioned by
    the reason.
    """
    tagged = tag_valid(df, rules, reason_col)
    good = tagged.filter(F.col(reason_col).isNull()).drop(reason_col)
    bad = tagged.filter(F.col(reason_col).isNotNull())
    return good, bad


def isolate_errors(df: DataFrame, exprs: Mapping[str, tuple[Column, str | None]],
                   error_col: str = "error") -> DataFrame:
    """F9. Per-record failure isolation without raising.

    ``exprs = {"out": (try_expression, source_column)}``. A row whose
    source is non-NULL but whose ``try_`` result is NULL gets
    ``error = 'out: could not convert'`` (first failure wins); the job
    never stops on a bad record. Use :func:`split_errors` for two frames.
    """
    cols = {name: e for name, (e, _src) in exprs.items()}
    out = df.withColumns(cols)
    err = None
    for name, (_e, src) in exprs.items():
        if src is None:
            continue
        cond = F.when(F.col(src).isNotNull() & F.col(name).isNull(), F.lit(f"{name}: could not convert"))
        err = cond if err is None else F.coalesce(err, cond)
    if err is None:
        err = F.lit(None).cast("string")
    if error_col in out.columns:
        err = F.coalesce(F.col(error_col), err)
    return out.withColumn(error_col, err)


def split_errors(df: DataFrame, error_col: str = "error") -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(error_col).isNull()).drop(error_col), df.filter(F.col(error_col).isNotNull())


def where_tag(df: DataFrame, tags_col: str, key: str, value: str | None = None,
              key_field: str = "Key", value_field: str = "Value") -> DataFrame:
    """F8. Keep rows whose tag array holds ``key`` (= ``value`` when given)."""
    def pred(t):
        c = t[key_field] == F.lit(key)
        return c if value is None else c & (t[value_field] == F.lit(value))
    return df.filter(F.coalesce(F.exists(F.col(tags_col), pred), F.lit(False)))


def clean(df: DataFrame, drop_null: Sequence[str] = (), fill: Mapping[str, object] | None = None,
          rules: Sequence[tuple[str, Column]] = (), reason_col: str = "reject_reason"
          ) -> tuple[DataFrame, DataFrame]:
    """F10. Drop rows with NULL in ``drop_null``, fill defaults, then apply
    validation rules. Returns ``(good, rejected)``; dropped rows are part of
    ``rejected`` with reason ``null:<col>`` so nothing disappears silently."""
    null_rules = [(f"null:{c}", F.col(c).isNotNull()) for c in drop_null]
    tagged = tag_valid(df, null_rules, reason_col)
    if fill:
        filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()}
        tagged = tagged.withColumns(filled)
    tagged = tag_valid(tagged, list(rules), reason_col)
    return (tagged.filter(F.col(reason_col).isNull()).drop(reason_col),
            tagged.filter(F.col(reason_col).isNotNull()))

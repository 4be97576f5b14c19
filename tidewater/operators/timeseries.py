"""Metric statistics per period (A7), consecutive-breach alarms (W1),
z-score anomalies (M10)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions.time import as_ts, ts_type
from tidewater.session import materialised, sized_broadcast

# Statistic names and their output columns.
STATISTICS = {
    "Sum": "sum",
    "Average": "average",
    "Maximum": "maximum",
    "Minimum": "minimum",
    "SampleCount": "sample_count",
}
# Alarm states.
ALARM, OK, INSUFFICIENT_DATA = "ALARM", "OK", "INSUFFICIENT_DATA"

SLICE_PERIODS = 4096  # periods of a key that one window partition covers


def metric_statistics(df: DataFrame, ts: str, value: str, by: Sequence[str] = (),
                      period_s: int = 300, start=None, end=None,
                      dims: Mapping[str, str] | None = None, dims_col: str = "dimensions",
                      stats: Sequence[str] = tuple(STATISTICS)) -> DataFrame:
    """A7. Statistics per tumbling period; start inclusive, end exclusive;
    periods without data are absent. ``dims`` keeps rows whose dimension
    map holds every given name/value pair.

    The period is a projection (``window`` on a tumbling size), so this is
    one hash aggregate on (period, *by) with a map-side partial phase.
    """
    c = F.col(ts)
    like = ts_type(df, ts)
    if start is not None:
        df = df.filter(c >= as_ts(start, like))
    if end is not None:
        df = df.filter(c < as_ts(end, like))
    for k, v in (dims or {}).items():
        df = df.filter(F.col(dims_col)[k] == F.lit(v))
    x = F.col(value)
    agg = {"Sum": F.sum(x), "Average": F.avg(x), "Maximum": F.max(x), "Minimum": F.min(x),
           "SampleCount": F.count(x)}
    w = F.window(c, f"{int(period_s)} seconds")
    out = df.groupBy(w.start.alias("period_start"), *by).agg(
        *[agg[s].alias(STATISTICS[s]) for s in stats])
    return out


def period_index(ts: str, ts_dtype: str, period_s: int) -> Column:
    """Number of a period since the epoch; ``ts`` is a period start, in UTC where it has no zone."""
    if ts_dtype == "timestamp":
        seconds = F.unix_seconds(ts)
    else:
        days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
        seconds = days * 86_400 + F.hour(ts) * 3_600 + F.minute(ts) * 60 + F.second(ts)
    return F.floor(seconds / int(period_s))


def period_time(period: str, ts_dtype: str, period_s: int) -> Column:
    """Start of a period by its number, as ``ts_dtype``."""
    seconds = F.col(period) * int(period_s)
    if ts_dtype == "timestamp":
        return F.timestamp_seconds(seconds)
    zero = F.lit(0)
    return F.lit("1970-01-01 00:00:00").cast(ts_dtype) + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))


def breaches(v: Column, op: str, threshold: float, missing: str) -> Column:
    """W1's rule for one period: does its value (NULL: silent) breach the threshold?"""
    t = F.lit(float(threshold))
    return F.when(v.isNull(), F.lit(missing == "breach")).otherwise({">": v > t, ">=": v >= t, "<": v < t, "<=": v <= t}[op])


def alarm_state(breaching: Column, present: Column, seen: Column, periods: int) -> Column:
    """W1's rule for a frame: ``seen`` periods up to now, ``present`` of them with data, ``breaching`` of them in breach."""
    return (F.when(seen < periods, F.lit(INSUFFICIENT_DATA))
            .when(breaching == periods, F.lit(ALARM))
            .when(present < periods, F.lit(INSUFFICIENT_DATA))
            .otherwise(F.lit(OK)))


def alarm(stats: DataFrame, stat: str, op: str, threshold: float, periods: int,
          by: Sequence[str] = (), period_s: int = 300, ts_col: str = "period_start",
          missing: str = "missing", start=None, end=None, keys: DataFrame | None = None,
          slice_periods: int = SLICE_PERIODS) -> DataFrame:
    """W1. Alarm state per key and period: ALARM when the last ``periods``
    periods all breach ``stat op threshold``.

    Periods with no data are filled between each key's first and last
    period and treated per ``missing``: ``"missing"`` (not present: the
    state is INSUFFICIENT_DATA until ``periods`` present periods are in the
    frame), ``"breach"`` (counts as breaching) or ``"ok"`` (counts as not
    breaching).

    With ``start`` and ``end`` (texts or datetimes on period boundaries, end
    exclusive) every key is evaluated over that whole range: silence before
    its first and after its last period is filled too, and periods outside
    are not looked at. Keys are those of ``stats`` (at any time) and of
    ``keys``, which names keys that may have no row at all; without ``by``
    the one series is evaluated even if ``stats`` is empty.

    Time is cut into slices of ``slice_periods`` periods; (key, slice) is what
    windows and shuffles go by, so a key with millions of periods is
    worked on by many tasks. A slice takes the last ``periods - 1`` periods
    of the one before it along (its halo), and nothing else. A row travels with the
    run of silent periods after it; runs end at their slice and are
    spelled out after the shuffle only.
    """
    if missing not in ("missing", "breach", "ok"):
        raise ValueError("missing must be 'missing', 'breach' or 'ok'")
    if (start is None) != (end is None) or (keys is not None and end is None):
        raise ValueError("start and end go together, and keys need them")
    if start is not None and any(pd.Timestamp(t) != pd.Timestamp(t).floor(f"{period_s}s") for t in (start, end)):
        raise ValueError("start and end must be on period boundaries")
    col, halo, size = STATISTICS.get(stat, stat), periods - 1, max(int(slice_periods), int(periods))
    ts_dtype = dict(stats.dtypes)[ts_col]
    s = stats.select(*by, period_index(ts_col, ts_dtype, period_s).alias("_i"), F.col(col).alias("_v"))
    if start is None:
        # count(_v) >= 0 always holds: it keeps the column, so that both uses of the statistics are one shuffle
        spans = s.groupBy(*by).agg(F.min("_i").alias("_lo"), F.max("_i").alias("_hi"), F.count("_v").alias("_n")).where("_n >= 0")
    else:
        lo, hi = (int((pd.Timestamp(t) - pd.Timestamp(0)).total_seconds()) // int(period_s) for t in (start, end))
        who = s.select(*by) if keys is None else s.select(*by).unionByName(keys.select(*by))
        spans = (who.distinct() if by else s.sparkSession.range(1)).select(
            *by, F.lit(lo).cast("long").alias("_lo"), F.lit(hi - 1).cast("long").alias("_hi")).where("_lo <= _hi")
        s = s.where((F.col("_i") >= lo) & (F.col("_i") < hi))
    slice_of = lambda i: F.floor(i / size)
    # the first row of every slice says where its periods begin (with the halo) and end
    heads = spans.select(*by, "_lo", "_hi", F.explode(F.sequence(slice_of(F.col("_lo")), slice_of(F.col("_hi")))).alias("_slice")).select(
        *by, "_slice", F.greatest("_lo", F.col("_slice") * size - halo).alias("_i"), F.lit(0).alias("_row"),
        F.lit(None).cast(dict(s.dtypes)["_v"]).alias("_v"), F.least("_hi", F.col("_slice") * size + size - 1).alias("_to"))
    own = slice_of(F.col("_i"))
    slices = F.when(F.pmod("_i", F.lit(size)) >= size - halo, F.array(own, own + 1)).otherwise(F.array(own))
    rows = s.select(*by, F.explode(slices).alias("_slice"), "_i", F.lit(1).alias("_row"), "_v", F.lit(None).cast("long").alias("_to"))
    piece = Window.partitionBy(*by, "_slice")
    order = piece.orderBy("_i", "_row")
    g = heads.unionByName(rows).withColumns({
        "_stop": F.coalesce(F.lead("_i").over(order) - 1, F.first("_to").over(order.rowsBetween(Window.unboundedPreceding, 0)))})
    run = F.when(F.col("_stop") >= F.col("_i"), F.sequence("_i", "_stop"))
    g = g.select(*by, "_slice", "_i", "_v", F.explode(run).alias("_p"))
    g = g.select(*by, "_slice", "_p", F.when(F.col("_p") == F.col("_i"), F.col("_v")).alias("_v"))
    breach = breaches(F.col("_v"), op, threshold, missing)
    present = F.col("_v").isNotNull() | F.lit(missing != "missing")
    w = piece.orderBy("_p").rowsBetween(-halo, 0)
    g = g.withColumns({
        "breaching": breach,
        "_nb": F.sum(breach.cast("int")).over(w),
        "_np": F.sum(present.cast("int")).over(w),
        "_nr": F.count(F.lit(1)).over(w),
    }).where(F.col("_p") >= F.col("_slice") * size)
    return g.select(*by, period_time("_p", ts_dtype, period_s).alias(ts_col), F.col("_v").alias(col), "breaching",
                    alarm_state(F.col("_nb"), F.col("_np"), F.col("_nr"), periods).alias("state"))


def anomalies(df: DataFrame, value: str, by: Sequence[str] = (), z: float = 3.0,
              out: str = "z_score") -> DataFrame:
    """M10. Flag rows more than ``z`` sample standard deviations from their
    group mean. Group moments are a partial aggregate, written to the shared
    checkpoint folder (its true size is known then) and joined back: one row
    per group, broadcast only under the size check."""
    if by:
        moments = df.groupBy(*by).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))
        j = df.join(sized_broadcast(materialised(moments, "moments")), on=list(by), how="inner")
    else:  # global moments as scalar subqueries, no join at all
        j = df.withColumns({"_mu": df.select(F.avg(value)).scalar(),
                            "_sd": df.select(F.stddev_samp(value)).scalar()})
    zs = F.when(F.col("_sd") > 0, (F.col(value) - F.col("_mu")) / F.col("_sd"))
    return (j.withColumn(out, zs)
            .withColumn("is_anomaly", F.coalesce(F.abs(F.col(out)) > F.lit(z), F.lit(False)))
            .drop("_mu", "_sd"))

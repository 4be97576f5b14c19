import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import timeseries as TS
from conftest import rows

T0 = dt.datetime(2024, 1, 1)


def _m(spark, pts):
    return spark.createDataFrame([(T0 + dt.timedelta(seconds=s), k, v) for s, k, v in pts],
                                 "ts timestamp_ntz, k string, v double")


def test_metric_statistics_bounds_and_empty_periods(spark):
    df = _m(spark, [(0, "a", 1.0), (299, "a", 3.0), (300, "a", 10.0), (900, "a", 2.0), (1200, "a", 99.0)])
    s = TS.metric_statistics(df, "ts", "v", by=["k"], period_s=300, start=T0.isoformat(sep=" "),
                             end=(T0 + dt.timedelta(seconds=1200)).isoformat(sep=" "))
    got = rows(s, "period_start", "sum", "average", "maximum", "minimum", "sample_count")
    assert got == [(T0, 4.0, 2.0, 3.0, 1.0, 2), (T0 + dt.timedelta(seconds=300), 10.0, 10.0, 10.0, 10.0, 1),
                   (T0 + dt.timedelta(seconds=900), 2.0, 2.0, 2.0, 2.0, 1)]


def test_metric_statistics_dimensions(spark):
    df = spark.createDataFrame([(T0, 1.0, {"Queue": "q1"}), (T0, 5.0, {"Queue": "q2"})],
                               "ts timestamp_ntz, v double, dimensions map<string,string>")
    s = TS.metric_statistics(df, "ts", "v", dims={"Queue": "q2"})
    assert rows(s, "sum") == [(5.0,)]


def test_alarm_consecutive_and_missing(spark):
    # periods: 0 breach, 1 breach, 2 silent, 3 breach, 4 ok
    df = _m(spark, [(0, "a", 150.0), (300, "a", 120.0), (900, "a", 200.0), (1200, "a", 1.0)])
    s = TS.metric_statistics(df, "ts", "v", by=["k"], period_s=300, stats=["Average"])
    states = [r.state for r in TS.alarm(s, "Average", ">", 100, 2, by=["k"]).orderBy("period_start").collect()]
    assert states == ["INSUFFICIENT_DATA", "ALARM", "INSUFFICIENT_DATA", "INSUFFICIENT_DATA", "OK"]
    br = [r.state for r in TS.alarm(s, "Average", ">", 100, 2, by=["k"], missing="breach").orderBy("period_start").collect()]
    assert br == ["INSUFFICIENT_DATA", "ALARM", "ALARM", "ALARM", "OK"]
    ok = [r.state for r in TS.alarm(s, "Average", ">", 100, 2, by=["k"], missing="ok").orderBy("period_start").collect()]
    assert ok == ["INSUFFICIENT_DATA", "ALARM", "OK", "OK", "OK"]


def test_alarm_less_than_on_sum(spark):
    df = _m(spark, [(0, "a", 0.0), (300, "a", 0.5), (600, "a", 3.0)])
    s = TS.metric_statistics(df, "ts", "v", by=["k"], stats=["Sum"])
    got = [r.state for r in TS.alarm(s, "Sum", "<", 1, 2, by=["k"]).orderBy("period_start").collect()]
    assert got == ["INSUFFICIENT_DATA", "ALARM", "OK"]


def test_alarm_range_fills_silence(spark):
    at = lambda s: (T0 + dt.timedelta(seconds=s)).isoformat(sep=" ")
    # a: one row, then silent; b: rows only after the range; c: named, without rows
    df = _m(spark, [(300, "a", 5.0), (3600, "b", 5.0)])
    s = TS.metric_statistics(df, "ts", "v", by=["k"], stats=["Sum"])
    out = TS.alarm(s, "Sum", "<", 1, 2, by=["k"], missing="breach", start=at(-300), end=at(1200),
                   keys=spark.createDataFrame([("c",), ("a",)], "k string"))
    got = {k: [r.state for r in out.where(f"k = '{k}'").orderBy("period_start").collect()] for k in "abc"}
    assert got["a"] == ["INSUFFICIENT_DATA", "ALARM", "OK", "OK", "ALARM"]
    assert got["b"] == got["c"] == ["INSUFFICIENT_DATA"] + ["ALARM"] * 4
    none = TS.metric_statistics(df.where("false"), "ts", "v", stats=["Sum"])
    one = TS.alarm(none, "Sum", "<", 1, 2, missing="breach", start=at(0), end=at(900))
    assert [r.state for r in one.orderBy("period_start").collect()] == ["INSUFFICIENT_DATA", "ALARM", "ALARM"]
    with pytest.raises(ValueError):
        TS.alarm(s, "Sum", "<", 1, 2, by=["k"], start=at(10), end=at(900))


def test_anomalies_do_not_shuffle_events(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    df = spark.range(200_000).selectExpr("id % 5 AS k", "cast(id as double) AS v")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")  # below the estimate of an unwritten aggregate
        plan = TS.anomalies(df, "v", by=["k"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = TS.anomalies(df, "v", by=["k"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_anomalies(spark):
    vals = [(float(x),) for x in [10, 11, 9, 10, 10, 11, 9, 10, 10, 100]]
    df = spark.createDataFrame(vals, "v double")
    a = TS.anomalies(df, "v", z=2.5)
    assert rows(a.filter("is_anomaly"), "v") == [(100.0,)]


def _brute_alarm(points, op, thr, n, missing):
    """Direct reading of the W1 rules over one key's per-period values."""
    if not points:
        return []
    lo, hi = min(points), max(points)
    out, hist = [], []
    for p in range(lo, hi + 1):
        v = points.get(p)
        hist.append(v)
        w = hist[-n:]
        br = [(missing == "breach") if x is None else (x > thr if op == ">" else x < thr) for x in w]
        pres = [x is not None or missing != "missing" for x in w]
        if len(w) < n:
            st = "INSUFFICIENT_DATA"
        elif all(br):
            st = "ALARM"
        elif not all(pres):
            st = "INSUFFICIENT_DATA"
        else:
            st = "OK"
        out.append((p, st))
    return out


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(st.integers(0, 30), st.floats(0, 200, allow_nan=False), min_size=1, max_size=20),
       st.sampled_from([">", "<"]), st.integers(1, 3), st.sampled_from(["missing", "breach", "ok"]), st.sampled_from([1, 3, 7, 4096]))
def test_alarm_matches_brute_force(spark, points, op, n, missing, size):
    rows_ = [(T0 + dt.timedelta(seconds=300 * p), "k", v) for p, v in points.items()]
    df = spark.createDataFrame(rows_, "ts timestamp_ntz, k string, v double")
    s = TS.metric_statistics(df, "ts", "v", by=["k"], stats=["Maximum"])
    got = [(int((r.period_start - T0).total_seconds() // 300), r.state)
           for r in TS.alarm(s, "Maximum", op, 100.0, n, by=["k"], missing=missing, slice_periods=size).orderBy("period_start").collect()]
    assert got == _brute_alarm(points, op, 100.0, n, missing)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3600), st.sampled_from(["x", "y"]), st.integers(-50, 50)),
                min_size=1, max_size=40),
       st.integers(0, 1800), st.integers(1800, 3601))
def test_metric_statistics_matches_python(spark, pts, start, end):
    df = spark.createDataFrame([(T0 + dt.timedelta(seconds=s), k, float(v)) for s, k, v in pts],
                               "ts timestamp_ntz, k string, v double")
    out = TS.metric_statistics(df, "ts", "v", by=["k"], period_s=300,
                               start=(T0 + dt.timedelta(seconds=start)).isoformat(sep=" "),
                               end=(T0 + dt.timedelta(seconds=end)).isoformat(sep=" "))
    got = sorted((int((r.period_start - T0).total_seconds()), r.k, r.sum, r.maximum, r.minimum, r.sample_count)
                 for r in out.collect())
    groups = {}
    for s, k, v in pts:
        if start <= s < end:
            groups.setdefault((s // 300 * 300, k), []).append(float(v))
    want = sorted((p, k, sum(vs), max(vs), min(vs), len(vs)) for (p, k), vs in groups.items())
    assert got == want


def test_alarm_of_one_long_key_uses_many_tasks(spark):
    """One key, two rows a million periods apart: the silence between them is worked on in slices."""
    df = _m(spark, [(-300 * 500, "a", 150.0), (300 * 999_500, "a", 150.0)])
    s = TS.metric_statistics(df, "ts", "v", by=["k"], stats=["Average"])
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        out = TS.alarm(s, "Average", ">", 100, 3, by=["k"], missing="breach")
        got = out.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("state") == "ALARM").cast("int")).alias("a")).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(r.n for r in got) == 1_000_001 and sum(r.a for r in got) == 999_999
    assert len(got) == 16 and max(r.n for r in got) < 150_000


def test_alarm_periods_with_and_without_zone(spark):
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.sql(f"SELECT k, cast(t AS {kind}) AS ts, v FROM VALUES ('a', '1969-12-31 23:50:00', 5.0D), (NULL, '2024-03-31 02:30:00', 5.0D),"
                       " ('a', '1970-01-01 00:05:00', 5.0D) AS x(k, t, v)")
        s = TS.metric_statistics(df, "ts", "v", by=["k"], stats=["Sum"])
        out = TS.alarm(s, "Sum", ">", 1, 1, by=["k"], slice_periods=2)
        assert dict(out.dtypes)["period_start"] == kind
        assert [(r.k, str(r.period_start), r.state) for r in out.orderBy("k", "period_start").collect()] == [
            (None, "2024-03-31 02:30:00", "ALARM"), ("a", "1969-12-31 23:50:00", "ALARM"), ("a", "1969-12-31 23:55:00", "INSUFFICIENT_DATA"),
            ("a", "1970-01-01 00:00:00", "INSUFFICIENT_DATA"), ("a", "1970-01-01 00:05:00", "ALARM")]

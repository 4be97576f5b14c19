import datetime as dt

from pyspark.sql import functions as F

from tidewater.operators import filters as FL
from conftest import rows


def test_get_item_query_key_pushdown(spark, tmp):
    df = spark.createDataFrame([("u1", 1, "a"), ("u1", 2, "b"), ("u2", 1, "c")], "id string, ts int, v string")
    df.write.parquet(tmp + "/t")
    t = spark.read.parquet(tmp + "/t")
    assert rows(FL.get_item(t, id="u1", ts=2), "v") == [("b",)]
    q = FL.query_key(t, "id", "u1")
    assert rows(q, "v") == [("a",), ("b",)]
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(id), EqualTo(id,u1)]" in plan


def test_where_recent_bounds(spark):
    base = dt.datetime(2024, 1, 30)
    df = spark.createDataFrame([(base - dt.timedelta(hours=24),), (base - dt.timedelta(hours=23),), (base,),
                                (base + dt.timedelta(seconds=1),)], "ts timestamp_ntz")
    got = rows(FL.where_recent(df, "ts", 24, as_of="2024-01-30 00:00:00"))
    assert got == [(base - dt.timedelta(hours=23),), (base,)]


def test_topic_filters(spark):
    df = spark.createDataFrame([(t,) for t in ["sensors", "sensors/t", "sensors/a/b", "sensorsX", "weather/t", None]],
                               "topic string")
    assert rows(FL.where_topic(df, "topic", "sensors/#")) == [("sensors",), ("sensors/a/b",), ("sensors/t",)]
    assert rows(FL.where_topic(df, "topic", "+/t")) == [("sensors/t",), ("weather/t",)]
    assert rows(FL.where_topic(df, "topic", "sensors/+/#")) == [("sensors/a/b",), ("sensors/t",)]
    assert len(rows(FL.where_topic(df, "topic", "#"))) == 5


def test_contains_prefix(spark):
    df = spark.createDataFrame([("Red Bolt",), ("small red",), ("blue",)], "n string")
    assert rows(FL.where_contains(df, "n", "RED", ignore_case=True)) == [("Red Bolt",), ("small red",)]
    assert rows(FL.where_contains(df, "n", "RED")) == []
    assert rows(FL.where_prefix(df, "n", "SMALL", ignore_case=True)) == [("small red",)]


def test_split_valid_reasons(spark):
    df = spark.createDataFrame([("d1", 5), (None, 5), ("d3", None)], "device string, n int")
    good, bad = FL.split_valid(df, [("missing_device", F.col("device").isNotNull()), ("no_n", F.col("n") > 0)])
    assert rows(good) == [("d1", 5)]
    assert rows(bad, "reject_reason") == [("missing_device",), ("no_n",)]


def test_isolate_errors_never_raises(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "2024-01-02"), (None, "bad")], "a string, d string")
    out = FL.isolate_errors(df, {"a_int": (F.col("a").try_cast("int"), "a"),
                                 "d_date": (F.try_to_date("d", "yyyy-MM-dd"), "d")})
    good, bad = FL.split_errors(out)
    assert rows(good, "a_int") == [(1,)]
    assert rows(bad, "error") == [("a_int: could not convert",), ("d_date: could not convert",)]


def test_where_tag_and_clean(spark):
    df = spark.createDataFrame([(1, [("env", "prod")]), (2, [("env", "dev")]), (3, None)],
                               "id int, tags array<struct<Key:string, Value:string>>")
    assert rows(FL.where_tag(df, "tags", "env", "prod"), "id") == [(1,)]
    assert rows(FL.where_tag(df, "tags", "env"), "id") == [(1,), (2,)]
    d2 = spark.createDataFrame([(1, None, 5), (None, "x", 1), (3, "y", -1)], "a int, b string, c int")
    good, bad = FL.clean(d2, drop_null=["a"], fill={"b": "?"}, rules=[("neg", F.col("c") >= 0)])
    assert rows(good) == [(1, "?", 5)]
    assert rows(bad, "reject_reason") == [("neg",), ("null:a",)]

import datetime as dt

from pyspark.sql import functions as F

from tidewater.functions import (
    base_name, elapsed_days, ends_with_any_case, format_or_raw, html_escape, is_true, parse_iso, title_from_file,
    weekday_name,
)
from tidewater.operators import filters as FL
from tidewater.operators import joins as J
from tidewater.session import cut_lineage, estimated_bytes, sized_broadcast, spread
from conftest import rows


def test_text_helpers(spark):
    df = spark.createDataFrame([("uploads/q1_sales report.PPTX", "a<b & c>d", "TRUE")], "k string, h string, t string")
    r = df.select(base_name("k").alias("b"), title_from_file("k").alias("t"), html_escape("h").alias("h"),
                  ends_with_any_case("k", ".pptx").alias("e"), is_true("t").alias("y"),
                  is_true(F.lit(None).cast("string")).alias("n")).first()
    assert (r.b, r.t, r.h, r.e, r.y, r.n) == ("q1_sales report.PPTX", "Q1 Sales Report", "a&lt;b &amp; c&gt;d",
                                             True, True, False)


def test_time_helpers(spark):
    df = spark.createDataFrame([("2024-03-05T10:15:00Z", "not a date")], "a string, b string")
    r = df.select(format_or_raw("a").alias("fa"), format_or_raw("b").alias("fb"),
                  weekday_name(parse_iso("a")).alias("en"), weekday_name(parse_iso("a"), "tr").alias("tr")).first()
    assert (r.fa, r.fb, r.en, r.tr) == ("Mar 05, 2024 10:15", "not a date", "Tuesday", "Salı")
    d = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23, 0), dt.datetime(2024, 1, 2, 1, 0)),
                               (dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 3, 0, 0))], "a timestamp, b timestamp")
    assert [r.d for r in d.select(elapsed_days("a", "b").alias("d")).collect()] == [0, 2]


def test_where_eq_attach_and_session_helpers(spark, tmp):
    ev = spark.createDataFrame([("b", "k1", "Put"), ("b", "k2", "Put")], "bucket string, key string, ev string")
    inv = spark.createDataFrame([("b", "k1", 10)], "bucket string, key string, size bigint")
    assert rows(J.attach_object_info(ev, inv), "key", "size") == [("k1", 10)]
    assert rows(FL.where_eq(ev, "key", "k2"), "key") == [("k2",)]
    small = spark.range(10)
    assert estimated_bytes(small) > 0
    # unknown size (local rows): no hint; a small Parquet side: hint
    assert "broadcast" not in ev.join(sized_broadcast(inv), ["bucket", "key"])._jdf.queryExecution() \
        .optimizedPlan().toString().lower()
    inv.write.parquet(tmp + "/inv")
    inv = spark.read.parquet(tmp + "/inv")
    plan = ev.join(sized_broadcast(inv), ["bucket", "key"])._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan.lower()
    big_plan = ev.join(sized_broadcast(inv, max_bytes=1), ["bucket", "key"])._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in big_plan.lower()
    one = spark.range(100).coalesce(1)
    assert spread(one, 8).rdd.getNumPartitions() == 8 and spread(spark.range(100).repartition(8), 8).rdd.getNumPartitions() == 8
    c = cut_lineage(spark.range(5).withColumn("x", F.col("id") * 2))
    assert c.count() == 5 and "LogicalRDD" in c._jdf.queryExecution().analyzed().toString()

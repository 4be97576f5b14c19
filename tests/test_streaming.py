import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tidewater.operators import keyed as K
from tidewater.operators import timeseries as TS
from tidewater.streaming import jobs, tables
from tidewater.streaming.alarm import late_rows, stream_alarm
from conftest import rows


def _write_lines(d, name, recs):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        for r in recs:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def _run(q, timeout=120):
    q.awaitTermination(timeout)
    assert q.exception() is None


SENSOR_1 = [
    {"topic": "sensors/temperature", "device_id": "d1", "timestamp": "2024-01-01T00:00:00Z", "temperature": 21.5, "humidity": 40},
    {"topic": "sensors/temperature", "device_id": "d1", "timestamp": "2024-01-01T00:00:00Z", "temperature": 22.0},
    {"topic": "sensors/humidity", "device_id": "d2", "timestamp": "2024-01-01T00:01:00Z", "humidity": None},
    {"topic": "weather/istanbul", "city": "İstanbul", "temperature": 9},
    {"topic": "sensors", "timestamp": "2024-01-01T00:02:00Z"},
]
SENSOR_2 = [
    {"topic": "sensors/pressure", "device_id": "d3", "timestamp": "2024-01-01T00:05:00Z", "pressure": 1013.2},
    {"topic": "sensors/temperature", "device_id": "d1", "timestamp": "2024-01-01T00:00:00Z", "temperature": 30.0},
]


def _batch_sensor(spark, src):
    r = jobs.sensor_rows(spark.read.text(src), as_of="2024-01-02 00:00:00")
    good = r.filter("reject_reason is null").drop("reject_reason")
    # stream semantics: later files / later lines win for the same key
    good = good.withColumn("_o", F.monotonically_increasing_id())
    return K.latest_by_key(good, list(jobs.SENSOR_KEYS), ["_o"]).drop("_o")


def test_sensor_ingest_stream_equals_batch_replay_restart(spark, tmp):
    src, out = os.path.join(tmp, "src"), os.path.join(tmp, "out")
    _write_lines(src, "m1.json", SENSOR_1)
    cp = os.path.join(tmp, "cp")
    _run(jobs.run_sensor_ingest(spark, src, out, cp, as_of="2024-01-02 00:00:00"))
    items = tables.read_table(spark, os.path.join(out, "items"))
    first = rows(items, "device_id", "timestamp", "topic", "temperature", "humidity", "pressure")
    assert [r[0] for r in first] == ["d1", "d2"]
    d1 = [r for r in first if r[0] == "d1"][0]
    assert float(d1[3]) == 22.0 and float(d1[4]) == 0.0  # put replaces: humidity of the 2nd message is missing -> 0
    rej = spark.read.parquet(os.path.join(out, "rejected"))
    assert rows(rej, "reject_reason") == [("missing_device_id",)]  # topic 'sensors' passes, weather is filtered out
    # replay of the same input under a fresh checkpoint: same table, no duplicates
    _run(jobs.run_sensor_ingest(spark, src, out, os.path.join(tmp, "cp2"), as_of="2024-01-02 00:00:00"))
    assert rows(tables.read_table(spark, os.path.join(out, "items")),
                "device_id", "timestamp", "topic", "temperature", "humidity", "pressure") == first
    # restart from the first checkpoint with a new file
    _write_lines(src, "m2.json", SENSOR_2)
    _run(jobs.run_sensor_ingest(spark, src, out, cp, as_of="2024-01-02 00:00:00"))
    got = tables.read_table(spark, os.path.join(out, "items"))
    want = _batch_sensor(spark, src)
    cols = ["device_id", "timestamp", "topic", "temperature", "humidity", "pressure", "processed_at"]
    assert rows(got, *cols) == rows(want, *cols)


def test_sensor_reject_explicit_null(spark, tmp):
    lines = spark.createDataFrame([(json.dumps(r),) for r in SENSOR_1], "value string")
    r = jobs.sensor_rows(lines, as_of="2024-01-02 00:00:00", reject_null=["humidity"])
    assert ("null:humidity",) in rows(r.filter("reject_reason is not null"), "reject_reason")


def test_consumer_bad_record_and_counts(spark, tmp):
    q, log, out = (os.path.join(tmp, x) for x in ("queue", "log", "out"))
    msgs = []
    for i in range(7):
        m = {"message_id": f"m{i}", "timestamp": f"2024-01-01T00:00:0{i}", "recipient": "a@b.c",
             "subject": "S", "message": f"hello {i}"}
        msgs.append({"body": json.dumps(m)})
    msgs[3] = {"body": "{broken"}
    msgs[5] = {"body": json.dumps({"timestamp": "x"})}
    for i, m in enumerate(msgs):
        _write_lines(q, f"msg{i:02d}.json", [m])
    _run(jobs.run_consumer(spark, q, log, out, os.path.join(tmp, "cp"), as_of="2024-01-01 01:00:00", max_per_batch=5))
    counts = spark.read.parquet(os.path.join(out, "counts"))
    per_batch = [r.processed for r in counts.collect()]
    assert len(per_batch) == 2 and sum(per_batch) == 5  # 7 messages in batches of at most 5
    t = tables.read_table(spark, log)
    assert t.count() == 5 and {r.status for r in t.collect()} == {"sent"}
    failed = rows(spark.read.parquet(os.path.join(out, "failed")), "error")
    assert failed == [("bad_json",), ("missing message_id",)]
    sent = spark.read.parquet(os.path.join(out, "sent")).filter("message_id = 'm0'").first()
    assert "Mesaj: hello 0" in sent.text
    # stream = batch: the same operators over all queue files at once
    b = jobs.consume_rows(spark.read.text(q), as_of="2024-01-01 01:00:00").filter("error is null")
    cols = ["message_id", "timestamp", "status", "processed_at"]
    assert rows(t, *cols) == rows(b, *cols)


def test_dedup_stream(spark, tmp):
    src = os.path.join(tmp, "ev")
    t0 = dt.datetime(2024, 1, 1)
    recs = [{"id": i % 4, "ts": (t0 + dt.timedelta(seconds=i)).isoformat()} for i in range(12)]
    _write_lines(src, "a.json", recs)
    s = spark.readStream.schema("id int, ts timestamp_ntz").json(src)
    q = (jobs.dedup_stream(s, ["id"], "ts", "1 hour").writeStream.format("memory").queryName("dedup_t")
         .trigger(availableNow=True).option("checkpointLocation", os.path.join(tmp, "cp")).start())
    _run(q)
    assert sorted(r.id for r in spark.table("dedup_t").collect()) == [0, 1, 2, 3]


def _metric_files(src, t0):
    # three files, 25 minutes apart, so the watermark closes periods in between;
    # explicit modification times fix the order in which the source reads them
    import time as _t
    now = _t.time()
    for f in range(3):
        recs = [{"k": "a" if i % 2 else "b", "ts": (t0 + dt.timedelta(minutes=25 * f + i)).isoformat(),
                 "v": float(50 + 40 * ((f + i) % 3))} for i in range(0, 20, 2)]
        _write_lines(src, f"f{f}.json", recs)
        os.utime(os.path.join(src, f"f{f}.json"), (now - 100 + 30 * f, now - 100 + 30 * f))


def test_stream_metrics_equal_batch(spark, tmp):
    src = os.path.join(tmp, "m")
    t0 = dt.datetime(2024, 1, 1)
    _metric_files(src, t0)
    s = spark.readStream.schema("k string, ts timestamp_ntz, v double").option("maxFilesPerTrigger", 1).json(src)
    q = (jobs.stream_metrics(s, "ts", "v", by=["k"], period_s=300, delay="1 minute").writeStream
         .format("memory").queryName("metrics_t").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(tmp, "cp")).start())
    _run(q)
    live = spark.table("metrics_t").withColumn("period_start", F.col("period_start").cast("timestamp_ntz"))
    batch = TS.metric_statistics(spark.read.schema("k string, ts timestamp_ntz, v double").json(src),
                                 "ts", "v", by=["k"], period_s=300)
    got = rows(live, "period_start", "k", "sum", "sample_count")
    want = rows(batch, "period_start", "k", "sum", "sample_count")
    # exactly the periods the final watermark has closed
    wm = dt.datetime.fromisoformat(q.lastProgress["eventTime"]["watermark"].replace("Z", ""))
    closed = [r for r in want if r[0] + dt.timedelta(seconds=300) <= wm]
    assert got == closed and len(closed) >= len(want) - 4


def test_stream_alarm_matches_batch(spark, tmp):
    src = os.path.join(tmp, "a")
    t0 = dt.datetime(2024, 1, 1)
    _metric_files(src, t0)
    s = spark.readStream.schema("k string, ts timestamp_ntz, v double").option("maxFilesPerTrigger", 1).json(src)
    q = (stream_alarm(s, "ts", "v", ["k"], "Average", ">", 60.0, 2, period_s=300, delay="1 minute")
         .writeStream.format("memory").queryName("alarm_t").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(tmp, "cp")).start())
    _run(q)
    live = rows(spark.table("alarm_t").withColumn("p", F.col("period_start").cast("timestamp_ntz")), "k", "p", "state")
    stats = TS.metric_statistics(spark.read.schema("k string, ts timestamp_ntz, v double").json(src),
                                 "ts", "v", by=["k"], period_s=300, stats=["Average"])
    batch = rows(TS.alarm(stats, "Average", ">", 60.0, 2, by=["k"]), "k", "period_start", "state")
    # exactly the periods the final watermark has closed, with the batch states
    wm = dt.datetime.fromisoformat(q.lastProgress["eventTime"]["watermark"].replace("Z", ""))
    closed = [r for r in batch if r[1] + dt.timedelta(seconds=300) <= wm]
    assert live == closed and len(closed) >= len(batch) - 4


def test_apply_changes_and_file_index(spark, tmp):
    src, table = os.path.join(tmp, "cdc"), os.path.join(tmp, "tbl")
    recs = [{"Records": [
        {"eventName": "INSERT", "dynamodb": {"NewImage": {"id": {"S": "u1"}, "age": {"N": "30"}}}},
        {"eventName": "INSERT", "dynamodb": {"NewImage": {"id": {"S": "u2"}, "age": {"N": "41"}}}},
        {"eventName": "MODIFY", "dynamodb": {"NewImage": {"id": {"S": "u1"}, "age": {"N": "31"}}}},
        {"eventName": "REMOVE", "dynamodb": {"Keys": {"id": {"S": "u2"}}}}]}]
    _write_lines(src, "c1.json", recs)
    _run(jobs.apply_changes(spark, src, table, ["id"], {"id": "string", "age": "int"}, os.path.join(tmp, "cp")))
    assert rows(tables.read_table(spark, table), "id", "age") == [("u1", 31)]
    up = os.path.join(tmp, "uploads")
    os.makedirs(up)
    open(os.path.join(up, "my%20file.txt"), "w").write("abc")
    idx = os.path.join(tmp, "idx")
    _run(jobs.run_file_index(spark, up, idx, checkpoint=os.path.join(tmp, "cp2"), as_of="2024-01-01 00:00:00"))
    assert rows(tables.read_table(spark, idx), "file_id", "size", "status") == [
        ("my file.txt", 3, "processed")]


def test_keyed_table_rewrites_touched_buckets_only(spark, tmp):
    path = os.path.join(tmp, "kt")
    tables.put(spark.range(200).selectExpr("id as k", "id * 10 as v"), path, ["k"], 0, buckets=8)
    files = lambda: {r[0] for r in spark.read.parquet(os.path.join(path, "table")).select("_metadata.file_path").distinct().collect()}
    before = files()
    tables.delete(spark.createDataFrame([(7,)], "k long"), path, ["k"], 1, buckets=99)  # the table keeps its 8 buckets
    assert len(before - files()) == len(files() - before) == 1
    tables.update(spark.createDataFrame([(9, 5, "x"), (7, None, "y"), (900, 1, None)], "k long, v long, note string"), path, ["k"], 2, ["v", "note"])
    got = {r.k: (r.v, r.note) for r in tables.read_table(spark, path).collect()}
    assert len(got) == 201 and got[9] == (5, "x") and got[7] == (None, "y") and got[900] == (1, None) and got[8] == (80, None)
    some = tables.get_rows(spark, path, spark.createDataFrame([(9,), (10,), (12345,)], "k long"), ["k"])
    assert rows(some, "k") == [(9,), (10,)]
    # a bucket that loses its last row is replaced too
    tables.delete(spark.createDataFrame([(k,) for k in got], "k long"), path, ["k"], 3)
    assert tables.read_table(spark, path).count() == 0


def test_changes_of_one_key_apply_in_order_over_messages_and_batches(spark, tmp):
    """INSERT, REMOVE, INSERT in three messages, then REMOVE in the next batch and INSERT in a third."""
    rec = lambda seq, op, v: {"Records": [{"eventName": op, "dynamodb": {"SequenceNumber": str(seq), "Keys": {"id": {"S": "u"}},
                                                                       **({} if op == "REMOVE" else {"NewImage": {"id": {"S": "u"}, "v": {"N": str(v)}}})}}]}
    schema, src, table, cp = {"id": "string", "v": "int"}, os.path.join(tmp, "cdc"), os.path.join(tmp, "t"), os.path.join(tmp, "cp")
    steps = [[rec(3, "INSERT", 3), rec(1, "INSERT", 1), rec(2, "REMOVE", 0)], [rec(4, "REMOVE", 0)], [rec(10, "INSERT", 10), rec(9, "INSERT", 9)]]
    seen = []
    for i, recs in enumerate(steps):
        _write_lines(src, f"c{i}.json", recs)
        _run(jobs.apply_changes(spark, src, table, ["id"], schema, cp))
        seen.append(rows(tables.read_table(spark, table), "id", "v"))
    assert seen == [[("u", 3)], [], [("u", 10)]]


def test_batch_replaces_buckets_again_after_a_crash(spark, tmp, monkeypatch):
    """The driver dies while buckets are replaced and one bucket is gone: the batch, run again, brings all rows back."""
    path = os.path.join(tmp, "kt")
    old = spark.range(100).selectExpr("id as k", "'old' as v")
    tables.put(old, path, ["k"], 0, writer="cp", buckets=4)
    new = spark.range(50, 150).selectExpr("id as k", "'new' as v")
    tables.put(new, path, ["k"], 1, writer="cp")
    want = rows(tables.read_table(spark, path))
    # as if batch 1 had stopped between dropping an old bucket and moving the new one in place
    part = os.path.join(path, "table", "_buckets=4", "_bucket=2")
    for f in os.listdir(part):
        os.remove(os.path.join(part, f))
    assert len(rows(tables.read_table(spark, path))) < len(want)
    tables.put(new, path, ["k"], 1, writer="cp")
    assert rows(tables.read_table(spark, path)) == want and len(want) == 150
    # another writer's batch 1 is another batch
    tables.put(spark.createDataFrame([(500, "x")], "k long, v string"), path, ["k"], 1, writer="other")
    assert tables.read_table(spark, path).count() == 151


def test_document_chain_and_fan_out(spark, tmp):
    root = os.path.join(tmp, "docs")
    os.makedirs(os.path.join(root, "incoming"))
    open(os.path.join(root, "incoming", "q1_sales_report.txt"), "w").write("Sales\nup 5%\n\n\n  \n\nOutlook\n\n")
    open(os.path.join(root, "incoming", "skip.pdf"), "w").write("x")
    q1, q2 = jobs.run_document_chain(spark, root, as_of="2024-01-01 00:00:00")
    _run(q2)
    d = jobs.dashboard(spark, root).collect()
    assert [(r.title, r.slide_count, r.first_title) for r in d] == [("Q1 Sales Report", 4, "Sales")]
    src = os.path.join(tmp, "fan")
    _write_lines(src, "a.json", [{"x": 1}, {"x": 2}])
    seen = {}

    def sink_a(df, bid):
        df.write.mode("overwrite").parquet(os.path.join(tmp, f"a{bid}"))

    def sink_b(df, bid):
        seen[bid] = df.count()
    s = spark.readStream.schema("x int").json(src)
    _run(jobs.fan_out(s, {"a": sink_a, "b": sink_b}, os.path.join(tmp, "cpf")))
    assert seen == {0: 2} and spark.read.parquet(os.path.join(tmp, "a0")).count() == 2


def test_log_tail_and_incremental(spark, tmp):
    logs = os.path.join(tmp, "logs")
    _write_lines(logs, "l1.json", [{"log_group": "/app", "log_stream": "s", "timestamp": 1, "message": "ERROR disk"},
                                  {"log_group": "/app", "log_stream": "s", "timestamp": 2, "message": "INFO ok"}])
    from tidewater.streaming.sources import stream_logs
    q = (stream_logs(spark, logs, contains="ERROR").writeStream.format("memory").queryName("logs_t")
         .trigger(availableNow=True).option("checkpointLocation", os.path.join(tmp, "cpl")).start())
    _run(q)
    assert [r.message for r in spark.table("logs_t").collect()] == ["ERROR disk"]
    src = os.path.join(tmp, "inc")
    _write_lines(src, "a.json", [{"x": 1}])
    seen = []
    cp = os.path.join(tmp, "cpi")
    _run(jobs.incremental(spark, src, "x int", lambda df, bid: seen.extend(r.x for r in df.collect()), cp))
    _write_lines(src, "b.json", [{"x": 2}])
    _run(jobs.incremental(spark, src, "x int", lambda df, bid: seen.extend(r.x for r in df.collect()), cp))
    assert seen == [1, 2]  # the second run reads only the new file (job bookmark)


def test_failed_batch_replays_to_same_table(spark, tmp):
    """A micro-batch that dies after part of its writes is replayed from the
    checkpoint; per-batch partition overwrite leaves no duplicates."""
    src, out = os.path.join(tmp, "src"), os.path.join(tmp, "out")
    _write_lines(src, "m1.json", SENSOR_1)
    cp = os.path.join(tmp, "cp")
    calls = {"n": 0}

    def flaky(df, batch_id):
        rows_ = jobs.sensor_rows(df, as_of="2024-01-02 00:00:00")
        good = rows_.filter("reject_reason is null").drop("reject_reason")
        tables.put(good, os.path.join(out, "items"), jobs.SENSOR_KEYS, batch_id)
        calls["n"] += 1
        if calls["n"] == 1:
            raise RuntimeError("executor lost after the first write")

    q = jobs._start(jobs.stream_messages(spark, src), flaky, cp, None)
    with pytest.raises(Exception, match="executor lost"):
        q.awaitTermination(120)
    q = jobs._start(jobs.stream_messages(spark, src), flaky, cp, None)  # restart, same checkpoint
    _run(q)
    assert calls["n"] == 2
    items = tables.read_table(spark, os.path.join(out, "items"))
    assert rows(items, "device_id") == [("d1",), ("d2",)]


def test_late_rows_are_dropped_and_counted(spark, tmp):
    # late rows: the watermark drops them and the progress counts them
    m = os.path.join(tmp, "m")
    t0 = dt.datetime(2024, 1, 1)
    _write_lines(m, "a.json", [{"k": "a", "ts": (t0 + dt.timedelta(hours=2)).isoformat(), "v": 1.0}])
    _write_lines(m, "b.json", [{"k": "a", "ts": t0.isoformat(), "v": 5.0}])
    _write_lines(m, "c.json", [{"k": "a", "ts": (t0 + dt.timedelta(minutes=1)).isoformat(), "v": 7.0}])
    import time as _t
    now = _t.time()
    for i, f in enumerate(["a.json", "b.json", "c.json"]):  # read in this order, one file per batch
        os.utime(os.path.join(m, f), (now - 60 + 30 * i, now - 60 + 30 * i))
    st = spark.readStream.schema("k string, ts timestamp_ntz, v double").option("maxFilesPerTrigger", 1).json(m)
    q = (jobs.stream_metrics(st, "ts", "v", by=["k"], period_s=300, delay="10 minutes").writeStream
         .format("memory").queryName("late_t").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(tmp, "cpm")).start())
    _run(q)
    dropped = late_rows(q)
    # lateness is judged against the previous batch's watermark: b (next batch
    # after the jump) is still counted, c (one batch later) is dropped
    assert dropped == 1
    assert rows(spark.table("late_t"), "sum") == [(5.0,)]


def test_trigger_kwargs():
    from tidewater.streaming.sources import trigger_kwargs
    assert trigger_kwargs(None) == {"availableNow": True}
    assert trigger_kwargs("once") == {"once": True}
    assert trigger_kwargs("5 minutes") == {"processingTime": "5 minutes"}


def test_stream_alarm_ttl_forgets_silent_key(spark, tmp):
    src = os.path.join(tmp, "ttl")
    t0 = dt.datetime(2024, 1, 1)
    import time as _t
    now = _t.time()
    # key b reports once; key a keeps the watermark moving for an hour
    _write_lines(src, "f0.json", [{"k": "a", "ts": t0.isoformat(), "v": 1.0}, {"k": "b", "ts": t0.isoformat(), "v": 1.0}])
    _write_lines(src, "f1.json", [{"k": "a", "ts": (t0 + dt.timedelta(minutes=60)).isoformat(), "v": 1.0}])
    _write_lines(src, "f2.json", [{"k": "a", "ts": (t0 + dt.timedelta(minutes=120)).isoformat(), "v": 1.0}])
    for i in range(3):
        os.utime(os.path.join(src, f"f{i}.json"), (now - 100 + 30 * i, now - 100 + 30 * i))
    s = spark.readStream.schema("k string, ts timestamp_ntz, v double").option("maxFilesPerTrigger", 1).json(src)
    q = (stream_alarm(s, "ts", "v", ["k"], "Average", ">", 5.0, 2, period_s=300, delay="1 minute", ttl_s=1800)
         .writeStream.format("memory").queryName("ttl_t").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(tmp, "cp")).start())
    _run(q)
    b_rows = spark.table("ttl_t").filter("k = 'b'").count()
    a_rows = spark.table("ttl_t").filter("k = 'a'").count()
    assert a_rows > b_rows >= 1 and b_rows <= 1800 // 300 + 1  # b stops after its retention


def _times(src, names):
    """Files in this order, one a batch."""
    import time as _t
    now = _t.time()
    for i, f in enumerate(names):
        os.utime(os.path.join(src, f), (now - 200 + 10 * i, now - 200 + 10 * i))


@pytest.mark.parametrize("missing", ["breach", "ok", "missing"])
def test_stream_alarm_on_silence_equals_batch(spark, tmp, missing):
    """Keys fall silent at different times and one comes back; a late row is dropped and counted."""
    src = os.path.join(tmp, "silence")
    t0 = dt.datetime(2024, 1, 1)
    at = lambda m: (t0 + dt.timedelta(minutes=m)).isoformat()
    files = [[("a", 0, 5.0), ("b", 1, 0.0), ("c", 2, None)], [("a", 31, 0.5), ("a", 33, 0.2)], [("b", 90, 7.0), ("a", 92, 1.0)],
             [("a", 95, 2.0)], [("a", 3, 100.0), ("a", 160, 3.0)], [("a", 300, 1.0)]]
    for i, f in enumerate(files):
        _write_lines(src, f"f{i}.json", [{"k": k, "ts": at(m), "v": v} for k, m, v in f])
    _times(src, [f"f{i}.json" for i in range(len(files))])
    s = spark.readStream.schema("k string, ts timestamp_ntz, v double").option("maxFilesPerTrigger", 1).json(src)
    q = (stream_alarm(s, "ts", "v", ["k"], "Sum", "<", 1.0, 2, period_s=300, delay="1 minute", missing=missing)
         .writeStream.format("memory").queryName(f"silence_{missing}").outputMode("append").trigger(availableNow=True)
         .option("checkpointLocation", os.path.join(tmp, "cp")).start())
    _run(q)
    assert late_rows(q) == 1
    live = spark.table(f"silence_{missing}").selectExpr("k", "cast(period_start as timestamp_ntz) as p", "value", "breaching", "state")
    end = t0 + dt.timedelta(minutes=295)  # the last watermark is minute 299
    data = spark.read.schema("k string, ts timestamp_ntz, v double").json(src).where("v is null or v <> 100")
    stats = TS.metric_statistics(data, "ts", "v", by=["k"], period_s=300, stats=["Sum"])
    batch = TS.alarm(stats, "Sum", "<", 1.0, 2, by=["k"], missing=missing, start=t0.isoformat(sep=" "), end=end.isoformat(sep=" "))
    want = batch.selectExpr("k", "period_start as p", "sum as value", "breaching", "state")
    assert rows(live) == rows(want) and len(rows(live)) == 3 * 59


def test_stream_alarm_restart_goes_on_from_its_state(spark, tmp):
    src = os.path.join(tmp, "restart")
    t0 = dt.datetime(2024, 1, 1)
    s = spark.readStream.schema("k string, ts timestamp_ntz, v double").json(src) if os.path.isdir(src) else None
    for i, minutes in enumerate([(0, 6), (40,), (80,)]):
        _write_lines(src, f"f{i}.json", [{"k": "a", "ts": (t0 + dt.timedelta(minutes=m)).isoformat(), "v": 1.0} for m in minutes])
        s = spark.readStream.schema("k string, ts timestamp_ntz, v double").json(src)
        q = (stream_alarm(s, "ts", "v", ["k"], "Sum", ">", 0.5, 2, delay="0 seconds", missing="ok").writeStream
             .format("parquet").option("path", os.path.join(tmp, "out")).outputMode("append").trigger(availableNow=True)
             .option("checkpointLocation", os.path.join(tmp, "cp")).start())
        _run(q)
    got = rows(spark.read.parquet(os.path.join(tmp, "out")), "period_start", "state")
    assert len(got) == 16 and len({r[0] for r in got}) == 16  # minutes 0 to 80, no period twice
    assert [r[1] for r in got][:3] == ["INSUFFICIENT_DATA", "ALARM", "OK"]


def test_queue_drains_one_file_in_batches_of_messages(spark, tmp):
    """60 messages of one file and 7 of two more, in batches of five; a restart goes on where the last run ended."""
    q, cp, seen = os.path.join(tmp, "queue"), os.path.join(tmp, "cp"), []
    _write_lines(q, "a.json", [f"m{i}" for i in range(60)])
    take = lambda df, batch_id: seen.append([r.value for r in df.collect()])
    from tidewater.streaming.sources import stream_queue
    assert jobs._drain(stream_queue(spark, q, 5), take, cp).exception() is None
    assert [len(b) for b in seen] == [5] * 12 and [m for b in seen for m in b] == [f"m{i}" for i in range(60)]
    _write_lines(q, "b.json", ["n0", "", "n1", "n2"])
    _write_lines(q, "c.json", ["n3", "n4", "n5", "n6"])
    _times(q, ["a.json", "b.json", "c.json"])  # a.json gets a new time: it is not read again only if it sorts before b
    os.utime(os.path.join(q, "a.json"), (1, 1))
    seen.clear()
    assert jobs._drain(stream_queue(spark, q, 5), take, os.path.join(tmp, "cp2")).exception() is None
    assert [len(b) for b in seen] == [5] * 13 + [2] and [m for b in seen[12:] for m in b] == [f"n{i}" for i in range(7)]
    _write_lines(q, "d.json", ["o0"])
    seen.clear()
    assert jobs._drain(stream_queue(spark, q, 5), take, os.path.join(tmp, "cp2")).exception() is None
    assert seen == [["o0"]]

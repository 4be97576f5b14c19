"""Streaming jobs (T1-T4, T6-T8, T11, K6). Each job composes batch
operators inside ``foreachBatch`` (or as stateless stream transforms) and
writes idempotently per batch id."""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewater.operators import filters as FL
from tidewater.operators import nested as N
from tidewater.operators import shape as P
from tidewater.operators.keyed import latest_by_key
from tidewater.session import checkpoint_path
from tidewater.streaming import tables
from tidewater.streaming.sources import stream_files, stream_messages, stream_queue, trigger_kwargs

BATCH = tables.BATCH


def _default_cp(spark: SparkSession, job: str, *paths: str) -> str:
    """Checkpoint under the shared ``spark.checkpoint.dir``, unique per job
    and per input/output paths, so two jobs never share state."""
    h = hashlib.sha1("|".join(paths).encode()).hexdigest()[:16]
    return checkpoint_path(spark, f"{job}-{h}")


def _start(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
           trigger: str | None) -> StreamingQuery:
    return (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
            .trigger(**trigger_kwargs(trigger)).start())


def _drain(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run batch after batch until the source has nothing more, then stop: for
    sources with a batch limit of their own, which ``availableNow`` would end after one batch."""
    query = _start(df, fn, checkpoint, "0 seconds")
    query.processAllAvailable()
    query.stop()
    return query


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Append one batch as partition ``_batch=<id>``; replay overwrites it."""
    (df.withColumn(BATCH, F.lit(int(batch_id))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(path))


def dead_letters(bad: DataFrame, path: str, batch_id: int, attempts: int = 1) -> None:
    """T11. Rejected rows kept with their reason and attempt count."""
    _write_batch(bad.withColumn("attempts", F.lit(int(attempts))), path, batch_id)


def fan_out(df: DataFrame, sinks: Mapping[str, Callable[[DataFrame, int], None]],
            checkpoint: str | None = None, trigger: str | None = None) -> StreamingQuery:
    """K6. Same micro-batch to several sinks; the batch is persisted once so
    every sink reads it without recomputing the source."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for _name, sink in sinks.items():
                sink(batch, batch_id)
        finally:
            batch.unpersist()
    if checkpoint is None:
        # identity of the stream: its logical plan without attribute ids, which
        # names the source path and format, and so is stable across restarts
        plan = re.sub(r"#\d+L?", "", df._jdf.queryExecution().logical().toString())
        checkpoint = _default_cp(df.sparkSession, "fan_out", plan, *sorted(sinks))
    cp = checkpoint
    return _start(df, run, cp, trigger)


# --------------------------------------------------------------- T1 sensors

SENSOR_KEYS = ("device_id", "timestamp")

# The topic written when a message carries none, and the
# readings filled with 0 when missing.
DEFAULT_TOPIC = "sensors/temperature"
READINGS = ("temperature", "humidity", "pressure")
READING_TYPE = "decimal(38,10)"


# Place of a message among all messages of a batch: the same whatever the split.
PLACE = ("_time", "_file", "_block", "_line")


def placed(messages: DataFrame) -> DataFrame:
    """Messages with their file's time and name and the split's start."""
    return messages.select("value", F.col("_metadata.file_modification_time").alias("_time"), F.col("_metadata.file_path").alias("_file"),
                           F.col("_metadata.file_block_start").alias("_block"))


def _lined(batch: DataFrame) -> DataFrame:
    """A batch of ``placed`` messages with ``_line``, which rises with the lines of a split."""
    return batch.withColumn("_line", F.monotonically_increasing_id())


def sensor_rows(lines: DataFrame, as_of=None, pattern: str = "sensors/#",
                reject_null: Sequence[str] = ()) -> DataFrame:
    """Sensor messages (raw JSON text in ``value``) -> stored items with a
    ``reject_reason`` (NULL = valid). Shared by batch and stream."""
    v = F.try_parse_json(F.col("value"))
    ts_now = F.date_format(F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp"),
                           "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    base = lines.select(
        "value", *[c for c in lines.columns if c == "_place"],
        F.coalesce(F.try_variant_get(v, "$.topic", "string"), F.lit(DEFAULT_TOPIC)).alias("topic"),
        F.try_variant_get(v, "$.device_id", "string").alias("device_id"),
        F.coalesce(F.try_variant_get(v, "$.timestamp", "string"), ts_now).alias("timestamp"))
    routed = FL.where_topic(base, "topic", pattern)
    fields = {r: (READING_TYPE, 0) for r in READINGS}
    items = P.json_fields(routed, "value", fields, reject_null=reject_null)
    items = FL.tag_valid(items, [("missing_device_id", F.col("device_id").isNotNull())])
    return items.withColumn("processed_at", ts_now).drop("value")


def run_sensor_ingest(spark: SparkSession, src: str, out: str, checkpoint: str | None = None,
                      trigger: str | None = None, as_of=None, pattern: str = "sensors/#",
                      reject_null: Sequence[str] = ()) -> StreamingQuery:
    """T1. topic filter -> required-field gate -> defaults -> stamp ->
    upsert by (device_id, timestamp) into ``out/items``; rejects to
    ``out/rejected``. Replays of a batch are idempotent."""
    def batch(df: DataFrame, batch_id: int) -> None:
        rows = sensor_rows(_lined(df).withColumn("_place", F.struct(*PLACE)).drop(*PLACE), as_of, pattern, reject_null).persist()
        try:
            good = rows.filter(F.col("reject_reason").isNull()).drop("reject_reason")
            tables.put(good, os.path.join(out, "items"), SENSOR_KEYS, batch_id, order_col="_place", writer=cp)
            dead_letters(rows.filter(F.col("reject_reason").isNotNull()).drop("_place"), os.path.join(out, "rejected"), batch_id)
        finally:
            rows.unpersist()
    cp = checkpoint or _default_cp(spark, "sensor_ingest", src, out)
    return _start(placed(stream_messages(spark, src)), batch, cp, trigger)



# ------------------------------------------------------------- T2 consumer

# Text and subject line sent for each notification (fields of
# the message), the text without the surrounding blank lines.
NOTIFICATION_TEXT = ("🔔 Yeni Bildirim\n\n📧 Alıcı: {recipient}\n📌 Konu: {subject}\n💬 Mesaj: {message}\n"
                     "📅 Tarih: {timestamp}\n🆔 ID: {message_id}")
SUBJECT_LINE = "AWS Bildirim: {subject}"
SENT = "sent"
MESSAGE_KEYS = ("message_id", "timestamp")


def consume_rows(lines: DataFrame, as_of=None, text: str = NOTIFICATION_TEXT, subject_line: str = SUBJECT_LINE) -> DataFrame:
    """Queue records (``{"body": "<message json>"}`` per line) -> parsed
    messages with the rendered text and subject line (both templates over the message's
    fields) and an ``error`` for records that
    cannot be processed (bad JSON, or a missing required field)."""
    outer = F.try_parse_json(F.col("value"))
    body_txt = F.coalesce(F.try_variant_get(outer, "$.body", "string"), F.col("value"))
    m = F.try_parse_json(body_txt)
    g = lambda k: F.try_variant_get(m, f"$.{k}", "string")
    df = lines.select(g("message_id").alias("message_id"), g("timestamp").alias("timestamp"),
                      g("recipient").alias("recipient"), g("subject").alias("subject"),
                      g("message").alias("message"), m.isNull().alias("_bad"))
    df = df.withColumn("error", F.when(F.col("_bad"), F.lit("bad_json"))
                       .when(F.col("message_id").isNull(), F.lit("missing message_id"))
                       .when(F.col("timestamp").isNull(), F.lit("missing timestamp"))
                       .when(F.col("recipient").isNull(), F.lit("missing recipient"))
                       .when(F.col("subject").isNull(), F.lit("missing subject"))
                       .when(F.col("message").isNull(), F.lit("missing message"))).drop("_bad")
    df = P.render(P.render(df, text, "text"), subject_line, "subject_line")
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumns({"status": F.lit(SENT),
                           "processed_at": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")})


def run_consumer(spark: SparkSession, src: str, log: str, out: str, checkpoint: str | None = None,
                 trigger: str | None = None, as_of=None, max_per_batch: int = 5) -> StreamingQuery:
    """T2. Drain the queue in batches of ``max_per_batch`` messages: parse,
    render, mark ``sent`` (update by key, created if absent) in the log
    table, write the sent texts and the processed count per batch (A14).
    A bad record goes to ``out/failed`` and never stops the batch."""
    def batch(df: DataFrame, batch_id: int) -> None:
        rows = consume_rows(df, as_of).persist()
        try:
            ok = rows.filter(F.col("error").isNull())
            tables.update(ok.select(*MESSAGE_KEYS, "status", "processed_at"), log, MESSAGE_KEYS, batch_id,
                          set_cols=["status", "processed_at"], writer=cp)
            _write_batch(ok.select(*MESSAGE_KEYS, "recipient", "subject_line", "text"), os.path.join(out, "sent"), batch_id)
            dead_letters(rows.filter(F.col("error").isNotNull()), os.path.join(out, "failed"), batch_id)
            counts = ok.agg(F.count(F.lit(1)).alias("processed")).withColumn("batch_id", F.lit(int(batch_id)))
            _write_batch(counts, os.path.join(out, "counts"), batch_id)
        finally:
            rows.unpersist()
    cp = checkpoint or _default_cp(spark, "consumer", src, log, out)
    queue = stream_queue(spark, src, max_per_batch)
    return _drain(queue, batch, cp) if trigger in (None, "availableNow") else _start(queue, batch, cp, trigger)


# ------------------------------------------------- T3 / T4 stateless + state

def event_time(df: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP (not TIMESTAMP_NTZ); cast under the UTC session."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def dedup_stream(df: DataFrame, id_cols: Sequence[str], ts: str, delay: str = "10 minutes") -> DataFrame:
    """T3. Drop repeats of the same id arriving within ``delay`` of each
    other; state is bounded by the watermark."""
    return event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(id_cols))


def stream_metrics(df: DataFrame, ts: str, value: str, by: Sequence[str] = (), period_s: int = 300,
                   delay: str = "10 minutes", closed_at: str | None = None) -> DataFrame:
    """T4. Tumbling statistics, emitted once a period is closed by the
    watermark (append mode). Rows later than ``delay`` are dropped and
    counted in the query progress as ``numRowsDroppedByWatermark``. Spark
    judges lateness against the watermark of the previous micro-batch, so a
    late row that arrives in the batch right after the watermark moved is
    still aggregated; closed periods are never re-emitted.

    ``closed_at`` names a column with the event time of the closed period,
    which a second stateful operator on the stream needs."""
    d = event_time(df, ts).withWatermark(ts, delay)
    x = F.col(value)
    return (d.groupBy(F.window(ts, f"{int(period_s)} seconds").alias("w"), *by)
            .agg(F.sum(x).alias("sum"), F.avg(x).alias("average"), F.max(x).alias("maximum"),
                 F.min(x).alias("minimum"), F.count(x).alias("sample_count"))
            .select(*([F.window_time("w").alias(closed_at)] if closed_at else []), F.col("w.start").alias("period_start"), *by,
                    "sum", "average", "maximum", "minimum", "sample_count"))


# --------------------------------------------------------- T6 change apply

def change_rows(df: DataFrame, body_col: str, keys: Sequence[str], schema: Mapping[str, str],
                order_cols: Sequence[str] = ()) -> DataFrame:
    """Change-stream records (``Records[].eventName`` INSERT / MODIFY /
    REMOVE with ``dynamodb.NewImage`` / ``Keys``) -> typed rows + op.

    ``_pos`` orders the records: by their sequence number where they have
    one, then by the message's place (``order_cols`` of ``df``: its file's
    time and name, and its line there) and the record's place in it."""
    rec_t = ("struct<Records: array<struct<eventName: string, dynamodb: struct<"
             "SequenceNumber: string, Keys: map<string, struct<S: string, N: string, BOOL: boolean>>, "
             "NewImage: map<string, struct<S: string, N: string, BOOL: boolean>>>>>>")
    r = df.select(*order_cols, F.posexplode(F.from_json(F.col(body_col), rec_t)["Records"]).alias("_at", "r"))
    number = F.col("r.dynamodb.SequenceNumber").try_cast("decimal(38,0)")
    r = r.withColumn("_pos", F.struct(number.alias("number"), *order_cols, "_at"))
    img = F.coalesce(F.col("r.dynamodb.NewImage"), F.col("r.dynamodb.Keys"))
    d = r.select("_pos", F.col("r.eventName").alias("event_name"), img.alias("_img"))
    d = N.decode_attributes(d, "_img", schema).drop("_img")
    return d.withColumn("_op", F.when(F.col("event_name") == "REMOVE", F.lit("delete")).otherwise(F.lit("put")))


def apply_change_rows(rows: DataFrame, table: str, keys: Sequence[str], schema: Mapping[str, str], batch_id: int, writer: str = "",
                      buckets: int = tables.BUCKETS) -> None:
    """One batch of ``change_rows``, put and deleted in the keyed table in the order of ``_pos``."""
    puts = tables.changes(rows.filter(F.col("_op") == "put").select(*schema, "_pos"), "put", order_col="_pos")
    dels = tables.changes(rows.filter(F.col("_op") == "delete").select(*keys, "_pos"), "delete", order_col="_pos")
    tables.write_changes(puts.unionByName(dels, allowMissingColumns=True), table, keys, batch_id, writer, buckets)


def apply_changes(spark: SparkSession, src: str, table: str, keys: Sequence[str],
                  schema: Mapping[str, str], checkpoint: str | None = None,
                  trigger: str | None = None) -> StreamingQuery:
    """T6. Apply a change stream to a keyed table: inserts and modifies are
    puts, removes are deletes, in the records' order (see ``change_rows``)."""
    def batch(df: DataFrame, batch_id: int) -> None:
        rows = change_rows(_lined(df), "value", keys, schema, PLACE).persist()
        try:
            apply_change_rows(rows, table, keys, schema, batch_id, cp)
        finally:
            rows.unpersist()
    cp = checkpoint or _default_cp(spark, "apply_changes", src, table)
    return _start(placed(stream_messages(spark, src)), batch, cp, trigger)


# ---------------------------------------------------- T7 document chain

def document_metadata(docs: DataFrame, as_of=None, out_folder: str = "converted", suffix: str = ".pdf") -> DataFrame:
    """Converter stage: text files (``path``, ``value`` whole text) ->
    metadata rows (name, title, section count, created, name and path of the converted file)."""
    secs = N.sections(docs.select("path", "value"), "value", ["path"], sep="\n\n", title_prefix="Slide")
    counts = secs.groupBy("path").agg(F.count(F.lit(1)).alias("slide_count"),
                                      F.min_by("title", "section_no").alias("first_title"))
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    from tidewater.functions.text import base_name, title_from_file
    return counts.select(
        base_name("path").alias("original_name"),
        F.concat(F.regexp_replace(base_name("path"), r"\.[^.]*$", ""), F.lit(suffix)).alias("pdf_name"),
        F.concat(F.lit(f"{out_folder}/"), F.regexp_replace(base_name("path"), r"\.[^.]*$", ""), F.lit(suffix)).alias("pdf_path"),
        title_from_file("path").alias("title"),
        "slide_count", "first_title",
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("create_date"),
        F.col("path").alias("source_path"))


def run_document_chain(spark: SparkSession, root: str, trigger: str | None = None,
                       as_of=None, checkpoint: str | None = None) -> tuple[StreamingQuery, StreamingQuery]:
    """T7. Two chained file jobs: ``root/incoming/*.txt`` -> sections ->
    one metadata JSON per document under ``root/metadata`` (converter);
    ``root/metadata`` -> rows appended to ``root/dashboard`` (the
    dashboard's table is :func:`dashboard` over it). Separate checkpoints.
    """
    inc = (spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", "*.txt")
           .load(os.path.join(root, "incoming")).withColumn("path", F.col("_metadata.file_path")))

    def convert(df: DataFrame, batch_id: int) -> None:
        md = document_metadata(df, as_of)
        md.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
          .partitionBy("original_name").json(os.path.join(root, "metadata"))

    cp = checkpoint or _default_cp(spark, "document_chain", root)
    q1 = _start(inc, convert, os.path.join(cp, "convert"), trigger)
    q1.awaitTermination() if trigger in (None, "availableNow", "once") else None
    md_schema = "pdf_name string, pdf_path string, title string, slide_count int, first_title string, create_date string, source_path string"
    md = stream_files(spark, os.path.join(root, "metadata"), md_schema, glob="*.json") \
        .withColumn("file", F.col("_metadata.file_path"))

    def collect(df: DataFrame, batch_id: int) -> None:
        _write_batch(df, os.path.join(root, "dashboard"), batch_id)

    q2 = _start(md, collect, os.path.join(cp, "dashboard"), trigger)
    return q1, q2


def dashboard(spark: SparkSession, root: str) -> DataFrame:
    """Dashboard table: the newest metadata row per document, newest first
    (documents without a parsable date last)."""
    rows = spark.read.parquet(os.path.join(root, "dashboard"))
    latest = latest_by_key(rows.drop("file"), ["source_path"], [BATCH]).drop(BATCH)
    created = F.col("create_date").try_cast("timestamp")
    return latest.orderBy(created.desc_nulls_last(), F.col("source_path"))


# --------------------------------------------------------- T8 file index

FILE_INDEX_KEYS = ("file_id",)
# Fixed value: the binaryFile source's schema (content is never selected).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def file_index_rows(files: DataFrame, bucket: str, as_of=None) -> DataFrame:
    """binaryFile rows -> index rows (file_id, bucket, size, processed_at, status)."""
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return files.select(F.try_url_decode(F.substring_index(F.col("path"), "/", -1)).alias("file_id"),
                        F.lit(bucket).alias("bucket"), F.col("length").alias("size"),
                        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("processed_at"),
                        F.lit("processed").alias("status"))


def run_file_index(spark: SparkSession, src: str, out: str, bucket: str = "uploads",
                   glob: str | None = None, checkpoint: str | None = None, trigger: str | None = None,
                   as_of=None) -> StreamingQuery:
    """T8. Each new file (metadata only, content never read) upserts its
    index row keyed by file name."""
    files = stream_files(spark, src, BINARY_FILE_SCHEMA, glob=glob, fmt="binaryFile").drop("content")

    def batch(df: DataFrame, batch_id: int) -> None:
        tables.put(file_index_rows(df, bucket, as_of), out, FILE_INDEX_KEYS, batch_id, writer=cp)
    cp = checkpoint or _default_cp(spark, "file_index", src, out)
    return _start(files, batch, cp, trigger)


def incremental(spark: SparkSession, path: str, schema, process: Callable[[DataFrame, int], None],
                checkpoint: str, fmt: str = "json") -> StreamingQuery:
    """S11. Only-new-data batch run (job bookmark): the file source's
    checkpoint remembers processed files; ``availableNow`` processes what
    is new and stops."""
    df = stream_files(spark, path, schema, fmt=fmt)
    return _start(df, process, checkpoint, "availableNow")

"""Nested data and JSON (N1-N4, N6-N9, N11). JSON text is parsed once
into a VARIANT (``try_parse_json``) and read with ``try_variant_get``:
no schema inference pass, and bad JSON is NULL instead of an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidewater.session import spread

# Event kinds, in classification order.
API_GATEWAY, S3, DYNAMODB, SCHEDULED, GENERIC = "api_gateway", "s3", "dynamodb", "scheduled", "generic"
SCHEDULED_SOURCE = "aws.events"


def _has(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant").isNotNull()


def event_kind(body: Column) -> Column:
    """N1 as an expression over JSON text: api_gateway when ``httpMethod``
    exists; s3 / dynamodb when ``Records[0]`` holds that key; scheduled
    when ``source = 'aws.events'``; generic otherwise (including empty
    ``Records``, records of another kind and unparsable text)."""
    v = F.try_parse_json(body)
    return (F.when(_has(v, "$.httpMethod"), F.lit(API_GATEWAY))
            .when(_has(v, "$.Records[0].s3"), F.lit(S3))
            .when(_has(v, "$.Records[0].dynamodb"), F.lit(DYNAMODB))
            .when(F.try_variant_get(v, "$.source", "string") == F.lit(SCHEDULED_SOURCE), F.lit(SCHEDULED))
            .otherwise(F.lit(GENERIC)))


def classify_events(df: DataFrame, body_col: str, out: str = "kind") -> DataFrame:
    """N1. Parsing is per-row CPU work: narrow inputs are spread first."""
    return spread(df).withColumn(out, event_kind(F.col(body_col)))


# Schema of the storage-event records read by :func:`explode_records`.
S3_RECORDS = ("struct<Records: array<struct<eventName: string, eventTime: string, "
              "s3: struct<bucket: struct<name: string>, object: struct<key: string, size: bigint>>>>>")


def explode_records(df: DataFrame, body_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """N2. One row per storage-event record: event name, time, bucket, key
    (percent/plus-decoded; NULL when the escape is broken) and size."""
    parsed = F.from_json(F.col(body_col), S3_RECORDS)
    r = spread(df).select(*keep, F.explode(parsed["Records"]).alias("_r"))
    return r.select(*keep,
                    F.col("_r.eventName").alias("event_name"),
                    F.col("_r.eventTime").alias("event_time"),
                    F.col("_r.s3.bucket.name").alias("bucket"),
                    F.try_url_decode(F.col("_r.s3.object.key")).alias("key"),
                    F.col("_r.s3.object.size").alias("size"))


NA = "N/A"


def flatten_instances(df: DataFrame, col: str = "Reservations", tag_key: str = "Name") -> DataFrame:
    """N3. Reservations[].Instances[] -> one row per instance with id, type,
    state, first tag ``tag_key`` value, zone, public IP, launch time;
    missing values become ``N/A``. Reservations without instances drop."""
    res = df.select(F.explode(F.col(col)).alias("_res"))
    inst = res.select(F.explode(F.col("_res.Instances")).alias("i"))
    tag = F.get(F.filter(F.col("i.Tags"), lambda t: t["Key"] == F.lit(tag_key)), 0)["Value"]
    na = F.lit(NA)
    return inst.select(
        F.col("i.InstanceId").alias("instance_id"),
        F.coalesce(F.col("i.InstanceType"), na).alias("instance_type"),
        F.coalesce(F.col("i.State.Name"), na).alias("state"),
        F.coalesce(tag, na).alias("name"),
        F.coalesce(F.col("i.Placement.AvailabilityZone"), na).alias("zone"),
        F.coalesce(F.col("i.PublicIpAddress"), na).alias("public_ip"),
        F.coalesce(F.col("i.LaunchTime").cast("string"), na).alias("launch_time"),
    )


def describe_tables(names: DataFrame, facts: DataFrame, name_col: str = "table_name") -> DataFrame:
    """N4. Listed tables with their facts; a listed table with no facts
    keeps its row with ``error = 'not found'`` instead of failing the list."""
    j = names.select(name_col).join(facts, on=name_col, how="left")
    present = F.lit(False)
    for c in facts.columns:
        if c != name_col:
            present = present | F.col(c).isNotNull()
    return j.withColumn("error", F.when(~present, F.lit("not found")))


def decode_attributes(df: DataFrame, col: str, schema: Mapping[str, str]) -> DataFrame:
    """N6. Type-tagged attribute map (``{"a": {"S": "x"}, "n": {"N": "1.5"}}``,
    JSON text or map) -> typed columns; numbers via ``try_cast``."""
    m = F.from_json(F.col(col), "map<string, struct<S: string, N: string, BOOL: boolean>>") \
        if dict(df.dtypes)[col] == "string" else F.col(col)
    df = spread(df)
    cols = {}
    for name, typ in schema.items():
        a = m[name]
        if typ == "string":
            cols[name] = a["S"]
        elif typ == "boolean":
            cols[name] = a["BOOL"]
        else:
            cols[name] = a["N"].try_cast(typ)
    return df.withColumns(cols)


def sections(df: DataFrame, text_col: str, id_cols: Sequence[str], sep: str = "\n\n",
             title_prefix: str = "Section") -> DataFrame:
    """N7. Numbered sections of each document.

    The text is cut at ``sep`` and every section is numbered from 1, blank
    ones too. A section's body is its lines trimmed, with blank lines
    dropped. The title is the section's first line (trimmed), or
    ``"<title_prefix> n"`` when that line is blank. A NULL text is one blank
    section.
    """
    strip = lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")
    parts = F.split(F.coalesce(F.col(text_col), F.lit("")), sep, -1)
    secs = F.transform(parts, lambda p: F.struct(
        strip(F.substring_index(p, "\n", 1)).alias("first"),
        F.array_join(F.filter(F.transform(F.split(p, "\n", -1), strip), lambda ln: ln != F.lit("")), "\n").alias("body")))
    s = spread(df).select(*id_cols, F.posexplode(secs).alias("_pos", "_s"))
    no = (F.col("_pos") + 1).cast("int")
    title = F.when(F.col("_s.first") != "", F.col("_s.first")).otherwise(
        F.concat(F.lit(f"{title_prefix} "), no.cast("string")))
    return s.select(*id_cols, no.alias("section_no"), title.alias("title"), F.col("_s.body").alias("body"))


def join_list(df: DataFrame, col: str, sep: str = ", ", out: str | None = None,
              missing: str | None = None) -> DataFrame:
    """N8. List -> text; ``missing`` replaces a NULL list."""
    e = F.array_join(F.col(col), sep)
    if missing is not None:
        e = F.coalesce(e, F.lit(missing))
    return df.withColumn(out or col, e)


# Fixed value: the chunk type that carries streamed text.
DELTA_TYPE = "content_block_delta"


def ordered_concat(df: DataFrame, key: Sequence[str], seq: str, text: str, sep: str = "",
                   out: str = "text", block: int = 4096) -> DataFrame:
    """Texts of each key concatenated in ``seq`` order, in two levels.

    Level 1 groups by (key, seq // block): a key with millions of pieces is
    cut into contiguous blocks that are joined in parallel. Level 2 joins
    the block strings in block order. Only the key's final string - the
    result itself - meets in one task.
    """
    key = list(key)
    b = F.floor(F.col(seq) / F.lit(block)).alias("_tw_blk")
    lvl1 = (df.groupBy(*key, b)
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(seq), F.col(text)))),
                                          lambda x: x[text]), sep).alias("_tw_t"),
                 F.count(F.lit(1)).alias("_tw_n")))
    return (lvl1.groupBy(*key)
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_tw_blk", "_tw_t"))),
                                          lambda x: x["_tw_t"]), sep).alias(out),
                 F.sum("_tw_n").alias("n_parts")))


def assemble_chunks(df: DataFrame, id_col: str, seq_col: str, body_col: str,
                    out: str = "text") -> DataFrame:
    """N9. Streamed reply chunks -> full text: only ``content_block_delta``
    chunks count, joined in sequence order."""
    typ = F.get_json_object(F.col(body_col), "$.type")
    txt = F.get_json_object(F.col(body_col), "$.delta.text")
    d = df.filter(typ == F.lit(DELTA_TYPE)).select(id_col, seq_col, F.coalesce(txt, F.lit("")).alias("_txt"))
    return ordered_concat(d, [id_col], seq_col, "_txt", "", out).drop("n_parts")


def as_json(df: DataFrame, cols: Sequence[str], out: str = "json", keep: Sequence[str] = ()) -> DataFrame:
    """N11. Row -> JSON text; decimals are written as JSON numbers (double)."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    fields = [F.col(c).cast("double").alias(c) if isinstance(types[c], DecimalType) else F.col(c) for c in cols]
    return df.select(*keep, F.to_json(F.struct(*fields)).alias(out))

"""Operator 4: WARC files, read in parallel by boundary-chain verification.

Writing: one record per row, in uncompressed WARC 1.1 files that Spark's text
writer lays out in the shared folder (a record ends with two line ends, the
writer's separator). Of equal payloads one row is a ``response``; the others
are ``revisit`` records that name it (``WARC-Refers-To``) and its digest and
leave the payload out. Digests are compared first; only rows that a Bloom
filter of the revisits lets through are shuffled with their payloads.

Reading: splits are cut at the magic line, which payloads may hold as well.
Each task turns every magic it meets into a candidate with the offset at
which its record would end (its successor). Inside a split, candidates point
on to the first successor past the split; between splits, pointers are
followed from the file's start with doubling, so rounds grow with the
logarithm of a file's splits. Only candidates reached from offset 0 are
records. Payloads that hold the magic are put together from their segments.

Rules for odd input: null html is an empty payload; CR and LF in urls are
percent-encoded in the archive; a null url or id is left out of the record
(which has a random id then) and comes back null; repeated rows are records
of their own; garbage before or after the chain is no record; of equal
payloads the largest id is the response (a null id only without another,
rows repeated with that id all are); a revisit whose response is not among the records has null payload_bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm import bloom
from tidewater.llm.common import shared_path, ship_by_value, small_batches, stored, table

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_PAD = len(MAGIC)
_LENGTH = re.compile(rb"(?im)^Content-Length:[ \t]*([0-9]{1,18})[ \t]*\r?$")
_ID = re.compile(rb"(?im)^WARC-Record-ID:[ \t]*<urn:page:(-?[0-9]{1,19})(?::[0-9a-f-]+)?>")
_URI = re.compile(rb"(?im)^WARC-Target-URI:[ \t]*([^\r\n]*)")
_TYPE = re.compile(rb"(?im)^WARC-Type:[ \t]*([a-z]+)")
_REFERS = re.compile(rb"(?im)^WARC-Refers-To:[ \t]*<urn:page:(-?[0-9]{1,19})>")
_DIGEST = re.compile(rb"(?im)^WARC-Payload-Digest:[ \t]*sha1:([A-Z2-7]{32})")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(sha1_hex: Column) -> Column:
    """40 hex digits as 32 of base 32 (A-Z, 2-7): ten hex digits are eight of base 32."""
    eights = [F.lpad(F.conv(F.substring(sha1_hex, 1 + 10 * i, 10), 16, 32), 8, "0") for i in range(4)]
    return F.translate(F.concat(*eights), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _with_refers(rows: DataFrame, min_bytes: int) -> DataFrame:
    """Adds ``refers``, the id of the response that a row revisits (else null), to rows of id, url, body and digest."""
    digests = stored(rows.where(F.octet_length("body") >= min_bytes).select("id", "digest"), "digests")
    again = stored(digests.groupBy("digest").agg(F.max("id").alias("refers"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated")
    revisits = stored(digests.join(again, "digest").where("NOT id <=> refers").distinct(), "revisits")
    words = bloom.n_words(revisits.count())
    key = F.xxhash64("digest", "id")
    some = stored(bloom.member_filter(bloom.with_bits(revisits, key, words)), "bloom")
    probed = bloom.probe(bloom.with_bits(rows, key, words), some, "maybe")
    clear = probed.where("NOT maybe").drop("maybe").withColumn("refers", F.lit(None).cast("long"))
    there = revisits.select(F.col("digest").alias("d"), F.col("id").alias("i"), F.col("refers").cast("long"))
    few = probed.where("maybe").drop("maybe")
    return clear.unionByName(few.join(there, F.expr("digest = d AND id <=> i"), "left").drop("d", "i"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0) -> None:
    """One record per row into WARC files below ``path``: of equal payloads of at least ``min_bytes`` one response, the others revisits."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(F.col(payload_col), F.lit("")).alias("body"))
    rows = _with_refers(rows.withColumn("digest", F.sha1(F.col("body").cast("binary"))), min_bytes)
    url = F.regexp_replace(F.regexp_replace(F.col("url"), r"\r", "%0D"), r"\n", "%0A")
    revisit = F.col("refers").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.col("body"))
    lines = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: <urn:"), F.coalesce(F.concat(F.lit("page:"), F.col("id").cast("string")), F.concat(F.lit("uuid:"), F.expr("uuid()"))),
        F.lit(">\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n")), F.lit("")),
        F.coalesce(F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers").cast("string"), F.lit(f">\r\nWARC-Profile: {PROFILE}\r\n")), F.lit("")),
        F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("digest")),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(block) + len(HTTP)).cast("string"), F.lit(END + HTTP), block)
    rows.select(lines.alias("value")).write.option("lineSep", END).text(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The bytes between magics, in order within a split: (file, block, value)."""
    rows = small_batches(spark.read.option("lineSep", MAGIC).text(path))
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.col("value").cast("binary").alias("value"))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def parse_record(seg: bytes) -> tuple[int, int, int | None, str | None, int, str | None, str, int | None] | None:
    """(header size, content length, id, url, payload bytes, digest, type, referred id) of a segment that starts a record, else None.

    Payload size and digest are -1 and None if the segment is not the whole record; a revisit has the digest of its header.
    """
    cut = seg.find(b"\r\n\r\n")
    if cut < 0:
        return None
    head = seg[:cut]
    length = _LENGTH.search(head)
    if not length:
        return None
    i, u, n = _ID.search(head), _URI.search(head), int(length[1])
    whole = len(seg) == cut + 4 + n + 4
    body = memoryview(seg)[cut + 4:cut + 4 + n]
    size, digest = payload_of(bytes(body)) if whole else (-1, None)
    t, r, d = _TYPE.search(head), _REFERS.search(head), _DIGEST.search(head)
    kind = t[1].decode() if t else "response"
    if kind == "revisit" and d:
        digest = d[1].decode()
    return (cut + 4, n, int(i[1]) if i else None, u[1].decode("utf-8", "replace") if u else None, size, digest, kind,
            int(r[1]) if r else None)


def payload_of(block: bytes) -> tuple[int, str]:
    """Size and digest of a block's payload, which follows the HTTP header."""
    cut = block.find(b"\r\n\r\n") if block.startswith(b"HTTP/") else -4
    payload = block[cut + 4:] if cut != -1 else b""
    return len(payload), payload_digest(payload)


_CAND = ("file string, block long, at long, size long, succ long, exit long, id long, url string, payload_bytes long, "
         "payload_digest string, record_type string, refers_to long, record boolean")


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Every segment with its place in its split, its successor and the first successor past the split.

    Offsets are relative to the split's first segment; one split's rows are held, without payloads.
    """
    key, at, rows = None, 0, []
    rows_at = {"id": 5, "refers_to": 10}

    def done() -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["file", "block", "at", "size", "succ", "id", "url", "payload_bytes", "payload_digest",
                                          "record_type", "refers_to", "record"])
        where = {a: i for i, a in enumerate(out["at"].tolist())}
        ends = out["succ"].tolist()
        for i in range(len(ends) - 1, -1, -1):  # successors lie behind
            ends[i] = ends[where[ends[i]]] if ends[i] in where and ends[i] > out["at"].iat[i] else ends[i]
        out.insert(5, "exit", np.array(ends, np.int64))
        for c in ("id", "refers_to"):
            out[c] = pd.array([r[rows_at[c]] for r in rows], "Int64")
        return out

    for b in batches:
        for f, block, value in zip(b.column("file").to_pylist(), b.column("block").to_pylist(), b.column("value")):
            if (f, block) != key:
                if rows:
                    yield done()
                key, at, rows = (f, block), 0, []
            seg = value.as_py() or b""
            r = parse_record(seg)
            # a candidate's own offset is that of the magic before its segment
            succ = at + _PAD + r[0] + r[1] + 4 if r else -1
            rows.append((f, block, at, len(seg), succ, *(r[2:] if r else (None, None, -1, None, None, None)), bool(r)))
            at += len(seg) + _PAD
    if rows:
        yield done()


def _as_batches(fn):
    """A function from Arrow batches to pandas frames, for mapInArrow."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("size", pa.int64()), ("succ", pa.int64()),
                        ("exit", pa.int64()), ("id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("record", pa.bool_())])

    def run(batches):
        for df in fn(batches):
            yield pa.RecordBatch.from_pandas(df, schema=schema, preserve_index=False)
    return run


def _walk(b: pd.DataFrame) -> pd.DataFrame:
    """The records of a split: the chain from its entry."""
    b = b.sort_values("at", kind="stable")
    off, succ = b["off"].to_numpy(), dict(zip(b["off"].tolist(), b["next"].tolist()))
    real, at = set(), int(b["entry"].iat[0])
    while at in succ and at not in real:
        real.add(at)
        at = succ[at]
    return b.loc[[o in real for o in off.tolist()], ["file", "off", "next"]]


def verified(cand: DataFrame) -> DataFrame:
    """Candidates (with absolute ``off``, ``next``, ``out``) that the chain from offset 0 of their file reaches."""
    jump = stored(cand.where("record").select("file", "off", F.col("out").alias("to")), "jumps")
    reached = jump.where("off = 0").select("file", "off")
    known = reached.count()
    while known:
        step = reached.join(jump, ["file", "off"]).select("file", F.col("to").alias("off")).join(jump.select("file", "off"), ["file", "off"])
        reached = stored(reached.union(step).distinct(), "reached")
        now = reached.count()
        if now == known:
            break
        known = now
        on = jump.select("file", F.col("off").alias("to"), F.col("to").alias("to2"))
        jump = stored(jump.join(on, ["file", "to"], "left").select("file", "off", F.coalesce("to2", "to").alias("to")), "jumps")
    entry = reached.withColumnRenamed("off", "entry").join(
        cand.select("file", "block", F.col("off").alias("entry")), ["file", "entry"])
    walk = cand.where("record").select("file", "block", "at", "off", "next").join(entry, ["file", "block"])
    return walk.groupBy("file", "block").applyInPandas(_walk, "file string, off long, next long")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """file, off, page_id, url, record_type, refers_to, payload_bytes and payload_digest of every record below ``path``."""
    segs = _segments(spark, path)
    cand = stored(segs.mapInArrow(_as_batches(_candidates), _CAND), "candidates")
    sizes = cand.groupBy("file", "block").agg(F.sum(F.col("size") + _PAD).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = stored(sizes.select("file", "block", "bytes", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base")), "splits")
    shift = F.col("base") - _PAD  # the first magic of a file is at 0, the segment before it is empty
    cand = (cand.join(base.select("file", "block", "base"), ["file", "block"])
                .select("*", (F.col("at") + shift).alias("off"), (F.col("succ") + shift).alias("next"), (F.col("exit") + shift).alias("out")))
    real = stored(verified(cand.where("off >= 0")), "records")
    records = cand.join(real.select("file", "off"), ["file", "off"]).select(
        "file", "off", "next", F.col("id").alias("page_id"), "url", "record_type", "refers_to", "payload_bytes", "payload_digest")

    # records whose payload holds the magic: their later segments are no records
    torn = stored(records.where("payload_bytes < 0").select("file", "off", "next"), "torn")
    if torn.isEmpty():
        return records.drop("next")
    spans = torn.join(base, "file").where("base - 10 < next AND base + bytes > off").select("file", "block", F.col("off").alias("of"), "next")
    parts = stored(cand.select("file", "block", "at", "off").join(spans, ["file", "block"]).where("off >= of AND off < next")
                   .select("file", "block", "at", "off", "of"), "parts")
    joined = _joined(segs, parts)
    return records.join(joined, ["file", "off"], "left").select(
        "file", "off", "page_id", "url", "record_type", "refers_to", F.coalesce("whole_bytes", "payload_bytes").alias("payload_bytes"),
        F.coalesce("whole_digest", "payload_digest").alias("payload_digest"))


def _joined(segs: DataFrame, parts: DataFrame) -> DataFrame:
    """Payload size and digest of the records in ``parts``; only their segments are shuffled."""
    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("at", pa.int64()), ("value", pa.binary())])

    def place(batches):
        key, at = None, 0
        for b in batches:
            where = []
            for f, block, size in zip(b.column("file").to_pylist(), b.column("block").to_pylist(),
                                      [len(v.as_buffer()) for v in b.column("value")]):
                if (f, block) != key:
                    key, at = (f, block), 0
                where.append(at)
                at += size + _PAD
            yield pa.RecordBatch.from_arrays([b.column("file"), b.column("block"), pa.array(where, pa.int64()), b.column("value")], schema=schema)

    placed = segs.mapInArrow(place, "file string, block long, at long, value binary")
    words = bloom.n_words(parts.count())
    key = F.xxhash64("file", "block", "at")
    some = stored(bloom.member_filter(bloom.with_bits(parts.select("file", "block", "at"), key, words)), "bloom")
    few = bloom.probe(bloom.with_bits(placed, key, words), some, "maybe").where("maybe")

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for f, o, ps in zip(b["file"], b["off"], b["ps"]):
                seg = MAGIC.encode().join(bytes(p["value"]) for p in sorted(ps, key=lambda p: p["off"]))
                head, n, *_ = parse_record(seg)
                out.append((f, o, *payload_of(seg[head:head + n])))
            yield pd.DataFrame(out, columns=["file", "off", "whole_bytes", "whole_digest"])

    rows = few.join(parts, ["file", "block", "at"]).select("file", F.col("of"), F.struct("off", "value").alias("p"))
    return (rows.groupBy("file", F.col("of").alias("off")).agg(F.collect_list("p").alias("ps"))
                .mapInPandas(whole, "file string, off long, whole_bytes long, whole_digest string"))


def with_revisits(records: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record, the size of a revisit from its response."""
    sizes = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(
        F.max("payload_bytes").alias("full"))
    revisit = F.col("record_type") == "revisit"
    cols = ["page_id", F.col("full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"]
    whole = records.where(~revisit).select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    return whole.union(records.where(revisit).join(sizes, ["refers_to", "payload_digest"], "left").select(*cols))


def op4_warc_boundary_chain(spark, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    return with_revisits(stored(read_warc(spark, path), "read"))


ship_by_value(__name__)

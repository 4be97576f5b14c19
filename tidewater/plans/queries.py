"""Queries bound to the driver tables, one per operator family.

Every query reads whole tables (no id subsets, no row caps) and returns
a lazy DataFrame; column names and types line up with the SQL in
:mod:`tidewater.plans.oracle`. Fixed ``as_of`` literals keep results
reproducible.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.text import two_decimals
from tidewater.functions.time import from_epoch, weekday_name
from tidewater.operators import aggregate as A
from tidewater.operators import audit as AU
from tidewater.operators import filters as FL
from tidewater.operators import joins as J
from tidewater.operators import keyed as K
from tidewater.operators import nested as N
from tidewater.operators import ordering as O
from tidewater.operators import shape as P
from tidewater.operators import timeseries as TS
from tidewater.operators.vector import vector_top_k
from tidewater.session import checkpoint_path, materialised, ship_by_value, spread

ship_by_value(__name__)  # the user handler below runs in Python workers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(v: str):
    return F.lit(v).cast("timestamp_ntz")


# ---------------------------------------------------------------- batch ETL

@query
def bucket_count(spark, d):
    """Balance band per customer, counted."""
    c = load(spark, d, "customer")
    c = P.bucket(c, "c_acctbal", [(0, "negative"), (1000, "low"), (5000, "mid")], "high", "balance_band")
    return A.count_by(c, "balance_band", out="n")


@query
def cast_clean(spark, d):
    """JSON text -> int, formatted text -> date, bad input -> NULL."""
    e = load(spark, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return P.cast_columns(e, {"k": "int", "day": ("date", "yyyy-MM-dd")})


@query
def label_in_count(spark, d):
    """P3 A2."""
    o = load(spark, d, "orders")
    o = P.label_in(o, "o_orderpriority", ["1-URGENT", "2-HIGH"], "rush", "normal", "priority_class")
    return A.count_by(o, "priority_class", out="n")


@query
def tenure_ratio(spark, d):
    """P5 A3: years since the order and price per (years + 1), averaged."""
    o = load(spark, d, "orders")
    o = P.tenure(o, "o_orderdate", "o_totalprice", as_of="2001-12-31", years_out="years",
                 ratio_out="ratio")
    return o.groupBy("o_orderstatus").agg(F.round(F.avg("years"), 4).alias("avg_years"),
                                          F.round(F.avg("ratio"), 4).alias("avg_ratio"))


@query
def defaults(spark, d):
    """Parts with returned quantity; parts never returned get 0."""
    p = load(spark, d, "part").select("p_partkey")
    r = (load(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
         .groupBy(F.col("l_partkey").alias("p_partkey"))
         .agg(F.sum("l_quantity").alias("returned_qty"), F.count(F.lit(1)).alias("returned_lines")))
    out = J.enrich(p, [(r, ["p_partkey"])])
    out = P.fill_defaults(out, {"returned_qty": 0.0, "returned_lines": 0})
    return out.select("p_partkey", F.round("returned_qty", 2).alias("returned_qty"), "returned_lines")


@query
def point_lookup(spark, d):
    """all events of one (user, type) key."""
    e = FL.get_item(load(spark, d, "events"), user_id=8, event_type="error")
    return e.select("event_id", "ts", "value")


@query
def key_query(spark, d):
    """one partition key."""
    return FL.query_key(load(spark, d, "events"), "user_id", 7).select("event_id", "event_type", "ts")


@query
def recent_rows(spark, d):
    """the last 24 hours before the as-of instant."""
    e = FL.where_recent(load(spark, d, "events"), "ts", 24, as_of="2024-01-30 00:00:00")
    return e.select("event_id", "ts")


@query
def prefix_contains(spark, d):
    """F5 U: name contains 'red' (any case) ∪ name starts with 'small'."""
    p = load(spark, d, "part").select("p_partkey", "p_name")
    a = FL.where_contains(p, "p_name", "RED", ignore_case=True).withColumn("match", F.lit("contains"))
    b = FL.where_prefix(p, "p_name", "small").withColumn("match", F.lit("prefix"))
    return a.unionByName(b)


@query
def url_prefix(spark, d):
    """secure pages."""
    return FL.where_prefix(load(spark, d, "pages"), "url", "https://").select("page_id", "url")


def _topics(e: DataFrame) -> DataFrame:
    t = (F.when(F.col("event_type").isin("click", "view"), F.concat(F.lit("sensors/"), "event_type"))
         .otherwise(F.concat(F.lit("weather/"), "event_type")))
    return e.withColumn("topic", t)


@query
def topic_filter(spark, d):
    """``sensors/#``."""
    e = _topics(load(spark, d, "events"))
    return FL.where_topic(e, "topic", "sensors/#").select("event_id", "topic")


@query
def topic_filter_level(spark, d):
    """single-level wildcard ``+/click``."""
    e = _topics(load(spark, d, "events"))
    return FL.where_topic(e, "topic", "+/click").select("event_id", "topic")


@query
def split_valid_counts(spark, d):
    """gate documents, count per reject reason ('ok' = valid)."""
    docs = load(spark, d, "documents").select("doc_id", "text", "n_chars")
    tagged = FL.tag_valid(docs, [
        ("missing_text", F.col("text").isNotNull()),
        ("too_short", F.col("n_chars") >= 50),
        ("too_long", F.col("n_chars") <= 20000),
    ])
    return A.count_by(tagged.withColumn("reason", F.coalesce("reject_reason", F.lit("ok"))), "reason", out="n")


@query
def mean_max_by_topic(spark, d):
    """A3 A4."""
    return load(spark, d, "events").groupBy("event_type").agg(
        F.round(F.avg("value"), 4).alias("avg_value"), F.max("value").alias("max_value"))


@query
def doc_totals(spark, d):
    """Documents and characters per source, largest first."""
    docs = load(spark, d, "documents")
    t = A.document_totals(docs, "n_chars", by=["source"])
    return O.newest_first(t, "total_count", tie=["source"])


@query
def gather_lines(spark, d):
    """Line items of each order as one sorted text and a count."""
    li = load(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(F.col("l_quantity") * 100).cast("bigint").alias("qty_cents"))
    g = A.gather(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "qty_cents"])
    txt = F.array_join(F.transform("items", lambda x: F.concat_ws(
        ":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"), x["qty_cents"].cast("string"))), ";")
    return g.select("l_orderkey", "n_items", txt.alias("items"))


@query
def count_rows(spark, d):
    """A1."""
    return A.row_count(load(spark, d, "lineitem"), out="n")


@query
def weekday_events(spark, d):
    """Scalar: English weekday name (Sunday = 1 as in dayofweek)."""
    e = load(spark, d, "events").select(weekday_name("ts").alias("weekday"))
    return A.count_by(e, "weekday", out="n")


# ------------------------------------------------------- metrics, alarms

@query
def metric_5min(spark, d):
    """5-minute statistics per event type in [start, end)."""
    s = TS.metric_statistics(load(spark, d, "events"), "ts", "value", by=["event_type"], period_s=300,
                             start="2024-01-02 00:00:00", end="2024-01-29 00:00:00")
    return s.select("period_start", "event_type", F.round("sum", 4).alias("sum"),
                    F.round("average", 4).alias("average"), "maximum", "minimum", "sample_count")


@query
def alarm_2x5min(spark, d):
    """Average > 100 for 2 consecutive 5-minute periods, per event type."""
    s = TS.metric_statistics(load(spark, d, "events"), "ts", "value", by=["event_type"], period_s=300,
                             stats=["Average"])
    a = TS.alarm(s, "Average", ">", 100.0, 2, by=["event_type"], period_s=300)
    return a.withColumn("average", F.round("average", 4))


@query
def alarm_silence(spark, d):
    """W1 over a range that ends after the data: Sum < 1 for 2 periods, silence breaches."""
    s = TS.metric_statistics(load(spark, d, "events"), "ts", "value", by=["event_type"], period_s=300, stats=["Sum"])
    a = TS.alarm(s, "Sum", "<", 1.0, 2, by=["event_type"], period_s=300, missing="breach",
                 start="2023-12-31 00:00:00", end="2024-02-02 00:00:00")
    return a.withColumn("sum", F.round("sum", 4))


@query
def anomalies_z3(spark, d):
    """Values more than 3 standard deviations from their type's mean."""
    e = load(spark, d, "events").select("event_id", "event_type", "value")
    a = TS.anomalies(e, "value", by=["event_type"], z=3.0)
    return a.filter("is_anomaly").select("event_id", F.round("z_score", 4).alias("z_score"))


@query
def monthly_cost(spark, d):
    """A8."""
    m = J.monthly_cost(load(spark, d, "orders"), "o_orderdate", "o_totalprice", by=["o_orderstatus"])
    return m.select(F.col("month").cast("timestamp_ntz").alias("month"), "o_orderstatus",
                    F.round("cost", 2).alias("cost"))


@query
def cost_rollup(spark, d):
    """Quantity × list price per brand (usage pre-summed per part)."""
    li = load(spark, d, "lineitem")
    prices = load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice", "p_brand")
    c = J.cost_rollup(li, prices, "l_partkey", "l_quantity", "p_retailprice", by=["p_brand"])
    return c.select("p_brand", F.round("cost", 2).alias("cost"))


# ------------------------------------------------------------ keyed tables

@query
def upsert_latest(spark, d):
    """K2: first half of January as the table, the rest as changes."""
    e = load(spark, d, "events").select("user_id", "event_type", "event_id", "ts", "value")
    cut = _ntz("2024-01-15 00:00:00")
    base, changes = e.filter(F.col("ts") < cut), e.filter(F.col("ts") >= cut)
    return K.upsert(base, changes, ["user_id", "event_type"], order_by=["ts", "event_id"])


@query
def update_status(spark, d):
    """K3: orders with a returned line get status RETURNED (created if absent)."""
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    patch = (load(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
             .select(F.col("l_orderkey").alias("o_orderkey"), F.lit("RETURNED").alias("o_orderstatus")))
    return K.update_by_key(o, patch, ["o_orderkey"], ["o_orderstatus"], created_col="created")


@query
def status_depth(spark, d):
    """Pending orders ('P') per priority."""
    return A.queue_depth(load(spark, d, "orders"), "o_orderstatus", by=["o_orderpriority"], waiting="P")


@query
def delete_keys(spark, d):
    """K4: drop orders of customers with a negative balance."""
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    neg = load(spark, d, "customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return K.delete_by_key(o, neg, ["o_custkey"])


@query
def latest_order(spark, d):
    """Newest order per customer (ties: higher order key)."""
    o = load(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return K.latest(o, "o_orderdate", by=["o_custkey"], tie=["o_orderkey"])


@query
def expire_rows(spark, d):
    """Events kept by a 7-day retention at the as-of instant."""
    return K.expire(load(spark, d, "events"), "ts", 7 * 86400, as_of="2024-01-30 00:00:00").select("event_id")


@query
def dedup_exact(spark, d):
    """One document per distinct text (lowest id) with its copy count."""
    docs = load(spark, d, "documents").select("doc_id", "text")
    return K.dedup_text(docs, "text", "doc_id", "n_copies", keep=["doc_id"])


# -------------------------------------------------------------- joins

@query
def enrich_left(spark, d):
    """Customers with nation name and order totals (0 when none)."""
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, d, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    o = (load(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
         .agg(F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total_spent")))
    e = P.fill_defaults(J.enrich(c, [(n, ["c_nationkey"]), (o, ["c_custkey"])]),
                        {"n_orders": 0, "total_spent": 0.0})
    return e.select("c_custkey", "n_name", "n_orders", F.round("total_spent", 2).alias("total_spent"))


@query
def has_lacks(spark, d):
    """Customers with / without a pending order since 2000."""
    c = load(spark, d, "customer").select("c_custkey")
    pend = (load(spark, d, "orders")
            .filter((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") >= _ntz("2000-01-01 00:00:00")))
            .select(F.col("o_custkey").alias("c_custkey")))
    has = AU.with_mfa(c, pend, "c_custkey").withColumn("status", F.lit("has"))
    lacks = AU.without_mfa(c, pend, "c_custkey").withColumn("status", F.lit("lacks"))
    return has.unionByName(lacks)


@query
def lineage_chain(spark, d):
    """Supplier -> nation (direct) ∪ supplier -> nation -> region (via)."""
    s = load(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n = load(spark, d, "nation")
    r = load(spark, d, "region")
    member = s.join(n.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), on="s_nationkey")
    direct = member.select("s_suppkey", F.col("n_name").alias("item"))
    gp = n.join(r.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), on="n_regionkey") \
          .select("n_name", F.col("r_name").alias("item"))
    via = AU.group_policies(member, gp, user_col="s_suppkey", group_col="n_name", policy_col="item")
    return AU.user_permissions(direct, via, user_col="s_suppkey", policy_col="item")


@query
def findings(spark, d):
    """Negative-balance and inactive customers, first 3 per kind + M more."""
    c = load(spark, d, "customer").select("c_custkey", "c_acctbal")
    last = (load(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
            .agg(F.max("o_orderdate").alias("last_order")))
    as_of = _ntz("2001-08-31 00:00:00")
    days = F.timestamp_diff("DAY", F.col("last_order"), as_of)
    cl = c.join(last, on="c_custkey", how="left")
    item = lambda kind, cond, detail: F.when(cond, F.struct(F.lit(kind).alias("kind"), detail.cast("bigint").alias("detail")))
    arr = F.array(item("negative_balance", F.col("c_acctbal") < 0, F.round(F.col("c_acctbal") * 100)),
                  item("inactive", days > 90, days))
    f = cl.select("c_custkey", F.explode(F.filter(arr, lambda x: x.isNotNull())).alias("f")).select(
        "c_custkey", "f.kind", "f.detail")
    top = O.first_n(f, 3, order=["c_custkey"], by=["kind"])
    return top.select("kind", F.col("rank").cast("bigint").alias("rank"), "c_custkey", "detail", "total", "more")


@query
def top_balances(spark, d):
    """W5 global: ten largest balances, total and "M more"."""
    c = load(spark, d, "customer").select("c_custkey", "c_acctbal")
    t = O.first_n(c, 10, order=[F.col("c_acctbal").desc(), F.col("c_custkey").asc()])
    return t.select(F.col("rank").cast("bigint").alias("rank"), "c_custkey", "c_acctbal", "total", "more")


# ------------------------------------------------------------- nested

def _envelopes(e: DataFrame) -> DataFrame:
    eid = F.col("event_id").cast("string")
    env = (F.when(F.col("event_type") == "click",
                  F.concat(F.lit('{"httpMethod":"POST","path":"/events/'), eid, F.lit('","body":"{}"}')))
           .when(F.col("event_type") == "view",
                 F.concat(F.lit('{"Records":[{"eventName":"ObjectCreated:Put","s3":{"bucket":{"name":"b"},'
                                '"object":{"key":"k'), eid, F.lit('"}}}]}')))
           .when(F.col("event_type") == "purchase",
                 F.concat(F.lit('{"Records":[{"eventName":"INSERT","dynamodb":{"NewImage":{"id":{"N":"'), eid,
                          F.lit('"}}}}]}')))
           .when(F.col("event_type") == "signup", F.lit('{"source":"aws.events","detail-type":"Scheduled Event"}'))
           .when(F.col("value") > 100, F.lit('{"Records":[{"eventSource":"aws:sqs","body":"x"}]}'))
           .otherwise(F.lit('{"Records":[]}')))
    return e.select("event_id", env.alias("envelope"))


@query
def classify_events(spark, d):
    """Envelopes derived from each event, classified."""
    env = _envelopes(spread(load(spark, d, "events").select("event_id", "event_type", "value")))
    return N.classify_events(env, "envelope").select("event_id", "kind")


@query
def explode_records(spark, d):
    """Every line item becomes a storage event with two records (part
    object, supplier object); records exploded and keys decoded."""
    # spread the narrow scan before the bodies are built: the shuffle then
    # moves four integers per row instead of a JSON text
    li = spread(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    rec = lambda bucket, key: F.concat(
        F.lit('{"eventName":"ObjectCreated:Put","s3":{"bucket":{"name":"'), bucket,
        F.lit('"},"object":{"key":"'), key, F.lit('"}}}'))
    body = F.concat(F.lit('{"Records":['),
                    rec(F.lit("parts"), F.concat(F.lit("part+"), F.col("l_partkey").cast("string"), F.lit("%20file.json"))),
                    F.lit(","),
                    rec(F.concat(F.lit("supp-"), F.col("l_suppkey").cast("string")),
                        F.concat(F.lit("line%20"), F.col("l_linenumber").cast("string"))),
                    F.lit("]}"))
    ev = li.select("l_orderkey", "l_linenumber", body.alias("body"))
    return N.explode_records(ev, "body", keep=["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "event_name", "bucket", "key")


@query
def flatten_two(spark, d):
    """Each order as a listing with two reservations (one empty); the
    first holds a tagged instance and a bare one."""
    o = spread(load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))
    inst_t = "struct<InstanceId: string, InstanceType: string, State: struct<Name: string>, " \
             "PublicIpAddress: string, Placement: struct<AvailabilityZone: string>, LaunchTime: string, " \
             "Tags: array<struct<Key: string, Value: string>>>"
    key = F.col("o_orderkey").cast("string")
    a = F.struct(F.concat(F.lit("i-"), key, F.lit("-a")).alias("InstanceId"), F.col("o_orderstatus").alias("InstanceType"),
                 F.struct(F.lit("running").alias("Name")).alias("State"), F.lit(None).cast("string").alias("PublicIpAddress"),
                 F.struct(F.lit(None).cast("string").alias("AvailabilityZone")).alias("Placement"),
                 F.lit(None).cast("string").alias("LaunchTime"),
                 F.array(F.struct(F.lit("Owner").alias("Key"), F.col("o_custkey").cast("string").alias("Value")),
                         F.struct(F.lit("Name").alias("Key"), F.col("o_orderpriority").alias("Value"))).alias("Tags")
                 ).cast(inst_t)
    b = F.struct(F.concat(F.lit("i-"), key, F.lit("-b")).alias("InstanceId")).cast(
        "struct<InstanceId: string>")
    b = F.struct(b["InstanceId"].alias("InstanceId"), F.lit(None).cast("string").alias("InstanceType"),
                 F.lit(None).cast("struct<Name: string>").alias("State"), F.lit(None).cast("string").alias("PublicIpAddress"),
                 F.lit(None).cast("struct<AvailabilityZone: string>").alias("Placement"),
                 F.lit(None).cast("string").alias("LaunchTime"),
                 F.array().cast("array<struct<Key: string, Value: string>>").alias("Tags")).cast(inst_t)
    res = F.array(F.struct(F.array(a, b).alias("Instances")),
                  F.struct(F.array().cast(f"array<{inst_t}>").alias("Instances")))
    listing = o.select(res.alias("Reservations"))
    return N.flatten_instances(listing, "Reservations").select("instance_id", "instance_type", "state", "name", "zone")


@query
def decode_attributes(spark, d):
    """Type-tagged attribute JSON built from each order, decoded back."""
    o = spread(load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"))
    doc = F.concat(F.lit('{"key":{"N":"'), F.col("o_orderkey").cast("string"), F.lit('"},"status":{"S":"'),
                   F.col("o_orderstatus"), F.lit('"},"price":{"N":"'), F.col("o_totalprice").cast("string"), F.lit('"}}'))
    a = N.decode_attributes(o.select(doc.alias("image")), "image",
                            {"key": "bigint", "status": "string", "price": "double"})
    return a.select(F.col("key").alias("o_orderkey"), F.col("status").alias("o_orderstatus"),
                    F.col("price").alias("o_totalprice"))


@query
def sections(spark, d):
    """Numbered lines of every document, trimmed; a blank one is titled by its number."""
    docs = load(spark, d, "documents").select("doc_id", "text")
    s = N.sections(docs, "text", ["doc_id"], sep="\n")
    return s.select("doc_id", F.col("section_no").cast("bigint").alias("section_no"), "title")


@query
def assemble_turns(spark, d):
    """Each conversation's turns joined in order ("role: text" lines)."""
    cv = load(spark, d, "conversations").select(
        "conv_id", "turn", F.concat("role", F.lit(": "), "text").alias("line"))
    return N.ordered_concat(cv, ["conv_id"], "turn", "line", sep="\n", out="text")


@query
def chat_history(spark, d):
    """All turns ordered by conversation and turn."""
    return O.chat_history(load(spark, d, "conversations")).select("conv_id", "turn", "role", "text")


@query
def chat_stats(spark, d):
    """Rows, conversations, text sizes per role."""
    cv = load(spark, d, "conversations").withColumn("n_chars", F.length("text"))
    s = A.table_stats(cv, size_col="n_chars", key_col="conv_id", by=["role"])
    return s.select("role", "n_rows", "n_keys", F.col("total_size").cast("bigint").alias("total_size"),
                    F.round("avg_size", 4).alias("avg_size"), F.col("max_size").cast("bigint").alias("max_size"))


@query
def request_reply(spark, d):
    """Request JSON per user turn; the prompt read back out of it."""
    cv = load(spark, d, "conversations").filter(F.col("role") == "user")
    r = P.build_requests(cv, "text", "Summarise:", max_tokens=256)
    r = P.extract_reply(r, "request", "$.messages[0].content", out="content")
    return r.select("conv_id", "turn",
                    F.get_json_object("request", "$.max_tokens").cast("bigint").alias("max_tokens"),
                    F.length("content").cast("bigint").alias("content_chars"))


@query
def render_template(spark, d):
    """One text line per order."""
    o = load(spark, d, "orders")
    return P.render(o, "Order {o_orderkey} for customer {o_custkey}: {o_orderstatus}", "text").select(
        "o_orderkey", "text")


@query
def latest_suffix(spark, d):
    """Customer name with the largest number per market segment."""
    return O.latest_suffix(load(spark, d, "customer"), "c_name", by=["c_mktsegment"])


@query
def leaderboard(spark, d):
    """Top-5 users by summed value within each event type (rank)."""
    e = (load(spark, d, "events").groupBy("event_type", "user_id")
         .agg(F.round(F.sum("value"), 2).alias("total")))
    lb = O.leaderboard(e, ["event_type"], "total", 5, method="rank")
    return lb.select("event_type", F.col("rank").cast("bigint").alias("rank"), "user_id", "total")


# ------------------------------------------------------ retrieval, ML

@query
def vector_top5(spark, d):
    """Exact cosine top-5 neighbours of every embedding (self excluded)."""
    e = load(spark, d, "embeddings")
    t = vector_top_k(e, e, k=5, exclude_self=True)
    return t.select("query_id", F.col("rank").cast("bigint").alias("rank"), "neighbor_id",
                    F.round("similarity", 4).alias("similarity"))


@query
def eval_report(spark, d):
    """A10: per-class report, 'toxic' scored as a prediction of 'quality'."""
    r = A.classification_report(load(spark, d, "labels"), "quality", "toxic")
    return r.select("class", F.round("precision", 4).alias("precision"), F.round("recall", 4).alias("recall"),
                    F.round("f1", 4).alias("f1"), "support")


@query
def eval_accuracy(spark, d):
    """Accuracy in percent of the same pairing."""
    e = A.evaluate(load(spark, d, "labels"), "quality", "toxic")
    return e.select("n", F.round("accuracy_pct", 4).alias("accuracy_pct"))


@query
def profile(spark, d):
    """One-pass profile of the numeric order columns."""
    p = A.profile(load(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"])
    return p.select("column", "n", "nulls", "n_distinct", "min", "max",
                    F.round("mean", 2).alias("mean"), F.round("stddev", 2).alias("stddev"))


@query
def profile_orders(spark, d):
    """Profile of every column of orders, text and dates too."""
    p = A.profile(load(spark, d, "orders"))
    return p.select("column", "n", "nulls", "n_distinct", "min", "max", F.round("mean", 2).alias("mean"),
                    F.round("stddev", 2).alias("stddev"), "min_text", "max_text")


# -------------------------------------------------------------- identity audit

def _trust_docs(s: DataFrame) -> DataFrame:
    k, n = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    principal = (F.when(F.col("s_nationkey") == 0, F.lit('"*"'))
                 .when(F.col("s_acctbal") < 0,
                       F.concat(F.lit('{"Service": ["svc-'), n, F.lit('", "svc-'), k, F.lit('", "a", "b"]}')))
                 .otherwise(F.concat(F.lit('{"AWS": "arn:'), k, F.lit('"}'))))
    doc = F.concat(F.lit('{"Version": "2012-10-17", "Statement": [{"Effect": "Allow", "Principal": '), principal,
                   F.lit(', "Action": "sts:AssumeRole"}]}'))
    return s.select("s_suppkey", doc.alias("trust_policy"))


@query
def trust_principals(spark, d):
    """Trust principals (list or scalar) per supplier-derived role."""
    roles = _trust_docs(load(spark, d, "supplier"))
    t = AU.trust_principals(roles, "trust_policy", "s_suppkey")
    return t.select("s_suppkey", "type", "shown", F.size("principals").cast("bigint").alias("n_principals"))


@query
def wildcard_statements(spark, d):
    """Allow statements with a '*' action in part-derived policies."""
    p = load(spark, d, "part")
    act = (F.when(F.col("p_size") > 40, F.lit('"*"'))
           .when(F.col("p_size") < 5, F.lit('["s3:GetObject", "*"]'))
           .otherwise(F.lit('["s3:GetObject"]')))
    doc = F.concat(F.lit('{"Statement": [{"Effect": "Allow", "Action": '), act,
                   F.lit('}, {"Effect": "Deny", "Action": "*"}]}'))
    w = AU.wildcard_statements(p.select("p_partkey", doc.alias("document")), "document", "p_partkey")
    return w.select("p_partkey", F.col("statement_no").cast("bigint").alias("statement_no"))


# Columns of the credential report built from each customer.
REPORT_SCHEMA = ("user string, mfa_active string, password_enabled string, password_last_used string, "
                 "access_key_1_active string, access_key_2_active string")


@query
def credential_audit(spark, d):
    """A two-line CSV credential report per customer, parsed and audited."""
    c = load(spark, d, "customer")
    tf = lambda cond: F.when(cond, F.lit("true")).otherwise(F.lit("false"))
    last = F.concat(F.lit("2001-0"), (F.pmod(F.col("c_custkey"), F.lit(9)) + 1).cast("string"),
                    F.lit("-15T00:00:00+00:00"))
    # the columns in another order than the schema, with one that nobody asked for
    line = F.concat_ws(",", tf(F.col("c_nationkey") < 5), F.lit('"arn:x, ""y"""'), last, F.col("c_name"), tf(F.col("c_acctbal") >= 0),
                       tf(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")), F.lit("true"))
    header = "access_key_2_active,arn,password_last_used,user,mfa_active,access_key_1_active,password_enabled"
    docs = c.select(F.concat(F.lit(header + "\n"), line, F.lit("\n")).alias("content"))
    report = AU.explode_csv_text(docs, "content", REPORT_SCHEMA)
    return AU.credential_findings(report, as_of="2001-12-31 00:00:00", max_days=90)


# ------------------------------------------------------- ML (rows-only check)

@query
def ml_split_sizes(spark, d):
    """M1: repeatable 80/20 hash split of the orders, sizes per side."""
    from tidewater.operators import ml as M
    o = load(spark, d, "orders")
    tr, te = M.split(o, "o_orderkey", 0.2, 42)
    return (tr.select(F.lit("train").alias("side")).unionByName(te.select(F.lit("test").alias("side")))
            .groupBy("side").agg(F.count(F.lit(1)).alias("n")))


@query
def kmeans_sizes(spark, d):
    """K-means (k = 10, seed 42) over the embeddings; cluster sizes."""
    from tidewater.operators import ml as M
    e = load(spark, d, "embeddings").select("vec_id", "embedding")
    return M.cluster(e, "embedding", 10, seed=42).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query
def forest_eval(spark, d):
    """80/20 hash split of the embeddings, random forest
    (100 trees, seed 42) on the vector, accuracy on the held-out part."""
    from tidewater.operators import ml as M
    e = load(spark, d, "embeddings").select("vec_id", "label", "embedding")
    train, test = M.split(e, "vec_id", 0.2, 42)
    model = M.train_forest(train, "embedding", "label", num_trees=100, seed=42)
    pred = M.predict(model, test, keep=["label"], features="embedding")
    return A.evaluate(pred.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction")


# ------------------------------------------------ more single-operator bindings

@query
def pick_stamp(spark, d):
    """Renamed projection of the customers plus a fixed processing date."""
    c = P.pick(load(spark, d, "customer"), {"id": "c_custkey", "name": "c_name", "segment": "c_mktsegment"})
    return P.stamp(c, "processing_date", "date", as_of="2024-01-01")


def _requests(c: DataFrame) -> DataFrame:
    """Notification requests derived from customers, in the three accepted
    shapes (JSON text under body, object under body, bare object) plus broken
    JSON for negative balances."""
    who = F.concat(F.lit("cust"), F.col("c_custkey").cast("string"), F.lit("@example.com"))
    seg = F.col("c_mktsegment")
    body = (F.when(F.col("c_acctbal") < 0, F.concat(F.lit('{"body": "{broken'), who))
            .when(seg == "BUILDING", F.concat(F.lit('{"body": "{\\"recipient\\": \\"'), who,
                                              F.lit('\\", \\"type\\": \\"sms\\"}"}')))
            .when(seg == "MACHINERY", F.concat(F.lit('{"body": {"subject": "Hi '), F.col("c_name"), F.lit('"}}')))
            .otherwise(F.concat(F.lit('{"message": "Hello '), F.col("c_name"), F.lit('", "recipient": "'), who,
                                F.lit('"}'))))
    return c.select("c_custkey", body.alias("request"))


@query
def notifications(spark, d):
    """Request bodies normalised to notification rows."""
    r = _requests(load(spark, d, "customer"))
    n = P.normalise_notifications(r, "request", as_of="2024-01-01 00:00:00")
    return n.select("c_custkey", "message_id", "recipient", "subject", "message", "notification_type", "status",
                    "reject_reason")


@query
def where_eq_signup(spark, d):
    """equality on a non-key attribute."""
    return FL.where_eq(load(spark, d, "events"), "event_type", "signup").select("event_id", "user_id")


@query
def tagged_parts(spark, d):
    """F8: parts whose tag list holds type = ECONOMY."""
    p = load(spark, d, "part")
    tags = F.array(F.struct(F.lit("brand").alias("Key"), F.col("p_brand").alias("Value")),
                   F.struct(F.lit("type").alias("Key"), F.col("p_type").alias("Value")))
    return FL.where_tag(p.select("p_partkey", tags.alias("tags")), "tags", "type", "ECONOMY").select("p_partkey")


@query
def value_errors(spark, d):
    """per-record conversion errors isolated in an error column."""
    e = load(spark, d, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.lit("n/a"))
        .otherwise(F.col("value").cast("string")).alias("value_text"))
    out = FL.isolate_errors(e, {"value_num": (F.col("value_text").try_cast("double"), "value_text")})
    return out.select("event_id", "value_num", "error")


@query
def clean_documents(spark, d):
    """drop-null / fill / rule gate over documents, counted per outcome."""
    docs = load(spark, d, "documents").select("doc_id", "text", "lang", "n_chars")
    good, bad = FL.clean(docs, drop_null=["text"], fill={"lang": "unknown"},
                         rules=[("too_short", F.col("n_chars") >= 50)])
    g = good.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).withColumn("outcome", F.lit("kept"))
    b = bad.groupBy(F.col("reject_reason").alias("lang")).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("outcome", F.lit("rejected"))
    return g.unionByName(b)


@query
def enrich_roles(spark, d):
    """Nations as roles with their suppliers as an attached-policy list."""
    roles = load(spark, d, "nation").select(F.col("n_name").alias("RoleName"), "n_nationkey")
    pol = (load(spark, d, "supplier").join(load(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
           .select(F.col("n_name").alias("RoleName"), F.col("s_name").alias("PolicyName"),
                   F.col("s_suppkey").cast("string").alias("PolicyArn")))
    r = AU.enrich_roles(roles, pol)
    return r.select("RoleName", F.size("policies").cast("bigint").alias("n_policies"),
                    F.get(F.col("policies"), 0)["PolicyName"].alias("first_policy"))


@query
def attach_object_info(spark, d):
    """Line-item 'events' joined to the part 'inventory' (size)."""
    ev = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.lit("parts").alias("bucket"),
                                           F.col("l_partkey").alias("key"))
    inv = load(spark, d, "part").select(F.lit("parts").alias("bucket"), F.col("p_partkey").alias("key"),
                                        F.col("p_size").alias("size"))
    return J.attach_object_info(ev, inv).select("l_orderkey", "l_linenumber", "key", "size")


def _report(c: DataFrame) -> DataFrame:
    tf = lambda cond: F.when(cond, F.lit("true")).otherwise(F.lit("false"))
    return c.select(F.col("c_name").alias("user"),
                    tf(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).alias("access_key_1_active"),
                    tf(F.col("c_nationkey") < 5).alias("access_key_2_active"))


@query
def active_keys(spark, d):
    """Users with active access keys and how many."""
    return AU.active_keys(_report(load(spark, d, "customer")))


@query
def sort_orders(spark, d):
    """Orders in ascending time (ties by key)."""
    return O.sort_by(load(spark, d, "orders").select("o_orderkey", "o_orderdate"), ["o_orderdate", "o_orderkey"])


@query
def object_versions(spark, d):
    """Part 'versions' with small parts also listed as delete markers."""
    p = load(spark, d, "part").select(F.col("p_partkey").alias("key"), F.col("p_size").alias("size"))
    return J.object_versions(p, p.filter(F.col("size") < 3))


@query
def describe_nations(spark, d):
    """Every nation listed; facts only where rich customers exist, else 'not found'."""
    n = load(spark, d, "nation").select(F.col("n_name").alias("table_name"), "n_nationkey")
    facts = (load(spark, d, "customer").filter(F.col("c_acctbal") > 9900)
             .join(load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
             .groupBy(F.col("n_name").alias("table_name")).agg(F.count(F.lit(1)).alias("items")))
    return N.describe_tables(n, facts)


@query
def join_list_names(spark, d):
    """Name parts as a list, joined back with a separator."""
    c = load(spark, d, "customer").select("c_custkey", F.split("c_name", "#").alias("parts"))
    return N.join_list(c, "parts", " / ", out="display").select("c_custkey", "display")


# ----------------------------------------------- ML (rows-only check)

@query
def shuffle_orders(spark, d):
    """M6: seeded, repeatable order of the orders."""
    from tidewater.operators import ml as M
    return M.shuffle(load(spark, d, "orders").select("o_orderkey"), "o_orderkey", 7)


@query
def drift_totalprice(spark, d):
    """M7: population stability of order prices, first half of the period vs the second."""
    from tidewater.operators import ml as M
    o = load(spark, d, "orders")
    cut = _ntz("1998-05-01 00:00:00")
    return M.drift(o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut), "o_totalprice")


@query
def pca_embeddings(spark, d):
    """First 3 principal components of every embedding."""
    from tidewater.operators import ml as M
    return M.reduce(load(spark, d, "embeddings").select("vec_id", "embedding"), "embedding", 3)


@query
def order_json(spark, d):
    """Each order as JSON text, its decimal price written as a number."""
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus",
                                        F.col("o_totalprice").cast("decimal(12,2)").alias("price"))
    return N.as_json(o, ["o_orderkey", "o_orderstatus", "price"], out="json", keep=["o_orderkey"])


def _event_handler(events: pd.DataFrame) -> pd.DataFrame:
    """A user handler on batches: error events are rejected, values classed."""
    bad = events["event_type"] == "error"
    kind = (events["value"] > 100).map({True: "high", False: "low"})
    return pd.DataFrame({"value_class": kind.where(~bad, None), "error": bad.map({True: "ValueError: rejected", False: None})})


@query
def event_handler(spark, d):
    """User handler on batches of events (mapInPandas); failures isolated per record."""
    from tidewater.operators import ml as M
    e = load(spark, d, "events").select("event_id", "event_type", "value")
    return M.apply_handler(e, _event_handler, "value_class string", keep=["event_id"])


@query
def logistic_eval(spark, d):
    """Logistic regression on the whole embedding,
    label 'label < 5', accuracy on the 20% hash split."""
    from tidewater.operators import ml as M
    e = load(spark, d, "embeddings").select("vec_id", (F.col("label") < 5).cast("int").alias("y"), "embedding")
    train, test = M.split(e, "vec_id", 0.2, 42)
    model = M.train_linear(train, "embedding", "y", kind="logistic")
    pred = M.predict(model, test, keep=["y"], features="embedding").withColumn("prediction", F.col("prediction").cast("int"))
    return A.evaluate(pred, "y", "prediction")


@query
def event_metrics(spark, d):
    """K7: every event as a metric row (namespace, name, value, unit, time,
    dimensions); the event-type dimension read back from the map."""
    from tidewater.sinks import to_metrics
    e = load(spark, d, "events")
    m = to_metrics(e, "App/Events", "Value", "value", "ts", unit="None", dims={"EventType": "event_type"})
    return m.select("namespace", "metric_name", "value", "unit", "timestamp",
                    F.col("dimensions")["EventType"].alias("event_type"))


@query
def event_logs(spark, d):
    """K8: every event as a log row: epoch-ms time and a JSON message."""
    from tidewater.sinks import to_log_rows
    e = load(spark, d, "events")
    return to_log_rows(e, "/app/events", "stream-1", "event_type", "ts", source="tidewater")


# ------------------------------------------- keyed changes, ranks, long lists

@query
def apply_change_log(spark, d):
    """Change records of customers (one an order, eight a message), applied to a bucketed keyed table in three batches."""
    from tidewater.streaming import jobs, tables
    o = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"))
    value = lambda s, n: F.struct(s.cast("string").alias("S"), n.cast("string").alias("N"))
    none = F.lit(None)
    key = F.create_map(F.lit("custkey"), value(none, F.col("o_custkey")))
    image = F.create_map(F.lit("custkey"), value(none, F.col("o_custkey")), F.lit("status"), value(F.col("o_orderstatus"), none),
                         F.lit("cents"), value(none, F.col("cents")))
    kind = F.when(F.col("o_orderkey") % 7 == 0, "REMOVE").when(F.col("o_orderkey") % 7 < 4, "INSERT").otherwise("MODIFY")
    record = F.struct(kind.alias("eventName"), F.struct(F.col("o_orderkey").cast("string").alias("SequenceNumber"), key.alias("Keys"),
                                                        F.when(kind != "REMOVE", image).alias("NewImage")).alias("dynamodb"))
    messages = o.select(F.floor(F.col("o_orderkey") / 8).alias("m"), record.alias("r")).groupBy("m").agg(F.collect_list("r").alias("Records"))
    messages = messages.select("m", F.to_json(F.struct("Records")).alias("value"))
    schema = {"custkey": "bigint", "status": "string", "cents": "bigint"}
    third = (o.agg(F.max("o_orderkey")).first()[0] or 0) // 24 + 1
    path = checkpoint_path(spark, f"change-log-{uuid.uuid4().hex}")
    rows = materialised(jobs.change_rows(messages, "value", ["custkey"], schema, ["m"]), "changes")
    for i in range(3):
        m = F.col("_pos")["m"]
        jobs.apply_change_rows(rows.where((m >= third * i) & (m < third * (i + 1))), path, ["custkey"], schema, i, buckets=8)
    return tables.read_table(spark, path).select(*schema)


@query
def top5000_prices(spark, d):
    """W9 beyond Spark's own group limit: the 5000 highest orders of each status."""
    o = load(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_totalprice")
    lb = O.leaderboard(o, ["o_orderstatus"], "o_totalprice", 5000, method="rank", tie=["o_orderkey"])
    return lb.withColumn("rank", F.col("rank").cast("bigint"))


@query
def price_ranks(spark, d):
    """W9 over all rows: rank and dense rank of every order by price."""
    return O.rank_all(load(spark, d, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice"], descending=True, dense_col="dense_rank").select(
        "o_orderkey", F.col("rank").cast("bigint").alias("rank"), F.col("dense_rank").cast("bigint").alias("dense_rank"))


@query
def gather_chunks(spark, d):
    """The line items of each return flag (a third of all rows and more) as lists of 5000."""
    g = A.gather_chunks(load(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber"), ["l_returnflag"],
                        ["l_orderkey", "l_linenumber"], 5000, F.lit(1))
    return g.select("l_returnflag", "chunk", "n_items", F.get("items", F.lit(0))["l_orderkey"].alias("first_order"),
                    F.element_at("items", -1)["l_orderkey"].alias("last_order"),
                    F.aggregate("items", F.lit(0).cast("bigint"), lambda a, x: a + x["l_linenumber"]).alias("lines"))


@query
def role_chunks(spark, d):
    """Nations as roles with their customers as attached policies, 50 a row."""
    n = load(spark, d, "nation").select(F.col("n_name").alias("RoleName"), "n_nationkey")
    pol = (load(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
           .select("RoleName", F.col("c_name").alias("PolicyName"), F.col("c_custkey").cast("string").alias("PolicyArn")))
    r = AU.role_policy_chunks(n.unionByName(spark.createDataFrame([("NOWHERE", -1)], "RoleName string, n_nationkey long"), allowMissingColumns=True)
                              .select("RoleName"), pol, chunk=50)
    return r.select("RoleName", "chunk", "n_policies", F.get(F.col("policies"), F.lit(0))["PolicyName"].alias("first_policy"))


@query
def drift_width(spark, d):
    """M7 with equal-width bins: population stability of order prices, first half of the period vs the second."""
    from tidewater.operators import ml as M
    o = load(spark, d, "orders")
    cut = _ntz("1998-05-01 00:00:00")
    return M.drift(o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut), "o_totalprice", edges="width").select(
        F.round("psi", 8).alias("psi"))


# ------------------------------------ operators bound one by one to a table

@query
def enrich_users(spark, d):
    """Customers as users, those with a balance have a console, their orders are access keys."""
    users = load(spark, d, "customer").select(F.col("c_name").alias("UserName"), "c_custkey")
    profiles = load(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_name").alias("UserName"))
    keys = load(spark, d, "orders").join(users, F.col("o_custkey") == F.col("c_custkey")).select("UserName", F.col("o_orderkey").cast("string").alias("AccessKeyId"))
    return AU.enrich_users(users.select("UserName"), profiles, keys).select(
        F.col("UserName").alias("user"), "has_console", F.col("n_keys").cast("bigint").alias("n_keys"), F.array_join("access_keys", ",").alias("access_keys"))


@query
def average_quantity(spark, d):
    """A3: mean quantity of each return flag and line status."""
    return A.average(load(spark, d, "lineitem"), "l_quantity", "average", by=["l_returnflag", "l_linestatus"]).withColumn("average", F.round("average", 6))


@query
def maximum_value(spark, d):
    """A4: largest value of each event type."""
    return A.maximum(load(spark, d, "events"), "value", "maximum", by=["event_type"])


@query
def assemble_chunks(spark, d):
    """Line items as streamed reply chunks; only content_block_delta chunks make the text."""
    li = load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_json(F.struct(
        F.when(F.col("l_linenumber") == 1, "message_start").otherwise("content_block_delta").alias("type"),
        F.struct(F.concat(F.col("l_linenumber").cast("string"), F.lit(";")).alias("text")).alias("delta"))).alias("body"))
    return N.assemble_chunks(li, "l_orderkey", "l_linenumber", "body")


@query
def json_payloads(spark, d):
    """P6 on JSON payloads: a missing key takes its default, an explicit null of a required one rejects the row."""
    n = F.col("event_id").cast("string")
    body = (F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"user":"u'), n, F.lit('","value":'), n, F.lit("}")))
            .when(F.col("event_id") % 3 == 1, F.lit('{"user":"x"}')).otherwise(F.lit('{"user":null,"value":null}')))
    e = load(spark, d, "events").select("event_id", body.alias("body"))
    return P.json_fields(e, "body", {"user": ("string", "nobody"), "value": ("bigint", 0)}, reject_null=["user"]).select(
        "event_id", "user", "value", "reject_reason")


@query
def constraint_checks(spark, d):
    """The second half of the orders checked against a profile of the first."""
    o = load(spark, d, "orders").select("o_orderdate", "o_custkey", "o_totalprice")
    cut = _ntz("1998-05-01 00:00:00")
    first, second = (A.profile(x.select("o_custkey", "o_totalprice")) for x in (o.filter(F.col("o_orderdate") < cut), o.filter(F.col("o_orderdate") >= cut)))
    return A.check_constraints(second, first, tolerance=0.01).select("column", "check", "ok")


@query
def consume_queue(spark, d):
    """T2 without the stream: orders as queue records, some broken, some without a recipient."""
    from tidewater.streaming import jobs
    k = F.col("o_orderkey").cast("string")
    fields = [F.concat(F.lit("m"), k).alias("message_id"), F.lit("2024-01-01T00:00:00").alias("timestamp"),
              F.when(F.col("o_orderkey") % 10 != 1, F.concat(F.col("o_custkey").cast("string"), F.lit("@x.org"))).alias("recipient"),
              F.col("o_orderpriority").alias("subject"), F.col("o_orderstatus").alias("message")]
    body = F.when(F.col("o_orderkey") % 10 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct(*fields)))
    lines = load(spark, d, "orders").select(F.to_json(F.struct(body.alias("body"))).alias("value"))
    rows = jobs.consume_rows(lines, as_of="2024-01-01 01:00:00")
    ok = F.col("error").isNull()
    return rows.select("message_id", F.when(ok, F.col("subject_line")).alias("subject_line"), F.when(ok, F.col("text")).alias("text"),
                       "status", "processed_at", "error")


@query
def md5_split(spark, d):
    """M1 by md5: sizes of an 80/20 split of orders."""
    from tidewater.operators import ml as M
    train, test = M.split(load(spark, d, "orders"), "o_orderkey", 0.2, 42, "md5")
    sums = lambda x, name: x.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
    return sums(train, "train").unionByName(sums(test, "test"))


@query
def md5_shuffle(spark, d):
    """M6 by md5: the place of every order in the seeded order."""
    from tidewater.operators import ml as M
    o = load(spark, d, "orders").select("o_orderkey", M.hash_number("o_orderkey", 7, "md5").alias("h"))
    return O.rank_all(o, ["h", "o_orderkey"], rank_col="place").select("o_orderkey", "place")


@query
def document_metadata(spark, d):
    """T7 without the stream: metadata of every document as a converted file."""
    from tidewater.streaming import jobs
    docs = load(spark, d, "documents").select(F.concat(F.lit("incoming/doc_"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
                                              F.col("text").alias("value"))
    return jobs.document_metadata(docs, as_of="2024-01-01 00:00:00")


@query
def epoch_text(spark, d):
    """Epoch seconds and back, and values as text with two decimals."""
    e = load(spark, d, "events").select("event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("epoch"), "value")
    return e.select("event_id", "epoch", from_epoch("epoch").cast("timestamp_ntz").alias("at"), two_decimals("value").alias("shown"))

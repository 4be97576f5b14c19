"""ANSI SQL (DuckDB dialect) equivalents of :mod:`tidewater.plans.queries`.

Run by the driver against the same Parquet tables; column names and
types match the Spark results (counts BIGINT, averages rounded)."""

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["bucket_count"] = """
SELECT CASE WHEN c_acctbal < 0 THEN 'negative' WHEN c_acctbal < 1000 THEN 'low'
            WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS balance_band,
       count(*) AS n
FROM customer GROUP BY 1
"""

ORACLE_SQL["cast_clean"] = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       TRY_CAST(strftime(ts, '%Y-%m-%d') AS DATE) AS day
FROM events
"""

ORACLE_SQL["label_in_count"] = """
SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'rush' ELSE 'normal' END AS priority_class,
       count(*) AS n
FROM orders GROUP BY 1
"""

ORACLE_SQL["tenure_ratio"] = """
WITH t AS (
  SELECT o_orderstatus, date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-12-31') / 365.0 AS years,
         o_totalprice
  FROM orders)
SELECT o_orderstatus, round(avg(years), 4) AS avg_years, round(avg(o_totalprice / (years + 1)), 4) AS avg_ratio
FROM t GROUP BY 1
"""

ORACLE_SQL["defaults"] = """
WITH r AS (SELECT l_partkey, sum(l_quantity) AS q, count(*) AS n FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
SELECT p_partkey, round(COALESCE(r.q, 0.0), 2) AS returned_qty, CAST(COALESCE(r.n, 0) AS BIGINT) AS returned_lines
FROM part LEFT JOIN r ON part.p_partkey = r.l_partkey
"""

ORACLE_SQL["point_lookup"] = """
SELECT event_id, ts, value FROM events WHERE user_id = 8 AND event_type = 'error'
"""

ORACLE_SQL["key_query"] = """
SELECT event_id, event_type, ts FROM events WHERE user_id = 7
"""

ORACLE_SQL["recent_rows"] = """
SELECT event_id, ts FROM events
WHERE ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 24 HOUR AND ts <= TIMESTAMP '2024-01-30 00:00:00'
"""

ORACLE_SQL["prefix_contains"] = """
SELECT p_partkey, p_name, 'contains' AS match FROM part WHERE contains(lower(p_name), 'red')
UNION ALL
SELECT p_partkey, p_name, 'prefix' AS match FROM part WHERE starts_with(p_name, 'small')
"""

ORACLE_SQL["url_prefix"] = """
SELECT page_id, url FROM pages WHERE starts_with(url, 'https://')
"""

_TOPICS = """
WITH t AS (SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN 'sensors/' || event_type
                                 ELSE 'weather/' || event_type END AS topic FROM events)
"""

ORACLE_SQL["topic_filter"] = _TOPICS + """
SELECT event_id, topic FROM t WHERE regexp_matches(topic, '^sensors(/.*)?$')
"""

ORACLE_SQL["topic_filter_level"] = _TOPICS + """
SELECT event_id, topic FROM t WHERE regexp_matches(topic, '^[^/]*/click$')
"""

ORACLE_SQL["split_valid_counts"] = """
SELECT CASE WHEN text IS NULL THEN 'missing_text' WHEN n_chars < 50 THEN 'too_short'
            WHEN n_chars > 20000 THEN 'too_long' ELSE 'ok' END AS reason,
       count(*) AS n
FROM documents GROUP BY 1
"""

ORACLE_SQL["mean_max_by_topic"] = """
SELECT event_type, round(avg(value), 4) AS avg_value, max(value) AS max_value FROM events GROUP BY 1
"""

ORACLE_SQL["doc_totals"] = """
SELECT source, count(*) AS n_documents, CAST(sum(COALESCE(n_chars, 0)) AS BIGINT) AS total_count
FROM documents GROUP BY 1 ORDER BY total_count DESC, source
"""

ORACLE_SQL["gather_lines"] = """
WITH li AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(round(l_quantity * 100) AS BIGINT) AS qty_cents
            FROM lineitem)
SELECT l_orderkey, count(*) AS n_items,
       string_agg(CAST(l_linenumber AS VARCHAR) || ':' || CAST(l_partkey AS VARCHAR) || ':' || CAST(qty_cents AS VARCHAR),
                  ';' ORDER BY l_linenumber, l_partkey, qty_cents) AS items
FROM li GROUP BY 1
"""

ORACLE_SQL["count_rows"] = """
SELECT count(*) AS n FROM lineitem
"""

ORACLE_SQL["weekday_events"] = """
SELECT dayname(ts) AS weekday, count(*) AS n FROM events GROUP BY 1
"""

ORACLE_SQL["metric_5min"] = """
SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS period_start, event_type,
       round(sum(value), 4) AS sum, round(avg(value), 4) AS average, max(value) AS maximum,
       min(value) AS minimum, count(value) AS sample_count
FROM events
WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' AND ts < TIMESTAMP '2024-01-29 00:00:00'
GROUP BY 1, 2
"""

ORACLE_SQL["alarm_2x5min"] = """
WITH s AS (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS period_start, avg(value) AS average
           FROM events GROUP BY 1, 2),
span AS (SELECT event_type, min(period_start) AS lo, max(period_start) AS hi FROM s GROUP BY 1),
grid AS (SELECT event_type, unnest(generate_series(lo, hi, INTERVAL 5 MINUTE)) AS period_start FROM span),
g AS (SELECT grid.event_type, grid.period_start, s.average
      FROM grid LEFT JOIN s ON grid.event_type = s.event_type AND grid.period_start = s.period_start),
f AS (SELECT *, COALESCE(average > 100.0, false) AS breaching, average IS NOT NULL AS present FROM g),
w AS (SELECT *, sum(CAST(breaching AS INTEGER)) OVER win AS nb, sum(CAST(present AS INTEGER)) OVER win AS np,
             count(*) OVER win AS nr
      FROM f WINDOW win AS (PARTITION BY event_type ORDER BY period_start ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))
SELECT event_type, period_start, round(average, 4) AS average, breaching,
       CASE WHEN nr < 2 THEN 'INSUFFICIENT_DATA' WHEN nb = 2 THEN 'ALARM'
            WHEN np < 2 THEN 'INSUFFICIENT_DATA' ELSE 'OK' END AS state
FROM w
"""

ORACLE_SQL["alarm_silence"] = """
WITH s AS (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) AS period_start, sum(value) AS sum
           FROM events GROUP BY 1, 2),
grid AS (SELECT event_type, unnest(generate_series(TIMESTAMP '2023-12-31 00:00:00', TIMESTAMP '2024-02-01 23:55:00',
                                                   INTERVAL 5 MINUTE)) AS period_start
         FROM (SELECT DISTINCT event_type FROM events)),
f AS (SELECT grid.event_type, grid.period_start, s.sum, COALESCE(s.sum < 1.0, true) AS breaching
      FROM grid LEFT JOIN s ON grid.event_type = s.event_type AND grid.period_start = s.period_start),
w AS (SELECT *, sum(CAST(breaching AS INTEGER)) OVER win AS nb, count(*) OVER win AS nr
      FROM f WINDOW win AS (PARTITION BY event_type ORDER BY period_start ROWS BETWEEN 1 PRECEDING AND CURRENT ROW))
SELECT event_type, period_start, round(sum, 4) AS sum, breaching,
       CASE WHEN nr < 2 THEN 'INSUFFICIENT_DATA' WHEN nb = 2 THEN 'ALARM' ELSE 'OK' END AS state
FROM w
"""

ORACLE_SQL["anomalies_z3"] = """
WITH m AS (SELECT event_id, value, avg(value) OVER (PARTITION BY event_type) AS mu,
                  stddev_samp(value) OVER (PARTITION BY event_type) AS sd FROM events)
SELECT event_id, round((value - mu) / sd, 4) AS z_score FROM m WHERE sd > 0 AND abs((value - mu) / sd) > 3.0
"""

ORACLE_SQL["monthly_cost"] = """
SELECT date_trunc('month', o_orderdate) AS month, o_orderstatus, round(sum(o_totalprice), 2) AS cost
FROM orders GROUP BY 1, 2
"""

ORACLE_SQL["cost_rollup"] = """
WITH u AS (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY 1)
SELECT p_brand, round(sum(u.q * p_retailprice), 2) AS cost
FROM u JOIN part ON u.l_partkey = part.p_partkey GROUP BY 1
"""

ORACLE_SQL["upsert_latest"] = """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
"""

ORACLE_SQL["update_status"] = """
WITH p AS (SELECT DISTINCT l_orderkey AS o_orderkey, 'RETURNED' AS o_orderstatus FROM lineitem WHERE l_returnflag = 'R')
SELECT COALESCE(o.o_orderkey, p.o_orderkey) AS o_orderkey, COALESCE(p.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
       o.o_orderkey IS NULL AS created
FROM orders o FULL OUTER JOIN p ON o.o_orderkey = p.o_orderkey
"""

ORACLE_SQL["status_depth"] = """
SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'P') AS waiting, count(*) AS total
FROM orders GROUP BY 1
"""

ORACLE_SQL["delete_keys"] = """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal < 0)
"""

ORACLE_SQL["latest_order"] = """
SELECT o_custkey, o_orderkey, o_orderdate FROM (
  SELECT o_custkey, o_orderkey, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1
"""

ORACLE_SQL["expire_rows"] = """
SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-30 00:00:00' - INTERVAL 7 DAY
"""

ORACLE_SQL["dedup_exact"] = """
SELECT min(doc_id) AS doc_id, count(*) AS n_copies FROM documents GROUP BY text
"""

ORACLE_SQL["enrich_left"] = """
WITH o AS (SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total FROM orders GROUP BY 1)
SELECT c.c_custkey, n.n_name, COALESCE(o.n_orders, 0) AS n_orders, round(COALESCE(o.total, 0.0), 2) AS total_spent
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN o ON c.c_custkey = o.o_custkey
"""

ORACLE_SQL["has_lacks"] = """
SELECT c_custkey,
       CASE WHEN EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P'
                         AND o.o_orderdate >= TIMESTAMP '2000-01-01 00:00:00') THEN 'has' ELSE 'lacks' END AS status
FROM customer c
"""

ORACLE_SQL["lineage_chain"] = """
WITH d AS (SELECT s.s_suppkey, n.n_name AS item, 'direct' AS origin, CAST(NULL AS VARCHAR) AS via_group
           FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
v AS (SELECT s.s_suppkey, r.r_name AS item, 'group' AS origin, n.n_name AS via_group
      FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
u AS (SELECT * FROM d UNION ALL SELECT * FROM v)
SELECT s_suppkey, item, origin, via_group, count(*) OVER (PARTITION BY s_suppkey) AS total FROM u
"""

ORACLE_SQL["findings"] = """
WITH last AS (SELECT o_custkey, max(o_orderdate) AS last_order FROM orders GROUP BY 1),
f AS (
  SELECT c_custkey, 'negative_balance' AS kind, CAST(round(c_acctbal * 100) AS BIGINT) AS detail
  FROM customer WHERE c_acctbal < 0
  UNION ALL
  SELECT c.c_custkey, 'inactive' AS kind, date_diff('day', l.last_order, TIMESTAMP '2001-08-31 00:00:00') AS detail
  FROM customer c JOIN last l ON c.c_custkey = l.o_custkey
  WHERE date_diff('day', l.last_order, TIMESTAMP '2001-08-31 00:00:00') > 90),
r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY c_custkey) AS rank,
             count(*) OVER (PARTITION BY kind) AS total FROM f)
SELECT kind, rank, c_custkey, detail, total, greatest(total - 3, 0) AS more FROM r WHERE rank <= 3
"""

ORACLE_SQL["top_balances"] = """
WITH r AS (SELECT c_custkey, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rank,
                  count(*) OVER () AS total FROM customer)
SELECT rank, c_custkey, c_acctbal, total, greatest(total - 10, 0) AS more FROM r WHERE rank <= 10
"""

ORACLE_SQL["classify_events"] = """
WITH e AS (
  SELECT event_id, CASE
    WHEN event_type = 'click' THEN '{"httpMethod":"POST","path":"/events/' || event_id || '","body":"{}"}'
    WHEN event_type = 'view' THEN '{"Records":[{"eventName":"ObjectCreated:Put","s3":{"bucket":{"name":"b"},"object":{"key":"k' || event_id || '"}}}]}'
    WHEN event_type = 'purchase' THEN '{"Records":[{"eventName":"INSERT","dynamodb":{"NewImage":{"id":{"N":"' || event_id || '"}}}}]}'
    WHEN event_type = 'signup' THEN '{"source":"aws.events","detail-type":"Scheduled Event"}'
    WHEN value > 100 THEN '{"Records":[{"eventSource":"aws:sqs","body":"x"}]}'
    ELSE '{"Records":[]}' END AS env
  FROM events)
SELECT event_id, CASE
  WHEN json_exists(env, '$.httpMethod') THEN 'api_gateway'
  WHEN json_exists(env, '$.Records[0].s3') THEN 's3'
  WHEN json_exists(env, '$.Records[0].dynamodb') THEN 'dynamodb'
  WHEN json_extract_string(env, '$.source') = 'aws.events' THEN 'scheduled'
  ELSE 'generic' END AS kind
FROM e
"""

ORACLE_SQL["explode_records"] = """
SELECT l_orderkey, l_linenumber, 'ObjectCreated:Put' AS event_name, 'parts' AS bucket,
       'part ' || l_partkey || ' file.json' AS key FROM lineitem
UNION ALL
SELECT l_orderkey, l_linenumber, 'ObjectCreated:Put' AS event_name, 'supp-' || l_suppkey AS bucket,
       'line ' || l_linenumber AS key FROM lineitem
"""

ORACLE_SQL["flatten_two"] = """
SELECT 'i-' || o_orderkey || '-a' AS instance_id, o_orderstatus AS instance_type, 'running' AS state,
       o_orderpriority AS name, 'N/A' AS zone FROM orders
UNION ALL
SELECT 'i-' || o_orderkey || '-b' AS instance_id, 'N/A' AS instance_type, 'N/A' AS state,
       'N/A' AS name, 'N/A' AS zone FROM orders
"""

ORACLE_SQL["decode_attributes"] = """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
"""

ORACLE_SQL["sections"] = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS ord
  FROM documents),
t AS (SELECT doc_id, ord, regexp_replace(line, '^\\s+|\\s+$', '', 'g') AS title FROM l)
SELECT doc_id, ord AS section_no, CASE WHEN title <> '' THEN title ELSE 'Section ' || ord END AS title
FROM t
"""

ORACLE_SQL["assemble_turns"] = """
SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS text, count(*) AS n_parts
FROM conversations GROUP BY conv_id
"""

ORACLE_SQL["chat_history"] = """
SELECT conv_id, turn, role, text FROM conversations ORDER BY conv_id, turn
"""

ORACLE_SQL["chat_stats"] = """
SELECT role, count(*) AS n_rows, count(DISTINCT conv_id) AS n_keys, CAST(sum(length(text)) AS BIGINT) AS total_size,
       round(avg(length(text)), 4) AS avg_size, CAST(max(length(text)) AS BIGINT) AS max_size
FROM conversations GROUP BY role
"""

ORACLE_SQL["request_reply"] = """
SELECT conv_id, turn, CAST(256 AS BIGINT) AS max_tokens,
       CAST(length('Summarise:' || chr(10) || chr(10) || text) AS BIGINT) AS content_chars
FROM conversations WHERE role = 'user'
"""

ORACLE_SQL["render_template"] = """
SELECT o_orderkey, 'Order ' || o_orderkey || ' for customer ' || o_custkey || ': ' || o_orderstatus AS text FROM orders
"""

ORACLE_SQL["latest_suffix"] = """
WITH c AS (SELECT c_mktsegment, c_name, TRY_CAST(regexp_extract(c_name, '(\\d+)$', 1) AS BIGINT) AS suffix FROM customer)
SELECT c_mktsegment, arg_max(c_name, suffix) AS c_name, max(suffix) AS suffix
FROM c WHERE suffix IS NOT NULL GROUP BY 1
"""

ORACLE_SQL["leaderboard"] = """
WITH t AS (SELECT event_type, user_id, round(sum(value), 2) AS total FROM events GROUP BY 1, 2),
r AS (SELECT *, rank() OVER (PARTITION BY event_type ORDER BY total DESC) AS rank FROM t)
SELECT event_type, rank, user_id, total FROM r WHERE rank <= 5
"""

ORACLE_SQL["vector_top5"] = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT a.vec_id AS query_id, b.vec_id AS neighbor_id,
             list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) AS similarity
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, neighbor_id) AS rank FROM p)
SELECT query_id, rank, neighbor_id, round(similarity, 4) AS similarity FROM r WHERE rank <= 5
"""

ORACLE_SQL["eval_report"] = """
WITH r AS (SELECT quality AS cls, 1 AS in_label, 0 AS in_pred, CASE WHEN quality = toxic THEN 1 ELSE 0 END AS tp FROM labels
           UNION ALL SELECT toxic AS cls, 0, 1, 0 FROM labels),
a AS (SELECT cls, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(in_label) AS BIGINT) AS support,
             CAST(sum(in_pred) AS BIGINT) AS predicted FROM r GROUP BY cls),
m AS (SELECT cls, support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS p,
             CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rc FROM a)
SELECT cls AS class, round(p, 4) AS precision, round(rc, 4) AS recall,
       round(CASE WHEN p + rc > 0 THEN 2.0 * p * rc / (p + rc) ELSE 0.0 END, 4) AS f1, support
FROM m
"""

ORACLE_SQL["eval_accuracy"] = """
SELECT count(*) AS n, round(100.0 * avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 4) AS accuracy_pct FROM labels
"""

ORACLE_SQL["profile"] = """
SELECT 'o_orderkey' AS "column", count(*) AS n, count(*) FILTER (WHERE o_orderkey IS NULL) AS nulls,
       count(DISTINCT o_orderkey) AS n_distinct, CAST(min(o_orderkey) AS DOUBLE) AS min, CAST(max(o_orderkey) AS DOUBLE) AS max,
       round(avg(o_orderkey), 2) AS mean, round(stddev_samp(o_orderkey), 2) AS stddev FROM orders
UNION ALL
SELECT 'o_custkey', count(*), count(*) FILTER (WHERE o_custkey IS NULL), count(DISTINCT o_custkey),
       CAST(min(o_custkey) AS DOUBLE), CAST(max(o_custkey) AS DOUBLE), round(avg(o_custkey), 2),
       round(stddev_samp(o_custkey), 2) FROM orders
UNION ALL
SELECT 'o_totalprice', count(*), count(*) FILTER (WHERE o_totalprice IS NULL), count(DISTINCT o_totalprice),
       min(o_totalprice), max(o_totalprice), round(avg(o_totalprice), 2), round(stddev_samp(o_totalprice), 2) FROM orders
"""

ORACLE_SQL["profile_orders"] = """
SELECT 'o_orderkey' AS "column", count(*) AS n, count(*) FILTER (WHERE o_orderkey IS NULL) AS nulls, count(DISTINCT o_orderkey) AS n_distinct,
       CAST(min(o_orderkey) AS DOUBLE) AS min, CAST(max(o_orderkey) AS DOUBLE) AS max, round(avg(o_orderkey), 2) AS mean,
       round(stddev_samp(o_orderkey), 2) AS stddev, CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM orders
UNION ALL
SELECT 'o_custkey' AS "column", count(*) AS n, count(*) FILTER (WHERE o_custkey IS NULL) AS nulls, count(DISTINCT o_custkey) AS n_distinct,
       CAST(min(o_custkey) AS DOUBLE) AS min, CAST(max(o_custkey) AS DOUBLE) AS max, round(avg(o_custkey), 2) AS mean,
       round(stddev_samp(o_custkey), 2) AS stddev, CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM orders
UNION ALL
SELECT 'o_totalprice' AS "column", count(*) AS n, count(*) FILTER (WHERE o_totalprice IS NULL) AS nulls, count(DISTINCT o_totalprice) AS n_distinct,
       CAST(min(o_totalprice) AS DOUBLE) AS min, CAST(max(o_totalprice) AS DOUBLE) AS max, round(avg(o_totalprice), 2) AS mean,
       round(stddev_samp(o_totalprice), 2) AS stddev, CAST(NULL AS VARCHAR) AS min_text, CAST(NULL AS VARCHAR) AS max_text FROM orders
UNION ALL
SELECT 'o_orderstatus', count(*), count(*) FILTER (WHERE o_orderstatus IS NULL), count(DISTINCT o_orderstatus),
       NULL, NULL, NULL, NULL, CAST(min(o_orderstatus) AS VARCHAR), CAST(max(o_orderstatus) AS VARCHAR) FROM orders
UNION ALL
SELECT 'o_orderdate', count(*), count(*) FILTER (WHERE o_orderdate IS NULL), count(DISTINCT o_orderdate),
       NULL, NULL, NULL, NULL, CAST(min(o_orderdate) AS VARCHAR), CAST(max(o_orderdate) AS VARCHAR) FROM orders
UNION ALL
SELECT 'o_orderpriority', count(*), count(*) FILTER (WHERE o_orderpriority IS NULL), count(DISTINCT o_orderpriority),
       NULL, NULL, NULL, NULL, CAST(min(o_orderpriority) AS VARCHAR), CAST(max(o_orderpriority) AS VARCHAR) FROM orders
"""

ORACLE_SQL["trust_principals"] = """
SELECT s_suppkey, 'Service' AS type,
       'svc-' || s_nationkey || ', svc-' || s_suppkey || ', a' AS shown, CAST(4 AS BIGINT) AS n_principals
FROM supplier WHERE s_nationkey <> 0 AND s_acctbal < 0
UNION ALL
SELECT s_suppkey, 'AWS' AS type, 'arn:' || s_suppkey AS shown, CAST(1 AS BIGINT) AS n_principals
FROM supplier WHERE s_nationkey <> 0 AND NOT (s_acctbal < 0)
"""

ORACLE_SQL["wildcard_statements"] = """
SELECT p_partkey, CAST(0 AS BIGINT) AS statement_no FROM part WHERE p_size > 40 OR p_size < 5
"""

ORACLE_SQL["credential_audit"] = """
WITH r AS (
  SELECT c_name AS "user", c_acctbal >= 0 AS mfa,
         CAST('2001-0' || ((c_custkey % 9) + 1) || '-15' AS TIMESTAMP) AS last_used,
         CAST(c_mktsegment IN ('BUILDING', 'MACHINERY') AS INTEGER) + CAST(c_nationkey < 5 AS INTEGER) AS n_keys
  FROM customer)
SELECT "user", 'mfa_inactive' AS kind, CAST(NULL AS BIGINT) AS detail FROM r WHERE NOT mfa
UNION ALL
SELECT "user", 'password_stale' AS kind, date_diff('day', last_used, TIMESTAMP '2001-12-31 00:00:00') AS detail
FROM r WHERE date_diff('day', last_used, TIMESTAMP '2001-12-31 00:00:00') > 90
UNION ALL
SELECT "user", 'active_keys' AS kind, CAST(n_keys AS BIGINT) AS detail FROM r WHERE n_keys > 0
"""

ORACLE_SQL["pick_stamp"] = """
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, DATE '2024-01-01' AS processing_date FROM customer
"""

ORACLE_SQL["notifications"] = """
WITH r AS (
  SELECT c_custkey, c_acctbal, c_mktsegment, c_name, 'cust' || c_custkey || '@example.com' AS who FROM customer),
b AS (
  SELECT *, CASE WHEN c_acctbal < 0 THEN '{"body": "{broken' || who
                 WHEN c_mktsegment = 'BUILDING' THEN '{"body": "{\\"recipient\\": \\"' || who || '\\", \\"type\\": \\"sms\\"}"}'
                 WHEN c_mktsegment = 'MACHINERY' THEN '{"body": {"subject": "Hi ' || c_name || '"}}'
                 ELSE '{"message": "Hello ' || c_name || '", "recipient": "' || who || '"}' END AS request
  FROM r)
SELECT c_custkey, sha256(request) AS message_id,
       CASE WHEN c_acctbal >= 0 AND c_mktsegment IN ('BUILDING') THEN who
            WHEN c_acctbal >= 0 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN who
            ELSE 'default@example.com' END AS recipient,
       CASE WHEN c_acctbal >= 0 AND c_mktsegment = 'MACHINERY' THEN 'Hi ' || c_name ELSE 'Bildirim' END AS subject,
       CASE WHEN c_acctbal >= 0 AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN 'Hello ' || c_name
            ELSE 'Merhaba!' END AS message,
       CASE WHEN c_acctbal >= 0 AND c_mktsegment = 'BUILDING' THEN 'sms' ELSE 'email' END AS notification_type,
       'queued' AS status,
       CASE WHEN c_acctbal < 0 THEN 'bad_json' END AS reject_reason
FROM b
"""

ORACLE_SQL["where_eq_signup"] = """
SELECT event_id, user_id FROM events WHERE event_type = 'signup'
"""

ORACLE_SQL["tagged_parts"] = """
SELECT p_partkey FROM part WHERE p_type = 'ECONOMY'
"""

ORACLE_SQL["value_errors"] = """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value_num,
       CASE WHEN event_type = 'error' THEN 'value_num: could not convert' END AS error
FROM events
"""

ORACLE_SQL["clean_documents"] = """
SELECT lang, count(*) AS n, 'kept' AS outcome FROM documents WHERE text IS NOT NULL AND n_chars >= 50 GROUP BY lang
UNION ALL
SELECT CASE WHEN text IS NULL THEN 'null:text' ELSE 'too_short' END AS lang, count(*) AS n, 'rejected' AS outcome
FROM documents WHERE text IS NULL OR NOT (n_chars >= 50) GROUP BY 1
"""

ORACLE_SQL["enrich_roles"] = """
WITH p AS (SELECT n.n_name, s.s_name, CAST(s.s_suppkey AS VARCHAR) AS arn
           FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
a AS (SELECT n_name, count(*) AS n_policies, arg_min(s_name, (s_name, arn)) AS first_policy FROM p GROUP BY 1)
SELECT n.n_name AS RoleName, COALESCE(a.n_policies, 0) AS n_policies, a.first_policy
FROM nation n LEFT JOIN a ON n.n_name = a.n_name
"""

ORACLE_SQL["attach_object_info"] = """
SELECT l_orderkey, l_linenumber, l_partkey AS key, p_size AS size FROM lineitem JOIN part ON l_partkey = p_partkey
"""

ORACLE_SQL["active_keys"] = """
SELECT c_name AS "user",
       CAST(CAST(c_mktsegment IN ('BUILDING', 'MACHINERY') AS INTEGER) + CAST(c_nationkey < 5 AS INTEGER) AS INTEGER) AS active_keys
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') OR c_nationkey < 5
"""

ORACLE_SQL["sort_orders"] = """
SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey
"""

ORACLE_SQL["object_versions"] = """
SELECT p_partkey AS key, p_size AS size, false AS is_marker FROM part
UNION ALL
SELECT p_partkey AS key, p_size AS size, true AS is_marker FROM part WHERE p_size < 3
"""

ORACLE_SQL["describe_nations"] = """
WITH f AS (SELECT n.n_name AS table_name, count(*) AS items FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
           WHERE c.c_acctbal > 9900 GROUP BY 1)
SELECT n.n_name AS table_name, f.items, CASE WHEN f.items IS NULL THEN 'not found' END AS error
FROM nation n LEFT JOIN f ON n.n_name = f.table_name
"""

ORACLE_SQL["join_list_names"] = """
SELECT c_custkey, replace(c_name, '#', ' / ') AS display FROM customer
"""

ORACLE_SQL["order_json"] = """
SELECT o_orderkey, json_object('o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus,
                               'price', CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE))::VARCHAR AS json
FROM orders
"""

ORACLE_SQL["event_handler"] = """
SELECT event_id,
       CASE WHEN event_type = 'error' THEN NULL WHEN value > 100 THEN 'high' ELSE 'low' END AS value_class,
       CASE WHEN event_type = 'error' THEN 'ValueError: rejected' END AS error
FROM events
"""

ORACLE_SQL["event_metrics"] = """
SELECT 'App/Events' AS namespace, 'Value' AS metric_name, value, 'None' AS unit, ts AS "timestamp",
       event_type
FROM events
"""

ORACLE_SQL["event_logs"] = """
SELECT '/app/events' AS log_group, 'stream-1' AS log_stream, epoch_us(ts) // 1000 AS "timestamp",
       json_object('timestamp', strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), 'message', event_type,
                   'source', 'tidewater')::VARCHAR AS message
FROM events
"""

ORACLE_SQL["apply_change_log"] = """
WITH last AS (SELECT o_custkey, max(o_orderkey) AS k FROM orders GROUP BY 1)
SELECT o.o_custkey AS custkey, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents
FROM last JOIN orders o ON o.o_orderkey = last.k WHERE k % 7 <> 0
"""

ORACLE_SQL["top5000_prices"] = """
WITH r AS (SELECT o_orderstatus, o_orderkey, o_totalprice,
                  rank() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
SELECT * FROM r WHERE rank <= 5000
"""

ORACLE_SQL["price_ranks"] = """
SELECT o_orderkey, rank() OVER (ORDER BY o_totalprice DESC) AS rank, dense_rank() OVER (ORDER BY o_totalprice DESC) AS dense_rank
FROM orders
"""

ORACLE_SQL["gather_chunks"] = """
WITH r AS (SELECT l_returnflag, l_orderkey, l_linenumber,
                  (row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) - 1) // 5000 AS chunk FROM lineitem)
SELECT l_returnflag, chunk, count(*) AS n_items, min(l_orderkey) AS first_order, max(l_orderkey) AS last_order,
       CAST(sum(l_linenumber) AS BIGINT) AS lines
FROM r GROUP BY 1, 2
"""

ORACLE_SQL["role_chunks"] = """
WITH r AS (SELECT n_name, c_name, (row_number() OVER (PARTITION BY n_name ORDER BY c_name, CAST(c_custkey AS VARCHAR)) - 1) // 50 AS chunk
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
g AS (SELECT n_name, chunk, count(*) AS n_policies, min(c_name) AS first_policy FROM r GROUP BY 1, 2),
n AS (SELECT n_name FROM nation UNION ALL SELECT 'NOWHERE')
SELECT n.n_name AS RoleName, coalesce(chunk, 0) AS chunk, coalesce(n_policies, 0) AS n_policies, first_policy FROM n LEFT JOIN g ON n.n_name = g.n_name
"""

ORACLE_SQL["drift_width"] = """
WITH s AS (SELECT CAST(o_totalprice AS DOUBLE) AS x, o_orderdate < TIMESTAMP '1998-05-01 00:00:00' AS old FROM orders),
e AS (SELECT min(x) AS lo, max(x) AS hi FROM s WHERE old),
b AS (SELECT old, len(list_filter(range(1, 10), lambda i: x >= lo + (hi - lo) * (CAST(i AS DOUBLE) / CAST(10 AS DOUBLE)))) AS bin FROM s, e),
c AS (SELECT bin, sum(CASE WHEN old THEN 1 ELSE 0 END) AS b, sum(CASE WHEN old THEN 0 ELSE 1 END) AS c FROM b GROUP BY 1),
p AS (SELECT greatest(b / sum(b) OVER (), CAST(1e-6 AS DOUBLE)) AS pb, greatest(c / sum(c) OVER (), CAST(1e-6 AS DOUBLE)) AS pc FROM c)
SELECT round(sum((pc - pb) * ln(pc / pb)), 8) AS psi FROM p
"""

ORACLE_SQL["enrich_users"] = """
SELECT c_name AS "user", any_value(c_acctbal) > 0 AS has_console, count(o_orderkey) AS n_keys,
       coalesce(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)), '') AS access_keys
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_name
"""

ORACLE_SQL["average_quantity"] = """
SELECT l_returnflag, l_linestatus, round(avg(l_quantity), 6) AS average FROM lineitem GROUP BY 1, 2
"""

ORACLE_SQL["maximum_value"] = """
SELECT event_type, max(value) AS maximum FROM events GROUP BY 1
"""

ORACLE_SQL["assemble_chunks"] = """
SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR) || ';', '' ORDER BY l_linenumber) AS text
FROM lineitem WHERE l_linenumber <> 1 GROUP BY 1
"""

ORACLE_SQL["json_payloads"] = """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'u' || event_id WHEN 1 THEN 'x' ELSE 'nobody' END AS "user",
       CASE event_id % 3 WHEN 0 THEN event_id ELSE 0 END AS value,
       CASE event_id % 3 WHEN 2 THEN 'null:user' END AS reject_reason
FROM events
"""

ORACLE_SQL["constraint_checks"] = """
WITH l AS (SELECT 'o_custkey' AS "column", o_orderdate, CAST(o_custkey AS DOUBLE) AS x FROM orders
           UNION ALL SELECT 'o_totalprice', o_orderdate, CAST(o_totalprice AS DOUBLE) FROM orders),
p AS (SELECT "column", o_orderdate < TIMESTAMP '1998-05-01 00:00:00' AS old, avg(CASE WHEN x IS NULL THEN 1.0 ELSE 0.0 END) AS nulls,
             min(x) AS lo, max(x) AS hi, avg(x) AS mean, stddev_samp(x) AS sd FROM l GROUP BY 1, 2),
j AS (SELECT a."column", a.nulls <= b.nulls + 0.01 AS c1, a.lo >= b.lo AS c2, a.hi <= b.hi AS c3,
             abs(a.mean - b.mean) <= 0.01 * (b.sd + abs(b.mean)) AS c4
      FROM p a JOIN p b ON a."column" = b."column" WHERE NOT a.old AND b.old)
SELECT "column", 'null_ratio' AS "check", c1 AS ok FROM j UNION ALL SELECT "column", 'min', c2 FROM j
UNION ALL SELECT "column", 'max', c3 FROM j UNION ALL SELECT "column", 'mean', c4 FROM j
"""

ORACLE_SQL["consume_queue"] = """
SELECT CASE WHEN o_orderkey % 10 <> 0 THEN 'm' || o_orderkey END AS message_id,
       CASE WHEN o_orderkey % 10 > 1 THEN 'AWS Bildirim: ' || o_orderpriority END AS subject_line,
       CASE WHEN o_orderkey % 10 > 1 THEN '🔔 Yeni Bildirim' || chr(10) || chr(10) || '📧 Alıcı: ' || o_custkey || '@x.org' || chr(10) ||
            '📌 Konu: ' || o_orderpriority || chr(10) || '💬 Mesaj: ' || o_orderstatus || chr(10) || '📅 Tarih: 2024-01-01T00:00:00' || chr(10) ||
            '🆔 ID: m' || o_orderkey END AS text,
       'sent' AS status, '2024-01-01T01:00:00.000000' AS processed_at,
       CASE o_orderkey % 10 WHEN 0 THEN 'bad_json' WHEN 1 THEN 'missing recipient' END AS error
FROM orders
"""

ORACLE_SQL["md5_split"] = """
WITH b AS (SELECT o_orderkey, CAST('0x' || substr(md5(o_orderkey || ':42'), 1, 8) AS BIGINT) % 10000 < 2000 AS test FROM orders)
SELECT CASE WHEN test THEN 'test' ELSE 'train' END AS part, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM b GROUP BY test
"""

ORACLE_SQL["md5_shuffle"] = """
SELECT o_orderkey, row_number() OVER (ORDER BY substr(md5(o_orderkey || ':7'), 1, 8), o_orderkey) AS place FROM orders
"""

ORACLE_SQL["document_metadata"] = r"""
WITH t AS (SELECT doc_id, string_split(text, chr(10) || chr(10)) AS parts FROM documents),
f AS (SELECT doc_id, len(parts) AS n, regexp_replace(split_part(parts[1], chr(10), 1), '^\s+|\s+$', '', 'g') AS first FROM t)
SELECT 'doc_' || doc_id || '.txt' AS original_name, 'doc_' || doc_id || '.pdf' AS pdf_name, 'converted/doc_' || doc_id || '.pdf' AS pdf_path,
       'Doc ' || doc_id AS title, n AS slide_count, CASE WHEN first <> '' THEN first ELSE 'Slide 1' END AS first_title,
       '2024-01-01T00:00:00Z' AS create_date, 'incoming/doc_' || doc_id || '.txt' AS source_path
FROM f
"""

ORACLE_SQL["epoch_text"] = """
SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS epoch, date_trunc('second', ts) AS "at", format('{:,.2f}', value) AS shown FROM events
"""

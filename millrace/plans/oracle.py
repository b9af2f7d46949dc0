"""SQL twins of the registered queries, for DuckDB over the same tables.

They repeat the input derivations and the semantics in SQL and share nothing with the operators.
"""

from __future__ import annotations

# Order messages: eight malformed kinds and well-formed ones, by event_id modulo 20.
RAW = """
raw AS (
  SELECT event_id, ts, 'orders' AS topic, CAST(event_id % 3 AS INTEGER) AS kafka_partition,
         event_id // 3 AS kafka_offset,
         CASE event_id % 20
           WHEN 0 THEN 'this is not json ' || event_id
           WHEN 1 THEN '{' || o || ', ' || p || ', ' || q || ', ' || t || '}'
           WHEN 2 THEN '{' || o || ', ' || n || ', ' || p || ', ' || q || '}'
           WHEN 3 THEN '{' || o || ', ' || n || ', "price": "x", ' || q || ', ' || t || l || '}'
           WHEN 4 THEN '{' || o || ', ' || n || ', ' || p || ', ' || q || ', "ts": "garbage"}'
           WHEN 5 THEN '[1]'
           WHEN 6 THEN '{' || o || ', "product": "", ' || p || ', ' || q || ', ' || t || '}'
           WHEN 7 THEN ''
           ELSE '{' || o || ', ' || n || ', ' || p || ', ' || q || ', ' || t || '}'
         END AS raw_value
  FROM (SELECT event_id, ts,
               '"order_id": "o' || event_id || '"' AS o,
               '"product": "' || event_type || '"' AS n,
               '"price": ' || CASE event_id % 100 WHEN 28 THEN '4.5' WHEN 29 THEN '4e-7' ELSE CAST(value AS VARCHAR) END AS p,
               '"quantity": ' || CASE event_id % 100 WHEN 28 THEN 2147483647 WHEN 29 THEN 1000000000
                                 ELSE 1 + event_id % 4 END AS q,
               CASE WHEN event_id % 500 = 3 THEN ', "note": "' || repeat('x', 12000) || '"' ELSE '' END AS l,
               '"ts": "' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00"' AS t
        FROM events)
)"""

# The messages parsed as JSON text and judged.
DECODED = f"""{RAW},
shaped AS (
  SELECT *, CASE WHEN json_valid(raw_value) THEN json_type(raw_value) END AS shape,
         CASE WHEN json_valid(raw_value) THEN raw_value END AS doc
  FROM raw
),
fields AS (
  SELECT *, doc ->> '$.order_id' AS order_id, doc ->> '$.product' AS product,
         CASE WHEN json_type(doc, '$.price') IN ('DOUBLE', 'BIGINT', 'UBIGINT')
              THEN CAST(doc ->> '$.price' AS DOUBLE) END AS price,
         CASE WHEN json_type(doc, '$.quantity') IN ('BIGINT', 'UBIGINT')
              THEN CAST(doc ->> '$.quantity' AS INTEGER) END AS quantity,
         CASE WHEN regexp_matches(doc ->> '$.ts', '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T')
              THEN TRY_CAST(doc ->> '$.ts' AS TIMESTAMP) END AS event_time
  FROM shaped
),
decoded AS (
  SELECT *, coalesce(shape = 'OBJECT' AND product <> '' AND price IS NOT NULL
                     AND quantity IS NOT NULL AND event_time IS NOT NULL, FALSE) AS is_valid,
         CASE WHEN shape = 'OBJECT' THEN 'missing or invalid product, ts, price or quantity'
              ELSE 'not a JSON object matching the schema' END AS reason
  FROM fields
)"""


def _windows(trunc: str, source: str = "decoded", extra: str = "") -> str:
    return f"""
  SELECT date_trunc('{trunc}', event_time) AS window_start,
         date_trunc('{trunc}', event_time) + INTERVAL 1 {trunc} AS window_end, product,{extra}
         count(*) AS orders_count,
         round(sum(price * quantity), 2) AS revenue
  FROM {source} WHERE is_valid GROUP BY ALL"""


SALES_LINES = """
sales AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         p_type AS category, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

SALES_ORDERS = """
parts AS (SELECT *, count(*) OVER () AS n_parts FROM part),
sales AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, p_name AS product,
         CASE WHEN o_orderkey % 11 <> 0 THEN p_type END AS category, CAST(1 + o_orderkey % 5 AS INTEGER) AS quantity,
         CAST(p_retailprice AS DOUBLE) AS unit_price, strftime(o_orderdate, '%Y-%m-%d') AS order_date
  FROM orders JOIN parts ON p_partkey = o_orderkey % n_parts
)"""

MERGED = f"""
WITH {SALES_ORDERS},
moved AS (SELECT *, o_orderkey + CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS place FROM orders),
changes AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, p_name AS product,
         CASE WHEN place % 11 <> 0 THEN p_type END AS category, CAST(2 + o_orderkey % 5 AS INTEGER) AS quantity,
         CAST(p_retailprice AS DOUBLE) AS unit_price, strftime(o_orderdate, '%Y-%m-%d') AS order_date
  FROM moved JOIN parts ON p_partkey = place % n_parts
  WHERE o_orderkey % 3 = 0
  UNION ALL
  SELECT CAST(o_orderkey + 1000000000 AS VARCHAR), CAST(o_custkey AS VARCHAR), p_name,
         CASE WHEN o_orderkey % 11 <> 0 THEN p_type END,
         CAST(1 + o_orderkey % 5 AS INTEGER), CAST(p_retailprice AS DOUBLE), strftime(o_orderdate, '%Y-%m-%d')
  FROM orders JOIN parts ON p_partkey = o_orderkey % n_parts
  WHERE o_orderkey % 50 = 0
)
SELECT coalesce(c.order_id, s.order_id) AS order_id,
       CASE WHEN c.order_id IS NULL THEN s.customer_id ELSE c.customer_id END AS customer_id,
       CASE WHEN c.order_id IS NULL THEN s.product ELSE c.product END AS product,
       CASE WHEN c.order_id IS NULL THEN s.category ELSE c.category END AS category,
       CASE WHEN c.order_id IS NULL THEN s.quantity ELSE c.quantity END AS quantity,
       CASE WHEN c.order_id IS NULL THEN s.unit_price ELSE c.unit_price END AS unit_price,
       CASE WHEN c.order_id IS NULL THEN s.order_date ELSE c.order_date END AS order_date
FROM sales s FULL JOIN changes c ON s.order_id = c.order_id
"""

# Queue messages: what the first attempt finds. A message without a poison cause fails
# ``failures`` times; one whose switch is not a number always fails.
MESSAGES = """
messages AS (
  SELECT event_id AS message_id, ts AS delivered_at,
         CASE WHEN event_id % 23 = 0 THEN 'invalid x-retry-count header: "bad"'
              WHEN event_id % 23 = 1 THEN 'invalid x-retry-count header: -1'
              WHEN event_id % 17 = 0
                THEN 'invalid JSON: Expecting property name enclosed in double quotes: line 1 column 2 (char 1)'
              WHEN event_id % 17 = 1 THEN 'order_id is required'
              WHEN event_id % 17 = 2 THEN 'expected a JSON object, got list' END AS poison,
         event_id % 17 = 3 AS bad_switch,
         CASE WHEN event_id % 17 = 3 THEN 1000000 ELSE event_id % 6 END AS failures
  FROM events
),
ledger AS (
  SELECT message_id, delivered_at, CAST(a AS BIGINT) AS attempt,
         CASE WHEN poison IS NOT NULL THEN 'poison' WHEN a < failures THEN 'transient' ELSE 'ok' END AS status,
         CASE WHEN poison IS NOT NULL THEN poison
              WHEN a < failures AND bad_switch THEN 'invalid literal for int() with base 10: ''abc'''
              WHEN a < failures THEN 'simulated transient failure ' || (a + 1) || '/' || failures END AS error,
         CASE WHEN poison IS NOT NULL OR (a < failures AND a >= 3) THEN 'dead'
              WHEN a < failures THEN 'retry' ELSE 'done' END AS target
  FROM messages, (SELECT unnest(range(4)) AS a)
  WHERE a = 0 OR (poison IS NULL AND a <= failures)
)"""

OUTCOMES = f"""
WITH {MESSAGES}
SELECT message_id, arg_max(target, attempt) AS target, count(*) AS attempts, max(attempt) AS retry_count,
       arg_max(error, attempt) FILTER (error IS NOT NULL) AS last_error
FROM ledger GROUP BY message_id
"""

REQUESTS = """
requests AS (
  SELECT user_id AS key, ts, event_id AS seq, event_type <> 'error' AS is_read FROM events
)"""

# One step per row of a key, carrying the time of the load in effect.
TTL = f"""
WITH RECURSIVE {REQUESTS},
numbered AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts, seq) AS rn FROM requests),
walk AS (
  SELECT key, seq, rn, is_read, CASE WHEN is_read THEN ts END AS load,
         CASE WHEN is_read THEN 'miss' END AS status
  FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.key, n.seq, n.rn, n.is_read,
         CASE WHEN NOT n.is_read THEN NULL
              WHEN w.load IS NULL OR n.ts >= w.load + INTERVAL 1 DAY THEN n.ts ELSE w.load END,
         CASE WHEN NOT n.is_read THEN NULL
              WHEN w.load IS NULL OR n.ts >= w.load + INTERVAL 1 DAY THEN 'miss' ELSE 'hit' END
  FROM walk w JOIN numbered n ON n.key = w.key AND n.rn = w.rn + 1
)"""

FAIL_OPEN = """
served AS (
  SELECT event_id AS seq, user_id AS key, ts,
         CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' THEN 'bypass'
              WHEN c_mktsegment = 'BUILDING' AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'
                THEN 'hit'
              ELSE 'miss' END AS status,
         c_name
  FROM events LEFT JOIN customer ON c_custkey = user_id
  WHERE event_type <> 'error'
)"""

LOGS = """
containers AS (
  SELECT CAST(user_id AS VARCHAR) AS container_id,
         CASE WHEN user_id % 2 = 0 THEN 'project' ELSE 'other' END
           || '-' || arg_min(event_type, (ts, event_id)) || '-' || user_id AS container_name,
         CASE user_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' END AS enabled
  FROM events GROUP BY user_id
),
lines AS (
  SELECT CAST(user_id AS VARCHAR) AS container_id, event_type || ' log line ' || event_id AS message,
         CASE WHEN event_id % 97 <> 5 THEN ts END AS ts FROM events
),
named AS (SELECT lines.*, container_name, enabled FROM lines LEFT JOIN containers USING (container_id))"""

# Hourly windows of four arrival batches; for each key the newest batch wins.
UPSERTED = f"""
WITH {DECODED},
arrived AS (SELECT *, event_id % 4 AS batch_id FROM decoded),
batches AS ({_windows("hour", "arrived", " batch_id,")})
SELECT window_start, window_end, product, arg_max(orders_count, batch_id) AS orders_count,
       arg_max(revenue, batch_id) AS revenue
FROM batches GROUP BY window_start, window_end, product
"""

DEAD_LETTERS = f"""
WITH {DECODED}
SELECT topic, kafka_partition, kafka_offset, raw_value, reason FROM decoded WHERE NOT is_valid
"""

BY_CATEGORY = """
SELECT category, count(*) AS n, CAST(sum(quantity) AS BIGINT) AS quantity FROM sales GROUP BY category
"""

SALES_REPORT = f"""
WITH {SALES_LINES}
SELECT category, CAST(sum(quantity * unit_price) AS DOUBLE) AS revenue, count(*) AS order_count
FROM sales GROUP BY category
"""

WORDS = r"regexp_replace(lower({0}), '[^\p{{L}}\p{{M}}\p{{N}}_]+', ' ', 'g')"

ORACLE: dict[str, str] = {
    "revenue_by_window": f"WITH {DECODED} {_windows('minute')}",
    "stream_revenue": f"WITH {DECODED} {_windows('minute')}",
    "stream_unique_orders": f"WITH {DECODED} {_windows('minute')}",
    # Late rows: held back to the third batch. A batch drops by the watermark that held before the batch
    # before it ended, so here the first batch decides: its newest order, less a minute.
    "late_row_counts": f"""WITH {DECODED}, half AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS cut FROM events),
        placed AS (SELECT d.*, d.ts < cut AS early, kafka_offset % 10 = 3 AS tenth FROM decoded d, half)
        SELECT CAST(2 AS BIGINT) AS batch_id, count(DISTINCT (date_trunc('minute', event_time), product)) AS late_rows
        FROM placed WHERE is_valid AND early AND tenth AND date_trunc('minute', event_time) + INTERVAL 1 MINUTE
          <= (SELECT date_trunc('millisecond', max(event_time)) FROM placed WHERE is_valid AND early AND NOT tenth) - INTERVAL 1 MINUTE
        HAVING count(*) > 0""",
    "lag_by_batch": """WITH half AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS cut FROM events),
        placed AS (SELECT CASE WHEN ts >= cut THEN 1 WHEN event_id // 3 % 10 = 3 THEN 2 ELSE 0 END AS batch_id FROM events, half),
        sized AS (SELECT CAST(batch_id AS BIGINT) AS batch_id, count(*) AS input_rows FROM placed GROUP BY 1)
        SELECT batch_id, input_rows, CAST((SELECT count(*) FROM events) - sum(input_rows) OVER (ORDER BY batch_id) AS BIGINT) AS behind
        FROM sized""",
    "latest_windows": f"WITH {DECODED}, w AS ({_windows('minute')}) SELECT * FROM w ORDER BY window_start DESC, product LIMIT 10",
    "orders_total": f"WITH {DECODED} SELECT count(*) AS orders FROM decoded WHERE is_valid",
    "windows_of_product": f"WITH {DECODED}, w AS ({_windows('hour')}) SELECT count(*) AS n FROM w WHERE product = 'purchase'",
    "valid_orders": f"""WITH {DECODED}
        SELECT order_id, product, price, quantity, event_time,
               price * quantity AS line_total
        FROM decoded WHERE is_valid""",
    "dead_letters": DEAD_LETTERS,
    "stream_dead_letters": DEAD_LETTERS,
    "stored_dead_letters": DEAD_LETTERS,
    "folded_dead_letters": DEAD_LETTERS,
    "stream_job": f"""WITH {DECODED}, w AS ({_windows('minute')})
        SELECT 'revenue' AS result, count(*) AS n, CAST(sum(orders_count) AS BIGINT) AS events FROM w
        UNION ALL SELECT 'dead_letters', count(*), count(*) FROM decoded WHERE NOT is_valid""",
    "dead_letter_reasons": f"WITH {DECODED} SELECT reason, count(*) AS n FROM decoded WHERE NOT is_valid GROUP BY reason",
    "dead_letter_matches": f"""WITH {DECODED} SELECT count(*) AS n FROM decoded
        WHERE NOT is_valid AND raw_value LIKE '%order_id%' AND raw_value NOT LIKE '%garbage%'""",
    "split_conservation": f"""WITH {DECODED}
        SELECT count(*) AS received, count(*) FILTER (is_valid) AS valid, count(*) FILTER (NOT is_valid) AS dead
        FROM decoded""",
    "contract_check": f"""WITH {DECODED}, w AS ({_windows('hour')})
        SELECT count(*) AS violations FROM w
        WHERE window_start IS NULL OR window_end IS NULL OR product IS NULL OR orders_count IS NULL OR revenue IS NULL""",
    "contract_violations": f"""WITH {DECODED},
        w AS ({_windows('hour', '(SELECT * REPLACE (true AS is_valid) FROM decoded WHERE event_time IS NOT NULL)')})
        SELECT * FROM w WHERE product IS NULL OR revenue IS NULL""",
    "upsert_latest": UPSERTED,
    "folded_windows": UPSERTED,
    "replayable_orders": f"""WITH {RAW}
        SELECT topic, kafka_partition AS "partition", kafka_offset AS "offset",
               replace(raw_value, '"price": "x"', '"price": 1.5') AS value
        FROM raw WHERE event_id % 20 = 3 AND kafka_partition <> 0""",
    "undiscarded_dead_letters": f"""WITH {DECODED}
        SELECT topic, kafka_partition, kafka_offset FROM decoded
        WHERE NOT is_valid AND reason LIKE 'missing%'""",
    "dead_letter_alerts": f"""WITH {DECODED}
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS period, count(*) AS dead_letters
        FROM decoded WHERE NOT is_valid GROUP BY 1 HAVING count(*) > 30""",
    "sales_by_category": SALES_REPORT,
    "sales_csv": SALES_REPORT,
    "top_customers": f"""WITH {SALES_LINES}
        SELECT customer_id, CAST(sum(quantity * unit_price) AS DOUBLE) AS total_spend
        FROM sales GROUP BY customer_id ORDER BY sum(quantity * unit_price) DESC, customer_id LIMIT 3""",
    "spend_by_customer": f"""WITH {SALES_LINES}
        SELECT customer_id, CAST(sum(quantity * unit_price) AS DOUBLE) AS total_spend FROM sales GROUP BY customer_id""",
    "duplicate_load_check": f"""WITH {SALES_ORDERS},
        loaded AS (SELECT * FROM sales UNION ALL SELECT * FROM sales)
        SELECT count(*) AS row_count, count(DISTINCT order_id) AS distinct_keys,
               count(*) - count(DISTINCT order_id) AS surplus_rows FROM loaded""",
    "safe_load_check": f"""WITH {SALES_ORDERS}
        SELECT count(*) AS row_count, count(DISTINCT order_id) AS distinct_keys,
               count(*) - count(DISTINCT order_id) AS surplus_rows FROM sales""",
    "repeated_order_ids": """SELECT CAST(l_orderkey AS VARCHAR) AS order_id, count(*) AS copies
        FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1""",
    "load_history": """SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'append'), (2, 'delete'), (3, 'append')) AS h(snapshot_id, operation)""",
    "catalog_sales": f"WITH {SALES_ORDERS} {BY_CATEGORY}",
    "compacted_sales": f"WITH {SALES_ORDERS} {BY_CATEGORY}",
    "merge_orders": MERGED,
    "merge_table": MERGED,
    "strict_decode": """SELECT event_id AS message_id,
               CASE event_id % 17 WHEN 0 THEN 'invalid' WHEN 2 THEN 'other' ELSE 'object' END AS kind,
               CASE event_id % 17
                 WHEN 0 THEN 'invalid JSON: Expecting property name enclosed in double quotes: line 1 column 2 (char 1)'
                 WHEN 2 THEN 'expected a JSON object, got list' END AS error
        FROM events""",
    "delivered_once": f"""WITH {MESSAGES}
        SELECT message_id, target, CASE WHEN target = 'retry' THEN attempt + 1 ELSE attempt END AS retry_count,
               error AS last_error
        FROM ledger WHERE attempt = 0""",
    "message_outcomes": OUTCOMES,
    "stream_retry_loop": OUTCOMES,
    "attempt_ledger": f"WITH {MESSAGES} SELECT message_id, attempt, status, error, target FROM ledger",
    "attempts_per_message": f"""WITH {MESSAGES}
        SELECT message_id, count(*) AS attempts, arg_max(error, attempt) FILTER (error IS NOT NULL) AS last_error
        FROM ledger GROUP BY message_id""",
    "queue_depths": f"""WITH {MESSAGES}
        SELECT q.queue, count(l.message_id) AS depth
        FROM (VALUES ('main'), ('retry'), ('dead')) AS q(queue)
        LEFT JOIN (SELECT * FROM ledger WHERE attempt = 0) l ON l.target = q.queue
        GROUP BY q.queue""",
    "message_conservation": f"""WITH {MESSAGES}
        SELECT count(*) AS received, count(*) FILTER (target = 'done') AS done,
               count(*) FILTER (target = 'dead') AS dead, count(*) FILTER (target = 'retry') AS waiting
        FROM ledger WHERE attempt = 0""",
    "stored_outcomes": f"WITH {MESSAGES} SELECT target, count(*) AS n FROM ledger WHERE attempt = 0 GROUP BY target",
    "retry_schedule": f"""WITH {MESSAGES}
        SELECT message_id, attempt, delivered_at + INTERVAL 3 SECOND AS due_fixed,
               delivered_at + to_seconds(3 * CAST(pow(2, attempt) AS BIGINT)) AS due_growing
        FROM ledger WHERE target = 'retry'""",
    "due_retries": f"""WITH {MESSAGES}
        SELECT attempt, count(*) AS n FROM ledger
        WHERE target = 'retry' AND delivered_at + INTERVAL 3 SECOND <= TIMESTAMP '2024-01-15' GROUP BY attempt""",
    "stream_retry": f"""WITH {MESSAGES}, body AS (
          SELECT event_id,
                 CASE WHEN event_id % 17 = 3
                   THEN '{{"order_id": "o' || event_id || '", "simulate_failures": "abc"}}'
                   ELSE '{{"order_id": "o' || event_id || '", "simulate_failures": ' || (event_id % 6) || '}}' END AS body
          FROM events)
        SELECT message_id, body, CAST(1 AS BIGINT) AS retry_count, error AS last_error,
               delivered_at + INTERVAL 3 SECOND AS due_at
        FROM ledger JOIN body ON event_id = message_id
        WHERE attempt = 0 AND target = 'retry'""",
    "cache_keys_nested": """SELECT event_id, 'shop:search:' || left(sha256(
            '{"filter":{"amount":' || CAST(value AS VARCHAR) || ',"kind":"' || event_type || '"},"flags":{'
            || CASE WHEN event_type < 'all' THEN '"' || event_type || '":' || (event_id % 3 = 0) || ',"all":null'
                    ELSE '"all":null,"' || event_type || '":' || (event_id % 3 = 0) END
            || '},"ids":[' || user_id || ',' || CASE WHEN event_id % 7 <> 0 THEN CAST(event_id AS VARCHAR) ELSE 'null' END
            || '],"since":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END
            || '"}'), 16) AS cache_key FROM events""",
    "cache_keys": """SELECT event_id, 'shop:product:' ||
               left(sha256('{"id":' || user_id || ',"kind":"' || event_type || '"}'), 16) AS cache_key FROM events""",
    "product_attributes": """SELECT p_partkey AS id, 'product-' || p_partkey AS name,
               CAST(CAST(10.99 AS DECIMAL(10,2)) + p_partkey * 7 % 90 AS DOUBLE) AS price FROM part""",
    "lookup_once": """SELECT event_id AS seq, user_id AS key, c_name AS value
        FROM events LEFT JOIN customer ON c_custkey = user_id WHERE event_type <> 'error'""",
    "lookup_by_function": """SELECT event_id AS seq, user_id AS key, 'product-' || user_id AS value
        FROM events WHERE event_type <> 'error'""",
    "lookup_load_counts": """SELECT user_id AS key, CAST(1 AS BIGINT) AS loads, count(*) AS answers, CAST(1 AS INTEGER) AS one_value
        FROM events WHERE event_type <> 'error' GROUP BY user_id""",
    "lookup_fail_open": f"""WITH {FAIL_OPEN}
        SELECT seq, key, CASE WHEN status = 'hit' THEN 'cached ' || c_name ELSE c_name END AS value, status FROM served""",
    "served_status_counts": f"WITH {FAIL_OPEN} SELECT status, count(*) AS requests FROM served GROUP BY status",
    "bypass_alerts": f"""WITH {FAIL_OPEN}
        SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS period, count(*) AS requests,
               avg(CASE WHEN status = 'bypass' THEN 1.0 ELSE 0.0 END) AS bypass_rate
        FROM served GROUP BY 1 HAVING avg(CASE WHEN status = 'bypass' THEN 1.0 ELSE 0.0 END) > 0.5""",
    "ttl_status": f"{TTL} SELECT seq, key, status, load AS loaded_at FROM walk WHERE is_read",
    "ttl_status_counts": f"{TTL} SELECT status, count(*) AS requests FROM walk WHERE is_read GROUP BY status",
    "stream_ttl_status": f"{TTL} SELECT seq, key, status FROM walk WHERE is_read",
    "fenced_values": """SELECT user_id AS key, max(event_id * 7919 % 10007) AS fence,
               arg_max(value, (event_id * 7919 % 10007, event_id)) AS value
        FROM events GROUP BY user_id""",
    "rejected_writes": """SELECT key, seq, fence FROM (
          SELECT user_id AS key, event_id AS seq, event_id * 7919 % 10007 AS fence,
                 max(event_id * 7919 % 10007) OVER (PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS highest
          FROM events) WHERE fence < highest""",
    "collected_logs": f"WITH {LOGS} SELECT container_id, message, ts FROM named WHERE enabled = 'true'",
    "shipped_logs": f"WITH {LOGS} SELECT container_id, message, CASE WHEN ts IS NOT NULL THEN 'stdout' END AS stream, ts FROM named WHERE enabled = 'true'",
    "joined_logs": """SELECT CAST(user_id AS VARCHAR) AS container_id, CASE event_id % 2 WHEN 0 THEN 'stdout' ELSE 'stderr' END AS stream,
               event_type || ' log line ' || event_id AS message, ts, 1 + event_id % 5 AS parts FROM events""",
    "log_metadata": f"WITH {LOGS} SELECT message, container_name, enabled FROM named",
    "project_logs": f"WITH {LOGS} SELECT message, container_name FROM named WHERE regexp_matches(container_name, '^project-.+-[0-9]+$')",
    "labelled_logs": f"WITH {LOGS} SELECT container_id, message FROM named WHERE enabled = 'false'",
    "log_day_counts": f"WITH {LOGS} SELECT strftime(ts, '%Y.%m.%d') AS day, count(*) AS n FROM named WHERE enabled = 'true' GROUP BY 1",
    "retained_days": f"""WITH {LOGS} SELECT strftime(ts, '%Y.%m.%d') AS day, count(*) AS n FROM named
        WHERE enabled = 'true' AND (ts IS NULL OR CAST(ts AS DATE) > DATE '2024-01-31' - 7) GROUP BY 1""",
    "retained_by_creation": f"""WITH {LOGS}, dated AS (
          SELECT strftime(ts, '%Y.%m.%d') AS day, coalesce(ts < TIMESTAMP '2024-01-20' AND container_id::BIGINT % 2 <> 0
            AND NOT ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12', false) AS at_once
          FROM named WHERE enabled = 'true')
        SELECT day, count(*) AS n FROM dated WHERE day IS NULL OR day NOT IN (SELECT day FROM dated WHERE at_once) GROUP BY 1""",
    "indexed_phrase_search": """
        SELECT phrase, event_id FROM events, (VALUES ('CLICK log-line', 'click log line'), ('Line 77', 'line 77'), ('log click', 'log click')) AS p(phrase, words)
        WHERE regexp_matches(event_type || ' log line ' || event_id, '(?i)(^|[^a-z0-9_])' || words || '([^a-z0-9_]|$)')""",
    "phrase_search": """SELECT count(*) AS n FROM events
        WHERE regexp_matches(event_type || ' log line ' || event_id, '(?i)(^|[^a-z0-9_])click log line([^a-z0-9_]|$)')""",
    "phrase_counts": f"""
        WITH words AS (
          SELECT item_id, [x FOR x IN string_split({WORDS.format('text')}, ' ') IF x <> ''] AS w FROM benchmark),
        phrases AS (
          SELECT DISTINCT unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS phrase FROM words),
        texts AS (
          SELECT doc_id, [x FOR x IN string_split({WORDS.format('text')}, ' ') IF x <> ''] AS w FROM documents),
        runs AS (
          SELECT DISTINCT doc_id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS phrase FROM texts)
        SELECT p.phrase, count(r.doc_id) AS n FROM phrases p LEFT JOIN runs r ON r.phrase = p.phrase GROUP BY p.phrase""",
}

"""DuckDB SQL for each registered query, written from the rules and not from the Spark code."""

from __future__ import annotations

# murmur2 of the (ASCII) user id from its characters, then the value-aware partition.
_KEYS = """
keys AS (
  SELECT k, length(k) AS n, xor(2538058380::BIGINT, length(k)) AS h0,
    list_transform(range(length(k) // 4), lambda i:
      (ascii(k[4*i+1]) + 256 * ascii(k[4*i+2]) + 65536 * ascii(k[4*i+3]) + 16777216::BIGINT * ascii(k[4*i+4]))
      * 1540483477 % 4294967296) AS b
  FROM (SELECT DISTINCT user_id::VARCHAR AS k FROM events)),
mixed AS (
  SELECT k, n, list_reduce(
    list_prepend(h0, list_transform(b, lambda w: xor(w, w >> 24) * 1540483477 % 4294967296)),
    lambda h, w: xor(h * 1540483477 % 4294967296, w)) AS h FROM keys),
tailed AS (
  SELECT k, CASE n % 4
    WHEN 0 THEN h
    WHEN 1 THEN xor(h, ascii(k[n])::BIGINT) * 1540483477 % 4294967296
    WHEN 2 THEN xor(h, (ascii(k[n-1]) + 256 * ascii(k[n]))::BIGINT) * 1540483477 % 4294967296
    ELSE xor(h, (ascii(k[n-2]) + 256 * ascii(k[n-1]) + 65536 * ascii(k[n]))::BIGINT) * 1540483477 % 4294967296
  END AS h FROM mixed),
finished AS (
  SELECT k, xor(z, z >> 15) AS u FROM (
    SELECT k, xor(h, h >> 13) * 1540483477 % 4294967296 AS z FROM tailed)),
hashed AS (
  SELECT k,
    (CASE WHEN u = 2147483648 THEN 0 WHEN u > 2147483648 THEN 4294967296 - u ELSE u END % 6)::INTEGER AS coded,
    ((u & 2147483647) % 6)::INTEGER AS kafka
  FROM finished)
"""

_PLAIN = """
plain AS (
  SELECT event_id, event_type, props, concat('p-', event_id) AS payment_id, user_id::VARCHAR AS user_id,
    concat('m-', event_id % 50) AS merchant_id, value::DECIMAL(18,2) AS amount, 'USD' AS currency,
    CASE event_type WHEN 'click' THEN 'CARD' WHEN 'view' THEN 'ACH' WHEN 'signup' THEN 'WIRE'
      WHEN 'purchase' THEN 'WALLET' WHEN 'error' THEN 'UPI' END AS payment_method,
    ts AS record_ts, 'payment.initiated.events' AS topic, event_id AS "offset"
  FROM events)
"""

_PAYMENTS = _KEYS + "," + _PLAIN + """,
payments AS (
  SELECT plain.*, CASE WHEN amount > 100 THEN 0 ELSE coded END AS "partition"
  FROM plain JOIN hashed ON k = user_id)
"""

_LEVEL = "CASE WHEN total >= 300 THEN 'CRITICAL' WHEN total >= 225 THEN 'HIGH' ELSE 'MEDIUM' END"
_START = "time_bucket(INTERVAL 5 MINUTE, record_ts)"
_DAY = "date_trunc('day', record_ts)"

_DISORDERED = """
disordered AS (
  SELECT * REPLACE (event_id * 2 + CASE WHEN event_id % 17 = 0 THEN 81 ELSE 0 END AS "offset") FROM plain),
timed AS (
  SELECT *, max(record_ts) OVER (ORDER BY "offset" ROWS UNBOUNDED PRECEDING) AS stream_time FROM disordered)
"""

_REDELIVERED = """
redelivered AS (
  SELECT payment_id, record_ts, "offset", user_id, amount, topic FROM base
  UNION ALL SELECT payment_id, record_ts + INTERVAL 1 HOUR, "offset", user_id, amount, topic
    FROM base WHERE event_id % 11 = 0
  UNION ALL SELECT 'p-0', record_ts, "offset", user_id, amount, topic FROM base WHERE event_id % 3 = 0)
"""

_ATTEMPTS = """
failed AS (
  SELECT payment_id, event_id, record_ts,
    CASE WHEN event_id % 35 = 0 THEN 'DeserializationException' ELSE 'RuntimeException' END AS error_class,
    'cannot process ' || event_type AS exception_message, topic || '.' || event_type AS original_topic,
    CASE WHEN event_id % 35 = 0 THEN 1 ELSE event_id % 3 + 1 END AS n
  FROM plain),
latest AS (
  SELECT payment_id, n::INTEGER AS attempt,
    record_ts + to_seconds(CASE n WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 3 END) AS failed_at,
    error_class, exception_message, original_topic,
    CASE WHEN error_class <> 'RuntimeException' THEN 'not_retryable' WHEN n >= 3 THEN 'exhausted' ELSE 'retry' END
      AS disposition
  FROM failed)
"""

_OUTBOX = """
outbox AS (
  SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'F' THEN 'PUBLISHED' ELSE 'FAILED' END
    AS status, concat('topic.', o_orderpriority) AS kafka_topic, o_custkey::VARCHAR AS kafka_key,
    o_totalprice, o_orderdate AS created_at FROM orders)
"""

_CATALOG = """
raw_fields AS (
  SELECT l_orderkey AS subject, l_linenumber AS version, concat('f', l_partkey % 3) AS field,
    ['int', 'long', 'string', 'bytes', 'enum'][l_suppkey % 5 + 1] AS type, l_returnflag = 'N' AS has_default,
    (l_quantity % 4)::INTEGER AS top, l_linestatus = 'O' AS fallback FROM lineitem{kept}),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY subject, version, field
    ORDER BY type, has_default, CASE WHEN type = 'enum' THEN top ELSE 0 END, type = 'enum' AND fallback) AS r
  FROM raw_fields),
catalog AS (SELECT * EXCLUDE (r) FROM ranked WHERE r = 1),
pairs AS (
  SELECT subject, version, lag(version) OVER (PARTITION BY subject ORDER BY version) AS before
  FROM (SELECT DISTINCT subject, version FROM catalog) QUALIFY before IS NOT NULL),
news AS (SELECT * FROM catalog JOIN pairs USING (subject, version)),
olds AS (SELECT c.*, p.version AS next FROM catalog c JOIN pairs p ON p.subject = c.subject AND p.before = c.version),
sides AS (
  SELECT coalesce(n.subject, o.subject) AS subject, coalesce(n.version, o.next) AS version,
    n.type AS nt, n.has_default AS nd, n.top AS ns, n.fallback AS nf,
    o.type AS ot, o.has_default AS od, o.top AS os, o.fallback AS of
  FROM news n FULL JOIN olds o ON o.subject = n.subject AND o.next = n.version AND o.field = n.field),
judged AS (
  SELECT subject, version,
    bool_and(CASE WHEN nt IS NULL THEN true WHEN ot IS NULL THEN nd ELSE {fits_back} END) AS backward,
    bool_and(CASE WHEN ot IS NULL THEN true WHEN nt IS NULL THEN od ELSE {fits_forward} END) AS forward
  FROM sides GROUP BY ALL)
SELECT subject, version, backward, forward,
  CASE WHEN backward AND forward THEN 'FULL' WHEN backward THEN 'BACKWARD' WHEN forward THEN 'FORWARD'
    ELSE 'NONE' END AS verdict FROM judged
"""


def _fits(writer: str, reader: str, strict: bool) -> str:
    same = (f"({writer}t = {reader}t AND ({writer}t <> 'enum' OR ({reader}s >= {writer}s OR {reader}f)))")
    if strict:
        return same
    wider = [("int", "long"), ("string", "bytes"), ("bytes", "string")]
    return "(" + " OR ".join([same, *[f"({writer}t = '{w}' AND {reader}t = '{r}')" for w, r in wider]]) + ")"


def _catalog(strict: bool, kept: str = "") -> str:
    return "WITH" + _CATALOG.format(kept=kept, fits_back=_fits("o", "n", strict), fits_forward=_fits("n", "o", strict))


def _uuid(digest: str) -> str:
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return "concat_ws('-', " + ", ".join(f"substr({digest}, {s}, {n})" for s, n in cuts) + ")"


_PAYMENT_UUID = _uuid("md5('payment:' || \"offset\")")

_SPEND = """
SELECT user_id, {start} AS window_start, {start} + INTERVAL {size} AS window_end, (sum(amount) * 100)::BIGINT AS total,
  count(*) AS payments FROM {source} GROUP BY ALL
"""

ORACLES: dict[str, str] = {
    "q01_intake_validate": "WITH" + _PLAIN + """,
body AS (
  SELECT event_id, payment_id,
    CASE WHEN event_id % 23 = 0 THEN NULL WHEN event_id % 29 = 0 THEN '   '
      WHEN event_id % 31 = 0 THEN repeat('u', 65) ELSE user_id END AS u,
    CASE WHEN event_id % 43 = 0 THEN NULL ELSE merchant_id END AS m,
    CASE WHEN event_id % 19 = 0 THEN -amount ELSE amount END AS a,
    CASE WHEN event_id % 37 = 0 THEN '' WHEN event_id % 41 = 0 THEN 'USDX' ELSE 'USD' END AS c,
    CASE WHEN event_id % 47 = 0 THEN 'CASH' ELSE payment_method END AS p FROM plain),
judged AS (
  SELECT payment_id, CASE WHEN event_id % 53 = 0 THEN 'body:unreadable' ELSE concat_ws(',',
    CASE WHEN trim(coalesce(u, '')) = '' THEN 'userId:blank' END,
    CASE WHEN length(u) > 64 THEN 'userId:too_long' END,
    CASE WHEN trim(coalesce(m, '')) = '' THEN 'merchantId:blank' END,
    CASE WHEN a <= 0 THEN 'amount:not_positive' END,
    CASE WHEN c = '' THEN 'currency:blank' END,
    CASE WHEN length(c) > 3 THEN 'currency:too_long' END,
    CASE WHEN p = 'CASH' THEN 'paymentMethod:unknown' END) END AS reasons FROM body)
SELECT payment_id AS request_id, reasons = '' AS accepted, reasons AS reject_reasons FROM judged""",

    "q02_payment_rows": "WITH" + _PLAIN + f"""
SELECT {_PAYMENT_UUID} AS id, user_id, merchant_id, (amount * 100)::BIGINT AS amount, currency, 'INITIATED' AS status,
  record_ts AS created_at FROM plain""",

    "q02_outbox_envelope": "WITH" + _PLAIN + f""",
ids AS (SELECT *, {_PAYMENT_UUID} AS pid FROM plain)
SELECT {_uuid("md5('outbox:' || pid)")} AS id, 'Payment' AS aggregate_type, pid AS aggregate_id,
  'PaymentInitiatedEvent' AS event_type, topic AS kafka_topic, user_id AS kafka_key, 'PENDING' AS status,
  record_ts AS created_at, pid AS payload_payment_id, user_id AS payload_user_id,
  merchant_id AS payload_merchant_id, (amount * 100)::BIGINT AS payload_amount, currency AS payload_currency,
  epoch_us(record_ts) // 1000 AS payload_initiated_millis FROM ids""",

    "q03_outbox_relay_batch": "WITH" + _OUTBOX + """
SELECT id, kafka_topic, kafka_key, o_totalprice::VARCHAR AS payload, created_at FROM outbox
WHERE status = 'PENDING' ORDER BY created_at, id LIMIT 100""",

    "q03_outbox_signalled": "WITH" + _OUTBOX + """
SELECT id, kafka_topic, created_at FROM outbox
WHERE status = 'PENDING' AND id IN (SELECT l_partkey FROM lineitem)""",

    "q04_outbox_state": "WITH" + _OUTBOX + """,
marks AS (SELECT l_partkey AS id, max(l_shipdate) AS sent_at FROM lineitem GROUP BY ALL)
SELECT id, CASE WHEN sent_at IS NULL THEN status ELSE 'PUBLISHED' END AS status, sent_at AS published_at
FROM outbox LEFT JOIN marks USING (id)""",

    "q04_outbox_reconcile": "WITH" + _OUTBOX + """,
sent AS (SELECT l_orderkey * 2 - l_linenumber * 3 AS sid, count(*) AS n FROM lineitem GROUP BY ALL),
both_sides AS (
  SELECT coalesce(id, sid) AS id, id AS oid, status, created_at, coalesce(n, 0) AS copies
  FROM outbox FULL JOIN sent ON id = sid)
SELECT * FROM (
  SELECT id, CASE WHEN oid IS NULL THEN 'not_in_outbox' WHEN copies > 1 THEN 'published_twice'
      WHEN status = 'PUBLISHED' AND copies = 0 THEN 'missing_on_topic'
      WHEN status = 'PENDING' AND copies = 1 THEN 'sent_not_marked'
      WHEN status = 'PENDING' THEN 'pending' END AS issue, copies,
    CASE WHEN status = 'PENDING' THEN date_diff('second', created_at, TIMESTAMP '2001-08-02') END AS pending_seconds
  FROM both_sides) WHERE issue IS NOT NULL""",

    "q05_typed_landing": "WITH" + _PLAIN + """
SELECT "offset", payment_id, user_id, merchant_id, ((amount - 40) * 100)::BIGINT AS amount, 'USD' AS currency,
  CASE WHEN event_id % 2 = 0 THEN payment_method END AS payment_method,
  date_trunc('millisecond', record_ts) AS initiated_ts,
  CASE WHEN event_id % 2 = 0 THEN json_extract_string(props, '$.k') END AS metadata
FROM plain WHERE event_id % 26 <> 0 AND event_id % 34 <> 0""",

    "q05_landing_quarantine": "WITH" + _PLAIN + """
SELECT payment_id, "offset", 'amount:undecodable' AS poison_reason FROM plain
WHERE event_id % 26 = 0 OR event_id % 34 = 0""",

    "q06_quarantine_split": "WITH" + _PLAIN + """,
judged AS (
  SELECT *, CASE WHEN event_id % 41 = 0 THEN 'empty' WHEN event_id % 13 = 0 OR event_id % 19 = 0 THEN 'undecodable'
    WHEN event_id % 23 = 0 THEN 'missing:userId' ELSE '' END AS reason FROM plain)
SELECT "offset", reason = '' AS readable, reason, CASE WHEN reason = '' THEN payment_id END AS payment_id,
  CASE WHEN reason = '' THEN (amount * 100)::BIGINT END AS amount FROM judged""",

    "q07_partition_assign": "WITH" + _KEYS + "," + _PLAIN + """,
flagged AS (SELECT *, event_id % 97 <> 0 AND amount > 100 AS high_value FROM plain JOIN hashed ON k = user_id)
SELECT payment_id, user_id, CASE WHEN high_value THEN 0 ELSE coded END AS coded_partition,
  CASE WHEN high_value THEN 0 ELSE kafka END AS kafka_partition, high_value FROM flagged""",

    "q08_partition_skew": "WITH" + _PAYMENTS + """
SELECT "partition", count(*) AS records, count(*) FILTER (amount > 100) AS high_value_records,
  (sum(amount) * 100)::BIGINT AS amount FROM payments GROUP BY ALL""",

    "q09_idempotent_first": "WITH" + _PLAIN + ", base AS (SELECT * FROM plain)," + _REDELIVERED + """,
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY payment_id ORDER BY record_ts, "offset") AS r,
    count(*) OVER (PARTITION BY payment_id) AS deliveries FROM redelivered)
SELECT 'payment-event:' || payment_id AS message_key, topic, record_ts AS processed_at, "offset", user_id,
  (amount * 100)::BIGINT AS amount, deliveries FROM ranked WHERE r = 1""",

    "q10_idempotent_ttl": """
WITH RECURSIVE claims AS (SELECT user_id, ts FROM events WHERE event_type <> 'error'),
chain(user_id, ts) AS (
  SELECT user_id, min(ts) FROM claims GROUP BY user_id
  UNION ALL
  SELECT c.user_id, min(e.ts) FROM chain c JOIN claims e
    ON e.user_id = c.user_id AND e.ts >= c.ts + INTERVAL 24 HOUR GROUP BY c.user_id)
SELECT concat('p-', e.event_id) AS payment_id, e.user_id::VARCHAR AS user_id, e.ts AS record_ts,
  CASE WHEN c.ts IS NULL THEN 'failed' WHEN c.ts = e.ts AND e.event_type <> 'error' THEN 'processed'
    ELSE 'duplicate' END AS outcome
FROM events e LEFT JOIN chain c
  ON c.user_id = e.user_id AND e.ts >= c.ts AND e.ts < c.ts + INTERVAL 24 HOUR""",

    "q11_window_spend": "WITH" + _PLAIN + _SPEND.format(start=_START, size="5 MINUTE", source="plain"),

    "q11_window_payment_ids": "WITH" + _PLAIN + f"""
SELECT user_id, {_DAY} AS window_start, {_DAY} + INTERVAL 1 DAY AS window_end, (sum(amount) * 100)::BIGINT AS total,
  count(*) AS payments, string_agg(payment_id, ',' ORDER BY record_ts, "offset") AS triggering_payment_ids
FROM plain GROUP BY ALL""",

    "q12_high_risk_alerts": "WITH" + _PLAIN + f""",
spend AS (
  SELECT user_id, {_START} AS window_start, {_START} + INTERVAL 5 MINUTE AS window_end, sum(amount) AS total,
    count(*) AS payments, string_agg(payment_id, ',' ORDER BY record_ts, "offset") AS ids FROM plain GROUP BY ALL)
SELECT user_id, window_start, window_end, (total * 100)::BIGINT AS total_amount, payments, {_LEVEL} AS risk_level,
  ids AS triggering_payment_ids FROM spend
WHERE total > 150 AND window_end + INTERVAL 30 SECOND <= (SELECT max(ts) FROM events)""",

    "q12_deduped_alerts": "WITH" + _PLAIN + ", base AS (SELECT * FROM plain)," + _REDELIVERED + f""",
firsts AS (
  SELECT * FROM redelivered
  QUALIFY row_number() OVER (PARTITION BY payment_id ORDER BY record_ts, "offset", user_id) = 1),
spend AS (
  SELECT user_id, {_DAY} AS window_start, {_DAY} + INTERVAL 1 DAY AS window_end, sum(amount) AS total,
    count(*) AS payments, string_agg(payment_id, ',' ORDER BY record_ts, "offset") AS ids FROM firsts GROUP BY ALL)
SELECT user_id, window_start, window_end, (total * 100)::BIGINT AS total_amount, payments, {_LEVEL} AS risk_level,
  ids AS triggering_payment_ids FROM spend
WHERE total > 150 AND window_end + INTERVAL 30 SECOND <= (SELECT max(record_ts) FROM redelivered)""",

    "q12_alert_id_blocks": "WITH" + _PLAIN + f""",
rich AS (
  SELECT user_id, {_DAY} AS window_start FROM plain GROUP BY ALL HAVING sum(amount) > 150)
SELECT user_id, {_DAY} AS window_start, "offset" // 100 AS block,
  string_agg(payment_id, ',' ORDER BY record_ts, "offset") AS payment_ids
FROM plain WHERE (user_id, {_DAY}) IN (SELECT (user_id, window_start) FROM rich) GROUP BY ALL""",

    "q13_risk_level_summary": "WITH" + _PLAIN + f""",
spend AS (SELECT user_id, {_START} AS w, sum(amount) AS total FROM plain GROUP BY ALL)
SELECT {_LEVEL} AS risk_level, count(*) AS alerts, (sum(total) * 100)::BIGINT AS total_amount FROM spend
WHERE total > 150 GROUP BY ALL""",

    "q14_early_signal": "WITH" + _PLAIN + f""",
summed AS (
  SELECT payment_id, user_id, {_DAY} AS window_start, sum(amount) OVER (
    PARTITION BY user_id, {_DAY} ORDER BY record_ts, "offset" ROWS UNBOUNDED PRECEDING) AS total FROM plain)
SELECT payment_id, user_id, window_start, (total * 100)::BIGINT AS running_total, total > 150 AS over_threshold FROM summed""",

    "q15_late_drop": "WITH" + _PLAIN + "," + _DISORDERED + f"""
SELECT payment_id, record_ts, stream_time,
  {_START} + INTERVAL 5 MINUTE <= stream_time - INTERVAL 30 SECOND AS late FROM timed""",

    "q15_spend_without_late": "WITH" + _PLAIN + "," + _DISORDERED + """,
kept AS (
  SELECT * FROM timed
  WHERE date_trunc('hour', record_ts) + INTERVAL 1 HOUR > stream_time - INTERVAL 30 SECOND)"""
        + _SPEND.format(start="date_trunc('hour', record_ts)", size="1 HOUR", source="kept"),

    "q16_partition_split_audit": "WITH" + _PAYMENTS + f""",
partial AS (
  SELECT user_id, {_DAY} AS window_start, "partition", sum(amount) AS s FROM payments GROUP BY ALL),
merged AS (
  SELECT user_id, window_start, window_start + INTERVAL 1 DAY AS window_end, sum(s) AS total,
    max(s) AS largest_partial, count(*) AS partitions FROM partial GROUP BY ALL)
SELECT user_id, window_start, window_end, (total * 100)::BIGINT AS total, (largest_partial * 100)::BIGINT AS largest_partial,
  partitions, total > 150 AS user_alert, largest_partial > 150 AS split_alert FROM merged
WHERE (total > 150) <> (largest_partial > 150)""",

    "q17_retry_schedule": "WITH" + _PLAIN + "," + _ATTEMPTS + """
SELECT payment_id, attempt, failed_at, disposition, CASE WHEN disposition = 'retry' THEN
  date_trunc('millisecond', failed_at) + to_seconds(CASE attempt WHEN 1 THEN 1 ELSE 2 END) END AS next_attempt_at
FROM latest""",

    "q17_container_retry": "WITH" + _PLAIN + "," + _ATTEMPTS + """,
due AS (
  SELECT payment_id, attempt, date_trunc('millisecond', failed_at) + INTERVAL 1 SECOND AS next_attempt_at
  FROM latest WHERE disposition = 'retry')
SELECT * FROM due WHERE next_attempt_at <= TIMESTAMP '2024-01-15'""",

    "q17_dead_letters": "WITH" + _PLAIN + "," + _ATTEMPTS + """
SELECT payment_id, attempt AS attempts, failed_at, error_class, exception_message, original_topic, disposition
FROM latest WHERE disposition <> 'retry'""",

    "q18_dead_letter_monitor": "WITH" + _PLAIN + "," + _ATTEMPTS + """
SELECT date_trunc('day', failed_at) AS window_start, original_topic, error_class, count(*) AS dead_letters,
  max(attempt) AS max_attempts, count(*) >= 3 AS burst FROM latest WHERE disposition <> 'retry' GROUP BY ALL""",

    "q19_latest_by_key": "WITH" + _PLAIN + """,
last AS (SELECT * FROM plain QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY "offset" DESC) = 1)
SELECT user_id, (amount * 100)::BIGINT AS balance, "offset" FROM last WHERE event_type <> 'error'""",

    "q19_compacted_log": "WITH" + _PLAIN + """,
last AS (SELECT * FROM plain QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY "offset" DESC) = 1)
SELECT user_id, record_ts, "offset", event_type = 'error' AS tombstone FROM last
WHERE event_type <> 'error' OR record_ts > TIMESTAMP '2024-01-30'""",

    "q20_retention_time": "WITH" + _PLAIN + """
SELECT payment_id, record_ts FROM plain WHERE record_ts >= TIMESTAMP '2024-01-24'""",

    "q20_alert_retention": "WITH" + _PLAIN + f""",
spend AS (
  SELECT user_id, {_START} AS window_start, {_START} + INTERVAL 5 MINUTE AS window_end, sum(amount) AS total,
    count(*) AS payments FROM plain GROUP BY ALL)
SELECT user_id, window_start, window_end, payments, (total * 100)::BIGINT AS total_amount, {_LEVEL} AS risk_level
FROM spend WHERE total > 150 AND window_end >= TIMESTAMP '2024-01-11'""",

    "q21_retention_bytes": "WITH" + _PAYMENTS + """,
sized AS (SELECT *, strlen(props) + strlen(user_id) AS bytes FROM payments),
summed AS (
  SELECT *, sum(bytes) OVER (PARTITION BY "partition" ORDER BY "offset" DESC ROWS UNBOUNDED PRECEDING) AS newer
  FROM sized)
SELECT payment_id, "partition", "offset", bytes::INTEGER AS bytes FROM summed WHERE newer <= 10000""",

    "q22_read_committed": "WITH" + _PLAIN + """,
committed AS (SELECT DISTINCT "offset" // 100 AS b FROM plain WHERE "offset" % 100 = 50 AND event_type <> 'error')
SELECT "offset" // 100 AS batch_id, payment_id, user_id, output
FROM plain, (VALUES ('processed'), ('balance')) AS o(output) WHERE "offset" // 100 IN (SELECT b FROM committed)""",

    "q23_schema_compat": _catalog(strict=False),
    "q23_schema_compat_strict": _catalog(strict=True),
    "q23_deleted_versions": _catalog(strict=False, kept=" WHERE (l_orderkey + l_linenumber) % 3 <> 0"),

    "q24_evolved_read": "WITH" + _PLAIN + """
SELECT payment_id, user_id, merchant_id, (amount * 100)::BIGINT AS amount,
  CASE WHEN event_id % 3 <> 0 AND event_id % 10 <> 0 THEN 'EUR' ELSE 'USD' END AS currency,
  CASE WHEN event_id % 3 <> 0 THEN payment_method END AS payment_method, record_ts AS initiated_ts, 0 AS metadata
FROM plain""",

    "q24_processed_defaults": "WITH" + _PLAIN + """
SELECT payment_id, user_id, (amount * 100)::BIGINT AS amount, 'USD' AS currency,
  CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'APPROVED' END AS status, 0.0::DOUBLE AS risk_score,
  record_ts AS processed_ts, CASE WHEN event_type = 'error' THEN 'declined by issuer' END AS failure_reason
FROM plain""",

    "q25_topic_counts": "WITH" + _PAYMENTS + """
SELECT topic, "partition", count(*) AS records,
  CASE WHEN grouping("partition") = 0 THEN max("offset") + 1 END AS end_offset
FROM payments GROUP BY GROUPING SETS ((topic, "partition"), (topic))""",

    "q26_consumer_lag": "WITH" + _PAYMENTS + """,
ends AS (SELECT topic, "partition", max("offset") + 1 AS end_offset FROM payments GROUP BY ALL),
progress AS (
  SELECT g.group_id, p."partition", max(p."offset") + 1 AS done
  FROM payments p, (VALUES ('fraud-monitor', TIMESTAMP '2100-01-01'), ('ledger', TIMESTAMP '2024-01-20'))
    AS g(group_id, until)
  WHERE p.event_id % 20 = 19 AND p.record_ts < g.until GROUP BY ALL),
owed AS (SELECT group_id, ends.* FROM ends, (VALUES ('fraud-monitor'), ('ledger')) AS g(group_id))
SELECT group_id, topic, owed."partition", end_offset, coalesce(done, 0) AS committed_offset,
  end_offset - coalesce(done, 0) AS lag
FROM owed LEFT JOIN progress ON progress.group_id = owed.group_id AND progress."partition" = owed."partition" """
        .replace("SELECT group_id, topic, owed", "SELECT owed.group_id, topic, owed"),

    "q27_delivery_audit": "WITH" + _PLAIN + ", base AS (SELECT * FROM plain WHERE event_id % 97 <> 0),"
        + _REDELIVERED + """,
counts AS (
  SELECT payment_id, coalesce(a.n, 0) AS accepted, coalesce(d.n, 0) AS delivered
  FROM (SELECT payment_id, count(*) AS n FROM plain GROUP BY ALL) a
  FULL JOIN (SELECT payment_id, count(*) AS n FROM redelivered GROUP BY ALL) d USING (payment_id))
SELECT payment_id, accepted, delivered, CASE WHEN accepted = 0 THEN 'not_accepted' WHEN delivered = 0 THEN 'lost'
  ELSE 'duplicated' END AS issue FROM counts WHERE accepted = 0 OR delivered = 0 OR delivered > accepted""",

    "q27_offset_gaps": "WITH" + _PLAIN + """,
kept AS (
  SELECT topic, "offset", lag("offset") OVER (ORDER BY "offset") AS b FROM plain
  WHERE event_type <> 'error' AND amount < 100)
SELECT topic, 0 AS "partition", b + 1 AS first_missing, "offset" - 1 AS last_missing, "offset" - b - 1 AS missing
FROM kept WHERE "offset" > b + 1""",

    "q27_order_inversions": "WITH" + _PLAIN + "," + _DISORDERED + """,
seen AS (
  SELECT *, max(record_ts) OVER (PARTITION BY payment_method ORDER BY "offset"
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest_before FROM disordered)
SELECT payment_id, payment_method, record_ts, newest_before FROM seen WHERE record_ts < newest_before""",

    "q15_late_by_topic": "WITH" + _PLAIN + "," + _DISORDERED + f""",
split AS (
  SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 'replayed' ELSE topic END AS topic) FROM disordered),
own AS (
  SELECT *, max(record_ts) OVER (PARTITION BY topic ORDER BY "offset" ROWS UNBOUNDED PRECEDING) AS seen FROM split)
SELECT payment_id, topic, seen AS stream_time, {_START} + INTERVAL 5 MINUTE <= seen - INTERVAL 30 SECOND AS late
FROM own""",

    "q27_user_inversions": "WITH" + _PLAIN + """,
moved AS (
  SELECT * REPLACE (event_id * 2 + CASE WHEN event_id % 17 = 0 THEN 4001 ELSE 0 END AS "offset") FROM plain),
seen AS (
  SELECT *, max(record_ts) OVER (PARTITION BY user_id ORDER BY "offset"
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest_before FROM moved)
SELECT payment_id, user_id, record_ts, newest_before FROM seen WHERE record_ts < newest_before""",

    "q28_hopping_alerts": "WITH" + _PLAIN + f""",
hops AS (
  SELECT payment_id, user_id, amount, record_ts, "offset",
    time_bucket(INTERVAL 1 MINUTE, record_ts) - to_minutes(i) AS window_start FROM plain, range(5) AS r(i)),
spend AS (
  SELECT user_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end, sum(amount) AS total,
    count(*) AS payments, string_agg(payment_id, ',' ORDER BY record_ts, "offset") AS ids FROM hops GROUP BY ALL)
SELECT user_id, window_start, window_end, (total * 100)::BIGINT AS total_amount, payments, {_LEVEL} AS risk_level,
  ids AS triggering_payment_ids FROM spend WHERE total > 150""",

    "q28_hopping_spend": "WITH" + _PLAIN + """,
hops AS (
  SELECT user_id, amount, time_bucket(INTERVAL 1 MINUTE, record_ts) - to_minutes(i) AS window_start
  FROM plain, range(5) AS r(i))
SELECT user_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end, (sum(amount) * 100)::BIGINT AS total,
  count(*) AS payments FROM hops GROUP BY ALL""",

    "q03_relay_offsets": "WITH" + _OUTBOX + """
SELECT id, kafka_topic AS topic, (kafka_key::BIGINT % 4)::INTEGER AS "partition",
  row_number() OVER (PARTITION BY kafka_topic, kafka_key::BIGINT % 4 ORDER BY created_at, id) - 1 AS "offset"
FROM outbox""",

    "q15_late_in_batches": "WITH" + _PLAIN + "," + _DISORDERED + f"""
SELECT payment_id, stream_time, {_START} + INTERVAL 5 MINUTE <= stream_time - INTERVAL 30 SECOND AS late FROM timed""",

    "q18_monitor_deltas": "WITH" + _PLAIN + "," + _ATTEMPTS + """
SELECT date_trunc('day', failed_at) AS window_start, original_topic, error_class, count(*) AS dead_letters,
  max(attempt) AS max_attempts, count(*) >= 3 AS burst FROM latest WHERE disposition <> 'retry' GROUP BY ALL""",
}

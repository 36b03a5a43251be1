"""DuckDB SQL equivalent to each fixture query (same column names).

Each statement reads the driver's tables as pre-registered views and states
the operator's semantics directly (QUALIFY, NOT IN, self-joins), which makes
it an independent check of the Spark plan in ``fixtures``.
"""

_TASKS = """
  SELECT user_id AS task_name,
         CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCEEDED' END AS state,
         ts AS scheduled_time, event_id, props AS error_message
  FROM events
"""

_ALL = ("region nation customer supplier part orders lineitem events documents "
        "embeddings pages benchmark labels conversations").split()

_SUPPLIER_DELTA = """
  SELECT s_suppkey, s_name || '-v2' AS s_name, s_nationkey, s_acctbal,
         CASE WHEN s_nationkey < 5 THEN 'DELETED' WHEN s_nationkey < 10 THEN 'UPDATED'
              WHEN s_nationkey < 15 THEN 'NEW' WHEN s_nationkey < 20 THEN 'BOGUS' ELSE '' END AS chng_flag
  FROM supplier
  UNION ALL
  SELECT s_suppkey + 1000000000, 'New-' || s_name, s_nationkey, s_acctbal,
         CASE WHEN s_nationkey < 5 THEN 'DELETED' WHEN s_nationkey < 10 THEN 'UPDATED'
              WHEN s_nationkey < 15 THEN 'NEW' WHEN s_nationkey < 20 THEN 'BOGUS' ELSE '' END
  FROM supplier
"""

_PAIRS = """
  SELECT c.o_orderkey AS claim_key, r.o_orderkey AS reversal_key,
         c.o_orderdate AS claim_date, r.o_orderdate AS reversal_date
  FROM orders c JOIN orders r
    ON c.o_custkey = r.o_custkey AND c.o_orderpriority = r.o_orderpriority
   AND c.o_orderdate < r.o_orderdate
  WHERE c.o_orderstatus = 'F' AND c.o_orderdate >= TIMESTAMP '1995-01-01 00:00:00'
    AND r.o_orderstatus = 'P' AND r.o_orderdate < TIMESTAMP '2001-06-01 00:00:00'
"""

_DUP = """
  WITH c AS (SELECT *, strftime(o_orderdate, '%m') AS bin FROM orders),
  ch AS (SELECT o_custkey, o_orderpriority, o_orderkey AS record_id, max(o_orderdate) AS max_time
         FROM c WHERE bin <> '12' AND o_orderstatus = 'P'
         GROUP BY o_custkey, o_orderpriority, o_orderkey),
  m AS (SELECT t.o_orderkey AS ck, ch.record_id AS rk, ch.max_time AS rt
        FROM c t JOIN ch ON t.o_custkey = ch.o_custkey AND t.o_orderpriority = ch.o_orderpriority
                        AND t.o_orderdate < ch.max_time
        WHERE (t.bin = '12' OR t.o_orderstatus = 'F') AND t.o_orderdate >= TIMESTAMP '2001-06-01 00:00:00' - INTERVAL 5 YEAR)
"""

_FLAG = "['DELETED', 'UPDATED', 'NEW', 'BOGUS', ''][1 + ({}) % 5]"

ORACLE = {
    "currently_failed": f"""
WITH t AS ({_TASKS}),
last AS (SELECT task_name, state, scheduled_time, event_id FROM t
         WHERE scheduled_time BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 00:00:00'
         QUALIFY row_number() OVER (PARTITION BY task_name
                                    ORDER BY scheduled_time DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1)
SELECT * FROM last WHERE state = 'FAILED'
""",
    "failed_since": f"""
SELECT task_name, state, scheduled_time, event_id FROM ({_TASKS}) t
WHERE state IN ('FAILED', 'CANCELLED', 'FAILED_AND_AUTO_SUSPENDED')
  AND scheduled_time >= date_trunc('minute', TIMESTAMP '2024-01-20 12:34:56') - INTERVAL 90 MINUTE
  AND scheduled_time <= TIMESTAMP '2024-01-20 12:34:56'
ORDER BY scheduled_time DESC, event_id DESC LIMIT 10
""",
    "failure_alert": f"""
SELECT count(*) > 0 AS alert FROM ({_TASKS}) t
WHERE state IN ('FAILED', 'CANCELLED', 'FAILED_AND_AUTO_SUSPENDED')
  AND scheduled_time >= date_trunc('minute', TIMESTAMP '2024-01-20 12:34:56') - INTERVAL 90 MINUTE
  AND scheduled_time <= TIMESTAMP '2024-01-20 12:34:56'
""",
    "alert_probe": f"""
SELECT 1 AS hit FROM ({_TASKS}) t
WHERE state IN ('FAILED', 'CANCELLED', 'FAILED_AND_AUTO_SUSPENDED')
  AND scheduled_time BETWEEN date_trunc('minute', TIMESTAMP '2024-01-20 12:34:56') - INTERVAL 90 MINUTE
                         AND TIMESTAMP '2024-01-20 12:34:56'
LIMIT 1
""",
    "alert_history": f"""
SELECT task_name, state, scheduled_time, event_id FROM ({_TASKS}) t
WHERE state IN ('FAILED', 'CANCELLED', 'FAILED_AND_AUTO_SUSPENDED') AND scheduled_time >= TIMESTAMP '2024-01-20 00:00:00'
""",
    "failed_runs": f"""
SELECT task_name, state, scheduled_time, event_id, error_message FROM ({_TASKS}) t
WHERE state = 'FAILED'
  AND CAST(task_name AS VARCHAR) ILIKE '1%' AND error_message ILIKE '%"k": 1%'
  AND scheduled_time > TIMESTAMP '2024-01-20 00:00:00'
""",
    "events_typed_since": """
SELECT event_id, event_type, ts, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM events
WHERE event_type IN ('click', 'purchase', 'view', 'signup')
  AND ts > TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-25 00:00:00'
  AND (event_type LIKE 'c%' OR event_type LIKE 'p%' OR event_type LIKE 'v%')
  AND TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) > 10
""",
    "staged_json_events": """
SELECT event_id AS event_ref, event_type, event_id + 1000000000000000000 AS record_id, user_id,
       ts AS ingested_timestamp
FROM events
WHERE event_type IN ('purchase', 'signup') AND ts > TIMESTAMP '2024-01-10 00:00:00'
""",
    "login_history": """
SELECT user_id, ts, event_type FROM events
WHERE CAST(user_id AS VARCHAR) ILIKE '1_' OR CAST(user_id AS VARCHAR) ILIKE '2_'
ORDER BY ts DESC, event_id DESC LIMIT 100
""",
    "events_by_id": """
SELECT event_id, ts, user_id, event_type FROM events
WHERE event_id IN (SELECT doc_id FROM labels) AND ts > TIMESTAMP '2024-01-03 00:00:00'
ORDER BY ts DESC, event_id DESC LIMIT 100
""",
    "count_by_type": """
SELECT event_type, count(*) AS n_rows FROM events
WHERE ts > TIMESTAMP '2024-01-05 00:00:00' GROUP BY event_type
""",
    "distinct_types": """
SELECT DISTINCT event_type FROM events
WHERE (event_type LIKE '%i%' OR event_type LIKE 's%') AND ts > TIMESTAMP '2024-01-05 00:00:00'
ORDER BY event_type
""",
    "total_distinct": """
SELECT count(*) AS n_total, (SELECT count(*) FROM (SELECT DISTINCT user_id FROM events)) AS n_distinct
FROM events
""",
    "duplicate_keys": """
SELECT l_orderkey, l_linenumber, count(*) AS cnt FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""",
    "out_of_order": """
SELECT conv_id, arg_min(role, turn) AS first_role FROM conversations
GROUP BY conv_id HAVING upper(arg_min(role, turn)) <> 'USER'
""",
    "transmission_out_of_order": """
SELECT o_orderkey AS transmission_id FROM orders
WHERE (o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%')
  AND (upper(CASE WHEN o_orderstatus = 'F' THEN 'created' WHEN o_orderstatus = 'O' THEN 'CREATED' ELSE 'open' END)
         <> 'CREATED'
       OR upper(CASE WHEN o_orderpriority LIKE '2%' THEN 'response' ELSE 'request' END) <> 'REQUEST')
""",
    "transmission_blank_status": """
SELECT count(*) FILTER (WHERE o_orderstatus = 'P') AS n_blank, count(*) AS n_rows FROM orders
WHERE o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' OR o_orderpriority LIKE '5%'
""",
    "status_mismatch": """
WITH one AS (SELECT l_orderkey, min(l_linestatus) AS l_linestatus FROM lineitem
             GROUP BY l_orderkey HAVING count(*) = 1)
SELECT o.o_orderkey, o.o_orderstatus, one.l_linestatus
FROM orders o JOIN one ON o.o_orderkey = one.l_orderkey
WHERE o.o_orderstatus <> one.l_linestatus
""",
    "single_table_mismatch": """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
WHERE l_returnflag <> l_linestatus AND l_linenumber = 1
""",
    "id_list": """
SELECT DISTINCT CAST(id AS VARCHAR) AS record_id
FROM (SELECT o_orderkey AS id FROM orders UNION ALL SELECT o_custkey FROM orders) WHERE id IS NOT NULL
""",
    "count_blank": """
SELECT count(*) FILTER (WHERE split_part(url, '?', 2) = '') AS n_blank, count(*) AS n_rows FROM pages
""",
    "bad_numerics": """
SELECT p_partkey, column_name, value FROM (
  SELECT p_partkey, 'brand_no' AS column_name, split_part(p_brand, '#', 2) AS value FROM part
  UNION ALL
  SELECT p_partkey, 'p_type', p_type FROM part)
WHERE value IS NOT NULL AND TRY_CAST(value AS BIGINT) IS NULL
""",
    "load_history": """
SELECT page_id, url FROM pages
WHERE page_id > 10 AND (url LIKE '%/en/%' OR url LIKE '%.html')
ORDER BY page_id DESC LIMIT 1000
""",
    "parse_delta": """
WITH l AS (SELECT concat_ws('|', s_suppkey, s_name, s_nationkey, CAST(floor(s_acctbal) AS BIGINT)) AS data
           FROM supplier)
SELECT CASE WHEN regexp_matches(split_part(data, '|', 1), '^[0-9]+$')
            THEN CAST(split_part(data, '|', 1) AS BIGINT) END AS supp_id,
       split_part(data, '|', 2) AS supp_name,
       CASE WHEN regexp_matches(split_part(data, '|', 3), '^[0-9]+$')
            THEN CAST(split_part(data, '|', 3) AS BIGINT) END AS nation_id,
       CASE WHEN regexp_matches(split_part(data, '|', 4), '^[0-9]+$')
            THEN CAST(split_part(data, '|', 4) AS BIGINT) END AS acct,
       split_part(data, '|', 5) AS extra
FROM l
""",
    "merge_flags": f"""
WITH d AS ({_SUPPLIER_DELTA}),
kept AS (
  SELECT t.s_suppkey,
         CASE WHEN d.chng_flag = 'UPDATED' THEN d.s_name ELSE t.s_name END AS s_name,
         CASE WHEN d.chng_flag = 'UPDATED' THEN d.s_nationkey ELSE t.s_nationkey END AS s_nationkey,
         CASE WHEN d.chng_flag = 'UPDATED' THEN d.s_acctbal ELSE t.s_acctbal END AS s_acctbal
  FROM supplier t LEFT JOIN d ON t.s_suppkey = d.s_suppkey
  WHERE d.chng_flag IS NULL OR d.chng_flag <> 'DELETED'),
ins AS (
  SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM d
  WHERE chng_flag IN ('NEW', 'UPDATED') AND s_suppkey NOT IN (SELECT s_suppkey FROM supplier))
SELECT * FROM kept UNION ALL SELECT * FROM ins
""",
    "delta_by_flag": f"""
SELECT * FROM ({_SUPPLIER_DELTA}) d WHERE chng_flag = 'UPDATED'
""",
    "upsert": """
WITH r AS (
  SELECT s_suppkey, s_name, s_nationkey, s_acctbal + 1 AS s_acctbal FROM supplier
  WHERE s_nationkey BETWEEN 10 AND 14
  UNION ALL
  SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_nationkey >= 20)
SELECT t.s_suppkey, t.s_name, t.s_nationkey,
       CASE WHEN r.s_suppkey IS NOT NULL THEN r.s_acctbal ELSE t.s_acctbal END AS s_acctbal
FROM supplier t LEFT JOIN r ON t.s_suppkey = r.s_suppkey
UNION ALL
SELECT * FROM r WHERE s_suppkey NOT IN (SELECT s_suppkey FROM supplier)
""",
    "export_text": """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority
FROM orders ORDER BY o_orderkey
""",
    "export_since": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE o_orderkey > 1000
  AND o_orderkey <= (SELECT max(v) FROM (SELECT o_orderkey AS v FROM orders WHERE o_orderkey > 1000 ORDER BY v LIMIT 500))
""",
    "export_all_batches": "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderdate IS NOT NULL",
    "delta_composite": f"""
WITH c AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey + 1 END AS l_suppkey,
                  'v2-' || l_linestatus AS l_linestatus, {_FLAG.format("l_orderkey + l_linenumber")} AS flag
           FROM lineitem WHERE l_orderkey % 3 = 0),
u AS (SELECT * FROM c QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1),
d AS (SELECT * FROM u UNION ALL SELECT l_orderkey + 1000000000, l_linenumber, l_suppkey, l_linestatus, flag FROM u)
SELECT t.l_orderkey, t.l_linenumber, CASE WHEN d.flag = 'UPDATED' THEN d.l_suppkey ELSE t.l_suppkey END AS l_suppkey,
       CASE WHEN d.flag = 'UPDATED' THEN d.l_linestatus ELSE t.l_linestatus END AS l_linestatus
FROM lineitem t LEFT JOIN d USING (l_orderkey, l_linenumber) WHERE d.flag IS NULL OR d.flag <> 'DELETED'
UNION ALL
SELECT l_orderkey, l_linenumber, l_suppkey, l_linestatus FROM d
WHERE flag IN ('NEW', 'UPDATED') AND NOT EXISTS (
  SELECT 1 FROM lineitem t WHERE t.l_orderkey = d.l_orderkey AND t.l_linenumber = d.l_linenumber)
""",
    "delta_set_aside": f"""
WITH c AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 7 <> 0 THEN l_suppkey + 1 END AS l_suppkey,
                  'v2-' || l_linestatus AS l_linestatus, {_FLAG.format("l_orderkey + l_linenumber")} AS chng_flag
           FROM lineitem WHERE l_orderkey % 3 = 0),
r AS (SELECT * FROM c QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1)
SELECT * FROM r UNION ALL SELECT l_orderkey + 1000000000, l_linenumber, l_suppkey, l_linestatus, chng_flag FROM r
""",
    "delta_single": f"""
WITH c AS (SELECT p_partkey, upper(p_name) AS p_name, CASE WHEN p_size % 5 <> 0 THEN p_size END AS p_size,
                  {_FLAG.format("p_partkey")} AS flag FROM part),
d AS (SELECT * FROM c UNION ALL SELECT p_partkey + 1000000000, p_name, p_size, flag FROM c)
SELECT t.p_partkey, CASE WHEN d.flag = 'UPDATED' THEN d.p_name ELSE t.p_name END AS p_name,
       CASE WHEN d.flag = 'UPDATED' THEN d.p_size ELSE t.p_size END AS p_size
FROM part t LEFT JOIN d USING (p_partkey) WHERE d.flag IS NULL OR d.flag <> 'DELETED'
UNION ALL
SELECT p_partkey, p_name, p_size FROM d
WHERE flag IN ('NEW', 'UPDATED') AND p_partkey NOT IN (SELECT p_partkey FROM part)
""",
    "delta_repeats": """
SELECT o_custkey AS cust_id, o_orderpriority AS priority, count(*) AS cnt FROM orders
GROUP BY o_custkey, o_orderpriority HAVING count(*) > 1
""",
    "ordered_concat": """
SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_nationkey) AS names FROM nation GROUP BY n_regionkey
""",
    "customer_join": """
SELECT c.c_custkey, c.c_name, n.n_name, c.c_mktsegment, 'customer' AS src, c.band
FROM (SELECT *, CAST(floor(c_acctbal / 1000) AS BIGINT) AS band FROM customer) c
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment ILIKE 'build%' AND c.band >= 2
ORDER BY n.n_name ASC NULLS LAST, c.c_custkey DESC NULLS FIRST
""",
    "reversal_pairs": _PAIRS,
    "reversal_count": f"""
SELECT count(*) AS n_pairs, count(DISTINCT claim_key) AS n_claims FROM ({_PAIRS}) p
""",
    "apply_reversals": f"""
WITH best AS (SELECT * FROM ({_PAIRS}) p
              QUALIFY row_number() OVER (PARTITION BY claim_key
                                         ORDER BY reversal_date DESC, reversal_key DESC) = 1)
SELECT o.o_orderkey, o.o_orderstatus, b.claim_key IS NOT NULL AS reversed,
       b.reversal_key AS reversed_record_id, b.reversal_date AS reversal_time
FROM orders o LEFT JOIN best b ON o.o_orderkey = b.claim_key
""",
    "apply_duplicate_reversals": f"""
{_DUP},
best AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY ck ORDER BY rt DESC, rk DESC) = 1)
SELECT o.o_orderkey, b.ck IS NOT NULL AS reversed, b.rk AS reversed_record_id, b.rt AS reversal_time
FROM orders o LEFT JOIN best b ON o.o_orderkey = b.ck
""",
    "duplicate_reversal_count": f"""
{_DUP}
SELECT count(*) AS n_pairs, count(DISTINCT ck) AS n_claims FROM m
""",
    "triage": """
WITH h AS (SELECT event_id AS h_event_id, ts AS h_ts, user_id AS h_user_id FROM events
           WHERE event_type = 'error'
             AND ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-12 00:00:00'),
p AS (SELECT o_orderkey AS p_o_orderkey, o_custkey AS p_o_custkey, o_orderdate AS p_o_orderdate FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey
                                 ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST) = 1),
q AS (SELECT c_custkey AS q_c_custkey, c_name AS q_c_name, c_mktsegment AS q_c_mktsegment FROM customer)
SELECT h_event_id, h_ts, h_user_id, p_o_orderkey, p_o_orderdate, q_c_name, q_c_mktsegment
FROM h LEFT JOIN p ON p.p_o_custkey = h.h_user_id LEFT JOIN q ON q.q_c_custkey = p.p_o_custkey
""",
    "not_in_keys": """
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""",
    "not_in_keys_null": """
SELECT doc_id FROM documents
WHERE doc_id NOT IN (SELECT CASE WHEN quality = 0 THEN NULL ELSE doc_id END FROM labels)
""",
    "in_keys": """
SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
""",
    "missing_keys_report": """
WITH raw AS (SELECT CASE WHEN doc_id % 97 = 5 THEN 'oops' || doc_id ELSE CAST(doc_id AS VARCHAR) END AS k FROM documents),
s AS (SELECT TRY_CAST(k AS BIGINT) AS record_id FROM raw WHERE TRY_CAST(k AS BIGINT) IS NOT NULL),
e AS (SELECT doc_id AS record_id FROM labels),
t AS (SELECT item_id AS record_id FROM benchmark)
SELECT 'source key without event' AS name, record_id, NULL::VARCHAR AS raw_key FROM s WHERE record_id NOT IN (SELECT record_id FROM e)
UNION ALL
SELECT 'source key without row', record_id, NULL FROM s WHERE record_id NOT IN (SELECT record_id FROM t)
UNION ALL
SELECT 'table key without source', record_id, NULL FROM t WHERE record_id NOT IN (SELECT record_id FROM s)
UNION ALL
SELECT DISTINCT 'unreadable key', NULL::BIGINT, k FROM raw WHERE TRY_CAST(k AS BIGINT) IS NULL
""",
    "except_keys": """
(SELECT c_custkey AS key, 'left only' AS side FROM customer EXCEPT SELECT o_custkey, 'left only' FROM orders)
UNION ALL
(SELECT o_custkey, 'right only' FROM orders EXCEPT SELECT c_custkey, 'right only' FROM customer)
""",
    "row_counts": "\nUNION ALL\n".join(
        f"SELECT '{t}' AS object_name, count(*) AS row_count FROM {t}" for t in _ALL) + "\nORDER BY object_name",
    "reconcile_counts": """
WITH l AS (
  SELECT 'orders' AS object_name, count(*) AS row_count FROM orders
  UNION ALL SELECT 'lineitem', count(*) FROM lineitem
  UNION ALL SELECT 'customer', count(*) FROM customer
  UNION ALL SELECT 'part', count(*) FROM part),
r AS (
  SELECT 'ORDERS' AS object_name, count(DISTINCT l_orderkey) AS row_count FROM lineitem
  UNION ALL SELECT 'Lineitem', count(*) FROM lineitem
  UNION ALL SELECT 'CUSTOMER', count(DISTINCT o_custkey) FROM orders
  UNION ALL SELECT 'supplier', count(DISTINCT l_suppkey) FROM lineitem)
SELECT coalesce(lower(l.object_name), lower(r.object_name)) AS object_name,
       l.row_count AS left_count, r.row_count AS right_count, l.row_count - r.row_count AS diff
FROM l FULL OUTER JOIN r ON lower(l.object_name) = lower(r.object_name)
""",
    "tagged_union": """
SELECT * FROM (
  SELECT 'REGION' AS object_type, r_name AS object_name, r_name AS owner FROM region
  UNION
  SELECT 'NATION', n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION
  SELECT 'OWNER', r_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey)
WHERE owner IN ('AFRICA', 'ASIA', 'EUROPE')
""",
    "render_rows": """
SELECT 'EXECUTE TASK ' || r_name || '.' || n_name || ';' AS command
FROM nation JOIN region ON n_regionkey = r_regionkey
""",
    "delete_where": """
SELECT * FROM events
WHERE NOT coalesce(event_type IN ('click', 'view') AND ts > TIMESTAMP '2024-01-15 00:00:00', false)
""",
    "tombstones": """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_acctbal < 0 AND c.c_custkey = o.o_custkey)
""",
    "apply_cdc": """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1
  AND event_type <> 'error'
""",
    "as_of": """
SELECT user_id, event_id, ts, event_type, value FROM events
WHERE ts <= TIMESTAMP '2024-01-15 00:00:00'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) = 1
  AND event_type <> 'error'
""",
    "fill_rate": """
SELECT 'EVENTS' AS source, ts::DATE AS on_day, count(*) AS n_rows,
       round(100.0::DOUBLE * count(*) FILTER (event_type <> 'error') / count(*), 2) AS filled_type,
       round(100.0::DOUBLE * count(*) FILTER (value >= 25) / count(*), 2) AS filled_value,
       round(100.0::DOUBLE * count(props) / count(*), 2) AS filled_props
FROM events WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00'
GROUP BY on_day
""",
    "volume_hour": """
WITH n AS (SELECT date_trunc('hour', ts) AS period, count(*) AS every, count(*) FILTER (event_type = 'purchase') AS bought
           FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-11 00:00:00' GROUP BY ALL)
SELECT unnest(['TOTAL', 'purchase']) AS kind, period, unnest([every, bought]) AS n_requests FROM n WHERE bought > 0
UNION ALL SELECT 'TOTAL', period, every FROM n WHERE bought = 0
""",
    "volume_day": """
WITH n AS (SELECT ts::DATE AS period, count(*) AS every, count(*) FILTER (event_type = 'purchase') AS bought
           FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts <= TIMESTAMP '2024-01-17 00:00:00' GROUP BY ALL)
SELECT unnest(['TOTAL', 'purchase']) AS kind, period, unnest([every, bought]) AS n_requests FROM n WHERE bought > 0
UNION ALL SELECT 'TOTAL', period, every FROM n WHERE bought = 0
""",
    "recluster": """
WITH e AS (SELECT event_id, event_type,
                  CASE WHEN value < 1 THEN 'n/a' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS event_time
           FROM events)
SELECT event_id, event_type, event_time,
       coalesce(date_trunc('day', TRY_CAST(event_time AS TIMESTAMP)), TIMESTAMP '1970-01-01 00:00:00')
         AS cluster_day
FROM e
""",
    "recluster_hour": "SELECT event_id, event_type, date_trunc('hour', ts) AS cluster_hour FROM events",
    "tagged_field": """
WITH m AS (SELECT p_partkey,
                  string_split(concat_ws('~', 'NM' || p_name, 'TY' || p_type, 'BR' || p_brand,
                                         'NM' || upper(p_name)), '~') AS f
           FROM part),
x AS (SELECT p_partkey,
             substr(list_filter(f, lambda x: starts_with(x, 'NM'))[2], 3) AS name_2,
             substr(list_filter(f, lambda x: starts_with(x, 'TY'))[1], 3) AS type_1,
             substr(list_filter(f, lambda x: starts_with(x, 'ZZ'))[1], 3) AS missing_1
      FROM m)
SELECT * FROM x WHERE name_2 IS NOT NULL
""",
}

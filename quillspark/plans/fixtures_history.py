"""Fixture queries for interval joins, history, content comparison and layout, with their SQL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators import claims, history, layout, reconcile
from quillspark.session import read_table, work_path
from quillspark.sources import documents, text

# --- claims: four keys, two-sided window -----------------------------------------------

WINDOW_KEYS = ["l_suppkey", "l_linenumber", "l_linestatus", "discount_pct"]


def _lines(spark: SparkSession, sf_dir: str, flag: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == flag)
    return li.withColumn("discount_pct", F.round(F.col("l_discount") * 100).cast("int")).select(
        "l_orderkey", *WINDOW_KEYS, "l_shipdate")


def reversal_window(spark, sf_dir):
    """Claims (lines flagged A) with every reversal (flagged R) of the same four keys that
    came after them, by 120 days at most."""
    pairs = claims.match_in_window(_lines(spark, sf_dir, "A"), _lines(spark, sf_dir, "R"), WINDOW_KEYS, "l_shipdate", "l_shipdate",
                                   at_most=dt.timedelta(days=120))
    return pairs.select(F.col("l_orderkey").alias("claim_order"), F.col("rev_l_orderkey").alias("reversal_order"), *WINDOW_KEYS,
                        F.col("l_shipdate").alias("claim_time"), F.col("rev_l_shipdate").alias("reversal_time"))


# --- history ---------------------------------------------------------------------------

def validity(spark, sf_dir):
    """Every user's states, each with the interval in which it held; an ``error`` deletes."""
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return history.validity_intervals(ev, ["user_id"], "ts", "event_id", "event_type", "error")


def error_context(spark, sf_dir):
    """Every ``error`` event with its user's last other event before it."""
    ev = read_table(spark, sf_dir, "events")
    errors = ev.filter(F.col("event_type") == "error").select("event_id", "user_id", "ts")
    states = ev.filter(F.col("event_type") != "error").select("user_id", "ts", "event_id", "event_type", "value")
    return history.state_at(errors, states, ["user_id"], "ts", "ts", "event_id")


# --- comparison --------------------------------------------------------------------------

def content_diff(spark, sf_dir):
    """Two copies of the order lines: in one, a few quantities differ, some lines are gone
    and one order's lines are there under another number."""
    li = read_table(spark, sf_dir, "lineitem")
    k, n = F.col("l_orderkey"), F.col("l_linenumber")
    other = li.filter(~((k % 5000 == 7) & (n == 1)))
    other = other.withColumn("l_quantity", F.when((k % 3000 == 11) & (n == 2), F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    other = other.withColumn("l_orderkey", F.when(k == 13, F.lit(900000013)).otherwise(k))
    return reconcile.content_diff(li, other, ["l_orderkey", "l_linenumber"], buckets=256)


# --- staging and layout --------------------------------------------------------------------

STORED = T.StructType([T.StructField("ingested", T.TimestampNTZType()), T.StructField("data", T.VariantType())])


def stage_by_type(spark: SparkSession, sf_dir: str) -> str:
    """Events as JSON documents, staged once by type and day."""
    ev = read_table(spark, sf_dir, "events")
    doc = F.to_json(F.struct(F.col("event_type").alias("eventType"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("eventTime"),
                             F.struct("event_id", "user_id", "value").alias("eventPayload")))
    path = work_path(spark, "staging", "by-type")
    documents.stage_documents(ev.select(F.col("ts").alias("ingested"), doc.alias("data")), "data", "$.eventType", "$.eventTime", path)
    return path


def watched_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A control table of event types, filtered to those that are to be read."""
    ev = read_table(spark, sf_dir, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n_events"))
    path = work_path(spark, "control", "types")
    ev.withColumn("priority", F.when(F.col("event_type").like("%s%"), 1).otherwise(0)).write.parquet(path)
    return spark.read.parquet(path).filter("priority > 0").select("event_type")


def staged_partitions(spark, sf_dir):
    """Documents of the control table's types since a day: only their folders are read."""
    path = stage_by_type(spark, sf_dir)
    docs = documents.staged_documents(spark, path, STORED, watched_types(spark, sf_dir), "2024-01-20")
    get = lambda p, t: F.try_variant_get(F.col("data"), p, t)
    return docs.select(get("$.eventPayload.event_id", "bigint").alias("event_id"), get("$.eventPayload.value", "double").alias("amount"),
                       documents.TYPE, documents.DAY, "ingested")


def _bad_dates(spark, sf_dir) -> DataFrame:
    """Events with their time as text; a third of the times is no date."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return ev.select("event_id", "event_type", F.when(F.col("event_id") % 3 == 0, F.lit("n/a")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("event_time"))


def layout_proof(spark, sf_dir):
    """Per day, the most files that a (day, type) filter has to open: as staged by arrival, and re-clustered."""
    ev = _bad_dates(spark, sf_dir)
    per_file = max(1, -(-ev.count() // 64))
    before = work_path(spark, "staging", "arrival")
    ev.withColumn("load", F.col("event_id") % 16).repartition("load").write.partitionBy("load").parquet(before)
    time, kind = F.col("event_time"), F.col("event_type")
    old = spark.read.schema(ev.schema).parquet(before)
    new = layout.write_clustered(ev, work_path(spark, "tables", "clustered"), time, kind, per_file)
    met = [layout.files_met(old, layout.cluster_bucket(time), kind), layout.files_met(new, F.col("cluster_day"), kind)]
    a, b = (m.groupBy("bucket").agg(F.sum("n_rows").alias(f"{n}_rows"), F.max("n_files").alias(f"{n}_files"))
            for m, n in zip(met, ("before", "after")))
    return a.join(b, "bucket").select(F.col("bucket").alias("cluster_day"), F.col("before_rows").alias("n_rows"),
                                      F.col("before_files").alias("files_before"), F.col("after_files").alias("files_after"))


def unversioned(spark, sf_dir):
    """Rows that no export batch holds: orders whose version (a date of an open order) is missing."""
    o = read_table(spark, sf_dir, "orders").withColumn("version", F.when(F.col("o_orderstatus") != "O", F.col("o_orderdate")))
    return text.count_unversioned(o, "version")


QUERIES = {
    "reversal_window": reversal_window,
    "validity": validity,
    "error_context": error_context,
    "content_diff": content_diff,
    "staged_partitions": staged_partitions,
    "layout_proof": layout_proof,
    "unversioned": unversioned,
}

ORACLE = {
    "reversal_window": """
WITH l AS (SELECT l_orderkey, l_suppkey, l_linenumber, l_linestatus, round(l_discount * 100)::INT AS discount_pct, l_shipdate, l_returnflag
           FROM lineitem)
SELECT c.l_orderkey AS claim_order, r.l_orderkey AS reversal_order, l_suppkey, l_linenumber, l_linestatus, discount_pct,
       c.l_shipdate AS claim_time, r.l_shipdate AS reversal_time
FROM l c JOIN l r USING (l_suppkey, l_linenumber, l_linestatus, discount_pct)
WHERE c.l_returnflag = 'A' AND r.l_returnflag = 'R' AND c.l_shipdate < r.l_shipdate AND r.l_shipdate <= c.l_shipdate + INTERVAL 120 DAY
""",
    "validity": """
WITH one AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1),
held AS (SELECT user_id, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to, event_id, event_type, value FROM one)
SELECT user_id, valid_from, valid_to, event_id, event_type, value FROM held WHERE event_type <> 'error'
""",
    "error_context": """
WITH state AS (SELECT user_id, ts, event_id, event_type, value FROM events WHERE event_type <> 'error'
               QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) = 1)
SELECT e.event_id, e.user_id, e.ts, s.ts AS state_ts, s.event_id AS state_event_id, s.event_type AS state_event_type, s.value AS state_value
FROM (SELECT * FROM events WHERE event_type = 'error') e ASOF LEFT JOIN state s ON e.user_id = s.user_id AND e.ts > s.ts
""",
    "content_diff": """
WITH other AS (
  SELECT CASE WHEN l_orderkey = 13 THEN 900000013 ELSE l_orderkey END AS l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN l_orderkey % 3000 = 11 AND l_linenumber = 2 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity,
         l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
  FROM lineitem WHERE NOT (l_orderkey % 5000 = 7 AND l_linenumber = 1)),
a AS (SELECT l_orderkey, l_linenumber, list_sort(list(row(l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus, l_shipdate)::VARCHAR)) AS rows FROM lineitem GROUP BY ALL),
b AS (SELECT l_orderkey, l_linenumber, list_sort(list(row(l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus, l_shipdate)::VARCHAR)) AS rows FROM other GROUP BY ALL)
SELECT l_orderkey, l_linenumber, CASE WHEN b.rows IS NULL THEN 'left only' WHEN a.rows IS NULL THEN 'right only' ELSE 'changed' END AS side
FROM a FULL JOIN b USING (l_orderkey, l_linenumber) WHERE a.rows IS DISTINCT FROM b.rows
""",
    "staged_partitions": """
SELECT event_id, value AS amount, event_type AS doc_type, ts::DATE AS doc_day, ts AS ingested
FROM events WHERE event_type LIKE '%s%' AND ts >= TIMESTAMP '2024-01-20 00:00:00'
""",
    "layout_proof": """
WITH e AS (SELECT event_id % 16 AS load, event_type AS kind, CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '1970-01-01 00:00:00'
                  ELSE date_trunc('day', ts)::TIMESTAMP END AS day FROM events),
placed AS (SELECT *, (row_number() OVER (ORDER BY day, kind) - 1) // (SELECT greatest(1, ceil(count(*) / 64)::BIGINT) FROM e) AS file FROM e),
old AS (SELECT min(day) AS a, max(day) AS b, min(kind) AS c, max(kind) AS d FROM placed GROUP BY load),
new AS (SELECT min(day) AS a, max(day) AS b, min(kind) AS c, max(kind) AS d FROM placed GROUP BY file),
asked AS (SELECT day, kind, count(*) AS n FROM e GROUP BY ALL),
met AS (SELECT day, n, (SELECT count(*) FROM old WHERE day BETWEEN a AND b AND kind BETWEEN c AND d) AS before,
               (SELECT count(*) FROM new WHERE day BETWEEN a AND b AND kind BETWEEN c AND d) AS after FROM asked)
SELECT day AS cluster_day, sum(n)::BIGINT AS n_rows, max(before) AS files_before, max(after) AS files_after FROM met GROUP BY day
""",
    "unversioned": "SELECT count(*) AS n_unversioned FROM orders WHERE o_orderstatus = 'O'",
}

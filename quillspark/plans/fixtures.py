"""Fixture queries: every operator run over the driver's tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose
column names equal those of the matching SQL in ``quillspark.plans.oracle``.
Roles of the driver tables follow SURVEY section 7.  Parameters (times,
patterns, sets) are fixed so results repeat; they never sample or cap the
input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.functions.scalar import json_fields, prefix_columns, tagged_field
from quillspark.functions.scalar import render_rows as render_text
from quillspark.operators import claims, health, layout, lookup, merge, reconcile
from quillspark.session import read_table, work_path
from quillspark.sources import storage, text

# Fixed parameters of the fixture queries (shared with the oracle SQL).
WINDOW_LO = "2024-01-10 00:00:00"
WINDOW_HI = "2024-01-20 00:00:00"
ALL_TABLES = ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split()


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# --------------------------------------------------------------- task log

def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a task-history log: user_id is the task name, an error
    event is a FAILED run, ``ts`` the scheduled/completed time, ``props``
    the error message."""
    ev = _t(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").alias("task_name"),
        F.when(F.col("event_type") == "error", F.lit("FAILED")).otherwise(F.lit("SUCCEEDED")).alias("state"),
        F.col("ts").alias("scheduled_time"),
        F.col("event_id"),
        F.col("props").alias("error_message"),
    )


def currently_failed(spark, sf_dir):
    t = _tasks(spark, sf_dir).drop("error_message")
    return health.currently_failed(t, "task_name", "scheduled_time", "state",
                                   lo=WINDOW_LO, hi=WINDOW_HI, tie="event_id")


ALERT_AT = "2024-01-20 12:34:56"


def failed_since(spark, sf_dir):
    t = _tasks(spark, sf_dir).drop("error_message")
    return health.failed_since(t, "scheduled_time", "state", ALERT_AT, minutes=90, n=10, tie="event_id")


def failure_alert(spark, sf_dir):
    t = _tasks(spark, sf_dir).drop("error_message")
    hits = health.failed_since(t, "scheduled_time", "state", ALERT_AT, minutes=90, n=None)
    return hits.agg((F.count(F.lit(1)) > 0).alias("alert"))


def alert_probe(spark, sf_dir):
    """The alert condition as a LIMIT 1 probe: one row or none."""
    t = _tasks(spark, sf_dir).drop("error_message")
    hits = health.failed_since(t, "scheduled_time", "state", ALERT_AT, minutes=90)
    return hits.select(F.lit(1).alias("hit")).limit(1)


def alert_history(spark, sf_dir):
    """Every failure since a time."""
    t = _tasks(spark, sf_dir).drop("error_message")
    return health.failure_history(t, "scheduled_time", "state", WINDOW_HI)


def failed_runs(spark, sf_dir):
    t = _tasks(spark, sf_dir)
    return health.failed_runs(t, "task_name", "error_message", "scheduled_time", "state",
                              name_pattern="1%", msg_pattern='%"k": 1%', since=WINDOW_HI, tie="event_id")


# ---------------------------------------------------------- event lookups

def events_typed_since(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    sel = lookup.staged_events(ev, "event_type", "ts", ["click", "purchase", "view", "signup"],
                               since=WINDOW_LO, until="2024-01-25 00:00:00")
    sel = sel.filter(F.col("event_type").like("c%") | F.col("event_type").like("p%")
                     | F.col("event_type").like("v%"))
    sel = json_fields(sel, "props", {"k": ("$.k", "bigint")})
    return sel.filter(F.col("k") > 10).select("event_id", "event_type", "ts", "k")


RECORD_ID_BASE = 1_000_000_000_000_000_000  # ids of 19 digits


def _staged_documents(spark, sf_dir) -> DataFrame:
    """events as staged JSON documents ``(data, ingested_timestamp)``: the
    event type, id and time sit in the document, the record id (19 digits)
    inside a nested payload.  Built and read in one plan: nothing is written."""
    ev = _t(spark, sf_dir, "events")
    doc = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("eventId"),
        F.col("event_type").alias("eventType"),
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("eventTime"),
        F.struct((F.col("event_id") + F.lit(RECORD_ID_BASE)).alias("record_id"),
                 F.col("user_id").alias("user_id")).alias("eventPayload")))
    return ev.select(doc.alias("data"), F.col("ts").alias("ingested_timestamp"))


def staged_json_events(spark, sf_dir):
    """O-S1 on documents: type filter and payload fields by JSON path."""
    since = _staged_documents(spark, sf_dir).filter(F.col("ingested_timestamp") > F.lit(WINDOW_LO))
    docs = json_fields(since, "data", {
        "event_type": ("$.eventType", "string"),
        "event_ref": ("$.eventId", "bigint"),
        "record_id": ("$.eventPayload.record_id", "bigint"),
        "user_id": ("$.eventPayload.user_id", "bigint"),
    })
    sel = lookup.staged_events(docs, "event_type", "ingested_timestamp", ["purchase", "signup"],
                               since=WINDOW_LO)
    return sel.select("event_ref", "event_type", "record_id", "user_id", "ingested_timestamp")


def events_by_id(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    keys = _t(spark, sf_dir, "labels").select("doc_id")
    return lookup.events_by_id(ev, "event_id", keys, "ts", since="2024-01-03 00:00:00", n=100, tie="event_id")


def login_history(spark, sf_dir):
    """Logins of two service users by ILIKE ANY (``_`` is a wildcard), newest 100."""
    ev = _t(spark, sf_dir, "events").select("user_id", "ts", "event_type", "event_id")
    hits = lookup.matches_any(ev, "user_id", ["1_", "2_"], case_insensitive=True)
    return health.newest(hits, "ts", 100, tie="event_id").select("user_id", "ts", "event_type")


def count_by_type(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return lookup.count_by_type(ev, "event_type", "ts", since="2024-01-05 00:00:00")


def distinct_types(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return lookup.distinct_types(ev, "event_type", ["%i%", "s%"], "ts", since="2024-01-05 00:00:00")


def total_distinct(spark, sf_dir):
    return lookup.count_total_distinct(_t(spark, sf_dir, "events"), "user_id")


def duplicate_keys(spark, sf_dir):
    return lookup.duplicate_keys(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def out_of_order(spark, sf_dir):
    conv = _t(spark, sf_dir, "conversations")
    return lookup.out_of_order(conv, ["conv_id"], "turn", {"first_role": "role"}, {"first_role": "USER"})


def _staged_transmissions(spark, sf_dir) -> DataFrame:
    """orders as staged transmission documents: a transaction code, a
    response status (empty for status P) and a ``transactions`` array whose
    first element's state/type vary with the order (empty for 5-LOW)."""
    o = _t(spark, sf_dir, "orders")
    pr = F.col("o_orderpriority")
    first = F.struct(
        F.when(F.col("o_orderstatus") == "F", F.lit("created")).when(F.col("o_orderstatus") == "O", F.lit("CREATED"))
         .otherwise(F.lit("open")).alias("state"),
        F.when(pr.startswith("2"), F.lit("response")).otherwise(F.lit("request")).alias("type"))
    second = F.struct(F.lit("SENT").alias("state"), F.lit("RESPONSE").alias("type"))
    txs = F.when(pr.startswith("5"), F.array().cast("array<struct<state:string,type:string>>")) \
           .otherwise(F.array(first, second))
    doc = F.to_json(F.struct(
        F.col("o_orderkey").cast("string").alias("transmissionId"),
        F.when(pr.startswith("1") | pr.startswith("2") | pr.startswith("5"), F.lit("B1")).otherwise(F.lit("B2"))
         .alias("transactionCode"),
        F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.col("o_orderstatus")).alias("responseStatusCode"),
        txs.alias("transactions")))
    return o.select(doc.alias("data"), F.col("o_orderdate").alias("ingested_timestamp"))


def transmission_out_of_order(spark, sf_dir):
    docs = _staged_transmissions(spark, sf_dir)
    bad = lookup.first_element_mismatch(docs, "data", "$.transactionCode", "B1", "$.transactions",
                                        {"state": "CREATED", "type": "REQUEST"},
                                        fields={"transmission_id": ("$.transmissionId", "bigint")})
    return bad.select("transmission_id")


def transmission_blank_status(spark, sf_dir):
    docs = json_fields(_staged_transmissions(spark, sf_dir), "data", {
        "code": ("$.transactionCode", "string"), "rsc": ("$.responseStatusCode", "string")})
    return lookup.count_blank(docs.filter(F.col("code") == "B1"), F.col("rsc"))


def single_table_mismatch(spark, sf_dir):
    """Two states of one row that differ where its count is one (single-table form)."""
    li = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return lookup.column_mismatch(li, "l_returnflag", "l_linestatus", count_col="l_linenumber", count=1)


def id_list(spark, sf_dir):
    """Distinct ids from a delimited text column: split, exploded, trimmed."""
    o = _t(spark, sf_dir, "orders")
    listed = o.select(F.concat_ws(" , ", F.col("o_orderkey"), F.lit(""), F.col("o_custkey"), F.col("o_orderkey")).alias("ids"))
    return lookup.ids_from_text(listed, "ids", ",")


def status_mismatch(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    li = _t(spark, sf_dir, "lineitem")
    return lookup.status_mismatch(o, li, "o_orderkey", "l_orderkey", "o_orderstatus", "l_linestatus")


def count_blank(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages")
    return lookup.count_blank(pages, F.split_part(F.col("url"), F.lit("?"), F.lit(2)))


def bad_numerics(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    return lookup.bad_numerics(part, ["p_partkey"], {
        "brand_no": F.split_part(F.col("p_brand"), F.lit("#"), F.lit(2)),
        "p_type": "p_type",
    })


def load_history(spark, sf_dir):
    pages = _t(spark, sf_dir, "pages").select("page_id", "url")
    return text.load_history(pages, "url", "page_id", since=10, patterns=["%/en/%", "%.html"], n=1000)


# ----------------------------------------------------- delimited delta

def _supplier_lines(spark, sf_dir) -> DataFrame:
    """supplier rendered as staged pipe-delimited lines (negative balances
    give a non-digit piece; field 5 is absent)."""
    s = _t(spark, sf_dir, "supplier")
    return s.select(F.concat_ws("|", F.col("s_suppkey"), F.col("s_name"), F.col("s_nationkey"),
                                F.floor(F.col("s_acctbal")).cast("bigint")).alias("data"))


def parse_delta(spark, sf_dir):
    lines = _supplier_lines(spark, sf_dir)
    return text.parse_delimited(lines, "data", "|", ["supp_id", "supp_name", "nation_id", "acct", "extra"],
                                int_cols=["supp_id", "nation_id", "acct"])


NEW_KEY_OFFSET = 1_000_000_000


def _supplier_delta(spark, sf_dir) -> DataFrame:
    """Change set over supplier: flags by nation bucket, for existing keys
    and for new keys (offset); includes unknown and empty flags."""
    s = _t(spark, sf_dir, "supplier")
    nk = F.col("s_nationkey")
    flag = (F.when(nk < 5, "DELETED").when(nk < 10, "UPDATED").when(nk < 15, "NEW")
             .when(nk < 20, "BOGUS").otherwise(""))
    old = s.select("s_suppkey", F.concat(F.col("s_name"), F.lit("-v2")).alias("s_name"),
                   "s_nationkey", "s_acctbal", flag.alias("chng_flag"))
    new = s.select((F.col("s_suppkey") + NEW_KEY_OFFSET).alias("s_suppkey"),
                   F.concat(F.lit("New-"), F.col("s_name")).alias("s_name"),
                   "s_nationkey", "s_acctbal", flag.alias("chng_flag"))
    return old.unionByName(new)


def merge_flags(spark, sf_dir):
    target = _t(spark, sf_dir, "supplier")
    delta = _supplier_delta(spark, sf_dir)
    return merge.merge_change_flags(target, delta, ["s_suppkey"], "chng_flag",
                                    cols=["s_name", "s_nationkey", "s_acctbal"])


def delta_by_flag(spark, sf_dir):
    return merge.delta_by_flag(_supplier_delta(spark, sf_dir), "chng_flag", "UPDATED")


def upsert(spark, sf_dir):
    target = _t(spark, sf_dir, "supplier")
    s = _t(spark, sf_dir, "supplier")
    nk = F.col("s_nationkey")
    matched = s.filter(nk.between(10, 14)).select("s_suppkey", "s_name", "s_nationkey",
                                                  (F.col("s_acctbal") + 1).alias("s_acctbal"))
    new = s.filter(nk >= 20).select((F.col("s_suppkey") + NEW_KEY_OFFSET).alias("s_suppkey"),
                                    "s_name", "s_nationkey", "s_acctbal")
    return merge.upsert(target, matched.unionByName(new), ["s_suppkey"], ["s_acctbal"])


# ------------------------------------------------------------- exports

def export_text(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate",
                                           "o_orderpriority")
    return text.export_as_text(o, "o_orderkey", keep=["o_orderkey"])


def export_since(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return text.export_since(o, "o_orderkey", 1000, 500)


def export_all_batches(spark, sf_dir):
    """Incremental export walked to its end over a version that repeats: the
    batches together are the whole table, each row once."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    n = max(1, -(-o.count() // 4))
    out, mark, batches = work_path(spark, "exports", "orders"), None, 0
    while True:
        path = f"{out}/batch={batches}"
        text.export_since(o, "o_orderdate", mark, n).write.parquet(path)
        last = text.next_mark(spark.read.schema(o.schema).parquet(path), "o_orderdate").first()[0]
        if last is None:
            return spark.read.schema(o.schema).parquet(*[f"{out}/batch={i}" for i in range(batches + 1)])
        mark, batches = last, batches + 1


# ------------------------------------------------- delta files into tables

def _flag(n):
    """Change flag by a number: all of them, an unknown and an empty one too."""
    out = F.lit("")
    for k, flag in enumerate(("DELETED", "UPDATED", "NEW", "BOGUS")):
        out = F.when(n % 5 == k, F.lit(flag)).otherwise(out)
    return out


def _composite_delta(target):
    """Pipe-delimited lines: a third of the order lines, and as many new ones."""
    li = target.filter(F.col("l_orderkey") % 3 == 0)
    sent = F.when(F.col("l_suppkey") % 7 == 0, F.lit("n/a")).otherwise((F.col("l_suppkey") + 1).cast("string"))

    def lines(shift):
        return li.select(F.concat_ws("|", F.col("l_orderkey") + F.lit(shift), F.col("l_linenumber"), sent,
                                     F.concat(F.lit("v2-"), F.col("l_linestatus")),
                                     _flag(F.col("l_orderkey") + F.col("l_linenumber"))).alias("data"))
    return text.parse_delimited(lines(0).unionByName(lines(NEW_KEY_OFFSET)), "data", "|",
                                ["l_orderkey", "l_linenumber", "l_suppkey", "l_linestatus", "chng_flag"],
                                int_cols=["l_orderkey", "l_linenumber", "l_suppkey"])


def delta_composite(spark, sf_dir):
    """Pipe-delimited lines merged on a composite key; quantities that are not digits
    become NULL, lines whose key repeats are set aside (``delta_set_aside``)."""
    target = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_linestatus")
    delta = _composite_delta(target)
    merged, _ = merge.merge_guarded(target, delta, ["l_orderkey", "l_linenumber"], "chng_flag")
    return merged


def delta_set_aside(spark, sf_dir):
    """The same merge's other result: the lines whose key repeats in the delta."""
    target = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_linestatus")
    _, again = merge.merge_guarded(target, _composite_delta(target), ["l_orderkey", "l_linenumber"], "chng_flag")
    return again


def delta_single(spark, sf_dir):
    """The single-key form: parts as lines, the size a guarded integer."""
    target = _t(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    size = F.when(F.col("p_size") % 5 == 0, F.concat(F.lit("-"), F.col("p_size"))).otherwise(F.col("p_size").cast("string"))

    def lines(shift):
        return target.select(F.concat_ws("|", F.col("p_partkey") + F.lit(shift), F.upper("p_name"), size,
                                         _flag(F.col("p_partkey"))).alias("data"))
    delta = text.parse_delimited(lines(0).unionByName(lines(NEW_KEY_OFFSET)), "data", "|",
                                 ["p_partkey", "p_name", "p_size", "chng_flag"], int_cols=["p_partkey", "p_size"])
    return merge.merge_change_flags(target, delta, ["p_partkey"], "chng_flag")


def delta_repeats(spark, sf_dir):
    """The repeat guard before a merge: keys that a parsed delta holds more than once."""
    o = _t(spark, sf_dir, "orders")
    lines = o.select(F.concat_ws("|", "o_custkey", "o_orderpriority", "o_orderkey").alias("data"))
    delta = text.parse_delimited(lines, "data", "|", ["cust_id", "priority", "order_id"], int_cols=["cust_id", "order_id"])
    return lookup.duplicate_keys(delta, ["cust_id", "priority"])


def ordered_concat(spark, sf_dir):
    return layout.ordered_concat(_t(spark, sf_dir, "nation"), "n_regionkey", "n_name", "n_nationkey",
                                 ", ", "names")


# ---------------------------------------------------------- customer join

def customer_join(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer")
    nation = _t(spark, sf_dir, "nation")
    return spark.sql(
        """
        SELECT c.c_custkey, c.c_name, n.n_name, c.c_mktsegment, 'customer' AS src, c.band
        FROM (SELECT *, CAST(floor(c_acctbal / 1000) AS BIGINT) AS band FROM {cust}) AS c
        JOIN {nation} AS n ON c.c_nationkey = n.n_nationkey
        WHERE c.c_mktsegment ILIKE :segment AND c.band >= :min_band
        ORDER BY n.n_name ASC NULLS LAST, c.c_custkey DESC NULLS FIRST
        """,
        args={"segment": "build%", "min_band": 2}, cust=cust, nation=nation)


# --------------------------------------------------------------- claims

CLAIM_KEYS = ["o_custkey", "o_orderpriority"]
CLAIMS_FROM = "1995-01-01 00:00:00"
REVERSALS_BEFORE = "2001-06-01 00:00:00"


def _claims(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit(CLAIMS_FROM)))


def _reversals(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.filter((F.col("o_orderstatus") == "P") & (F.col("o_orderdate") < F.lit(REVERSALS_BEFORE)))


def reversal_pairs(spark, sf_dir):
    c = _claims(spark, sf_dir).select("o_orderkey", *CLAIM_KEYS, "o_orderdate")
    r = _reversals(spark, sf_dir).select("o_orderkey", *CLAIM_KEYS, "o_orderdate")
    m = claims.match_reversals(c, r, CLAIM_KEYS, "o_orderdate", "o_orderdate")
    return m.select(F.col("o_orderkey").alias("claim_key"), F.col("rev_o_orderkey").alias("reversal_key"),
                    F.col("o_orderdate").alias("claim_date"), F.col("rev_o_orderdate").alias("reversal_date"))


def reversal_count(spark, sf_dir):
    c = _claims(spark, sf_dir)
    r = _reversals(spark, sf_dir)
    return claims.count_matches(c, r, CLAIM_KEYS, "o_orderdate", "o_orderdate")


def apply_reversals(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", *CLAIM_KEYS, "o_orderdate")
    r = _reversals(spark, sf_dir)
    eligible = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit(CLAIMS_FROM))
    out = claims.apply_reversals(o, r, CLAIM_KEYS, "o_orderdate", "o_orderdate", "o_orderkey", eligible=eligible)
    return out.select("o_orderkey", "o_orderstatus", "reversed", "reversed_record_id", "reversal_time")


CASH_BIN = "12"
DUP_AS_OF = "2001-06-01 00:00:00"


def _window_start():
    """Five years before the as-of time."""
    return F.lit(DUP_AS_OF).cast("timestamp_ntz") - F.make_ym_interval(F.lit(5))


def _with_bin(o: DataFrame) -> DataFrame:
    return o.withColumn("bin", F.date_format(F.col("o_orderdate"), "MM"))


def apply_duplicate_reversals(spark, sf_dir):
    o = _with_bin(_t(spark, sf_dir, "orders")).select("o_orderkey", "o_orderstatus", "bin", *CLAIM_KEYS,
                                                      "o_orderdate")
    r = o.filter((F.col("bin") != CASH_BIN) & (F.col("o_orderstatus") == "P"))
    eligible = (((F.col("bin") == CASH_BIN) | (F.col("o_orderstatus") == "F"))
                & (F.col("o_orderdate") >= _window_start()))
    out = claims.apply_duplicate_reversals(o, r, CLAIM_KEYS, "o_orderdate", "o_orderdate", "o_orderkey",
                                           eligible=eligible)
    return out.select("o_orderkey", "reversed", "reversed_record_id", "reversal_time")


def duplicate_reversal_count(spark, sf_dir):
    o = _with_bin(_t(spark, sf_dir, "orders"))
    r = o.filter((F.col("bin") != CASH_BIN) & (F.col("o_orderstatus") == "P"))
    changes = claims.aggregate_changes(r, CLAIM_KEYS, "o_orderdate", "o_orderkey")
    targets = o.filter(((F.col("bin") == CASH_BIN) | (F.col("o_orderstatus") == "F"))
                       & (F.col("o_orderdate") >= _window_start()))
    return claims.count_matches(targets, changes, CLAIM_KEYS, "o_orderdate", "max_time_processed")


# ---------------------------------------------------------------- triage

def triage(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    h = prefix_columns(ev.filter((F.col("event_type") == "error")
                                 & F.col("ts").between(F.lit("2024-01-10 00:00:00"), F.lit("2024-01-12 00:00:00")))
                         .select("event_id", "ts", "user_id"), "h_")
    # Only logs of the requests at hand: the aggregate never sees the rest.
    o = reconcile.in_keys(_t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), h,
                          "o_custkey", "h_user_id")
    p = prefix_columns(health.latest_per_key(o, "o_custkey", ["o_orderdate", "o_orderkey"]), "p_")
    q = prefix_columns(_t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), "q_")
    j = health.triage(h, p, q, "h_user_id", "p_o_custkey", "p_o_custkey", "q_c_custkey")
    return j.select("h_event_id", "h_ts", "h_user_id", "p_o_orderkey", "p_o_orderdate", "q_c_name",
                    "q_c_mktsegment").orderBy(F.col("h_ts").desc(), "h_event_id")


# ------------------------------------------------------- reconciliation

def not_in_keys(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    return reconcile.not_in(docs, _t(spark, sf_dir, "labels"), "doc_id")


def not_in_keys_null(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    lab = _t(spark, sf_dir, "labels").select(
        F.when(F.col("quality") == 0, F.lit(None)).otherwise(F.col("doc_id")).alias("doc_id"))
    return reconcile.not_in(docs, lab, "doc_id")


def in_keys(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang")
    return reconcile.in_keys(docs, _t(spark, sf_dir, "labels"), "doc_id")


def missing_keys_report(spark, sf_dir):
    """All documents as the source; their ids as padded text, some unreadable."""
    doc = F.col("doc_id")
    raw = F.when(doc % 97 == 5, F.concat(F.lit("oops"), doc)).otherwise(F.concat(F.lit(" "), doc))
    src = _t(spark, sf_dir, "documents").select(raw.alias("doc_id"))
    return reconcile.missing_keys_report(src, _t(spark, sf_dir, "labels"), _t(spark, sf_dir, "benchmark"),
                                         "doc_id", "doc_id", "item_id")


def except_keys(spark, sf_dir):
    """Keys that one of two tables lacks (EXCEPT both ways)."""
    return reconcile.except_keys(_t(spark, sf_dir, "customer"), _t(spark, sf_dir, "orders"), "c_custkey", "o_custkey")


def row_counts(spark, sf_dir):
    return reconcile.row_counts({t: _t(spark, sf_dir, t) for t in ALL_TABLES})


def reconcile_counts(spark, sf_dir):
    left = reconcile.row_counts({t: _t(spark, sf_dir, t) for t in ("orders", "lineitem", "customer", "part")})
    li = _t(spark, sf_dir, "lineitem")
    o = _t(spark, sf_dir, "orders")
    right = reconcile.row_counts({
        "ORDERS": li.select("l_orderkey").distinct(),
        "Lineitem": li,
        "CUSTOMER": o.select("o_custkey").distinct(),
        "supplier": li.select("l_suppkey").distinct(),
    })
    return reconcile.reconcile_counts(left, right)


def tagged_union(spark, sf_dir):
    r = _t(spark, sf_dir, "region")
    n = _t(spark, sf_dir, "nation")
    nr = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    parts = {
        "REGION": r.select(F.col("r_name").alias("object_name"), F.col("r_name").alias("owner")),
        "NATION": nr.select(F.col("n_name").alias("object_name"), F.col("r_name").alias("owner")),
        "OWNER": nr.select(F.col("r_name").alias("object_name"), F.col("r_name").alias("owner")),
    }
    return reconcile.tagged_union(parts, where=F.col("owner").isin("AFRICA", "ASIA", "EUROPE"))


def render_rows(spark, sf_dir):
    r = _t(spark, sf_dir, "region")
    n = _t(spark, sf_dir, "nation")
    nr = n.join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return render_text(nr, ["EXECUTE TASK ", F.col("r_name"), ".", F.col("n_name"), ";"], "command")


# ------------------------------------------------------- deletes / feeds

def delete_where(spark, sf_dir):
    """events minus a type set after a time; a NULL predicate keeps the row."""
    ev = _t(spark, sf_dir, "events")
    pred = F.col("event_type").isin("click", "view") & (F.col("ts") > F.lit("2024-01-15 00:00:00"))
    return storage.delete_where(ev, pred)


def tombstones(spark, sf_dir):
    """Deleted-record feed: customers with a negative balance are gone; their
    orders are removed by key (LEFT ANTI join)."""
    o = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    gone = _t(spark, sf_dir, "customer").filter(F.col("c_acctbal") < 0).select(F.col("c_custkey").alias("o_custkey"))
    return merge.apply_tombstones(o, gone, ["o_custkey"])


# ------------------------------------------------------------ CDC / as-of

CDC_CUTOFF = "2024-01-15 00:00:00"


def _event_state(spark, sf_dir):
    return _t(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")


def apply_cdc(spark, sf_dir):
    ev = _event_state(spark, sf_dir)
    target = merge.as_of(ev, ["user_id"], "ts", CDC_CUTOFF, op_col="event_type", delete_value="error",
                         tie="event_id")
    changes = ev.filter(F.col("ts") > F.lit(CDC_CUTOFF))
    return merge.apply_cdc(target, changes, ["user_id"], "event_type", "ts", tie="event_id",
                           delete_value="error", cols=["event_id", "ts", "event_type", "value"])


def as_of(spark, sf_dir):
    ev = _event_state(spark, sf_dir)
    return merge.as_of(ev, ["user_id"], "ts", CDC_CUTOFF, op_col="event_type", delete_value="error",
                       tie="event_id")


# ---------------------------------------------------------------- health

def fill_rate(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    base = ev.select(F.date_format(F.col("ts"), "yyyyMMdd").alias("date_of_service"),
                     F.nullif(F.col("event_type"), F.lit("error")).alias("c_type"),
                     F.when(F.col("value") >= 25, F.col("value")).alias("c_value"),
                     F.col("props").alias("c_props"))
    return health.fill_rate(base, "date_of_service",
                            {"filled_type": "c_type", "filled_value": "c_value", "filled_props": "c_props"},
                            as_of="2024-01-31", days=30, table_name="EVENTS")


def _volume(spark, sf_dir, by_hour, lo, hi):
    ev = _t(spark, sf_dir, "events")
    return health.volume_by_bucket(ev, "ts", "event_type", {"purchase": "purchase", "view": "view"},
                                   lo, hi, by_hour=by_hour, keep=["TOTAL", "purchase"])


def volume_hour(spark, sf_dir):
    return _volume(spark, sf_dir, True, "2024-01-10 00:00:00", "2024-01-11 00:00:00")


def volume_day(spark, sf_dir):
    return _volume(spark, sf_dir, False, "2024-01-10 00:00:00", "2024-01-17 00:00:00")


# ---------------------------------------------------------------- layout

def recluster(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    ev = ev.withColumn("event_time", F.when(F.col("value") < 1, F.lit("n/a"))
                       .otherwise(F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss")))
    out = layout.recluster(ev, F.col("event_time"), F.col("event_type"))
    return out.select("event_id", "event_type", "event_time", "cluster_day")


def recluster_hour(spark, sf_dir):
    """The earlier key: hour and type."""
    ev = _t(spark, sf_dir, "events").withColumn("event_time", F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss"))
    out = layout.recluster(ev, F.col("event_time"), F.col("event_type"), unit="hour", bucket_name="cluster_hour")
    return out.select("event_id", "event_type", "cluster_hour")


def tagged_field_q(spark, sf_dir):
    part = _t(spark, sf_dir, "part")
    msg = F.concat_ws("~", F.concat(F.lit("NM"), F.col("p_name")), F.concat(F.lit("TY"), F.col("p_type")),
                      F.concat(F.lit("BR"), F.col("p_brand")), F.concat(F.lit("NM"), F.upper(F.col("p_name"))))
    out = part.select("p_partkey", tagged_field(msg, "NM", 2, "~").alias("name_2"),
                      tagged_field(msg, "TY", 1, "~").alias("type_1"),
                      tagged_field(msg, "ZZ", 1, "~").alias("missing_1"))
    return out.filter(F.col("name_2").isNotNull())


QUERIES = {
    "currently_failed": currently_failed,
    "failed_since": failed_since,
    "failure_alert": failure_alert,
    "alert_probe": alert_probe,
    "alert_history": alert_history,
    "failed_runs": failed_runs,
    "events_typed_since": events_typed_since,
    "staged_json_events": staged_json_events,
    "events_by_id": events_by_id,
    "login_history": login_history,
    "count_by_type": count_by_type,
    "distinct_types": distinct_types,
    "total_distinct": total_distinct,
    "duplicate_keys": duplicate_keys,
    "out_of_order": out_of_order,
    "status_mismatch": status_mismatch,
    "single_table_mismatch": single_table_mismatch,
    "id_list": id_list,
    "transmission_out_of_order": transmission_out_of_order,
    "transmission_blank_status": transmission_blank_status,
    "count_blank": count_blank,
    "bad_numerics": bad_numerics,
    "load_history": load_history,
    "parse_delta": parse_delta,
    "merge_flags": merge_flags,
    "delta_by_flag": delta_by_flag,
    "upsert": upsert,
    "delta_composite": delta_composite,
    "delta_set_aside": delta_set_aside,
    "delta_single": delta_single,
    "delta_repeats": delta_repeats,
    "export_text": export_text,
    "export_since": export_since,
    "export_all_batches": export_all_batches,
    "ordered_concat": ordered_concat,
    "customer_join": customer_join,
    "reversal_pairs": reversal_pairs,
    "reversal_count": reversal_count,
    "apply_reversals": apply_reversals,
    "apply_duplicate_reversals": apply_duplicate_reversals,
    "duplicate_reversal_count": duplicate_reversal_count,
    "triage": triage,
    "not_in_keys": not_in_keys,
    "not_in_keys_null": not_in_keys_null,
    "in_keys": in_keys,
    "missing_keys_report": missing_keys_report,
    "except_keys": except_keys,
    "row_counts": row_counts,
    "reconcile_counts": reconcile_counts,
    "tagged_union": tagged_union,
    "render_rows": render_rows,
    "delete_where": delete_where,
    "tombstones": tombstones,
    "apply_cdc": apply_cdc,
    "as_of": as_of,
    "fill_rate": fill_rate,
    "volume_hour": volume_hour,
    "volume_day": volume_day,
    "recluster": recluster,
    "recluster_hour": recluster_hour,
    "tagged_field": tagged_field_q,
}

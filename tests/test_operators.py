"""Unit tests per operator on hand-made inputs: NULLs, repeats, ties, bad text."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quillspark.functions.scalar import guarded_int, json_fields, render_rows, tagged_field
from quillspark.operators import health, lookup, merge, reconcile
from quillspark.sources import catalog, storage, text

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def ts(h=0, m=0):
    return T0 + dt.timedelta(hours=h, minutes=m)


# ------------------------------------------------------------------ scans

def test_parse_delimited_short_line_bad_digits_and_wide_int(spark):
    df = spark.createDataFrame([("A|12|x",), ("B|12a|y|4000000000",), ("C",)], "data string")
    out = text.parse_delimited(df, "data", "|", ["k", "n", "s", "big"], int_cols=["n", "big"])
    assert rows(out) == [("A", 12, "x", None), ("B", None, "y", 4000000000), ("C", None, "", None)]


def test_guarded_int_rejects_sign_and_space(spark):
    df = spark.createDataFrame([("-1",), (" 2",), ("3",), (None,)], "v string")
    assert rows(df.select(guarded_int("v").alias("x"))) == [(3,), (None,), (None,), (None,)]


def test_export_since_next_batch(spark):
    df = spark.createDataFrame([(i, str(i)) for i in range(10)], "v long, s string")
    out = text.export_since(df, "v", 3, 4)
    assert [r.v for r in out.collect()] == [4, 5, 6, 7]


def test_export_since_keeps_rows_that_share_the_last_version(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", 2), ("e", 3), ("f", None)], "s string, v long")
    seen, mark = [], None
    while True:
        batch = text.export_since(df, "v", mark, 2)
        got = [r.s for r in batch.collect()]
        if not got:
            break
        seen, mark = seen + sorted(got), text.next_mark(batch, "v").first()[0]
    assert seen == ["a", "b", "c", "d", "e"]          # nothing twice, nothing lost; no version, no export
    assert text.export_since(df.limit(0), "v", None, 2).count() == 0


def test_export_as_text_keeps_version_type(spark):
    df = spark.createDataFrame([(2, 5, dt.date(2024, 1, 2))], "v long, n int, d date")
    out = text.export_as_text(df, "v", keep=["v"])
    assert dict(out.dtypes) == {"v": "bigint", "n": "string", "d": "string"}
    assert out.first().d == "2024-01-02"


def test_export_as_text_sorts_by_typed_version(spark):
    df = spark.createDataFrame([(10, "a"), (9, "b"), (100, "c")], "v long, s string")
    assert [r.v for r in text.export_as_text(df, "v").collect()] == ["9", "10", "100"]


def test_load_history_like_any_and_newest(spark):
    df = spark.createDataFrame([("a/en/1", 1), ("b.html", 2), ("c/fr/x", 3), ("d/en/z", 4)], "f string, t long")
    out = text.load_history(df, "f", "t", since=2, patterns=["%/en/%", "%.html"], n=1)
    assert [r.f for r in out.collect()] == ["d/en/z"]
    later = text.load_history(df, "f", "t", since=2, patterns=["%/en/%", "%.html"], n=5)
    assert [r.f for r in later.collect()] == ["d/en/z"]          # strictly after ``since``
    assert text.load_history(df, "f", "t").count() == 4          # no cap by default
    assert text.load_history(df, "f", "t", patterns=[]).count() == 0


def test_describe_columns_and_empty_table(spark):
    e = catalog.empty_table(spark, "a bigint, b string, c timestamp_ntz")
    assert e.count() == 0
    meta = catalog.describe_columns(spark, {"t": e})
    assert rows(meta, "column_name", "data_type", "ordinal_position") == [
        ("a", "BIGINT", 1), ("b", "VARCHAR", 2), ("c", "TIMESTAMP", 3)]


def test_delete_where_keeps_null_predicate_rows(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "k int, s string")
    out = storage.delete_where(df, F.col("s") == "x")
    assert rows(out) == [(2, None), (3, "y")]


def test_truncate_keeps_schema(spark):
    df = spark.createDataFrame([(1, "x")], "k int, s string")
    t = storage.truncate(df)
    assert t.count() == 0 and t.schema == df.schema


# ----------------------------------------------------------- projections

def test_json_fields_missing_null_malformed_and_long_ids(spark):
    docs = [('{"a": {"id": 1234567890123456789}, "t": "x"}',), ('{"a": null}',), ("not json",),
            ('{"t": ""}',)]
    df = spark.createDataFrame(docs, "doc string")
    out = json_fields(df, "doc", {"id": ("$.a.id", "bigint"), "t": ("$.t", "string")}, keep=False)
    assert rows(out) == [(1234567890123456789, "x"), (None, ""), (None, None), (None, None)]


def test_tagged_field_occurrence_and_missing(spark):
    df = spark.createDataFrame([("NMa~TYb~NMc",), ("TYz",), (None,)], "m string")
    out = df.select(tagged_field("m", "NM", 2).alias("x"), tagged_field("m", "TY", 1).alias("y"))
    assert rows(out) == [("c", "b"), (None, "z"), (None, None)]


def test_render_rows_null_operand_gives_null(spark):
    df = spark.createDataFrame([("a", "b"), ("c", None)], "x string, y string")
    out = render_rows(df, ["RUN ", F.col("x"), ".", F.col("y"), ";"])
    assert rows(out) == [("RUN a.b;",), (None,)]


def test_out_of_order_first_element(spark):
    df = spark.createDataFrame([(1, 0, "user"), (1, 1, "assistant"), (2, 1, "user"), (2, 0, "system"),
                                (3, 0, None)], "g long, pos long, role string")
    out = lookup.out_of_order(df, ["g"], "pos", {"first": "role"}, {"first": "USER"})
    assert rows(out) == [(2, "system")]


def test_column_mismatch_single_table(spark):
    df = spark.createDataFrame([("A", "A", 1), ("A", "R", 1), ("A", "R", 2), (None, "R", 1)],
                               "a string, b string, n int")
    assert rows(lookup.column_mismatch(df, "a", "b", "n")) == [("A", "R", 1)]


def test_next_mark(spark):
    df = spark.createDataFrame([(i,) for i in range(10)], "v long")
    assert text.next_mark(text.export_since(df, "v", 3, 4), "v").first()[0] == 7


def test_matches_any_keeps_underscore_wildcard(spark):
    df = spark.createDataFrame([("A_B",), ("AyB",), ("a_b",), ("other",)], "u string")
    assert rows(lookup.matches_any(df, "u", ["a_b"], case_insensitive=True)) == [("A_B",), ("AyB",), ("a_b",)]
    assert rows(lookup.matches_any(df, "u", ["A_B"])) == [("A_B",), ("AyB",)]
    assert lookup.matches_any(df, "u", []).count() == 0           # LIKE ANY of nothing
    assert lookup.distinct_types(df, "u", []).count() == 0


def test_ids_from_text_splits_trims_and_deduplicates(spark):
    df = spark.createDataFrame([("1, 2 ,,2",), (" 3",), (None,), ("",), ("a|b",)], "ids string")
    assert rows(lookup.ids_from_text(df, "ids")) == [("1",), ("2",), ("3",), ("a|b",)]
    assert rows(lookup.ids_from_text(df, "ids", "|")) == [("1, 2 ,,2",), ("3",), ("a",), ("b",)]


def test_unique_keys_drops_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k long, s string")
    assert rows(lookup.unique_keys(df, ["k"])) == [(1, "a"), (None, "d")]


def test_count_blank_is_not_null_test(spark):
    df = spark.createDataFrame([("",), (None,), ("x",), ("",)], "s string")
    assert lookup.count_blank(df, F.col("s")).first() == (2, 4)


def test_bad_numerics(spark):
    df = spark.createDataFrame([(1, "12", "x"), (2, None, "7"), (3, "1.5", None)], "k long, a string, b string")
    out = lookup.bad_numerics(df, ["k"], {"a": "a", "b": "b"})
    assert rows(out) == [(1, "b", "x"), (3, "a", "1.5")]


# ------------------------------------------------------------ aggregates

def test_count_total_distinct_counts_null_once(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k long")
    assert lookup.count_total_distinct(df, "k").first() == (5, 3)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "a long, b long")
    assert rows(lookup.duplicate_keys(df, ["a", "b"])) == [(1, 1, 2), (None, 3, 2)]


def test_fill_rate_window_and_bad_dates(spark):
    df = spark.createDataFrame([("20240130", 1), ("20240130", None), ("2024013x", 1), ("20240101", 1),
                                ("20231231", 1)], "d string, v long")
    out = health.fill_rate(df, "d", ["v"], as_of="2024-01-31", days=30)
    assert rows(out) == [(dt.date(2024, 1, 1), 1, 100.0), (dt.date(2024, 1, 30), 2, 50.0)]


def test_volume_by_bucket_inclusive_and_overlapping_total(spark):
    df = spark.createDataFrame([(ts(0, 5), "a"), (ts(0, 50), "b"), (ts(1, 0), "a"), (ts(2, 0), "a")],
                               "t timestamp_ntz, c string")
    out = health.volume_by_bucket(df, "t", "c", {"A": "a", "B": "b"}, ts(0), ts(1), keep=["TOTAL", "A"])
    assert rows(out) == [("A", ts(0), 1), ("A", ts(1), 1), ("TOTAL", ts(0), 2), ("TOTAL", ts(1), 1)]


# -------------------------------------------------------------- windows

def test_latest_per_key_nulls_first_and_tie_break(spark):
    df = spark.createDataFrame([(1, ts(1), 1, "a"), (1, ts(1), 2, "b"), (1, ts(0), 3, "c"),
                                (2, None, 4, "d"), (2, ts(5), 5, "e")], "k long, t timestamp_ntz, id long, v string")
    out = health.latest_per_key(df, "k", ["t", "id"])
    assert rows(out, "k", "v") == [(1, "b"), (2, "d")]
    early = health.latest_per_key(df, "k", ["t", "id"], earliest=True)
    assert rows(early, "k", "v") == [(1, "c"), (2, "e")]


def test_currently_failed_ignores_recovered_tasks(spark):
    df = spark.createDataFrame([("t1", "FAILED", ts(1), 1), ("t1", "SUCCEEDED", ts(2), 2),
                                ("t2", "SUCCEEDED", ts(1), 3), ("t2", "FAILED", ts(2), 4)],
                               "name string, state string, t timestamp_ntz, id long")
    out = health.currently_failed(df, "name", "t", "state", tie="id")
    assert rows(out, "name") == [("t2",)]


def test_failed_since_window_and_alert(spark):
    at = "2024-01-01 02:00:30"
    df = spark.createDataFrame([("a", "FAILED", ts(0, 29)), ("b", "FAILED", ts(0, 30)),
                                ("c", "CANCELLED", ts(1, 59)), ("d", "SUCCEEDED", ts(1, 59)),
                                ("e", "FAILED", ts(2, 1))], "name string, state string, t timestamp_ntz")
    out = health.failed_since(df, "t", "state", at, minutes=90, n=None)
    assert rows(out, "name") == [("b",), ("c",)]
    assert health.alert(df, "t", "state", at)
    assert not health.alert(df, "t", "state", "2024-01-01 00:00:00")


def test_triage_keeps_requests_without_log_and_dedupes_log(spark):
    from quillspark.functions.scalar import prefix_columns
    h = prefix_columns(spark.createDataFrame([(1,), (2,)], "rid long"), "h_")
    log = spark.createDataFrame([(10, 1, ts(1), "q1"), (11, 1, ts(2), "q2")],
                                "req long, rid long, t timestamp_ntz, qid string")
    p = prefix_columns(health.latest_per_key(log, "rid", ["t", "req"]), "p_")
    q = prefix_columns(spark.createDataFrame([("q2", 7)], "qid string, ms long"), "q_")
    out = health.triage(h, p, q, "h_rid", "p_rid", "p_qid", "q_qid")
    assert rows(out, "h_rid", "p_req", "q_ms") == [(1, 11, 7), (2, None, None)]


# --------------------------------------------------------------- joins

def test_not_in_null_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k long")
    right = spark.createDataFrame([(2,)], "k long")
    assert rows(reconcile.not_in(left, right, "k")) == [(1,)]
    with_null = spark.createDataFrame([(2,), (None,)], "k long")
    assert reconcile.not_in(left, with_null, "k").count() == 0
    empty = spark.createDataFrame([], "k long")
    assert reconcile.not_in(left, empty, "k").count() == 3


def test_in_keys_repeats_do_not_repeat_rows(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    keys = spark.createDataFrame([(1,), (1,), (1,)], "k long")
    assert rows(reconcile.in_keys(left, keys, "k")) == [(1, "a")]
    assert rows(lookup.rows_by_key(left, "k", [1, 1, 1])) == [(1, "a")]
    assert rows(lookup.rows_by_key(left, "k", keys)) == [(1, "a")]


def test_not_in_is_lazy(spark):
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "lazy")
    reconcile.not_in(spark.range(5).toDF("k"), spark.range(2).toDF("k"), "k")
    assert len(jobs.getJobIdsForGroup("lazy")) == 0
    spark.sparkContext.setJobGroup("", "")


def test_missing_keys_report_trims_text_ids(spark):
    src = spark.createDataFrame([(" 1",), ("2 ",)], "id string")
    ev = spark.createDataFrame([(1,)], "id long")
    tab = spark.createDataFrame([(2,), (5,)], "id long")
    out = reconcile.missing_keys_report(src, ev, tab, "id", "id", "id", tags=("no event", "no row", "extra", "bad"))
    assert rows(out) == [("extra", 5, None), ("no event", 2, None), ("no row", 1, None)]


def test_missing_keys_report_names_unreadable_ids_and_still_compares(spark):
    src = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    ev = spark.createDataFrame([("1",), ("oops",), ("oops",)], "id string")
    tab = spark.createDataFrame([("2",), ("5",), ("x",)], "id string")
    tags = ("no event", "no row", "extra", "bad")
    got = rows(reconcile.missing_keys_report(src, ev, tab, "id", "id", "id", tags=tags))
    assert got == [("bad", None, "oops"), ("bad", None, "x"), ("extra", 5, None), ("no event", 2, None),
                   ("no event", 3, None), ("no row", 1, None), ("no row", 3, None)]
    null = spark.createDataFrame([(None,)], "id long")    # a NULL of the data keeps NOT IN's meaning
    got = rows(reconcile.missing_keys_report(src, null, tab, "id", "id", "id", tags=tags))
    assert not [r for r in got if r[0] == "no event"] and ("no row", 1, None) in got


def test_except_keys(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    b = spark.createDataFrame([(2,), (3,)], "k long")
    assert rows(reconcile.except_keys(a, b, "k")) == [(1, "left only"), (3, "right only"), (None, "left only")]


# --------------------------------------------------------------- merges

def _target(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30), (4, "d", 40), (None, "n", 0)],
                                 "k long, s string, v long")


def _delta(spark):
    return spark.createDataFrame([
        (1, "a2", 11, "DELETED"), (2, "b2", 21, "UPDATED"), (3, "c2", 31, "NEW"), (4, "d2", 41, "BOGUS"),
        (5, "e", 50, "NEW"), (6, "f", 60, "UPDATED"), (7, "g", 70, "DELETED"), (8, "h", 80, ""),
        (9, "i", 90, None), (None, "z", 99, "NEW")], "k string, s string, v string, flag string")


def test_merge_change_flags_every_case(spark):
    for broadcast in (None, True, False):
        out = merge.merge_change_flags(_target(spark), _delta(spark), ["k"], "flag", broadcast=broadcast)
        assert rows(out) == [(2, "b2", 21), (3, "c", 30), (4, "d", 40), (5, "e", 50), (6, "f", 60),
                             (None, "n", 0), (None, "z", 99)]


def test_merge_twice_equals_once(spark):
    # A NULL key never matches, so (as in SQL MERGE) a NULL-key NEW row is
    # inserted by every run; the property holds for keyed rows.
    delta = _delta(spark).filter(F.col("k").isNotNull())
    once = merge.merge_change_flags(_target(spark), delta, ["k"], "flag")
    twice = merge.merge_change_flags(once, delta, ["k"], "flag")
    assert rows(once) == rows(twice)


def test_merge_rejects_repeated_key(spark):
    d = spark.createDataFrame([(2, "x", 1, "UPDATED"), (2, "y", 2, "UPDATED")], "k long, s string, v long, flag string")
    with pytest.raises(Exception, match="repeats"):
        merge.merge_change_flags(_target(spark), d, ["k"], "flag").collect()


def test_merge_composite_key_and_repeated_target_key(spark):
    t = spark.createDataFrame([(1, 1, "a"), (1, 1, "a'"), (1, 2, "b")], "p long, q long, s string")
    d = spark.createDataFrame([(1, 1, "u", "UPDATED"), (1, 3, "n", "NEW")], "p long, q long, s string, flag string")
    for broadcast in (True, False):
        out = merge.merge_change_flags(t, d, ["p", "q"], "flag", broadcast=broadcast)
        assert rows(out) == [(1, 1, "u"), (1, 1, "u"), (1, 2, "b"), (1, 3, "n")]


def test_upsert_refreshes_and_inserts(spark):
    t = spark.createDataFrame([("t1", ts(0), "x"), ("t2", ts(0), "y")], "name string, at timestamp_ntz, o string")
    r = spark.createDataFrame([("t2", ts(5), "ignored"), ("t3", ts(6), "z")], "name string, at timestamp_ntz, o string")
    for broadcast in (True, False):
        out = merge.upsert(t, r, ["name"], ["at"], broadcast=broadcast)
        assert rows(out) == [("t1", ts(0), "x"), ("t2", ts(5), "y"), ("t3", ts(6), "z")]


def test_apply_cdc_and_as_of(spark):
    ev = spark.createDataFrame([(1, 1, ts(0), "UPSERT", "a"), (1, 2, ts(1), "DELETE", None),
                                (2, 3, ts(0), "UPSERT", "b"), (2, 4, ts(2), "UPSERT", "c"),
                                (3, 5, ts(3), "UPSERT", "d")], "k long, id long, t timestamp_ntz, op string, v string")
    now = merge.as_of(ev, ["k"], "t", ts(10), op_col="op", tie="id")
    assert rows(now, "k", "v") == [(2, "c"), (3, "d")]
    earlier = merge.as_of(ev, ["k"], "t", ts(0, 30), op_col="op", tie="id")
    assert rows(earlier, "k", "v") == [(1, "a"), (2, "b")]
    applied = merge.apply_cdc(earlier, ev.filter(F.col("t") > F.lit(ts(0, 30))), ["k"], "op", "t", tie="id")
    assert rows(applied) == rows(now)


def test_apply_cdc_ignores_older_and_repeated_events(spark):
    schema = "k long, id long, t timestamp_ntz, op string, v string"
    target = spark.createDataFrame([(1, 9, ts(5), "UPSERT", "new"), (2, 8, ts(5), "UPSERT", "keep")], schema)
    late = spark.createDataFrame([(1, 1, ts(1), "UPSERT", "old"), (2, 2, ts(2), "DELETE", None), (3, 3, ts(1), "UPSERT", "in")], schema)
    for broadcast in (True, False):
        out = merge.apply_cdc(target, late, ["k"], "op", "t", tie="id", broadcast=broadcast)
        assert rows(out, "k", "v") == [(1, "new"), (2, "keep"), (3, "in")]
        assert rows(merge.apply_cdc(out, late, ["k"], "op", "t", tie="id"), "k", "v") == rows(out, "k", "v")


def test_apply_cdc_in_any_order_with_kept_deletes(spark):
    import itertools
    schema = "k long, t timestamp_ntz, op string, v string"
    batches = [[(1, ts(1), "UPSERT", "a"), (2, ts(1), "UPSERT", "x")], [(1, ts(2), "DELETE", None)],
               [(1, ts(0), "UPSERT", "older"), (2, ts(3), "UPSERT", "y")]]
    for order in itertools.permutations(range(3)):
        table = spark.createDataFrame([], "k long, t timestamp_ntz, op string, v string, gone boolean")
        for i in (*order, order[0]):                              # one batch comes twice
            events = spark.createDataFrame(batches[i], schema)
            table = merge.apply_cdc(table, events, ["k"], "op", "t", cols=["t", "op", "v"], deleted_col="gone")
        assert rows(table.filter("not gone"), "k", "v") == [(2, "y")], order
        assert rows(table.filter("gone"), "k") == [(1,)]


def test_apply_reversals_edge_rows(spark):
    from quillspark.operators import claims
    t = dt.datetime(2024, 1, 1)
    c = spark.createDataFrame([
        (1, "k", t, False), (2, "k", t + dt.timedelta(days=1), False),   # equal time: no match
        (3, "k", t, True),                                              # already reversed
        (4, "k", t, None), (5, "z", t, False)],                         # NULL flag; no reversal
        "id long, key string, ts timestamp_ntz, reversed boolean")
    r = spark.createDataFrame([(10, "k", t + dt.timedelta(days=1)), (11, "k", t - dt.timedelta(days=1))],
                              "id long, key string, ts timestamp_ntz")
    out = claims.apply_reversals(c, r, ["key"], "ts", "ts", "id")
    assert rows(out, "id", "reversed", "reversed_record_id") == [
        (1, True, 10), (2, False, None), (3, True, None), (4, None, None), (5, False, None)]


def test_apply_tombstones(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    tomb = spark.createDataFrame([(2,), (9,)], "k long")
    assert rows(merge.apply_tombstones(df, tomb, ["k"])) == [(1,), (3,)]


# ------------------------------------------------------------- set ops

def test_reconcile_counts_case_and_one_sided(spark):
    a = spark.createDataFrame([("Orders", 3), ("x", 1)], "object_name string, row_count long")
    b = spark.createDataFrame([("ORDERS", 2), ("y", 5)], "object_name string, row_count long")
    assert rows(reconcile.reconcile_counts(a, b)) == [("orders", 3, 2, 1), ("x", 1, None, None),
                                                      ("y", None, 5, None)]


def test_tagged_union_is_distinct(spark):
    a = spark.createDataFrame([("n1", "o"), ("n1", "o")], "name string, owner string")
    b = spark.createDataFrame([("o", "n1")], "owner string, name string")
    out = reconcile.tagged_union({"A": a, "B": b}, where=F.col("owner") == "o")
    assert rows(out) == [("A", "n1", "o"), ("B", "n1", "o")]

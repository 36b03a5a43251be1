"""Interval join, version cut, presence masks, content comparison, history, staging and layout against brute force and plans."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL, rows
from quillspark.operators import claims, history, layout, merge, reconcile
from quillspark.plans import fixtures_history
from quillspark.session import work_path
from quillspark.sources import documents, text

DAY = dt.datetime(2024, 1, 1)


def at(hours):
    return None if hours is None else DAY + dt.timedelta(hours=hours)


# --- interval join -----------------------------------------------------------------------

SIDE = "id long, a long, b string, c long, d string, t timestamp_ntz"
KEYS = ["a", "b", "c", "d"]


def sides(spark, seed, n, hot=0.0, span=900):
    r = random.Random(seed)
    out = []
    for _ in range(2):
        data = []
        for i in range(n):
            key = (1, "x", 1, "y") if r.random() < hot else tuple(r.choice([(1, 2, None), ("x", "y"), (1, 2), ("y", "z", None)][k]) for k in range(4))
            data.append((i, *key, at(r.randrange(span)) if r.random() < .95 else None))
        out.append(data)
    return out


def brute_pairs(c, r, more, most):
    return sorted((x[0], y[0]) for x in c for y in r if None not in x[1:] and x[1:5] == y[1:5] and y[5] is not None
                  and dt.timedelta(hours=more) < y[5] - x[5] <= dt.timedelta(hours=most))


@pytest.mark.parametrize("more,most,step", [(0, 48, None), (0, 24, dt.timedelta(hours=1)), (-30, 30, dt.timedelta(hours=7)), (24, 25, None),
                                            (0, 900, dt.timedelta(days=3))])
def test_window_pairs_like_brute_force(spark, more, most, step):
    c, r = sides(spark, 3, 150)
    got = claims.match_in_window(spark.createDataFrame(c, SIDE), spark.createDataFrame(r, SIDE), KEYS, "t", "t",
                                 dt.timedelta(hours=most), dt.timedelta(hours=more), step)
    assert got.columns == ["id", *KEYS, "t", "rev_id", "rev_t"]
    assert rows(got, "id", "rev_id") == sorted(brute_pairs(c, r, more, most), key=lambda x: (str(x[0]), str(x[1]))) or \
        sorted(map(tuple, got.select("id", "rev_id").collect())) == brute_pairs(c, r, more, most)


def test_window_ends_are_exact_and_empty_windows_fail(spark):
    c = spark.createDataFrame([(1, 1, "x", 1, "y", at(0))], SIDE)
    r = spark.createDataFrame([(h, 1, "x", 1, "y", at(h)) for h in (-1, 0, 1, 24, 25)], SIDE)
    got = claims.match_in_window(c, r, KEYS, "t", "t", dt.timedelta(hours=24))
    assert rows(got, "rev_id") == [(1,), (24,)]
    with pytest.raises(ValueError):
        claims.match_in_window(c, r, KEYS, "t", "t", dt.timedelta(0))


def test_a_hot_key_is_spread_over_its_buckets(spark):
    c, r = sides(spark, 5, 2000, hot=1.0, span=24 * 300)
    cd, rd = spark.createDataFrame(c, SIDE), spark.createDataFrame(r, SIDE)
    got = claims.match_in_window(cd, rd, KEYS, "t", "t", dt.timedelta(days=1), step=dt.timedelta(days=1))
    assert sorted(map(tuple, got.select("id", "rev_id").collect())) == brute_pairs(c, r, 0, 24)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = claims.match_in_window(cd, rd, KEYS, "t", "t", dt.timedelta(days=1))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    deal = [x for x in plan.splitlines() if "hashpartitioning" in x]
    assert deal and all("bucket" in x for x in deal) and "Cartesian" not in plan and "NestedLoop" not in plan
    share = cd.dropna(subset=["t"]).groupBy(claims.time_bucket(F.col("t"), dt.timedelta(days=1))).count().agg(F.max("count")).first()[0]
    assert share < 30  # of 2000 rows of one key


# --- version cut -----------------------------------------------------------------------------

@pytest.mark.parametrize("seed,n,kinds", [(1, 500, 40), (2, 300, 1), (3, 200, 100000)])
def test_version_cut_like_sorting(spark, seed, n, kinds):
    r = random.Random(seed)
    data = [(r.randrange(kinds) if r.random() < .9 else None,) for _ in range(n)]
    df = spark.createDataFrame(data, "v long").repartition(6)
    versions = sorted(x for x, in data if x is not None)
    timed = df.select((F.lit(DAY).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("v"))).alias("v"))
    for k in (2, len(versions) // 2, len(versions) + 5):
        want = versions[min(k, len(versions)) - 1]
        assert text.version_cut(df, "v", k) == text.sorted_cut(df, "v", k) == want
        assert text.version_cut(timed, "v", k) == at(want)
    assert text.version_cut(df.limit(0), "v", 3) is None and text.sorted_cut(df.limit(0), "v", 3) is None
    days = spark.createDataFrame([(-3,), (-3,), (0,), (9,)], "d int").select(F.date_add(F.lit("2024-01-10").cast("date"), F.col("d")).alias("v"))
    assert [str(text.version_cut(days, "v", k)) for k in (1, 2, 3, 4)] == ["2024-01-07", "2024-01-07", "2024-01-10", "2024-01-19"]
    wide = spark.createDataFrame([(-2 ** 62,), (5,), (2 ** 62,)], "v long")
    assert [text.version_cut(wide, "v", k) for k in (1, 2, 3)] == [-2 ** 62, 5, 2 ** 62]


def test_export_plan_has_no_single_partition_exchange_of_rows(spark):
    df = spark.createDataFrame([(i, f"2024-01-{1 + i % 28:02d}") for i in range(200)], "id long, v string")
    batch = text.export_since(df, "v", "2024-01-03", 40)
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Subquery" not in plan and "GlobalLimit" not in plan
    got = rows(batch, "v")
    assert set(got) == {(f"2024-01-{d:02d}",) for d in (4, 5, 6, 7, 8)} or len(got) >= 40
    assert min(got) == ("2024-01-04",) and len(got) >= 40 and len([x for x in got if x < max(got)]) < 40
    nulls = spark.createDataFrame([(1, None), (2, "a")], "id long, v string")
    assert text.export_since(nulls, "v", None, 5).count() == 1 and rows(text.count_unversioned(nulls, "v")) == [(1,)]
    assert text.export_since(nulls, "v", "z", 5).count() == 0


# --- presence mask ----------------------------------------------------------------------------

TAGS = ("source key without event", "source key without row", "table key without source", "unreadable key")


def brute_report(s, e, t):
    def num(x):
        try:
            return None if x is None else int(x)
        except ValueError:
            return "bad"
    out = Counter()
    sides = [[num(x) for x in side] for side in (s, e, t)]
    good = [[x for x in side if x != "bad"] for side in sides]
    for tag, a, b in ((TAGS[0], 0, 1), (TAGS[1], 0, 2), (TAGS[2], 2, 0)):
        for x in good[a]:
            if not good[b] or (None not in good[b] and x is not None and x not in good[b]):
                out[tag, x, None] += 1
    for side in (s, e, t):
        for x in {x for x in side if num(x) == "bad"}:
            out[TAGS[3], None, x] += 1
    return out


@pytest.mark.parametrize("s,e,t", [
    (["1", "2", "2", "3", "x"], ["2", "y"], ["3", "4", "x"]), (["1", None, "2"], ["2"], ["1", "9"]), (["1"], ["1", None], [None, "7"]),
    (["1", None, "1"], [], ["1"]), ([], ["1"], ["2", "2", None]), (["x", "x"], ["x"], []), ([], [], [])])
def test_missing_keys_like_not_in(spark, s, e, t):
    df = lambda v: spark.createDataFrame([(x,) for x in v], "k string")
    got = reconcile.missing_keys_report(df(s), df(e), df(t), "k", "k", "k")
    assert Counter(map(tuple, got.collect())) == brute_report(s, e, t)


def test_each_side_is_scanned_once(spark):
    src = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(F.col("doc_id").cast("string").alias("doc_id"))
    labels, bench = (spark.read.parquet(f"{SF_SMALL}/{n}.parquet") for n in ("labels", "benchmark"))
    plan = reconcile.presence(((src, "doc_id"), (labels, "doc_id"), (bench, "item_id")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 3 and plan.count("Exchange") == 1
    report = reconcile.missing_keys_report(src, labels, bench, "doc_id", "doc_id", "item_id")
    assert all("presence" in f for f in report.inputFiles())


# --- content comparison --------------------------------------------------------------------------

def test_content_diff_names_changed_keys(spark):
    schema = "k long, part string, v double, w array<int>"
    a = [(i, "p", i / 2, [i]) for i in range(300)] + [(None, "p", 1.0, None), (5, "p", 2.5, [5]), (7, None, 1.0, [1])]
    b = [(i, "p", i / 2 + (i == 17), [i] if i != 18 else [0]) for i in range(300) if i != 19]
    b += [(None, "p", 1.0, None), (400, "q", 0.0, []), (7, None, 1.0, [1])]
    got = reconcile.content_diff(spark.createDataFrame(a, schema).repartition(5), spark.createDataFrame(b, schema), ["k", "part"], buckets=32)
    assert rows(got) == sorted([(17, "p", "changed"), (18, "p", "changed"), (19, "p", "left only"), (400, "q", "right only"), (5, "p", "changed")],
                               key=lambda t: tuple((x is None, str(x)) for x in t))
    same = spark.createDataFrame(a, schema)
    assert reconcile.content_diff(same, same.repartition(7), "k").count() == 0
    assert reconcile.content_diff(same, same.withColumn("v", F.col("v") + 1), "k", cols=["w"]).count() == 0


# --- history ----------------------------------------------------------------------------------------

LOG = "k long, t timestamp_ntz, id long, op string"


def log_rows(seed, n=200):
    r = random.Random(seed)
    return [(r.choice([1, 1, 1, 2, 3, None]), at(r.randrange(0, 400, 3)) if r.random() < .95 else None, i, r.choice(["SET", "SET", "DELETE"]))
            for i in range(n)]


def brute_states(log):
    last = {}
    for k, t, i, op in log:
        if k is not None and t is not None and last.get((k, t), (-1,))[0] < i:
            last[k, t] = (i, op)
    return sorted((k, t, *v) for (k, t), v in last.items())


@pytest.mark.parametrize("seed", [1, 2])
def test_validity_like_brute_force(spark, seed):
    log = log_rows(seed)
    states = brute_states(log)
    want = [(k, t, n[1] if n and n[0] == k else None, i) for (k, t, i, op), n in zip(states, [*states[1:], None]) if op != "DELETE"]
    got = history.validity_intervals(spark.createDataFrame(log, LOG), ["k"], "t", "id", "op")
    assert sorted(map(tuple, got.select("k", "valid_from", "valid_to", "id").collect()), key=lambda x: x[:2]) == want
    assert history.validity_intervals(spark.createDataFrame([], LOG), ["k"], "t").count() == 0


@pytest.mark.parametrize("strict", [True, False])
def test_state_at_like_brute_force(spark, strict):
    log, r = log_rows(3), random.Random(9)
    probes = [(i, r.choice([1, 2, 3, 4, None]), at(r.randrange(0, 420)) if r.random() < .95 else None) for i in range(150)]
    states = brute_states(log)
    want = {}
    for i, k, t in probes:
        seen = [s for s in states if s[0] == k and t is not None and (s[1] < t or (not strict and s[1] == t))]
        want[i] = seen[-1][2] if seen else None
    got = history.state_at(spark.createDataFrame(probes, "pid long, k long, pt timestamp_ntz"), spark.createDataFrame(log, LOG), ["k"],
                           "pt", "t", "id", strict)
    assert got.columns == ["pid", "k", "pt", "state_t", "state_id", "state_op"]
    assert {x["pid"]: x["state_id"] for x in got.collect()} == want and got.count() == len(probes)


# --- staging and layout -------------------------------------------------------------------------------

def scanned_files(df):
    """Files that the plan's scans opened, after it ran (plan without adaptive stages)."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    out = 0
    for i in range(leaves.size()):
        m = leaves.apply(i).metrics()
        if m.contains("numFiles"):
            out += m.apply("numFiles").value()
    return out


def test_types_from_a_table_prune_folders(spark):
    path = fixtures_history.stage_by_type(spark, SF_SMALL)
    everything = spark.read.parquet(path).inputFiles()
    types = fixtures_history.watched_types(spark, SF_SMALL)
    wanted = {r[0] for r in types.collect()}
    assert 0 < len(wanted) < 5
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = documents.staged_documents(spark, path, fixtures_history.STORED, types, "2024-01-20")
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan and f"{documents.DAY}" in plan.split("PartitionFilters:")[1].split("]")[0]
        n = len(df.collect())
        hit = [f for f in everything if any(f"{documents.TYPE}={t}/" in f for t in wanted) and f.split(f"{documents.DAY}=")[1][:10] >= "2024-01-20"]
        assert n and scanned_files(df) - len(types.inputFiles()) <= len(hit) < len(everything) / 2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_staging_loses_no_document(spark):
    path = work_path(spark, "t by type")
    data = [('{"type": "a", "time": "2024-01-02 03:04:05", "x": 1}', 1), ("not json", 2), ('{"type": "b", "time": "never"}', 3),
            ('{"time": "2024-01-02 00:00:00"}', 4), (None, 5)]
    documents.stage_documents(spark.createDataFrame(data, "doc string, n int"), "doc", "$.type", "$.time", path)
    documents.stage_documents(spark.createDataFrame(data[:1], "doc string, n int"), "doc", "$.type", "$.time", path)
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("doc", T.VariantType())])
    got = documents.staged_documents(spark, path, schema)
    assert rows(got, "n", documents.TYPE) == sorted([(1, "a"), (1, "a"), (2, None), (3, "b"), (4, None), (5, None)],
                                                    key=lambda t: tuple((x is None, str(x)) for x in t))
    one = documents.staged_documents(spark, path, schema, ["a"], "2024-01-01")
    assert rows(one.select(F.try_variant_get("doc", "$.x", "int"), F.col(documents.DAY).cast("string"))) == [(1, "2024-01-02")] * 2


def test_layout_proof_opens_far_fewer_files(spark):
    got = fixtures_history.layout_proof(spark, "/root/testdata/sf0.01").collect()
    bad = dt.datetime(1970, 1, 1)
    days = [r for r in got if r["cluster_day"] != bad]
    assert len(days) == 30 and all(r["files_before"] >= 16 for r in got)
    assert all(4 * r["files_after"] <= r["files_before"] for r in days)
    hot = next(r for r in got if r["cluster_day"] == bad)
    assert 1 < hot["files_after"] < hot["files_before"]      # a third of the rows, cut over several files
    assert sum(r["n_rows"] for r in got) == 10000


# --- repeat guard -----------------------------------------------------------------------------------------

def test_guarded_merge_sets_repeats_aside(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    delta = spark.createDataFrame([("1", "x", "UPDATED"), ("2", "y", "UPDATED"), ("2", "z", "DELETED"), ("3", "n", "NEW"), (None, "0", "NEW"),
                                   (None, "0", "NEW")], "k string, v string, f string")
    merged, again = merge.merge_guarded(target, delta, ["k"], "f")
    assert rows(merged) == [(1, "x"), (2, "b"), (3, "n"), (None, "0"), (None, "0")]
    assert rows(again) == [(2, "y", "UPDATED"), (2, "z", "DELETED")]
    once, again = merge.split_repeats(delta, ["k"])
    assert once.count() + again.count() == delta.count()


def test_changes_meet_files_by_range(spark):
    path = work_path(spark, "t-files")
    for lo in (0, 5):
        spark.createDataFrame([(at(24 * d), t) for d in range(lo, lo + 5) for t in ("a", "c")], "t timestamp_ntz, kind string").coalesce(1).write.mode(
            "append").parquet(path)
    spark.createDataFrame([(at(0), "b"), (at(24 * 9), "b")], "t timestamp_ntz, kind string").coalesce(1).write.mode("append").parquet(path)
    df = spark.read.parquet(path)
    got = {(r["bucket"], r["type"]): r["n_files"] for r in layout.files_met(df, F.date_trunc("day", "t").cast("timestamp_ntz"), F.col("kind")).collect()}
    assert got[at(0), "b"] == 2 and got[at(24), "a"] == 1 and got[at(24 * 9), "b"] == 2 and len(got) == 22


def test_clustered_files_hold_exactly_their_rows(spark, monkeypatch):
    monkeypatch.setattr(layout, "NUMBERED", 10)
    data = [(i, "n/a" if i % 3 == 0 else f"2024-01-{1 + i % 9:02d} 01:00:00", "ab"[i % 2] if i % 11 else None) for i in range(500)]
    df = spark.createDataFrame(data + data[:40], "id int, t string, kind string").repartition(5)
    out = layout.write_clustered(df, work_path(spark, "t-clustered"), F.col("t"), F.col("kind"), 32)
    sizes = Counter(r[0] for r in out.select(F.col("_metadata.file_path")).collect())
    assert sorted(sizes.values()) == sorted([32] * (540 // 32) + [540 % 32])
    assert Counter(map(tuple, out.select("id", "t", "kind").collect())) == Counter(data + data[:40])
    ranges = sorted((r["low_bucket"], r["high_bucket"]) for r in layout.file_ranges(out, F.col("cluster_day"), F.col("kind")).collect())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))

"""Bucketed merges, rejected events, applied-file manifests and the change register."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from quillspark.operators import bucketed, merge
from quillspark.session import path_exists, work_path
from quillspark.streaming import register, streams

ROW = "k long, v string"


def local(path):
    return path.removeprefix("file:")


def files(path):
    """Data files below a folder with their write times."""
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(local(path)) for f in fs
            if f.endswith(".parquet")}


def flagged(target, changes):
    return merge.merge_change_flags(target, changes, ["k"], "flag")


def changes(spark, data):
    return spark.createDataFrame(data, "k long, v string, flag string")


def test_merge_writes_only_touched_buckets(spark):
    path = work_path(spark, "t-buckets")
    table = spark.createDataFrame([(i, f"v{i}") for i in range(200)] + [(None, "none")], ROW)
    bucketed.write_buckets(table, path, ["k"], 16)
    before = files(path)
    c = changes(spark, [(7, "new", "UPDATED"), (8, "", "DELETED"), (1000, "added", "NEW"), (9, "x", "BOGUS")])
    touched = bucketed.merge_buckets(spark, path, table.schema, c, ["k"], flagged, work_path(spark, "t-work"), 16)
    after = files(path)
    want = {r[0] for r in c.select(bucketed.bucket_of(table.schema, ["k"], 16)).distinct().collect()}
    assert set(touched) == want and 0 < len(want) < 16
    kept = {f for f in before if not any(f"{bucketed.BUCKET}={b}/" in f for b in touched)}
    assert kept and all(after.get(f) == before[f] for f in kept)
    assert all(any(f"{bucketed.BUCKET}={b}/" in f for b in touched) for f in set(after) - kept)
    want_rows = {**{i: f"v{i}" for i in range(200)}, 7: "new", 1000: "added", None: "none"}
    del want_rows[8]
    assert dict(rows(bucketed.read_buckets(spark, path, table.schema))) == want_rows


def test_merge_equals_whole_table_merge_and_prunes(spark):
    path = work_path(spark, "t-buckets")
    table = spark.createDataFrame([(i, f"v{i}") for i in range(300)], ROW)
    bucketed.write_buckets(table, path, ["k"], 8)
    c = changes(spark, [(i * 3, f"n{i}", ("UPDATED", "DELETED", "NEW", None)[i % 4]) for i in range(150)])
    bucketed.merge_buckets(spark, path, table.schema, c, ["k"], flagged, work_path(spark, "t-work"), 8)
    assert rows(bucketed.read_buckets(spark, path, table.schema)) == rows(flagged(table, c))
    plan = bucketed.read_buckets(spark, path, table.schema, [1, 2])._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{bucketed.BUCKET}" in plan


def test_interrupted_merge_repeats_from_its_own_copy(spark):
    path, work = work_path(spark, "t-buckets"), work_path(spark, "t-work")
    table = spark.createDataFrame([(i, "old") for i in range(50)], ROW)
    bucketed.write_buckets(table, path, ["k"], 4)
    c = changes(spark, [(i, "new", "UPDATED") for i in range(20)])
    touched = bucketed.merge_buckets(spark, path, table.schema, c, ["k"], flagged, work, 4)
    want = rows(bucketed.read_buckets(spark, path, table.schema))
    from quillspark.session import delete_path
    delete_path(spark, f"{path}/{bucketed.BUCKET}={touched[0]}")       # as if the copy had stopped half way

    def never(target, changes):
        raise AssertionError("the half replaced table must not be read")
    assert bucketed.merge_buckets(spark, path, table.schema, c, ["k"], never, work, 4) == touched
    assert rows(bucketed.read_buckets(spark, path, table.schema)) == want


def test_bucket_that_empties_and_no_changes(spark):
    path = work_path(spark, "t-buckets")
    table = spark.createDataFrame([(1, "a"), (2, "b")], ROW)
    bucketed.write_buckets(table, path, ["k"], 64)
    gone = changes(spark, [(1, "", "DELETED")])
    bucketed.merge_buckets(spark, path, table.schema, gone, ["k"], flagged, work_path(spark, "t-work"), 64)
    assert rows(bucketed.read_buckets(spark, path, table.schema)) == [(2, "b")]
    before = files(path)
    assert bucketed.merge_buckets(spark, path, table.schema, gone.limit(0), ["k"], flagged, work_path(spark, "t-work"), 64) == []
    assert files(path) == before
    assert bucketed.read_buckets(spark, work_path(spark, "t-none"), table.schema).count() == 0


# --- change events without a time, rejected documents -------------------------------------

def test_event_without_time_hides_nothing(spark):
    schema = "k long, t timestamp_ntz, op string, v string"
    day = lambda d: dt.datetime(2024, 1, d)
    target = spark.createDataFrame([(1, day(1), "UPSERT", "old"), (2, day(1), "UPSERT", "stays")], schema)
    events = spark.createDataFrame([(1, day(2), "UPSERT", "new"), (1, None, "UPSERT", "untimed"), (2, None, "DELETE", "x"),
                                    (3, None, "UPSERT", "only")], schema)
    got = merge.apply_cdc(target, events, ["k"], "op", "t")
    assert rows(got, "k", "v") == [(1, "new"), (2, "stays"), (3, "only")]


DOCS = T.StructType([T.StructField("data", T.StringType())])
TABLE = "k long, t timestamp_ntz, op string, v string, is_deleted boolean"
FIELDS = {"k": ("$.k", "bigint"), "t": ("$.t", "timestamp_ntz"), "op": ("$.op", "string"), "v": ("$.v", "string")}


def doc(k, h, op="UPSERT", v="x"):
    return f'{{"k": {k}, "t": "2024-01-01 {h:02d}:00:00", "op": "{op}", "v": "{v}"}}'


def test_rejected_documents_are_kept_apart(spark):
    stage, target = work_path(spark, "t docs"), work_path(spark, "t typed")
    table = spark.createDataFrame([], TABLE).schema
    ckpt = streams.new_checkpoint(spark, "typed")
    handler = streams.typed_table_writer(spark, target, table, "data", FIELDS, ["k"], "op", "t", buckets=4)
    bad = ["not json", '{"k": "text", "t": "2024-01-01 01:00:00"}', '{"k": 5, "op": "UPSERT"}', None, "null", '{"k": 5, "t": "never"}']
    loads = [[doc(1, 5, v="a"), *bad], [doc(1, 3, v="late"), doc(2, 1, v="b")], [doc(1, 5, v="a"), *bad], [*bad]]
    for load in loads:
        spark.createDataFrame([(x,) for x in load], DOCS).coalesce(1).write.mode("append").parquet(stage)
        streams.drain_once(streams.event_stream(spark, stage, DOCS), handler, ckpt)
    assert rows(streams.read_typed_table(spark, target, table, len(loads)), "k", "v") == [(1, "a"), (2, "b")]
    got = streams.read_rejected(spark, target)
    assert rows(got.groupBy("reason").count()) == [("no key", 6), ("no time", 6), ("unreadable", 6)]
    assert rows(got.select("batch_id").distinct()) == [(0,), (2,), (3,)]
    assert streams.read_rejected(spark, work_path(spark, "none")).count() == 0


def test_retried_batch_writes_the_same(spark):
    target = work_path(spark, "t-typed")
    table = spark.createDataFrame([], TABLE).schema
    handler = streams.typed_table_writer(spark, target, table, "data", FIELDS, ["k"], "op", "t", buckets=4)
    first = spark.createDataFrame([(doc(i, 1),) for i in range(20)] + [("bad",)], DOCS)
    second = spark.createDataFrame([(doc(3, 9, v="new"),), (doc(4, 9, "DELETE"),)], DOCS)
    handler(first, 0)
    handler(first, 0)
    before = files(f"{target}/table")
    handler(second, 1)
    once = rows(streams.read_typed_table(spark, target, table, 2))
    handler(second, 1)
    assert rows(streams.read_typed_table(spark, target, table, 2)) == once and len(once) == 19
    assert streams.read_rejected(spark, target).count() == 1
    after = files(f"{target}/table")
    untouched = {f for f in before if f in after}
    assert untouched and all(before[f] == after[f] for f in untouched)
    assert not path_exists(spark, f"{target}/work/batch_id=0")


# --- manifests -----------------------------------------------------------------------------

def test_backlog_by_manifest_with_odd_names(spark):
    stage, target = work_path(spark, "in coming+100%"), work_path(spark, "t target")
    schema = spark.createDataFrame([], ROW).schema
    manifest = f"{target}_files"

    def load(*ids):
        spark.createDataFrame([(i, "x") for i in ids], ROW).coalesce(1).write.mode("append").parquet(stage)

    def drain(ckpt):
        streams.drain_once(streams.event_stream(spark, stage, schema, with_file=True),
                           streams.append_writer(target, ckpt, manifest), ckpt)
    load(1, 2)
    assert streams.waiting_files(spark, stage, manifest).count() == 1
    ckpt = streams.new_checkpoint(spark, "m")
    drain(ckpt)
    assert streams.waiting_files(spark, stage, manifest).isEmpty()
    load(3)
    assert rows(streams.waiting_rows(spark, stage, schema, manifest), "k") == [(3,)]
    drain(ckpt)
    drain(ckpt)
    assert streams.waiting_rows(spark, stage, schema, manifest).count() == 0
    got = streams.read_appended(spark, target, schema)
    assert rows(got, "k") == [(1,), (2,), (3,)] and got.columns == ["k", "v"]
    # neither probe reads the target
    for df in (streams.waiting_files(spark, stage, manifest), streams.waiting_rows(spark, stage, schema, manifest)):
        assert "t%20target-" not in str(df.inputFiles()).replace("_files", "") or all("_files" in f or "in%20coming" in f for f in df.inputFiles())


def test_backlog_by_target_with_a_space_in_the_name(spark):
    stage, target = work_path(spark, "in coming"), work_path(spark, "t-target")
    schema = spark.createDataFrame([], ROW).schema
    spark.createDataFrame([(1, "x")], ROW).write.mode("append").parquet(stage)
    filed = T.StructType([*schema.fields, T.StructField(streams.FILE_COL, T.StringType())])
    assert rows(streams.backlog(spark, stage, schema, spark.createDataFrame([], filed))) == [(1, "x")]


# --- change register -------------------------------------------------------------------------

TIMED = "id long, at timestamp_ntz"


def source(spark, name, column="at"):
    return register.Source(name, work_path(spark, f"t {name}"), spark.createDataFrame([], TIMED.replace("at ", f"{column} ")).schema, column)


def change(spark, s, *hours):
    data = [(i, None if h is None else dt.datetime(2024, 1, 1, h)) for i, h in enumerate(hours)]
    spark.createDataFrame(data, s.schema).coalesce(1).write.mode("append").parquet(s.path)


def hours(log):
    return {r["source_name"]: (r["changed_at"] and r["changed_at"].hour, r["n_rows"]) for r in log.read().collect()}


def test_register_late_unregister_and_register_again(spark):
    log = register.Register(spark)
    a, b = source(spark, "a"), source(spark, "b", "changed")
    watch = log.register([a, b])
    assert hours(log) == {"a": (None, 0), "b": (None, 0)}
    change(spark, a, 5, 7, None)
    change(spark, b, 9)
    log.run(watch, [a, b])
    assert hours(log) == {"a": (7, 3), "b": (9, 1)}
    change(spark, a, 2)                                  # late: counted, the time stays
    log.run(watch, [a, b])
    log.run(watch, [a, b])                               # nothing new
    assert hours(log) == {"a": (7, 4), "b": (9, 1)}
    log.unregister("b")
    change(spark, a, 8)
    change(spark, b, 20)
    log.run(watch, [a, b])
    assert hours(log) == {"a": (8, 5)}
    again = log.register([b])                            # anew, from the first file on
    assert hours(log) == {"a": (8, 5), "b": (None, 0)}
    log.run(again, [b])
    assert hours(log) == {"a": (8, 5), "b": (20, 2)}
    log.unregister("a")
    change(spark, a, 23)
    log.run(watch, [a, b])                               # no source of it is watched any more
    assert hours(log) == {"b": (20, 2)}
    with pytest.raises(KeyError):
        log.unregister("a")
    with pytest.raises(ValueError):
        log.register([a, a])


def test_register_batch_is_idempotent(spark):
    log = register.Register(spark)
    a = source(spark, "a")
    watch = log.register([a])
    batch = spark.createDataFrame([("a", dt.datetime(2024, 1, 1, 3), 4)], register.REGISTER)
    write = log.writer(watch)
    write(batch, 0)
    write(batch, 0)
    assert hours(log) == {"a": (3, 4)}
    write(spark.createDataFrame([], register.REGISTER), 1)
    assert hours(log) == {"a": (3, 4)}

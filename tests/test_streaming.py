"""Change streams: on-demand runs, a reset, backlog, scheduled tasks, a typed table, resync."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from quillspark.session import work_path
from quillspark.streaming import streams

SCHEMA = "event_id long, event_type string, ts timestamp_ntz"


def _load(spark, stage, data):
    spark.createDataFrame(data, SCHEMA).write.mode("append").parquet(stage)


def _ev(i, typ, h):
    return (i, typ, dt.datetime(2024, 1, 1, h))


def test_drain_twice_then_reset_replays(spark):
    stage = work_path(spark, "t-stage")
    target = work_path(spark, "t-target")
    ckpt = streams.new_checkpoint(spark, "t")
    schema = spark.createDataFrame([], SCHEMA).schema
    _load(spark, stage, [_ev(1, "a", 1), _ev(2, "b", 2)])
    w = streams.append_writer(target, ckpt)
    stream = streams.event_stream(spark, stage, schema, with_file=True)
    filed = T.StructType([*schema.fields, T.StructField(streams.FILE_COL, T.StringType())])
    applied = lambda: streams.read_appended(spark, target, filed)
    assert streams.has_data(spark, stage, schema, applied())
    streams.drain_once(stream, w, ckpt)
    assert streams.read_appended(spark, target, schema).count() == 2
    streams.drain_once(stream, w, ckpt)
    assert streams.read_appended(spark, target, schema).count() == 2      # nothing new
    _load(spark, stage, [_ev(3, "a", 3)])
    assert streams.has_data(spark, stage, schema, applied())
    assert rows(streams.backlog(spark, stage, schema, applied()), "event_id") == [(3,)]
    streams.drain_once(stream, w, ckpt)
    assert not streams.has_data(spark, stage, schema, applied())
    assert streams.backlog(spark, stage, schema, applied()).count() == 0
    # reset: new checkpoint and new target replay everything once
    t2 = work_path(spark, "t-target")
    c2 = streams.new_checkpoint(spark, "t")
    streams.drain_once(streams.event_stream(spark, stage, schema), streams.append_writer(t2, c2), c2)
    assert rows(streams.read_appended(spark, t2, schema), "event_id") == [(1,), (2,), (3,)]


def test_drain_discard_moves_offset(spark):
    stage = work_path(spark, "t-stage")
    schema = spark.createDataFrame([], SCHEMA).schema
    _load(spark, stage, [_ev(1, "a", 1)])
    ckpt = streams.new_checkpoint(spark, "d")
    streams.drain_once(streams.event_stream(spark, stage, schema), streams.discard, ckpt)
    target = work_path(spark, "t-target")
    streams.drain_once(streams.event_stream(spark, stage, schema), streams.append_writer(target, ckpt), ckpt)
    assert streams.read_appended(spark, target, schema).count() == 0


def test_null_keys_are_no_lasting_backlog(spark):
    stage, target = work_path(spark, "t-stage"), work_path(spark, "t-target")
    schema = spark.createDataFrame([], SCHEMA).schema
    _load(spark, stage, [(None, "a", None)])
    ckpt = streams.new_checkpoint(spark, "n")
    streams.drain_once(streams.event_stream(spark, stage, schema, with_file=True), streams.append_writer(target, ckpt), ckpt)
    filed = T.StructType([*schema.fields, T.StructField(streams.FILE_COL, T.StringType())])
    assert not streams.has_data(spark, stage, schema, streams.read_appended(spark, target, filed))


def test_two_checkpoints_on_one_target_keep_both(spark):
    stage, other, target = (work_path(spark, n) for n in ("t-a", "t-b", "t-target"))
    schema = spark.createDataFrame([], SCHEMA).schema
    _load(spark, stage, [_ev(1, "a", 1)])
    _load(spark, other, [_ev(2, "b", 2)])
    for path in (stage, other):
        ckpt = streams.new_checkpoint(spark, "two")
        streams.drain_once(streams.event_stream(spark, path, schema), streams.append_writer(target, ckpt), ckpt)
    assert rows(streams.read_appended(spark, target, schema), "event_id") == [(1,), (2,)]


def test_typed_table_from_documents_late_and_repeated(spark):
    stage, target = work_path(spark, "t-docs"), work_path(spark, "t-typed")
    docs = T.StructType([T.StructField("data", T.StringType())])
    table = spark.createDataFrame([], "k long, t timestamp_ntz, op string, v string, is_deleted boolean").schema
    fields = {"k": ("$.k", "bigint"), "t": ("$.t", "timestamp_ntz"), "op": ("$.op", "string"), "v": ("$.v", "string")}
    ckpt = streams.new_checkpoint(spark, "typed")
    handler = streams.typed_table_writer(spark, target, table, "data", fields, ["k"], "op", "t")
    doc = lambda k, h, op, v: (f'{{"k": {k}, "t": "2024-01-01 {h:02d}:00:00", "op": "{op}", "v": "{v}"}}',)
    loads = [[doc(1, 5, "UPSERT", "new"), doc(2, 5, "DELETE", ""), doc(3, 1, "UPSERT", "c"), ("not json",)],
             [doc(1, 2, "UPSERT", "old"), doc(2, 1, "UPSERT", "back")], [doc(1, 5, "UPSERT", "new")]]
    for load in loads:
        spark.createDataFrame(load, docs).coalesce(1).write.mode("append").parquet(stage)
        streams.drain_once(streams.event_stream(spark, stage, docs), handler, ckpt)
    got = streams.read_typed_table(spark, target, table, len(loads)).filter("k is not null")
    assert rows(got, "k", "v") == [(1, "new"), (3, "c")]
    assert streams.read_typed_table(spark, target, table, 0).count() == 0


def test_scheduled_task_runs_and_stops(spark):
    stage = work_path(spark, "t-stage")
    target = work_path(spark, "t-target")
    schema = spark.createDataFrame([], SCHEMA).schema
    _load(spark, stage, [_ev(1, "a", 1)])
    ckpt = streams.new_checkpoint(spark, "task")
    q = streams.start_task(streams.event_stream(spark, stage, schema), streams.append_writer(target, ckpt), ckpt,
                           every="1 second")
    try:
        q.processAllAvailable()
        _load(spark, stage, [_ev(2, "a", 2)])
        q.processAllAvailable()
    finally:
        q.stop()
    assert rows(streams.read_appended(spark, target, schema), "event_id") == [(1,), (2,)]


def test_wait_idle_follows_a_throttled_stream_to_its_last_file(spark):
    stage, target = work_path(spark, "t-stage"), work_path(spark, "t-target")
    schema = spark.createDataFrame([], SCHEMA).schema
    for i in range(4):
        spark.createDataFrame([_ev(i, "a", i)], SCHEMA).coalesce(1).write.mode("append").parquet(stage)
    ckpt = streams.new_checkpoint(spark, "idle")
    q = streams.start_task(streams.event_stream(spark, stage, schema, max_files_per_trigger=1),
                           streams.append_writer(target, ckpt), ckpt, every="100 milliseconds")
    try:
        streams.wait_idle(q)
    finally:
        q.stop()
    assert rows(streams.read_appended(spark, target, schema), "event_id") == [(0,), (1,), (2,), (3,)]


def test_resync_board(spark):
    stage = work_path(spark, "t-stage")
    target = work_path(spark, "t-target")
    schema = spark.createDataFrame([], SCHEMA).schema
    _load(spark, stage, [_ev(i, "a", i % 24) for i in range(7)])
    ckpt = streams.new_checkpoint(spark, "r")
    streams.drain_once(streams.event_stream(spark, stage, schema), streams.append_writer(target, ckpt), ckpt)
    board, new_target = streams.resync(spark, stage, schema, target, "event_id", name="ev")
    assert rows(board) == [("ev", 7, 7, 0, 0, 0)]
    assert streams.read_appended(spark, new_target, schema).filter(F.col("event_id") >= 0).count() == 7


def test_resync_names_wrong_content_of_equal_size(spark):
    stage, target = work_path(spark, "t-stage"), work_path(spark, "t-target")
    schema = spark.createDataFrame([], SCHEMA).schema
    _load(spark, stage, [_ev(i, "a", i) for i in range(5)])
    _load(spark, target + "/run=x/batch_id=0", [_ev(i + 1, "a", i) for i in range(5)])   # one key off
    board, _ = streams.resync(spark, stage, schema, target, "event_id", name="ev")
    assert rows(board) == [("ev", 5, 5, 0, 1, 1)]

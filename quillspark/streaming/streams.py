"""Structured Streaming versions of the source's streams and tasks.

* a change stream over the staging table is a file-source ``readStream``;
  a new checkpoint starts with every file already there (O-R1, O-R7);
* a task run on demand is ``trigger(availableNow=True)`` + ``foreachBatch``
  (O-R2); a scheduled task is a ``processingTime`` trigger, and micro-batches
  without new files are skipped (O-R3);
* draining moves the offset and writes nothing (O-R6);
* backlog and has-data compare the staged files with those applied, by a manifest
  that each batch writes or by the file name that each applied row carries (O-R4, O-R5);
* resync replays a table from scratch and compares counts and keys (O-R9);
* a typed table is kept current from staged JSON documents by ``foreachBatch``,
  bucket by bucket, and documents that can't be applied have an output of their own.

Exactly-once into plain parquet: every micro-batch writes its own folder
``run=<checkpoint>/batch_id=<id>`` with overwrite, so a retried batch replaces
its own output and a new checkpoint never touches another one's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quillspark.functions.scalar import json_fields
from quillspark.operators.bucketed import BUCKETS, merge_buckets, read_buckets
from quillspark.operators.merge import apply_cdc
from quillspark.operators.reconcile import content_diff, except_keys, reconcile_counts, row_counts
from quillspark.session import delete_path, path_exists, work_path

BatchFn = Callable[[DataFrame, int], None]

#: Column that names the staged file of an applied row.
FILE_COL = "__file"


def event_stream(spark: SparkSession, path: str, schema: T.StructType,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None,
                 path_glob: str | None = None, with_file: bool = False) -> DataFrame:
    """Append-only change stream over staged files in ``path``.

    ``with_file`` adds ``__file``, the staged file of each row, which ``backlog``
    compares with the staging folder.
    """
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if path_glob:
        r = r.option("pathGlobFilter", path_glob)
    out = r.load(path)
    return out.select("*", F.col("_metadata.file_path").alias(FILE_COL)) if with_file else out


def new_checkpoint(spark: SparkSession, name: str = "stream") -> str:
    """A fresh checkpoint folder under the shared checkpoint root.

    Resetting a stream (drop and re-create) is starting from a new
    checkpoint: it replays every staged file.
    """
    return work_path(spark, "checkpoints", name)


def drain_once(stream: DataFrame, fn: BatchFn, checkpoint: str, name: str | None = None) -> None:
    """Process everything pending once, then stop (``availableNow``).

    A second call on the same checkpoint delivers only files staged since.
    """
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    q = w.start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def start_task(stream: DataFrame, fn: BatchFn, checkpoint: str, every: str = "1 minute",
               name: str | None = None) -> StreamingQuery:
    """Scheduled task: a micro-batch every ``every`` when files arrived.

    Returns the running query; ``stop()`` it to suspend the task.
    """
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(processingTime=every)
    if name:
        w = w.queryName(name)
    return w.start()


def wait_idle(query: StreamingQuery) -> None:
    """Block until a running task has processed every file staged so far.

    Waits for a trigger that finds nothing new (``processAllAvailable``), so a
    stream held to a few files per trigger is followed to its last file; this can
    take one trigger interval longer than the work itself.
    """
    query.processAllAvailable()


def discard(batch: DataFrame, batch_id: int) -> None:
    """Batch handler that writes nowhere: a drain only moves the offset."""
    return None


def _run_id(checkpoint: str) -> str:
    """Names a checkpoint in the folders that its batches write."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]


def append_writer(target: str, checkpoint: str, manifest: str | None = None) -> BatchFn:
    """Batch handler appending each micro-batch as its own folder of ``target``.

    The folder is ``run=<id>/batch_id=<n>``; the id belongs to ``checkpoint``, in
    which batches count from 0.  Overwrite of the batch's own folder makes a
    retried batch idempotent, and a second checkpoint on the same target adds
    its rows beside the first one's.

    ``manifest`` names a folder for the batch's input files, written in the same
    way after the rows (the stream must be read ``with_file``).  The staged files
    that it lacks are the backlog: no applied row has to be read to know them.
    """
    run = _run_id(checkpoint)

    def _write(batch: DataFrame, batch_id: int) -> None:
        at = f"run={run}/batch_id={batch_id}"
        if manifest is None:
            batch.write.mode("overwrite").parquet(f"{target}/{at}")
            return
        batch.drop(FILE_COL).write.mode("overwrite").parquet(f"{target}/{at}")
        batch.select(FILE_COL).distinct().write.mode("overwrite").parquet(f"{manifest}/{at}")
    return _write


def staged_files(spark: SparkSession, path: str, path_glob: str = "*.parquet") -> DataFrame:
    """``(__file)``: the files of a staging folder, from its listing alone.

    The binary-file source lists files as rows; its ``content`` is not read.
    """
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", path_glob).load(path)
    return listing.select(F.col("_metadata.file_path").alias(FILE_COL))


def applied_files(spark: SparkSession, manifest: str) -> DataFrame:
    """``(__file)``: the files that batches have applied, as their manifests say."""
    if not path_exists(spark, manifest):
        return spark.createDataFrame([], f"{FILE_COL} string")
    return spark.read.schema(f"{FILE_COL} string").parquet(manifest).select(FILE_COL)


def waiting_files(spark: SparkSession, path: str, manifest: str, path_glob: str = "*.parquet") -> DataFrame:
    """``(__file)``: staged files that no batch has applied (listing minus manifest).

    A file without rows never shows in a batch, so it would wait forever; probe
    rows with ``waiting_rows`` where such files are staged.
    """
    return staged_files(spark, path, path_glob).join(applied_files(spark, manifest), FILE_COL, "left_anti")


def waiting_rows(spark: SparkSession, path: str, schema: T.StructType, manifest: str) -> DataFrame:
    """Staged rows of the files that no batch has applied.  Neither the target nor a
    file name passes the driver: rows meet the manifest by an anti join on their file."""
    staged = spark.read.schema(schema).parquet(path)
    filed = staged.select("*", F.col("_metadata.file_path").alias(FILE_COL))
    return filed.join(applied_files(spark, manifest), FILE_COL, "left_anti").select(*schema.fieldNames())


def read_appended(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """The table written by ``append_writer`` (empty before the first batch)."""
    if not path_exists(spark, target):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(target)
    return df.select(*schema.fieldNames())


def pending_files(staged: DataFrame, applied: DataFrame) -> DataFrame:
    """``(__file)``: staged files of which no row was applied.

    Both sides are reduced to file names first (no data column of ``staged`` is
    read); rows without a key count like any other.
    """
    names = staged.select(F.col("_metadata.file_path").alias(FILE_COL)).distinct()
    return names.join(applied.select(FILE_COL).distinct(), FILE_COL, "left_anti")


def backlog(spark: SparkSession, staged_path: str, schema: T.StructType, applied: DataFrame) -> DataFrame:
    """Staged rows not applied yet, without consuming them.

    ``applied`` is the target of a stream read ``with_file``.  Rows are selected by a
    join on their file, so no file name is collected and any folder name will do.
    ``waiting_rows`` answers the same from a manifest, without reading the target.
    """
    staged = spark.read.schema(schema).parquet(staged_path)
    filed = staged.select("*", F.col("_metadata.file_path").alias(FILE_COL))
    return filed.join(pending_files(staged, applied), FILE_COL, "left_semi").select(*schema.fieldNames())


def has_data(spark: SparkSession, staged_path: str, schema: T.StructType, applied: DataFrame) -> bool:
    """Stream-has-data probe: any staged file not applied yet."""
    return not pending_files(spark.read.schema(schema).parquet(staged_path), applied).isEmpty()


# Why a document was not applied.
UNREADABLE, NO_KEY, NO_TIME = "unreadable", "no key", "no time"


def rejection(doc_col: str, readable: str, keys: Sequence[str], ts_col: str) -> Column:
    """Why a parsed document can't be applied, NULL if it can."""
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    return (F.when(F.col(doc_col).isNull() | ~F.col(readable), UNREADABLE).when(no_key, NO_KEY)
            .when(F.col(ts_col).isNull(), NO_TIME))


def typed_table_writer(spark: SparkSession, target: str, schema: T.StructType, doc_col: str,
                       fields: Mapping[str, tuple[str, str]], keys: Sequence[str], op_col: str, ts_col: str,
                       tie: str | None = None, deleted_col: str = "is_deleted", delete_value: str = "DELETE",
                       buckets: int = BUCKETS) -> BatchFn:
    """Batch handler keeping a typed table current from staged JSON documents.

    Each batch takes ``fields`` from the document by JSON path, keeps the latest
    event per key and merges it (``apply_cdc``): an event that is not newer than
    the row changes nothing, a delete marks the row in ``deleted_col``.  ``schema``
    is the table's, with ``deleted_col``.

    The table under ``<target>/table`` is laid out in ``buckets`` key-hash buckets,
    and a batch rewrites only those that its events touch (``merge_buckets``).
    Documents that are not JSON, have no key or no time are not merged: they go,
    with the reason, to ``<target>/rejected`` (``read_rejected``), so a replayed
    stream adds no row to the table for them.  A retried batch writes the same
    again; the batch's own folder is removed once the next batch begins.
    """
    table, keys = f"{target}/table", list(keys)

    def _apply(batch: DataFrame, batch_id: int) -> None:
        work = f"{target}/work/batch_id={batch_id}"
        if batch_id:
            delete_path(spark, f"{target}/work/batch_id={batch_id - 1}")
        # Parsed once: the read copy feeds both outputs.
        if not path_exists(spark, f"{work}/parsed/_SUCCESS"):
            parsed = json_fields(batch.select(doc_col), doc_col, {**fields, "__any": ("$", "variant")})
            (parsed.withColumn("__any", F.col("__any").isNotNull())
             .withColumn("__reason", rejection(doc_col, "__any", keys, ts_col))
             .drop("__any").write.mode("overwrite").parquet(f"{work}/parsed"))
        parsed = spark.read.parquet(f"{work}/parsed")
        (parsed.filter(F.col("__reason").isNotNull()).select(F.col(doc_col).alias("document"), F.col("__reason").alias("reason"))
         .write.mode("overwrite").parquet(f"{target}/rejected/batch_id={batch_id}"))
        events = parsed.filter(F.col("__reason").isNull()).select(*fields)
        cols = [f.name for f in schema.fields if f.name not in keys and f.name != deleted_col]
        merge_buckets(spark, table, schema, events, keys,
                      lambda rows, changes: apply_cdc(rows, changes, keys, op_col, ts_col, tie, delete_value, cols, deleted_col),
                      work, buckets)
    return _apply


def read_typed_table(spark: SparkSession, target: str, schema: T.StructType, batches: int,
                     deleted_col: str = "is_deleted") -> DataFrame:
    """The typed table after its last batch, without its deleted rows (empty if ``batches`` is 0)."""
    if not batches:
        return spark.createDataFrame([], schema).drop(deleted_col)
    df = read_buckets(spark, f"{target}/table", schema)
    return df.filter(~F.coalesce(F.col(deleted_col), F.lit(False))).drop(deleted_col)


def read_rejected(spark: SparkSession, target: str) -> DataFrame:
    """``(document, reason, batch_id)``: documents that the typed table's batches did not apply."""
    schema = "document string, reason string, batch_id int"
    if not path_exists(spark, f"{target}/rejected"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{target}/rejected")


def resync(spark: SparkSession, staged_path: str, schema: T.StructType, target: str, key: str,
           name: str = "table", path_glob: str | None = None, content: bool = False) -> tuple[DataFrame, str]:
    """Back up, truncate, reset, replay and compare counts and keys.

    The current target is copied to a backup folder, a new (empty) target
    generation and a new checkpoint are taken, the stream is replayed from
    the first staged file, and one row compares backup and rebuilt table:
    ``object_name, left_count, right_count, diff, left_only, right_only``, the
    last two counting distinct keys that the other side lacks.  ``content`` adds
    ``changed``: the keys that both sides have with other rows, by checksums of key
    buckets (``reconcile.content_diff``).  Returns the row and the new target path.
    """
    backup = work_path(spark, "backup", name)
    read_appended(spark, target, schema).write.mode("overwrite").parquet(backup)
    new_target = work_path(spark, "tables", name)
    ckpt = new_checkpoint(spark, name)
    drain_once(event_stream(spark, staged_path, schema, path_glob=path_glob), append_writer(new_target, ckpt), ckpt)
    old, new = spark.read.schema(schema).parquet(backup), read_appended(spark, new_target, schema)
    board = reconcile_counts(row_counts({name: old}), row_counts({name: new}))
    keys = except_keys(old, new, key).agg(F.count(F.when(F.col("side") == "left only", 1)).alias("l"),
                                          F.count(F.when(F.col("side") == "right only", 1)).alias("r"))
    board = board.withColumn("left_only", keys.select("l").scalar()).withColumn("right_only", keys.select("r").scalar())
    if content:
        changed = content_diff(old, new, key).agg(F.count(F.when(F.col("side") == "changed", 1)).alias("c"))
        board = board.withColumn("changed", changed.scalar())
    return board, new_target

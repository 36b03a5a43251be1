"""Change register of watched tables by stateful streaming.

A watch is one streaming query over the file streams of several sources.  Their rows
are reduced to (source, change time) and kept as running aggregates in Spark's
keyed streaming state: the last change time and the rows seen, per source.  In
update mode a micro-batch hands only the sources that changed to ``foreachBatch``,
which upserts them into the register.  A late file can raise the count, never lower
the time.

Watches are independent: each has its own checkpoint, state and register folder, so a
source can be added without replaying the others.  An unregistered source ends by
name: later batches leave it out, and readers do not see its row.  A watch whose
sources are all unregistered is not run any more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.operators.health import latest_per_key
from quillspark.session import path_exists, work_path
from quillspark.streaming import streams

#: A register row: when the source last changed (by its own time column) and how many rows were seen.
REGISTER = "source_name string, changed_at timestamp_ntz, n_rows bigint"


@dataclass(frozen=True)
class Source:
    """A staging folder of parquet files, and the column that says when a row changed."""
    name: str
    path: str
    schema: T.StructType
    time_col: str


def change_stream(spark: SparkSession, sources: Sequence[Source], max_files_per_trigger: int | None = None) -> DataFrame:
    """``(source_name, changed_at)`` of every row staged in any of the sources; only time columns are read."""
    out = None
    for s in sources:
        rows = streams.event_stream(spark, s.path, T.StructType([s.schema[s.time_col]]), max_files_per_trigger=max_files_per_trigger)
        one = rows.select(F.lit(s.name).alias("source_name"), F.col(s.time_col).cast("timestamp_ntz").alias("changed_at"))
        out = one if out is None else out.unionByName(one)
    return out


def last_changes(changes: DataFrame) -> DataFrame:
    """Running last change time and row count per source (streaming state; rows without a time only count)."""
    return changes.groupBy("source_name").agg(F.max("changed_at").alias("changed_at"), F.count(F.lit(1)).alias("n_rows"))


class Register:
    """The register under ``root``: a folder of watches, their states and who is watched."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, root or work_path(spark, "register")

    # --- who is watched: an append-only list of decisions, a few rows per source

    def _decide(self, rows: Sequence[tuple[str, str, bool]]) -> None:
        decided = f"{self.root}/decisions"
        seq = self.spark.read.schema("seq long").parquet(decided).agg(F.max("seq")).first()[0] if path_exists(self.spark, decided) else -1
        data = [(seq + 1, *r) for r in rows]
        self.spark.createDataFrame(data, "seq long, source_name string, watch string, watched boolean").coalesce(1).write.mode(
            "append").parquet(decided)

    def watched(self) -> DataFrame:
        """``(source_name, watch)`` of the sources watched now; a source registered again belongs to its last watch."""
        decided = f"{self.root}/decisions"
        if not path_exists(self.spark, decided):
            return self.spark.createDataFrame([], "source_name string, watch string")
        rows = self.spark.read.schema("seq long, source_name string, watch string, watched boolean").parquet(decided)
        return latest_per_key(rows, "source_name", ["seq"]).filter("watched").select("source_name", "watch")

    def register(self, sources: Sequence[Source]) -> str:
        """Watch ``sources`` from their first staged file on; returns the watch's name.

        A name that is registered again starts anew in the new watch, and its row
        in the old one is not shown any more.
        """
        names = [s.name for s in sources]
        if not names or len(set(names)) < len(names):
            raise ValueError("a watch needs sources, each named once")
        said = "\n".join(f"{s.name}\t{s.path}\t{s.time_col}" for s in sources)
        n = len(self.spark.read.parquet(f"{self.root}/decisions").select("watch").distinct().collect()) if path_exists(
            self.spark, f"{self.root}/decisions") else 0
        watch = f"w{n}-{hashlib.sha256(said.encode()).hexdigest()[:8]}"
        self._decide([(name, watch, True) for name in names])
        return watch

    def unregister(self, name: str) -> None:
        """End the updates of a source and drop its row from the register."""
        here = self.watched().filter(F.col("source_name") == name).first()
        if here is None:
            raise KeyError(f"not registered: {name}")
        self._decide([(name, here["watch"], False)])

    # --- the streaming part

    def writer(self, watch: str) -> streams.BatchFn:
        """Upsert of a micro-batch's changed sources into the watch's register.

        Batch ``n`` reads the rows after batch ``n - 1`` and writes its own folder
        (one row per source), so a retried batch writes the same again.
        """
        def _upsert(batch: DataFrame, batch_id: int) -> None:
            live = self.watched().filter(F.col("watch") == watch).select("source_name")
            new = batch.join(live, "source_name", "left_semi")
            before = f"{self.root}/rows/watch={watch}/after={batch_id - 1}"
            old = self.spark.read.schema(REGISTER).parquet(before) if batch_id else self.spark.createDataFrame([], REGISTER)
            rows = (old.unionByName(new).groupBy("source_name")
                    .agg(F.max("changed_at").alias("changed_at"), F.max("n_rows").alias("n_rows")))
            rows.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/rows/watch={watch}/after={batch_id}")
        return _upsert

    def run(self, watch: str, sources: Sequence[Source], max_files_per_trigger: int | None = None) -> None:
        """Process everything staged for a watch since its last run, then stop.

        ``sources`` are those that the watch was registered with, unregistered ones
        included (a streaming query keeps its inputs).  Does nothing once none of
        them is watched.
        """
        if self.watched().filter(F.col("watch") == watch).isEmpty():
            return
        q = (last_changes(change_stream(self.spark, sources, max_files_per_trigger)).writeStream.outputMode("update")
             .foreachBatch(self.writer(watch)).option("checkpointLocation", f"{self.root}/checkpoints/{watch}")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()

    def read(self) -> DataFrame:
        """``source_name, changed_at, n_rows``: one row per watched source (no time and no rows before its first change)."""
        rows = f"{self.root}/rows"
        watched = self.watched()
        if not path_exists(self.spark, rows):
            return watched.select("source_name", F.lit(None).cast("timestamp_ntz").alias("changed_at"), F.lit(0).cast("long").alias("n_rows"))
        every = self.spark.read.schema(f"{REGISTER}, watch string, after int").parquet(rows)
        last = latest_per_key(every, ["watch", "source_name"], ["after"])
        out = watched.join(last, ["source_name", "watch"], "left")
        return out.select("source_name", "changed_at", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows"))

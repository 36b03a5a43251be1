"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.session import BROADCAST_MAX_BYTES, work_path
from quillspark.session import fits_broadcast as fits

#: Whitespace-separated words: runs of anything but these six characters.
SPACE_WORD = r"[^\x20\x09-\x0D]+"

#: Rows and bytes in one Arrow batch.  Texts may be long, so batches are kept small.
ARROW_ROWS, ARROW_BYTES = 256, 32 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: a batch of very long texts must fit a Python worker.

    These are settings of the session, and a lazy result needs them when it runs, so
    they stay set; they bound memory and change no result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with a copy that every executor can read again, and gives
    the planner the real size of the result.
    """
    path = work_path(df.sparkSession, "llm", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checked_broadcast(table: DataFrame, limit: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Mark a staged table for broadcast if it fits.

    Beyond the limit the table comes back as it is and Spark plans a shuffle
    join; the rows of the join are the same either way.
    """
    return F.broadcast(table) if fits(table, limit) else table


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  Pure ASCII texts take the fast path."""
    slow = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(slow)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores put before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, (T.MapType, T.VariantType))


def comparable(df: DataFrame) -> list[Column]:
    """The columns of ``df`` in a form that can be hashed and compared: maps and variants as JSON."""
    return [F.to_json(F.struct(F.col(f"`{f.name}`").alias("v"))) if _has_map(f.dataType) else F.col(f"`{f.name}`")
            for f in df.schema.fields]


def numbered(rows: DataFrame, order: list[str], name: str, stage: str) -> DataFrame:
    """``rows`` with their place in ``order``, from 0, without a task that holds them all.

    Rows are range-sorted and written; a row's place is its place in its range
    plus the sizes of the ranges before, of which there are as many as partitions.
    The order must tell rows apart, so that equal keys never fill one range.
    """
    laid = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                  .withColumn("_at", F.monotonically_increasing_id()), stage)
    part = F.shiftright("_at", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = laid.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))  # a row per partition
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return laid.withColumn("_part", part).join(F.broadcast(starts), "_part").select(*rows.columns, place.alias(name))

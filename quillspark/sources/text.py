"""Delimited-line scans and text exports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.scalar import guarded_int, like_any
from quillspark.session import work_path


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Staged delimited files as one text column ``data`` (splittable scan)."""
    return spark.read.text(path).withColumnRenamed("value", "data")


def parse_delimited(df: DataFrame, col: str, sep: str, names: Sequence[str],
                    int_cols: Iterable[str] = (), int_type: str = "bigint",
                    keep: Iterable[str] = ()) -> DataFrame:
    """Split a delimited text column into named columns (1-based positions).

    ``split_part`` is used per field, so a missing trailing field is ``''``
    (not NULL) exactly like the source system.  Columns in ``int_cols`` are
    guarded: digits only cast to ``int_type``, anything else is NULL.  Pure
    projection: it fuses into the scan's code-generated stage.
    """
    ints = set(int_cols)
    src = F.col(col)
    cols = [F.col(k) for k in keep]
    for i, name in enumerate(names, start=1):
        piece = F.split_part(src, F.lit(sep), F.lit(i))
        cols.append((guarded_int(piece, int_type) if name in ints else piece).alias(name))
    return df.select(*cols)


def export_as_text(df: DataFrame, order_col: str, keep: Iterable[str] = ()) -> DataFrame:
    """Every column cast to text, ordered by the record-version column.

    Columns named in ``keep`` keep their type (one source export leaves the
    version uncast, another casts it).  The ORDER BY is a range-partitioned
    distributed sort, not a single-task sort.  NULL versions sort last.
    """
    keep = set(keep)
    cols = [F.col(c) if c in keep else F.col(c).cast("string").alias(c) for c in df.columns]
    # A row hash after the version lets the range sort split a version value
    # shared by very many rows; the output is still ordered by version.
    # The sort is on the typed version (text would put "10" before "9").
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    out = df.select(*cols, F.col(order_col).alias("__ord"), tie.alias("__tie"))
    return out.orderBy(F.col("__ord").asc_nulls_last(), "__tie").drop("__ord", "__tie")


#: Ranges into which one pass of the selection cuts the versions that are left.
RANGES = 1024


def _axis(v: Column, kind: T.DataType) -> Column | None:
    """A version as a whole number of the same order, None for types without one."""
    if isinstance(kind, T.IntegralType):
        return v.cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(v.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(v).cast("long")
    return None


def version_cut(df: DataFrame, version_col: str, n: int):
    """Version of the ``n``-th row in version order (the greatest one if there are fewer rows; None for no row).

    Distributed selection by counts per version range: the span between the least and
    the greatest version is cut into ``RANGES`` equal ranges, each task counts its
    rows per range, and the running sum of these few numbers names the range that
    holds row ``n``; only that range is cut again, until it is one version.  No row
    is moved or sorted.  Versions without such a span (text, fractions) are counted
    and range-sorted instead, see ``sorted_cut``.
    """
    v = F.col(version_col)
    at = _axis(v, df.schema[version_col].dataType)
    if at is None:
        return sorted_cut(df, version_col, n)
    low, high, total, last = df.agg(F.min(at), F.max(at), F.count(v), F.max(v)).first()
    if not total or total <= n:
        return last
    while low < high:
        width = -(-(high - low + 1) // RANGES)
        # A span beyond 62 bits is measured in decimals.
        from_low = at - F.lit(low) if high - low < 1 << 62 else at.cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
        part = F.call_function("div", from_low, F.lit(width).cast(T.LongType() if high - low < 1 << 62 else T.DecimalType(20, 0)))
        counts = df.filter((at >= low) & (at <= high)).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).collect()
        for part, rows in sorted(tuple(r) for r in counts):  # RANGES at most
            if n <= rows:
                break
            n -= rows
        low, high = low + part * width, min(high, low + (part + 1) * width - 1)
    return df.filter(at == low).agg(F.min(v)).first()[0]


def sorted_cut(df: DataFrame, version_col: str, n: int):
    """``version_cut`` for versions of any type that sorts.

    Versions are counted (partial aggregation first), their counts range-sorted and
    written once; a running sum over the ranges, of which there are as many as
    partitions, names the one that holds row ``n``, and only that range is walked
    version by version.
    """
    spark = df.sparkSession
    counts = df.groupBy(F.col(version_col).alias("v")).agg(F.count(F.lit(1)).alias("n")).filter("v is not null")
    path = work_path(spark, "version-ranges")
    (counts.repartitionByRange("v").sortWithinPartitions("v").withColumn("range", F.spark_partition_id())
     .write.parquet(path))
    ranges = spark.read.parquet(path)
    upto = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = ranges.groupBy("range").agg(F.sum("n").alias("n"), F.max("v").alias("last"))
    sums = sums.withColumn("upto", F.sum("n").over(upto))  # a row per range
    hit = sums.filter(F.col("upto") >= n).orderBy("range").first()
    if hit is None:
        return sums.agg(F.max("last")).first()[0]
    upto = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranges.filter(F.col("range") == hit["range"]).withColumn("upto", F.sum("n").over(upto) + (hit["upto"] - hit["n"]))
    return inside.filter(F.col("upto") >= n).agg(F.min("v")).first()[0]


def export_since(df: DataFrame, version_col: str, last, n: int) -> DataFrame:
    """Next export batch: about ``n`` rows with the smallest versions above ``last``.

    Inferred rule (the source shows the version column, its ordering and the
    export-control table, not the batch query): versions strictly greater than
    the last exported one (``None``: all), ascending, up to the version of the
    ``n``-th row, *with every row of that version*.  The next mark is the
    batch's greatest version, so rows that share it must not be left behind.
    Rows without a version are never exported; ``count_unversioned`` tells how
    many there are.  The cut is found first (``version_cut``); the batch itself is
    a filter on the version range that reaches the scan.
    """
    v, kind = F.col(version_col), df.schema[version_col].dataType
    above = df.filter(v.isNotNull() if last is None else v > F.lit(last).cast(kind))
    cut = version_cut(above.select(version_col), version_col, n)
    return above.filter(v <= F.lit(cut).cast(kind)).orderBy(v.asc())


def count_unversioned(df: DataFrame, version_col: str) -> DataFrame:
    """``n_unversioned``: rows that no export batch will ever hold, as they have no version."""
    return df.agg(F.count(F.when(F.col(version_col).isNull(), 1)).alias("n_unversioned"))


def next_mark(batch: DataFrame, version_col: str) -> DataFrame:
    """The export-control mark after a batch: its greatest version (one row)."""
    return batch.agg(F.max(F.col(version_col)).alias("last_exported_version"))


def load_history(df: DataFrame, name_col: str, time_col: str, since=None,
                 patterns: Iterable[str] | None = None, n: int | None = None,
                 pipe_col: str | None = None, pipe: str | None = None,
                 rows_col: str | None = None) -> DataFrame:
    """Load-history scan: loads of one pipe strictly after ``since`` that
    carried rows, whose file name matches any LIKE pattern (``None``: no such
    filter; an empty list matches nothing), newest first, at most ``n``."""
    out = df
    if pipe_col is not None and pipe is not None:
        out = out.filter(F.col(pipe_col) == pipe)
    if since is not None:
        out = out.filter(F.col(time_col) > F.lit(since))
    if rows_col is not None:
        out = out.filter(F.col(rows_col) > 0)
    if patterns is not None:
        out = out.filter(like_any(F.col(name_col), patterns))
    out = out.orderBy(F.col(time_col).desc_nulls_first(), F.col(name_col).desc())
    return out if n is None else out.limit(n)

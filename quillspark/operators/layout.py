"""Table layout: re-clustering and ordered concatenation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.session import default_parallelism

BAD_DATE_BUCKET = "1970-01-01 00:00:00"


def cluster_bucket(ts_text: Column, unit: str = "day") -> Column:
    """Clustering bucket of an event time held as text: the day (or other
    ``date_trunc`` unit), or the 1970 bucket when the text is not a timestamp."""
    parsed = F.try_to_timestamp(ts_text).cast("timestamp_ntz")
    return F.coalesce(F.date_trunc(unit, parsed).cast("timestamp_ntz"),
                      F.lit(BAD_DATE_BUCKET).cast("timestamp_ntz"))


def recluster(df: DataFrame, ts_text: Column, type_col: Column, n_parts: int | None = None,
              unit: str = "day", bucket_name: str = "cluster_day") -> DataFrame:
    """Rewrite layout: range-partition by (time bucket, type), sort within.

    Written out, each file then covers a narrow (day, type) range, so
    min/max statistics prune scans.  A deterministic row hash ends the range key, so a hot
    bucket (say, the 1970 bucket of bad dates holding a third of all rows)
    is cut across several partitions instead of landing in one.  Rows are
    unchanged apart from the added bucket column.
    """
    n = n_parts or default_parallelism(df)
    cols = [F.col(c) for c in df.columns]
    out = (df.withColumn(bucket_name, cluster_bucket(ts_text, unit))
             .withColumn("__ctype", type_col.cast("string"))
             .withColumn("__tie", F.xxhash64(*cols)))
    return (out.repartitionByRange(n, F.col(bucket_name), F.col("__ctype"), F.col("__tie"))
               .sortWithinPartitions(bucket_name, "__ctype").drop("__ctype", "__tie"))


#: Rows of one (bucket, type) that are numbered together, about.
NUMBERED = 4096


def numbered_files(df: DataFrame, bucket: Column, type_col: Column, rows_per_file: int, bucket_name: str = "cluster_day") -> DataFrame:
    """``df`` with its bucket and ``__file``: the rows in (bucket, type) order, cut exactly every ``rows_per_file`` rows.

    No task sorts a whole (bucket, type), which may be a third of all rows: its rows
    are dealt by a row hash into parts of about ``NUMBERED``, numbered inside their
    part, and the parts' sizes are summed up (a row per part).
    """
    cols = [F.col(c) for c in df.columns]
    rows = df.select(*cols, bucket.alias(bucket_name), type_col.cast("string").alias("__type"), F.xxhash64(*cols).alias("__hash"))
    group, names = [F.col(bucket_name), F.col("__type")], [bucket_name, "__type", "__part"]

    def meet(a: DataFrame, b: DataFrame, on: list[str]) -> DataFrame:
        # A type may be NULL, so the keys are compared null-safe under names of their own.
        b = b.select(*[F.col(c).alias(f"__b_{c}") if c in on else F.col(c) for c in b.columns])
        cond = F.lit(True)
        for c in on:
            cond = cond & F.col(c).eqNullSafe(F.col(f"__b_{c}"))
        return a.join(b, cond).drop(*[f"__b_{c}" for c in on])
    sizes = rows.groupBy(*group).agg(F.ceil(F.count(F.lit(1)) / NUMBERED).cast("int").alias("__parts"))
    rows = meet(rows, sizes, names[:2]).withColumn("__part", F.pmod("__hash", F.col("__parts")).cast("int")).drop("__parts")
    before = Window.orderBy(*names).rowsBetween(Window.unboundedPreceding, -1)  # a row per part
    starts = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).select(
        *names, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    rows = rows.withColumn("__at", F.row_number().over(Window.partitionBy(*names).orderBy("__hash")) - 1)
    file = F.call_function("div", F.col("__start") + F.col("__at"), F.lit(rows_per_file))
    return meet(rows, starts, names).select(*cols, bucket_name, "__type", file.alias("__file"))


def write_clustered(df: DataFrame, path: str, ts_text: Column, type_col: Column, rows_per_file: int,
                    unit: str = "day", bucket_name: str = "cluster_day") -> DataFrame:
    """Write ``df`` clustered by (time bucket, type), ``rows_per_file`` rows in every file, and read it back.

    A bucket that holds a large share of the rows becomes many files.  Partitions hold
    whole files in order, so the writer's row bound cuts them where the numbering did.
    """
    rows = numbered_files(df, cluster_bucket(ts_text, unit), type_col, rows_per_file, bucket_name)
    out = rows.repartitionByRange(default_parallelism(df), "__file").sortWithinPartitions("__file", bucket_name, "__type")
    out = out.drop("__file", "__type")
    out.write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(out.schema).parquet(path)


def file_ranges(df: DataFrame, bucket: Column, type_col: Column) -> DataFrame:
    """``file, low_bucket, high_bucket, low_type, high_type, n_rows`` of every file of a parquet
    table: what the statistics of a file let a scan know about it."""
    return (df.select(F.col("_metadata.file_path").alias("file"), bucket.alias("__b"), type_col.cast("string").alias("__t"))
            .groupBy("file").agg(F.min("__b").alias("low_bucket"), F.max("__b").alias("high_bucket"),
                                 F.min("__t").alias("low_type"), F.max("__t").alias("high_type"), F.count(F.lit(1)).alias("n_rows")))


def files_met(df: DataFrame, bucket: Column, type_col: Column, step: str = "1 day") -> DataFrame:
    """``bucket, type, n_rows, n_files``: how many files a filter on one (bucket, type) can't skip.

    A file is met if both values lie within its ranges.  Files are spread over the
    buckets that they reach and meet the (bucket, type) pairs by an equi-join.
    """
    wanted = df.select(bucket.alias("bucket"), type_col.cast("string").alias("type")).groupBy("bucket", "type").agg(
        F.count(F.lit(1)).alias("n_rows"))
    buckets = wanted.select("bucket").distinct()
    ranges = file_ranges(df, bucket, type_col)
    step_sql = F.expr(f"INTERVAL {step}")
    # A file that also holds the bad-date bucket reaches from there on; only buckets that exist are kept.
    reach = ranges.select("low_type", "high_type", F.explode(F.sequence("low_bucket", "high_bucket", step_sql)).alias("bucket")).join(
        buckets, "bucket", "left_semi")
    met = wanted.join(reach, "bucket").filter(F.col("type").between(F.col("low_type"), F.col("high_type")))
    n = met.groupBy("bucket", "type").agg(F.count(F.lit(1)).alias("n_files"))
    return wanted.join(n, ["bucket", "type"]).select("bucket", "type", "n_rows", "n_files")


def ordered_concat(df: DataFrame, group, value: str, order: str, sep: str = ", ",
                   name: str = "values") -> DataFrame:
    """``LISTAGG(value, sep) WITHIN GROUP (ORDER BY order)`` per group.

    The concatenated text of a group is the feature itself, so the group is
    assembled in one buffer by design; use it for short lists.
    """
    group = [group] if isinstance(group, str) else list(group)
    sep_sql = sep.replace("'", "''")
    agg = F.expr(f"listagg(`{value}`, '{sep_sql}') WITHIN GROUP (ORDER BY `{order}`)")
    return df.groupBy(*group).agg(agg.alias(name))

"""Tables laid out in key-hash buckets, merged bucket by bucket.

A table is a folder partitioned by the hash bucket of its keys.  Changes are dealt
by the same hash, so a merge reads the buckets that they touch, and no other, and
replaces those alone by a dynamic partition overwrite.  The cost of a batch follows
the buckets that it touches, not the table.

A merge runs in two steps.  The merged buckets are first written to a folder of the
batch's own, then copied over the table's.  A batch that is run again after its
first step was complete repeats the second step only, from that folder: it writes
the same rows however far the first attempt came, and never reads a table that is
half replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.session import delete_path, path_exists

#: Partition column of a bucketed table.
BUCKET = "__bucket"

#: Buckets of a table unless told otherwise.
BUCKETS = 64


def bucket_of(schema: T.StructType, keys: Sequence[str], n: int) -> Column:
    """Bucket of a row: hash of the keys, cast to the table's types (a NULL key counts too)."""
    return F.pmod(F.xxhash64(*[F.col(k).cast(schema[k].dataType) for k in keys]), F.lit(n)).cast("int")


def _with_bucket(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])


def write_buckets(df: DataFrame, path: str, keys: Sequence[str], n: int = BUCKETS) -> None:
    """Write ``df`` as a bucketed table; large buckets are split into several files."""
    out = df.withColumn(BUCKET, bucket_of(df.schema, keys, n))
    out.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, buckets: Sequence[int] | None = None) -> DataFrame:
    """The table, or some of its buckets (partition pruning); empty before the first write."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(_with_bucket(schema)).parquet(path)
    if buckets is not None:
        df = df.filter(F.col(BUCKET).isin(list(buckets)))
    return df.select(*schema.fieldNames())


def merge_buckets(spark: SparkSession, path: str, schema: T.StructType, changes: DataFrame, keys: Sequence[str],
                  merge: Callable[[DataFrame, DataFrame], DataFrame], work: str, n: int = BUCKETS) -> list[int]:
    """Merge ``changes`` into the bucketed table at ``path``; returns the touched buckets.

    ``merge(target, changes)`` gets the target rows of the touched buckets and all
    changes and returns those buckets' new rows, like the functions of
    ``operators.merge``.  ``work`` is a folder of this batch alone; run again with
    the same folder and changes, the batch changes nothing any more.  ``n`` must be the
    table's number of buckets, and bounds what reaches the driver.  A bucket whose
    rows all go away loses its folder.  Without changes nothing is written.
    """
    touched = sorted(r[0] for r in changes.select(bucket_of(schema, keys, n).alias(BUCKET)).distinct().collect())
    if not touched:
        return []
    rows = f"{work}/rows"
    if not path_exists(spark, f"{rows}/_SUCCESS"):
        new = merge(read_buckets(spark, path, schema, touched), changes).select(*schema.fieldNames())
        write_buckets(new, rows, keys, n)
    done = spark.read.schema(_with_bucket(schema)).parquet(rows)
    (done.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(path))
    for b in touched:  # at most n
        if not path_exists(spark, f"{rows}/{BUCKET}={b}"):
            delete_path(spark, f"{path}/{BUCKET}={b}")
    return touched

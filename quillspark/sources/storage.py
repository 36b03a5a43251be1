"""Table writes expressed as DataFrame functions plus parquet folders.

Plain parquet refuses DELETE/UPDATE/MERGE, so each change is a function
``old table -> new table``; persisting it is a write to a new folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def snapshot(df: DataFrame, path: str, mode: str = "overwrite",
             spark: SparkSession | None = None) -> DataFrame:
    """CTAS / clone / backup: write ``df`` to ``path`` and return the copy.

    Reading back the written table also cuts the lineage, so a lost
    executor recomputes from the copy, not from the source.
    """
    df.write.mode(mode).parquet(path)
    spark = spark or df.sparkSession
    return spark.read.parquet(path)


def append_rows(df: DataFrame, rows: DataFrame) -> DataFrame:
    """INSERT: rows appended, columns matched by name (narrow union)."""
    return df.unionByName(rows)


def delete_where(df: DataFrame, pred: Column) -> DataFrame:
    """DELETE WHERE ``pred``: rows where the predicate is NULL stay."""
    return df.filter(~F.coalesce(pred, F.lit(False)))


def truncate(df: DataFrame) -> DataFrame:
    """TRUNCATE: same schema, no rows."""
    return df.limit(0)


def preview(df: DataFrame, n: int, order_by: list | None = None) -> DataFrame:
    """First ``n`` rows.  Without ``order_by`` which rows come back is not
    defined (as in the source); with it this is a top-n."""
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(n)

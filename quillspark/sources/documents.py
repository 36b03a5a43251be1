"""Staged JSON documents as a partitioned VARIANT table.

A document that is parsed in every query has to be read whole in every query.  Here it
is parsed once, when it is staged, and its type and day become partition columns:
a query for some types and days opens their folders only, whether the types are
literals (partition filters) or come from a table (dynamic partition pruning).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partition columns of a staged table.
TYPE, DAY = "doc_type", "doc_day"


def stage_documents(df: DataFrame, doc_col: str, type_path: str, time_path: str, path: str, mode: str = "append") -> None:
    """Write documents as VARIANT, partitioned by type and day (both read by JSON path).

    Other columns are kept.  Text that is not JSON becomes a NULL document; without a
    type or a readable time a document goes to the NULL folder of that column, so
    no row is lost.  Rows are dealt by (type, day) before the write, large folders
    being split, so a load adds few files to each folder.
    """
    doc = F.col(doc_col)
    if not isinstance(df.schema[doc_col].dataType, T.VariantType):
        doc = F.try_parse_json(doc)
    rows = df.select(*[F.col(c) for c in df.columns if c != doc_col], F.explode(F.array(doc)).alias(doc_col))
    rows = (rows.withColumn(TYPE, F.try_variant_get(F.col(doc_col), type_path, "string"))
            .withColumn(DAY, F.to_date(F.try_variant_get(F.col(doc_col), time_path, "timestamp_ntz"))))
    rows.hint("rebalance", TYPE, DAY).write.mode(mode).partitionBy(TYPE, DAY).parquet(path)


def staged_documents(spark: SparkSession, path: str, schema: T.StructType, types=None, since_day=None) -> DataFrame:
    """Staged documents of some types and days; ``schema`` is that of the stored columns.

    ``types`` is a list of names, or a table with one column of them: a semi join whose
    right side, if it is filtered and small enough for Spark to broadcast, prunes the
    folders before they are read.  ``since_day`` is the first day wanted.  ``doc_type`` and ``doc_day`` come with the rows.
    """
    full = T.StructType([*schema.fields, T.StructField(TYPE, T.StringType()), T.StructField(DAY, T.DateType())])
    out = spark.read.schema(full).parquet(path)
    if since_day is not None:
        out = out.filter(F.col(DAY) >= F.lit(since_day).cast("date"))
    if isinstance(types, DataFrame):
        wanted = types.select(F.col(types.columns[0]).alias("__type"))
        return out.join(wanted, F.col(TYPE) == F.col("__type"), "left_semi")
    return out if types is None else out.filter(F.col(TYPE).isin(list(types)))

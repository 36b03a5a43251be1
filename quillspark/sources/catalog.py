"""Table metadata as rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quillspark.functions.scalar import ansi_type_name

COLUMNS_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("data_type", T.StringType()),
    T.StructField("is_nullable", T.StringType()),
    T.StructField("ordinal_position", T.IntegerType()),
])


def describe_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column metadata (name, ANSI type, nullable, 1-based position) as rows,
    sorted by table and column name.

    Built from each DataFrame's resolved schema on the driver: no data is
    read, only the catalog/footers.  The result is at most
    (tables x columns) rows, a metadata-sized frame.
    """
    rows = []
    for tname, df in tables.items():
        for pos, f in enumerate(df.schema.fields, start=1):
            rows.append((tname, f.name, ansi_type_name(f.dataType),
                         "YES" if f.nullable else "NO", pos))
    rows.sort(key=lambda r: (r[0], r[1]))
    return spark.createDataFrame(rows, COLUMNS_SCHEMA)


def empty_table(spark: SparkSession, schema: T.StructType | str) -> DataFrame:
    """An empty table with an explicit schema (CREATE TABLE)."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    return spark.createDataFrame([], schema)

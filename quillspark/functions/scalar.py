"""Column expressions shared by the operators.

All of these build JVM-side expressions (no Python UDF), so they stay
inside whole-stage code generation.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def json_fields(df: DataFrame, col: str, fields: Mapping[str, tuple[str, str]],
                keep: bool = True) -> DataFrame:
    """Project JSON paths of a text or VARIANT column into typed columns.

    ``fields`` maps an output name to ``(json_path, spark_type)``, e.g.
    ``{"record_id": ("$.eventPayload.record_id", "bigint")}``.  The document
    is parsed once into a VARIANT (``try_parse_json``: malformed text gives
    NULL) and each path is read with ``try_variant_get``, so a missing key,
    a JSON null or a value of the wrong type gives NULL instead of failing
    the job.  Keys are case-sensitive.  19-digit ids survive as BIGINT.
    """
    src = F.col(col)
    v = "__doc_variant"
    if not isinstance(df.schema[col].dataType, T.VariantType):
        src = F.try_parse_json(src)
        # explode of a one-element array: the parse stays below it, so a later
        # filter on a field is not pushed down into a second parse.
        out = df.select("*", F.explode(F.array(src)).alias(v))
    else:
        out = df.withColumn(v, src)
    for name, (path, typ) in fields.items():
        out = out.withColumn(name, F.try_variant_get(F.col(v), path, typ))
    out = out.drop(v)
    return out if keep else out.drop(col)


def guarded_int(c: Column | str, typ: str = "bigint") -> Column:
    """Digits-only text to an integer, anything else to NULL (regex guard).

    A 10-digit id above 2**31 needs BIGINT, hence the default.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.rlike("^[0-9]+$"), c.try_cast(typ))


def like_any(c: Column, patterns: Iterable[str], case_insensitive: bool = False) -> Column:
    """``LIKE ANY`` / ``ILIKE ANY``: true if any pattern matches, false for no patterns."""
    cond = F.lit(False)
    for p in patterns:
        cond = cond | (c.ilike(p) if case_insensitive else c.like(p))
    return cond


def tagged_field(c: Column | str, tag: str, occurrence: int = 1, sep: str = "~") -> Column:
    """Value of the ``occurrence``-th field whose text starts with ``tag``.

    A raw message is a list of fields split by ``sep``; each field begins
    with its tag (for example ``"NMsmall ring"`` holds tag ``NM``).  The tag
    is stripped from the result; a missing occurrence gives NULL.  Built from
    ``split``/``filter``/``try_element_at``, no Python UDF.
    """
    c = F.col(c) if isinstance(c, str) else c
    pieces = F.split(c, re.escape(sep))
    hits = F.filter(pieces, lambda x: x.startswith(tag))
    hit = F.try_element_at(hits, F.lit(occurrence))
    return F.substring(hit, len(tag) + 1, 1 << 30)


def render_rows(df: DataFrame, template: Iterable, name: str = "command") -> DataFrame:
    """Text from rows: concatenates literals and columns in order.

    ``template`` items are column names wrapped as ``F.col`` (or Columns)
    and plain strings as literals.  Like the SQL ``||`` operator, a NULL
    operand makes the whole text NULL (``concat``, not ``concat_ws``).
    """
    parts = [p if isinstance(p, Column) else F.lit(p) for p in template]
    return df.select(F.concat(*parts).alias(name))


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Rename every column to ``<prefix><name>`` so joins never clash."""
    return df.select([F.col(c).alias(f"{prefix}{c}") for c in df.columns])


# Mapping from Spark types to the ANSI names that
# information_schema.columns reports for the same columns.
_ANSI_NAMES = {
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.ShortType: "SMALLINT",
    T.ByteType: "TINYINT",
    T.DoubleType: "DOUBLE",
    T.FloatType: "FLOAT",
    T.StringType: "VARCHAR",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
    T.TimestampType: "TIMESTAMP WITH TIME ZONE",
    T.BinaryType: "BLOB",
    T.VariantType: "VARIANT",
}


def ansi_type_name(dt: T.DataType) -> str:
    """ANSI/information_schema name of a Spark type."""
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.ArrayType):
        return f"{ansi_type_name(dt.elementType)}[]"
    for k, v in _ANSI_NAMES.items():
        if isinstance(dt, k):
            return v
    return dt.simpleString().upper()

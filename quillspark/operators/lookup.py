"""Event lookups, counts and data-quality probes.

SURVEY 2.1 (O-S1..O-S3), 2.2 (O-P9..O-P11, O-P15) and 2.5 (O-A2..O-A5).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.functions.scalar import like_any


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def staged_events(df: DataFrame, type_col, time_col: str, types: Iterable[str],
                  since=None, until=None) -> DataFrame:
    """Staged events of the given types ingested after ``since``.

    ``type_col`` may be a column name or an expression over the document
    (e.g. a JSON path).  Both filters reach the parquet scan when they are
    on stored columns; the type list becomes a hash set (InSet).
    """
    out = df.filter(_col(type_col).isin(list(types)))
    if since is not None:
        out = out.filter(F.col(time_col) > F.lit(since))
    if until is not None:
        out = out.filter(F.col(time_col) <= F.lit(until))
    return out


def rows_by_key(df: DataFrame, col: str, keys) -> DataFrame:
    """Rows whose ``col`` is in ``keys``.

    ``keys`` is a Python list (a literal IN list, an InSet filter) or a
    DataFrame with one column (a semi join: repeats in the list never
    repeat rows; Spark broadcasts the list if its own size statistics allow).
    """
    if isinstance(keys, DataFrame):
        k = keys.select(keys.columns[0]).withColumnRenamed(keys.columns[0], "__key")
        return df.join(k, F.col(col) == F.col("__key"), "left_semi")
    return df.filter(F.col(col).isin(list(dict.fromkeys(keys))))


def matches_any(df: DataFrame, col, patterns: Iterable[str], case_insensitive: bool = False) -> DataFrame:
    """Rows whose text matches any pattern (``LIKE ANY`` / ``ILIKE ANY``).

    ``%`` and ``_`` are wildcards, as in SQL (``A_B`` also matches
    ``AyB``).  Numbers are compared as their text.  No pattern matches no row.
    """
    return df.filter(like_any(_col(col).cast("string"), patterns, case_insensitive))


def events_by_id(df: DataFrame, id_col: str, keys, time_col: str, since=None,
                 n: int | None = None, tie: str | None = None) -> DataFrame:
    """Events by id ingested strictly after ``since``, newest first, at most ``n``."""
    out = rows_by_key(df, id_col, keys)
    if since is not None:
        out = out.filter(F.col(time_col) > F.lit(since))
    order = [F.col(time_col).desc_nulls_first()] + ([F.col(tie).desc()] if tie else [])
    out = out.orderBy(*order)
    return out.limit(n) if n is not None else out


def count_by_type(df: DataFrame, type_col, time_col: str | None = None, since=None,
                  types: Iterable[str] | None = None, name: str = "event_type") -> DataFrame:
    """Rows per type (optionally since a time and for a type list).

    The type is cast to STRING first (a VARIANT cannot be grouped).
    Partial+final hash aggregate: skew on one type is absorbed map-side.
    """
    t = _col(type_col).cast("string")
    out = df
    if since is not None:
        out = out.filter(F.col(time_col) > F.lit(since))
    if types is not None:
        out = out.filter(t.isin(list(types)))
    return out.groupBy(t.alias(name)).agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_types(df: DataFrame, type_col, patterns: Iterable[str], time_col: str | None = None,
                   since=None, name: str = "event_type") -> DataFrame:
    """Distinct types matching any LIKE pattern, sorted (none for no pattern)."""
    t = _col(type_col).cast("string")
    out = df.filter(like_any(t, patterns))
    if since is not None:
        out = out.filter(F.col(time_col) > F.lit(since))
    return out.select(t.alias(name)).distinct().orderBy(name)


def duplicate_keys(df: DataFrame, keys: Sequence[str], min_count: int = 2) -> DataFrame:
    """Keys that occur at least ``min_count`` times (GROUP BY .. HAVING)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
              .filter(F.col("cnt") >= min_count))


def unique_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs once: those that a repeat guard lets through
    (``duplicate_keys`` lists the others)."""
    once = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct(*df.columns)).alias("__r"))
    return once.filter(F.col("__n") == 1).select("__r.*")


def count_total_distinct(df: DataFrame, key: str) -> DataFrame:
    """Total rows and distinct keys side by side, in one aggregate.

    ``SELECT DISTINCT`` counts a NULL key once while ``COUNT(DISTINCT)``
    skips it; the distinct count here follows ``SELECT DISTINCT``:
    ``count(distinct key) + (1 if any key is NULL)``.
    """
    k = F.col(key)
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        (F.countDistinct(k) + F.max(k.isNull().cast("int"))).cast("bigint").alias("n_distinct"),
    )


def out_of_order(df: DataFrame, group: Sequence[str], pos: str, fields: Mapping[str, str],
                 expected: Mapping[str, str]) -> DataFrame:
    """Groups whose first element is not in the expected state.

    ``fields`` maps output names to columns of the element; the first element
    is the one with the smallest ``pos`` (``min_by``: a partial aggregate, no
    array is collected).  A group is reported when any field, upper-cased,
    differs from its expected value.  A NULL field gives NULL, hence is not
    reported, like ``transactions[0]`` missing in the source.
    """
    aggs = [F.min_by(F.col(c), F.col(pos)).alias(name) for name, c in fields.items()]
    first = df.groupBy(*group).agg(*aggs)
    cond = None
    for name, want in expected.items():
        c = F.upper(F.col(name)) != F.lit(want)
        cond = c if cond is None else (cond | c)
    return first.filter(cond)


def first_element_mismatch(df: DataFrame, doc_col: str, code_path: str, code: str,
                           array_path: str, expected: Mapping[str, str],
                           fields: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """Documents of one transaction code whose first array element is not in
    the expected state, read by JSON path (``$.transactions[0].state``).

    Fields compare upper-cased; an empty array or a missing field gives NULL,
    hence is not reported (three-valued logic, as in the source).  ``fields``
    (name: path, type) adds columns from the same parse.
    """
    v = "__doc"
    if isinstance(df.schema[doc_col].dataType, T.VariantType):
        out = df.withColumn(v, F.col(doc_col))
    else:  # parsed once: filters are not pushed below the explode
        out = df.select("*", F.explode(F.array(F.try_parse_json(F.col(doc_col)))).alias(v))
    out = out.filter(F.try_variant_get(F.col(v), code_path, "string") == F.lit(code))
    cond = None
    for field, want in expected.items():
        got = F.upper(F.try_variant_get(F.col(v), f"{array_path}[0].{field}", "string"))
        c = got != F.lit(want)
        cond = c if cond is None else (cond | c)
    extra = [F.try_variant_get(F.col(v), path, typ).alias(name) for name, (path, typ) in (fields or {}).items()]
    return out.filter(cond).select(*df.columns, *extra)


def status_mismatch(header: DataFrame, items: DataFrame, key: str, item_key: str,
                    a: str, b: str) -> DataFrame:
    """Headers with exactly one item whose status ``a`` differs from the item's ``b``.

    The item side is reduced to one row per key (count and the single
    status) before the join; NULL on either side is not a mismatch.
    """
    one = (items.groupBy(F.col(item_key).alias("__k"))
                .agg(F.count(F.lit(1)).alias("__n"), F.min(F.col(b)).alias(b))
                .filter(F.col("__n") == 1).drop("__n"))
    j = header.join(one, F.col(key) == F.col("__k"), "inner").drop("__k")
    return j.filter(F.col(a) != F.col(b))


def column_mismatch(df: DataFrame, a: str, b: str, count_col: str | None = None,
                    count: int = 1) -> DataFrame:
    """Rows whose column ``a`` differs from ``b`` (single-table form), where
    ``count_col`` (e.g. a transaction count) equals ``count``.  NULL on
    either side is not a mismatch."""
    cond = F.col(a) != F.col(b)
    if count_col is not None:
        cond = cond & (F.col(count_col) == F.lit(count))
    return df.filter(cond)


def count_blank(df: DataFrame, expr: Column, name: str = "n_blank") -> DataFrame:
    """Rows where ``expr`` is present but empty (``= ''``, not IS NULL)."""
    return df.agg(F.count(F.when(expr == F.lit(""), 1)).alias(name),
                  F.count(F.lit(1)).alias("n_rows"))


def bad_numerics(df: DataFrame, keys: Sequence[str], cols: Mapping[str, Column | str],
                 typ: str = "bigint") -> DataFrame:
    """Values that would break a numeric load: present but not castable.

    The probed columns are unpivoted with ``stack`` (one narrow projection)
    into ``(column_name, value)``, then ``value IS NOT NULL AND
    try_cast(value) IS NULL``.
    """
    pairs = []
    for name, c in cols.items():
        pairs += [F.lit(name), _col(c).cast("string")]
    stacked = df.select(*keys, F.stack(F.lit(len(cols)), *pairs).alias("column_name", "value"))
    return stacked.filter(F.col("value").isNotNull() & F.col("value").try_cast(typ).isNull())


def ids_from_text(df: DataFrame, col: str, sep: str = ",", name: str = "record_id") -> DataFrame:
    """Distinct ids of a delimited text column: split, exploded, trimmed.

    Empty pieces and NULL texts give no id.  Ids stay text; compare them with
    ``reconcile.missing_keys_report``, which reports those that do not convert.
    """
    pieces = df.select(F.explode(F.split(F.col(col), f"\\Q{sep}\\E")).alias("__p"))
    return pieces.select(F.trim(F.col("__p")).alias(name)).filter(F.col(name) != "").distinct()

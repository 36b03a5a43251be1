"""Pipeline-health reports: latest state, failures, fill rates, traffic.

SURVEY 2.5 (O-A6, O-A10), 2.6 (O-W1, O-W2), 2.7 (O-L2, O-L3), 2.11
(O-T4..O-T6) and the request triage join O-J3.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def latest_per_key(df: DataFrame, keys, order, earliest: bool = False) -> DataFrame:
    """One row per key: the row that sorts first on ``order`` descending.

    Equivalent to ``QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY
    order DESC NULLS FIRST) = 1`` (the source systems put NULL first on
    DESC).  ``order`` must end with a unique tie-break column, otherwise the
    pick among equal rows is arbitrary.  ``earliest=True`` flips it to
    ascending with NULLs last.

    Plan: a grouped ``max_by``/``min_by`` over a struct, not a window.  The
    aggregate runs a partial (map-side) step, so a key holding a third of
    all rows is reduced to one row per map task before the shuffle, instead
    of being sorted in a single task.
    """
    keys = _names(keys)
    order = _names(order)
    payload = [c for c in df.columns if c not in keys]
    # (is_null, value) per order column: the max puts NULL first (DESC NULLS
    # FIRST), the min puts it last (ASC NULLS LAST).
    rank = F.struct(*[x for c in order for x in (F.col(c).isNull(), F.col(c))])
    pick = F.min_by if earliest else F.max_by
    out = df.groupBy(*keys).agg(pick(F.struct(*[F.col(c) for c in payload]), rank).alias("__row"))
    return out.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in payload]).select(*df.columns)


def newest(df: DataFrame, ts: str, n: int, tie: str | None = None) -> DataFrame:
    """Top ``n`` newest rows (TakeOrderedAndProject: per-task top-n, then merge)."""
    cols = [F.col(ts).desc_nulls_first()]
    if tie:
        cols.append(F.col(tie).desc())
    return df.orderBy(*cols).limit(n)


def any_rows(df: DataFrame) -> bool:
    """Existence probe (``LIMIT 1``): stops after the first row is found."""
    return not df.isEmpty()


def currently_failed(df: DataFrame, key: str, ts: str, state: str,
                     failed: str = "FAILED", lo=None, hi=None,
                     tie: str | None = None) -> DataFrame:
    """Tasks whose latest run in ``[lo, hi]`` failed.

    Latest-per-name first, then the state filter: filtering first would
    report tasks that have since recovered.  Keyed by name only, as in the
    source (equal names in two schemas merge).
    """
    out = df
    if lo is not None and hi is not None:
        out = out.filter(F.col(ts).between(F.lit(lo), F.lit(hi)))
    order = [ts] + ([tie] if tie else [])
    last = latest_per_key(out, key, order)
    return last.filter(F.col(state) == F.lit(failed))


# Run states that count as a failure.
FAILURE_STATES = ("FAILED", "CANCELLED", "FAILED_AND_AUTO_SUSPENDED")


def failed_since(df: DataFrame, ts: str, state: str, at, minutes: int = 90,
                 states: Iterable[str] = FAILURE_STATES, n: int | None = None,
                 tie: str | None = None) -> DataFrame:
    """Failed runs completed within ``minutes`` before ``at`` truncated to the
    minute; with ``n``, the newest ``n`` of them, newest first.

    ``at`` stands in for the source's "now": runs after ``at`` are excluded
    so that a past alert time can be replayed.  The look-back is 90 minutes
    (the source displays 32 but filters on 90).
    """
    at_col = F.lit(at).cast("timestamp_ntz") if not isinstance(at, Column) else at
    start = F.date_trunc("minute", at_col).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))
    out = df.filter(F.col(state).isin(list(states))
                    & (F.col(ts) >= start) & (F.col(ts) <= at_col))
    if n is None:
        return out
    return newest(out, ts, n, tie)


def alert(df: DataFrame, ts: str, state: str, at, minutes: int = 90,
          states: Iterable[str] = FAILURE_STATES) -> bool:
    """Alert condition: any failure in the look-back window (LIMIT 1 probe)."""
    return any_rows(failed_since(df, ts, state, at, minutes, states, n=None))


def failure_history(df: DataFrame, ts: str, state: str, since, states: Iterable[str] = FAILURE_STATES) -> DataFrame:
    """Every failed run completed at or after ``since``, newest first."""
    hits = df.filter(F.col(state).isin(list(states)) & (F.col(ts) >= F.lit(since)))
    return hits.orderBy(F.col(ts).desc_nulls_first())


def failed_runs(df: DataFrame, name_col: str, msg_col: str, ts: str, state: str,
                name_pattern: str = "%", msg_pattern: str = "%", since=None,
                states: Iterable[str] = ("FAILED",), tie: str | None = None) -> DataFrame:
    """Runs in ``states`` (default FAILED) scheduled strictly after
    ``since`` whose name and message match ILIKE patterns, newest first."""
    out = df.filter(F.col(state).isin(list(states))
                    & F.col(name_col).cast("string").ilike(name_pattern)
                    & F.col(msg_col).ilike(msg_pattern))
    if since is not None:
        out = out.filter(F.col(ts) > F.lit(since))
    cols = [F.col(ts).desc_nulls_first()] + ([F.col(tie).desc()] if tie else [])
    return out.orderBy(*cols)


def fill_rate(df: DataFrame, date_col: str, cols: Mapping[str, str] | Sequence[str], as_of,
              days: int = 30, fmt: str = "yyyyMMdd", table_name: str | None = None) -> DataFrame:
    """Per service day, percent of rows where each column is populated.

    The day is parsed from text with ``try_to_date`` (bad text gives NULL and
    the row drops), kept if it lies in ``[as_of - days, as_of - 1]`` (both
    ends inclusive), newest day first; days without rows are absent.  ``cols``
    maps output names to columns (a list uses ``filled_<col>``).  One pass,
    partial aggregation per day.
    """
    if not isinstance(cols, Mapping):
        cols = {f"filled_{c}": c for c in cols}
    day = F.try_to_date(F.col(date_col), fmt)
    as_of_d = F.lit(as_of).cast("date")
    base = df.withColumn("on_day", day).filter(
        F.col("on_day").between(F.date_sub(as_of_d, days), F.date_sub(as_of_d, 1)))
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for out_name, c in cols.items():
        aggs.append(F.round(F.lit(100.0) * F.count(F.col(c)) / F.count(F.lit(1)), 2).alias(out_name))
    res = base.groupBy("on_day").agg(*aggs)
    if table_name is not None:
        res = res.select(F.lit(table_name).alias("source"), *res.columns)
    return res.orderBy(F.col("on_day").desc_nulls_first())


def volume_by_bucket(df: DataFrame, ts: str, category_col: str,
                     categories: Mapping[str, str], lo, hi, by_hour: bool = True,
                     total: str | None = "TOTAL", keep: Iterable[str] | None = None) -> DataFrame:
    """Request counts per category and hour (or day) in ``[lo, hi]``.

    ``categories`` maps a category name to the value of ``category_col`` it
    counts; ``total`` counts every row and so overlaps the others.  One scan:
    each row is exploded into the categories it belongs to (instead of one
    scan per category), then a partial+final hash aggregate.  Categories not
    in ``keep`` are never generated, which is the same as dropping them
    after the aggregate.
    """
    names = ([total] if total else []) + list(categories)
    keep = set(names if keep is None else keep)
    tags = []
    if total and total in keep:
        tags.append(F.lit(total))
    for name, value in categories.items():
        if name in keep:
            tags.append(F.when(F.col(category_col) == F.lit(value), F.lit(name)))
    t = F.col(ts)
    if by_hour:
        bucket = F.date_trunc("HOUR", t)
        if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
            bucket = bucket.cast("timestamp_ntz")
    else:
        bucket = t.cast("date")
    rows = (df.filter(t.between(F.lit(lo), F.lit(hi)))
              .select(F.explode(F.array(*tags)).alias("kind"), bucket.alias("period"))
              .filter(F.col("kind").isNotNull()))
    return (rows.groupBy("kind", "period")
                .agg(F.count(F.lit(1)).alias("n_requests"))
                .orderBy("period", "kind"))


def triage(requests: DataFrame, logs: DataFrame, queries: DataFrame,
           req_key: str, log_req_key: str, log_query_key: str, query_key: str) -> DataFrame:
    """Request triage: requests LEFT JOIN log LEFT JOIN query timing.

    The second join keys on the log's column, so a request without a log
    row also has no query row.  Requests survive without a match; repeated
    log rows multiply (dedupe the log first with ``latest_per_key``).
    Inputs should carry distinct column names (``prefix_columns``).
    """
    j = requests.join(logs, F.col(log_req_key) == F.col(req_key), "left")
    return j.join(queries, F.col(query_key) == F.col(log_query_key), "left")

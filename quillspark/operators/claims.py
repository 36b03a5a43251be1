"""Claim / reversal matching and the updates built on it.

SURVEY 2.3 (O-J2, O-J7), 2.4 (O-D5..O-D7) and O-A7.

Scale notes.  A claim matches every reversal with the same four keys that
was processed later.  Listing the pairs (``match_reversals``) is the dry-run
SELECT and its output is as large as the pair set; everything else here
avoids pairs:

* the update picks, per claim, the latest reversal (time, then id).  The
  latest reversal of a key group qualifies exactly when any does, so one
  aggregate row per key group is enough (a partial aggregate: a hot key is
  reduced map-side), joined back with one right row per key;
* the dry-run count works per key and day, then over a key's days: never a
  join, and no task holds more than one day of a hot key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def match_reversals(claims: DataFrame, reversals: DataFrame, keys: Sequence[str],
                    claim_time: str, rev_time: str, rev_prefix: str = "rev_") -> DataFrame:
    """All (claim, reversal) pairs: equal ``keys`` and claim time < reversal time.

    Equi join on the keys with the time order as a residual condition
    (shuffle or broadcast hash join, never a cartesian product); every
    matching pair is kept, as in the source's dry run (this is not an as-of
    join).  Reversal columns other than the keys get ``rev_prefix``.
    Apply per-side filters (status sets, date windows) before calling; they
    are pushed into each scan.
    """
    keys = list(keys)
    r = reversals.select(*[F.col(k).alias(f"__rk_{k}") for k in keys],
                         *[F.col(c).alias(f"{rev_prefix}{c}") for c in reversals.columns if c not in keys])
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"__rk_{k}")
        cond = c if cond is None else (cond & c)
    cond = cond & (F.col(claim_time) < F.col(f"{rev_prefix}{rev_time}"))
    return claims.join(r, cond, "inner").drop(*[f"__rk_{k}" for k in keys])


#: Time buckets over which one reversal is spread, about.
SPREAD = 16


def time_bucket(time: Column, step: dt.timedelta) -> Column:
    """Number of the ``step``-wide bucket of a time (session time zone UTC, which the library sets)."""
    return F.floor(F.unix_micros(time.cast("timestamp")) / F.lit(step // dt.timedelta(microseconds=1))).cast("long")


def match_in_window(claims: DataFrame, reversals: DataFrame, keys: Sequence[str], claim_time: str, rev_time: str,
                    at_most: dt.timedelta, more_than: dt.timedelta = dt.timedelta(0), step: dt.timedelta | None = None,
                    rev_prefix: str = "rev_") -> DataFrame:
    """All (claim, reversal) pairs of equal ``keys`` with ``more_than < reversal time - claim time <= at_most``.

    An interval join in time buckets: a claim lies in the one bucket of its time, a
    reversal is repeated for every bucket in which a claim of its window can lie,
    and both meet by keys *and* bucket, with the exact bounds as a residual.  So a
    pair is found once, and a hot key is spread over the buckets of its times
    instead of meeting itself whole in one task.  ``step`` is the bucket's width
    (by default a ``SPREAD``-th of the window, a day at least, so a reversal is
    repeated ``SPREAD`` times or so).  NULL keys and times match nothing.
    """
    if at_most <= more_than:
        raise ValueError("the window is empty")
    keys, step = list(keys), step or max(dt.timedelta(days=1), (at_most - more_than) / SPREAD)
    c = claims.withColumn("__bucket", time_bucket(F.col(claim_time), step))
    t = F.col(rev_time)
    first, last = time_bucket(t - F.lit(at_most), step), time_bucket(t - F.lit(more_than), step)
    r = reversals.filter(t.isNotNull()).select(
        *[F.col(k).alias(f"__rk_{k}") for k in keys], *[F.col(x).alias(f"{rev_prefix}{x}") for x in reversals.columns if x not in keys],
        F.explode(F.sequence(first, last)).alias("__rbucket"))
    cond = F.col("__bucket") == F.col("__rbucket")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"__rk_{k}"))
    rev = F.col(f"{rev_prefix}{rev_time}")
    cond = cond & (F.col(claim_time) + F.lit(more_than) < rev) & (rev <= F.col(claim_time) + F.lit(at_most))
    return c.join(r, cond, "inner").drop("__bucket", "__rbucket", *[f"__rk_{k}" for k in keys])


def count_matches(claims: DataFrame, reversals: DataFrame, keys: Sequence[str],
                  claim_time: str, rev_time: str) -> DataFrame:
    """Dry run of the update: number of pairs and of matched claims.

    Equal to ``count(*)`` and ``count(DISTINCT claim id)`` over
    ``match_reversals`` (one claim row per id) but computed without building a
    pair, in two exchanges and no Python:

    1. rows are dealt by (keys, day of their time) and counted per time there; a
       window over the times of one day counts, per claim, the strictly later
       reversals of the same day;
    2. one row per (keys, day) then meets the other days of its key, where a
       window adds up the reversals of all later days.

    A hot key is spread over its days.  Rows with a NULL key or time match
    nothing.
    """
    keys = list(keys)

    def side(df: DataFrame, time: str, nc: int, nr: int) -> DataFrame:
        # The keys are only compared, so they stay in the JVM with their types.
        df = df.select(*keys, F.col(time).alias("__t"), F.lit(nc).cast("bigint").alias("__c"),
                       F.lit(nr).cast("bigint").alias("__r"))
        return df.dropna(subset=["__t", *keys]).withColumn("__day", F.to_date("__t"))

    both = side(claims, claim_time, 1, 0).unionByName(side(reversals, rev_time, 0, 1))
    times = (both.repartition(*keys, "__day").groupBy(*keys, "__day", "__t")
             .agg(F.sum("__c").alias("__c"), F.sum("__r").alias("__r")))
    later = Window.partitionBy(*keys, "__day").orderBy(F.col("__t").desc()).rowsBetween(Window.unboundedPreceding, -1)
    times = times.withColumn("__l", F.coalesce(F.sum("__r").over(later), F.lit(0)))
    days = times.groupBy(*keys, "__day").agg(
        F.sum("__c").alias("__c"), F.sum("__r").alias("__r"), F.sum(F.col("__c") * F.col("__l")).alias("__pairs"),
        F.sum(F.when(F.col("__l") > 0, F.col("__c")).otherwise(0)).alias("__hit"))
    later = Window.partitionBy(*keys).orderBy(F.col("__day").desc()).rowsBetween(Window.unboundedPreceding, -1)
    days = days.withColumn("__l", F.coalesce(F.sum("__r").over(later), F.lit(0)))
    return days.agg(
        F.coalesce(F.sum(F.col("__pairs") + F.col("__c") * F.col("__l")), F.lit(0)).cast("bigint").alias("n_pairs"),
        F.coalesce(F.sum(F.when(F.col("__l") > 0, F.col("__c")).otherwise(F.col("__hit"))), F.lit(0)).cast("bigint").alias("n_claims"))


def latest_reversal_per_key(reversals: DataFrame, keys: Sequence[str], rev_time: str,
                            rev_id: str) -> DataFrame:
    """One row per key group: its latest reversal (time, then largest id)."""
    keys = list(keys)
    pick = F.max_by(F.struct(F.col(rev_time).alias("t"), F.col(rev_id).alias("id")),
                    F.struct(F.col(rev_time), F.col(rev_id)))
    return (reversals.filter(F.col(rev_time).isNotNull())
                     .groupBy(*keys).agg(pick.alias("__last"))
                     .select(*keys, F.col("__last.t").alias("__rev_time"), F.col("__last.id").alias("__rev_id")))


def apply_reversals(claims: DataFrame, reversals: DataFrame, keys: Sequence[str],
                    claim_time: str, rev_time: str, rev_id: str,
                    eligible=None, reversed_col: str = "reversed",
                    reversed_id_col: str = "reversed_record_id",
                    reversal_time_col: str = "reversal_time") -> DataFrame:
    """UPDATE claims SET reversed, reversed id, reversal time FROM matches.

    Every claim row is returned.  An ``eligible`` claim (Column predicate,
    default all) that is not reversed yet and has at least one later
    reversal of its key group is marked reversed with the latest such
    reversal (greatest time, then largest id: the source leaves the choice
    among several matches open).  Other rows keep their values; missing
    output columns start as not reversed/NULL.
    """
    keys = list(keys)
    last = latest_reversal_per_key(reversals, keys, rev_time, rev_id)
    base = claims
    if reversed_col not in base.columns:
        base = base.withColumn(reversed_col, F.lit(False))
    if reversed_id_col not in base.columns:
        base = base.withColumn(reversed_id_col, F.lit(None).cast(reversals.schema[rev_id].dataType))
    if reversal_time_col not in base.columns:
        base = base.withColumn(reversal_time_col, F.lit(None).cast(reversals.schema[rev_time].dataType))
    j = base.join(last, keys, "left")
    hit = F.col("__rev_time").isNotNull() & (F.col(claim_time) < F.col("__rev_time"))
    # Only claims not yet reversed are updated (``reversed = FALSE``: a NULL
    # flag is not FALSE, so such a row is left alone too).
    hit = hit & (F.col(reversed_col) == F.lit(False))
    if eligible is not None:
        hit = hit & F.coalesce(eligible, F.lit(False))
    hit = F.coalesce(hit, F.lit(False))
    out = []
    for c in base.columns:
        if c == reversed_col:
            out.append(F.when(hit, F.lit(True)).otherwise(F.col(c)).alias(c))
        elif c == reversed_id_col:
            out.append(F.when(hit, F.col("__rev_id")).otherwise(F.col(c)).alias(c))
        elif c == reversal_time_col:
            out.append(F.when(hit, F.col("__rev_time")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def aggregate_changes(reversals: DataFrame, keys: Sequence[str], rev_time: str,
                      rev_id: str) -> DataFrame:
    """Change set of the duplicate-status update: max time per keys + record id."""
    return (reversals.groupBy(*keys, rev_id)
                     .agg(F.max(F.col(rev_time)).alias("max_time_processed")))


def apply_duplicate_reversals(claims: DataFrame, reversals: DataFrame, keys: Sequence[str],
                              claim_time: str, rev_time: str, rev_id: str,
                              eligible=None, **cols) -> DataFrame:
    """UPDATE FROM an aggregated change set (max time per keys + record id).

    A claim takes the latest change (time, then record id) among those processed
    after it.  The latest of the per-record maxima is the latest of the raw rows,
    so they are reduced to one row per key group directly, in one aggregate.
    """
    return apply_reversals(claims, reversals, keys, claim_time, rev_time, rev_id, eligible=eligible, **cols)

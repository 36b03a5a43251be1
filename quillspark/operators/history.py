"""Validity intervals of a change log and point-in-time joins.

Both work per (key, day) first and then over a key's days, so a key that holds a
third of all changes is spread over its days instead of being sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def validity_intervals(changes: DataFrame, keys: Sequence[str], ts_col: str, tie: str | None = None,
                       op_col: str | None = None, delete_value: str = "DELETE",
                       names: tuple[str, str] = ("valid_from", "valid_to")) -> DataFrame:
    """The change log as states with the half-open interval ``[from, to)`` in which each held.

    Each change holds from its time until the key's next change (``to`` is NULL for
    the last one).  Of several changes of a key at one time the last by ``tie``
    counts.  With ``op_col``, a delete ends the state before it and is no state
    itself.  Changes without a time or key are left out.
    """
    keys, (a, b) = list(keys), names
    order = [ts_col] + ([tie] if tie else [])
    day = F.to_date(F.col(ts_col))
    rows = changes.dropna(subset=[ts_col, *keys])
    # One change per key and time: a partial maximum, no sort.
    payload = [c for c in changes.columns if c not in keys and c != ts_col]
    one = rows.groupBy(*keys, ts_col).agg(F.max_by(F.struct(*payload), _order(order)).alias("__p") if payload else F.lit(1).alias("__p"))
    one = one.withColumn("__day", day)
    inside = Window.partitionBy(*keys, "__day").orderBy(ts_col)
    one = one.withColumn("__next", F.lead(ts_col).over(inside))
    days = one.groupBy(*keys, "__day").agg(F.min(ts_col).alias("__first"))
    days = days.withColumn("__later", F.lead("__first").over(Window.partitionBy(*keys).orderBy("__day"))).drop("__first")
    out = one.join(days, [*keys, "__day"]).select(
        *keys, F.col(ts_col).alias(a), F.coalesce("__next", "__later").alias(b), *[F.col(f"__p.{c}").alias(c) for c in payload])
    return out.filter(F.coalesce(F.col(op_col) != F.lit(delete_value), F.lit(True))) if op_col else out


def state_at(probes: DataFrame, changes: DataFrame, keys: Sequence[str], probe_time: str, ts_col: str, tie: str | None = None,
             strict: bool = True, prefix: str = "state_") -> DataFrame:
    """Every probe with the state that its key had at the probe's time: a point-in-time join of many times at once.

    The state is the key's last change before the probe (``strict``; otherwise at
    its time too), the last by ``tie`` among changes of one time; its columns other
    than the keys get ``prefix`` and are NULL where there is none.  Every probe comes
    back once.

    Probes and changes of one (key, day) are sorted together; a probe without an
    earlier change that day takes the last change of the key's days before, from one
    row per (key, day).  Nothing is paired, so many probes between two changes cost
    no more than few.
    """
    keys = list(keys)
    order = [ts_col] + ([tie] if tie else [])
    held = [c for c in changes.columns if c not in keys]
    c = changes.dropna(subset=[ts_col, *keys])
    c = c.select(*keys, F.col(ts_col).alias("__t"), F.lit(1).alias("__kind"), (F.col(tie) if tie else F.lit(0)).alias("__tie"),
                 F.struct(*held).alias("__s"), F.lit(None).cast(probes.schema).alias("__p"))
    p = probes.select(*[F.col(k).cast(changes.schema[k].dataType).alias(k) for k in keys], F.col(probe_time).alias("__t"),
                      F.lit(0 if strict else 2).alias("__kind"), F.lit(None).cast(c.schema["__tie"].dataType).alias("__tie"),
                      F.lit(None).cast(c.schema["__s"].dataType).alias("__s"), F.struct(*probes.columns).alias("__p"))
    both = c.unionByName(p).withColumn("__day", F.to_date("__t"))
    upto = Window.partitionBy(*keys, "__day").orderBy("__t", "__kind", "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("__now", F.last("__s", ignorenulls=True).over(upto)).filter("__p is not null")
    # Days on which a key is probed or changes, with the state that the days before leave.
    days = both.groupBy(*keys, "__day").agg(
        F.max_by(F.col("__s"), F.when(F.col("__kind") == 1, F.struct("__t", "__tie"))).alias("__last")).withColumn(
        "__left", F.last("__last", ignorenulls=True).over(
            Window.partitionBy(*keys).orderBy("__day").rowsBetween(Window.unboundedPreceding, -1))).drop("__last")
    same = F.lit(True)
    for k in [*keys, "__day"]:
        same = same & found[k].eqNullSafe(days[k])
    out = found.join(days, same, "left").select(found["__p"], F.coalesce(found["__now"], days["__left"]).alias("__s"))
    return out.select("__p.*", *[F.col(f"__s.{x}").alias(f"{prefix}{x}") for x in held])


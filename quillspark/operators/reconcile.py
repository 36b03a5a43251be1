"""Cross-system reconciliation: missing keys, count boards, set differences.

SURVEY 2.3 (O-J5, O-J6), 2.5 (O-A1, O-A9) and 2.8 (O-U1..O-U6).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillspark.session import work_path


def not_in(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """``left WHERE left_key NOT IN (SELECT right_key FROM right)``, at scale.

    SQL semantics: if ``right`` holds a NULL key nothing is returned; if
    ``right`` is empty everything (NULL left keys too) is returned;
    otherwise NULL left keys drop and the rest is a plain LEFT ANTI join.
    Spark's own null-aware anti join needs a broadcast right side and falls
    back to a nested loop beyond it.  Here the two facts about ``right`` (has a
    NULL, is empty) are scalar subqueries over partial aggregates, evaluated when
    the query runs, beside a hash/sort-merge anti join that scales with both
    sides; building the query runs no job.
    """
    right_key = right_key or left_key
    keys = right.select(F.col(right_key).alias("__nk"))
    has_null = keys.agg(F.coalesce(F.max(F.col("__nk").isNull()), F.lit(False))).scalar()
    empty = keys.agg(F.count(F.lit(1)) == 0).scalar()
    lk = F.col(left_key)
    out = left.join(keys.filter(F.col("__nk").isNotNull()), lk == F.col("__nk"), "left_anti")
    return out.filter(empty | (~has_null & lk.isNotNull()))


def in_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None) -> DataFrame:
    """``left WHERE left_key IN (SELECT right_key FROM right)``: LEFT SEMI join."""
    right_key = right_key or left_key
    r = right.select(F.col(right_key).alias("__sk"))
    return left.join(r, F.col(left_key) == F.col("__sk"), "left_semi")


def missing_keys_report(source: DataFrame, events: DataFrame, table: DataFrame,
                        source_key: str, events_key: str, table_key: str,
                        key_type: str = "bigint",
                        tags: tuple[str, str, str, str] = ("source key without event", "source key without row",
                                                           "table key without source", "unreadable key")) -> DataFrame:
    """Three-way missing-key report as ``(name, record_id, raw_key)`` rows.

    Source keys missing from the event stream, source keys missing from the
    table, and table keys missing from the source; each a NULL-aware
    ``NOT IN``.  Keys are cast to ``key_type`` on every side first (text on
    one side, numbers on the other in the source scripts); text is trimmed.

    A key that is present but does not convert is reported in its own rows
    (``raw_key`` is its text, once per distinct text and side) and left out of
    the comparisons: as a NULL it would empty a whole section and hide what is
    missing.  Keys that are NULL in the data keep their SQL meaning.

    The three sides are one tagged union and one aggregate: a presence mask per
    key, here the rows that each side has of it.  The masks are written once, so
    each table is scanned once; sections, NULL keys, empty sides and unreadable
    keys are all read off them.
    """
    sides = ((source, source_key), (events, events_key), (table, table_key))
    masks = _written(presence(sides, key_type), "presence")
    s, e, t = (F.col(f"n_{i}") for i in range(3))
    good = masks.filter(F.col("raw_key").isNull())
    # Of each side: does it hold a NULL key, is it empty?
    null = [F.coalesce(F.max(F.when(F.col("record_id").isNull(), n)), F.lit(0)) > 0 for n in (s, e, t)]
    none = [F.coalesce(F.max(n), F.lit(0)) == 0 for n in (s, e, t)]
    facts = good.agg(F.struct(*[x.alias(f"null_{i}") for i, x in enumerate(null)],
                              *[x.alias(f"none_{i}") for i, x in enumerate(none)]).alias("f"))
    fact = facts.scalar()

    def section(left: int, right: int, tag: str) -> DataFrame:
        # left NOT IN right: all of it if the right side is empty, nothing if that holds a NULL.
        mine, other = F.col(f"n_{left}"), F.col(f"n_{right}")
        absent = fact[f"none_{right}"] | (~fact[f"null_{right}"] & F.col("record_id").isNotNull() & (other == 0))
        # A row of the report for each row of the key, in blocks: a key may hold very many.
        hit = good.filter((mine > 0) & absent).select("record_id", mine.alias("n"), F.explode(
            F.sequence(F.lit(0).cast("long"), F.call_function("div", mine - 1, F.lit(REPEAT_BLOCK)))).alias("block"))
        left = F.least(F.col("n") - F.col("block") * REPEAT_BLOCK, F.lit(REPEAT_BLOCK)).cast("int")
        return hit.select(F.lit(tag).alias("name"), "record_id", F.explode(F.array_repeat(F.lit(None).cast("string"), left)).alias("raw_key"))

    out = section(0, 1, tags[0]).unionByName(section(0, 2, tags[1])).unionByName(section(2, 0, tags[2]))
    each = F.filter(F.array(*[F.when(n > 0, F.lit(tags[3])) for n in (s, e, t)]), lambda x: x.isNotNull())
    bad = masks.filter(F.col("raw_key").isNotNull()).select(F.explode(each).alias("name"), "record_id", "raw_key")
    return out.unionByName(bad)


#: Rows of one key that the report emits at a time.
REPEAT_BLOCK = 4096


def _written(df: DataFrame, name: str) -> DataFrame:
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def presence(sides, key_type: str = "bigint") -> DataFrame:
    """``record_id, raw_key, n_0, n_1, ..``: how many rows each side has of a key.

    ``sides`` are ``(table, key column)`` pairs.  Keys are cast to ``key_type``, text
    is trimmed first; one that does not convert counts under its text in ``raw_key``
    (NULL otherwise).  One union and one aggregate, partial before the shuffle.
    """
    out = None
    for i, (df, c) in enumerate(sides):
        col = F.trim(F.col(c)) if isinstance(df.schema[c].dataType, T.StringType) else F.col(c)  # pasted lists carry spaces
        key = col.try_cast(key_type)
        part = df.select(key.alias("record_id"), F.when(key.isNull(), col.cast("string")).alias("raw_key"),
                         *[F.lit(int(i == j)).cast("long").alias(f"n_{j}") for j in range(len(sides))])
        out = part if out is None else out.unionByName(part)
    return out.groupBy("record_id", "raw_key").agg(*[F.sum(f"n_{j}").alias(f"n_{j}") for j in range(len(sides))])


#: Buckets of keys that a content comparison sums up first.
CHECK_BUCKETS = 4096


def content_diff(left: DataFrame, right: DataFrame, keys, cols=None, buckets: int = CHECK_BUCKETS,
                 tags: tuple[str, str, str] = ("left only", "right only", "changed")) -> DataFrame:
    """``keys.., side``: the keys whose rows differ between two tables.

    Content, not only counts and keys: every row's hash goes into order-free sums of
    its key bucket (count, XOR, sum), one aggregate per side without moving a row.
    Only the buckets that differ, ``buckets`` at most, are looked into again, key by
    key, with the same sums.  So two equal tables cost two scans.  Rows are compared as
    multisets per key (a NULL key is a key like any other); ``cols`` are compared
    besides the keys, by default all that the tables share.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = [c for c in left.columns if c in right.columns and c not in keys] if cols is None else list(cols)
    types = {f.name: f.dataType for f in left.schema.fields}

    def narrow(df: DataFrame, side: int) -> DataFrame:
        k = [F.col(c).cast(types[c]).alias(c) for c in keys]
        row = F.xxhash64(*k, *[F.col(c).cast(types[c]) for c in cols])
        return df.select(*k, row.alias("__h"), F.pmod(F.xxhash64(*k), F.lit(buckets)).cast("int").alias("__b"), F.lit(side).alias("__s"))

    def sums(df: DataFrame, by) -> DataFrame:
        aggs = []
        for side in (0, 1):
            h = F.when(F.col("__s") == side, F.col("__h"))
            aggs += [F.count(h).alias(f"__n{side}"), F.coalesce(F.bit_xor(h), F.lit(0)).alias(f"__x{side}"),
                     F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias(f"__t{side}")]
        same = F.lit(True)
        for what in ("n", "x", "t"):
            same = same & (F.col(f"__{what}0") == F.col(f"__{what}1"))
        return df.groupBy(*by).agg(*aggs).filter(~same)

    sides = [narrow(left, 0), narrow(right, 1)]
    differ = _written(sums(sides[0].unionByName(sides[1]), ["__b"]).select("__b"), "differing-buckets")
    inside = [s.join(F.broadcast(differ), "__b", "left_semi") for s in sides]  # `buckets` rows at most
    side = F.when(F.col("__n1") == 0, tags[0]).when(F.col("__n0") == 0, tags[1]).otherwise(tags[2])
    return sums(inside[0].unionByName(inside[1]), keys).select(*keys, side.alias("side"))


def except_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str | None = None,
                tags: tuple[str, str] = ("left only", "right only")) -> DataFrame:
    """``(key, side)``: distinct keys that one of two tables lacks (EXCEPT both ways;
    NULL is a value like any other)."""
    lk = left.select(F.col(left_key).alias("key"))
    rk = right.select(F.col(right_key or left_key).alias("key"))
    return (lk.subtract(rk).select("key", F.lit(tags[0]).alias("side"))
            .unionByName(rk.subtract(lk).select("key", F.lit(tags[1]).alias("side"))))


def row_counts(tables: Mapping[str, DataFrame], name: str = "object_name") -> DataFrame:
    """Row-count board: one ``(object_name, row_count)`` row per table, sorted.

    Each count is a separate global aggregate (parquet answers from footers
    where it can); the board is their UNION ALL, submitted as one job.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias(name), "row_count")
             for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(name)


def reconcile_counts(left: DataFrame, right: DataFrame, name: str = "object_name",
                     count: str = "row_count") -> DataFrame:
    """Compare two count boards by lower-cased name.

    Returns ``object_name`` (lower case), ``left_count``, ``right_count`` and
    ``diff = left - right`` (NULL when a side lacks the table): the same rows
    as a FULL OUTER JOIN on ``lower(name)`` when each board names a table
    once.  Built as a tagged UNION ALL plus one aggregate, so no join is
    planned at all (boards of literal names would otherwise fold the join
    key into a constant); names repeated on one side are added up.
    """
    lft = left.select(F.lower(F.col(name)).alias("__n"), F.col(count).alias("__l"),
                      F.lit(None).cast("bigint").alias("__r"))
    rgt = right.select(F.lower(F.col(name)).alias("__n"), F.lit(None).cast("bigint").alias("__l"),
                       F.col(count).alias("__r"))
    g = lft.unionByName(rgt).groupBy("__n").agg(F.sum("__l").alias("left_count"),
                                                 F.sum("__r").alias("right_count"))
    return g.select(F.col("__n").alias(name), "left_count", "right_count",
                    (F.col("left_count") - F.col("right_count")).alias("diff"))


def tagged_union(parts: Mapping[str, DataFrame], tag: str = "object_type",
                 where: Column | None = None) -> DataFrame:
    """UNION (distinct) of tagged inventories, columns matched by name, then
    an optional filter (e.g. on owner and database)."""
    out = None
    for t, df in parts.items():
        p = df.select(F.lit(t).alias(tag), *df.columns)
        out = p if out is None else out.unionByName(p)
    out = out.distinct()
    return out.filter(where) if where is not None else out

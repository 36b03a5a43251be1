"""Sharding by proportional stratified interleaving.

Rows are shuffled within each source by a seeded hash, ranked, and laid out by
their fractional rank ``(rank + 1/2) / size of the source``; the sequence is cut
into shards of equal length.  Every stretch of the sequence, so every shard,
then holds each source in proportion.

The rank within a source needs no task that holds a whole source: the hash range
is cut into equal buckets, bucket sizes are counted in a first pass over two
narrow columns and summed up to each bucket's first rank, and only rows of one
(source, bucket) are sorted together.  The places in the whole sequence follow from
the sources' sizes alone: every (source, rank) is generated, range-sorted by its
exact fraction and numbered, and comes back to its bucket, where its row lies sorted.
Nothing is done per row and source, so many sources cost what few do, and whole rows
move once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import checked_broadcast, comparable, free_name, numbered, staged

#: Rows that one (source, bucket) holds on average, at most.
BUCKET_ROWS = 2048

#: Most rows of a bucket whose places travel as one array.
ARRAY_ROWS = 1 << 18

#: Ranks that one row of a block stands for, as a power of two.
BLOCK_BITS = 12


def _bucket(key: Column, buckets: Column) -> Column:
    """Equal ranges of a hash-random long, in its order."""
    high = F.shiftright(key, 32) + F.lit(2 ** 31)  # 0 .. 2^32 - 1
    return F.shiftright(high * buckets, 32).cast("long")


def fraction_key(rank: Column, size: Column) -> tuple[Column, Column]:
    """Two longs that sort like ``(2 rank + 1) / (2 size)`` and are equal where it is.

    They hold its first 100 binary digits; fractions of sources of fewer than 2^41
    rows that differ do so within the first 84.
    """
    whole, rest, digits = 2 * size, 2 * rank + 1, []
    for _ in range(5):
        digits.append(F.call_function("div", F.shiftleft(rest, 20), whole))
        rest = F.shiftleft(rest, 20) % whole
    a, b, c, d, e = digits
    return (F.shiftleft(a, 40).bitwiseOR(F.shiftleft(b, 20)).bitwiseOR(c), F.shiftleft(d, 20).bitwiseOR(e))


def places(starts: DataFrame, sizes: DataFrame, src: str, bucket: str, first: str, n: str, size: str) -> DataFrame:
    """``src, bucket, rank, pos``: the place in the whole sequence of every rank, generated from the buckets' sizes."""
    last = F.col(n) - 1
    blocks = starts.join(checked_broadcast(sizes.select(src, size)), src).select(
        src, bucket, first, size, n, F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(last, BLOCK_BITS))).alias("block"))
    low = F.shiftleft("block", BLOCK_BITS)
    inside = F.explode(F.sequence(low, F.least(low + ((1 << BLOCK_BITS) - 1), last))).alias("inside")
    ranks = blocks.repartition(src, bucket, "block").select(src, bucket, first, size, inside)
    ranks = ranks.select(src, bucket, size, (F.col(first) + F.col("inside")).alias("rank"))
    a, b = fraction_key(F.col("rank"), F.col(size))
    return numbered(ranks.select(src, bucket, "rank", a.alias("a"), b.alias("b")), ["a", "b", src], "pos", "places").select(
        src, bucket, "rank", "pos")


def stratified_shards(rows: DataFrame, shards: int, by: str = "source", key: tuple[str, ...] = ("doc_id",),
                      seed: int = 17, shard: str = "shard", slot: str = "slot",
                      bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``rows`` with two more columns: ``shard`` (0 to ``shards`` - 1) and ``slot``
    (gapless from 0 within the shard).

    Shard sizes differ by one row at most, and each source's rows are spread
    over the shards in proportion.  A null source is a source of its own; equal
    fractions of several sources follow the sources' names.  Rows are shuffled by a
    hash of ``key``; rows with equal keys are ordered by their other columns' hash,
    and wholly equal rows take neighbouring places.  Columns of ``rows`` that are
    called ``shard`` or ``slot`` are replaced.  An empty table stays empty.  With
    fewer rows than shards, some shards are empty.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    n = {k: free_name(rows, f"_q_{k}") for k in ("src", "key", "bucket", "first", "rank", "rows", "size", "of", "pos", "buckets")}
    src = F.coalesce(F.concat(F.lit("s"), F.col(f"`{by}`").cast("string")), F.lit("n"))
    keyed = rows.select("*", src.alias(n["src"]),
                        F.xxhash64(F.lit(seed), *[F.col(f"`{k}`") for k in key]).alias(n["key"]))

    # Pass 1, narrow columns only: one row per source, then one per (source, bucket).
    sizes = keyed.groupBy(n["src"]).agg(F.count(F.lit(1)).alias(n["size"]))
    sizes = staged(sizes.select("*", F.ceil(F.col(n["size"]) / bucket_rows).cast("long").alias(n["buckets"])), "strata")
    of = sizes.agg(F.sum(n["size"])).scalar()
    keyed = keyed.join(checked_broadcast(sizes.select(n["src"], n["buckets"])), n["src"]).withColumn(
        n["bucket"], _bucket(F.col(n["key"]), F.col(n["buckets"])))
    below = Window.partitionBy(n["src"]).orderBy(n["bucket"]).rowsBetween(Window.unboundedPreceding, -1)
    starts = keyed.groupBy(n["src"], n["bucket"]).agg(F.count(F.lit(1)).alias(n["rows"]))
    starts = staged(starts.select("*", F.coalesce(F.sum(n["rows"]).over(below), F.lit(0)).alias(n["first"])), "bucket-starts")
    place = places(starts, sizes, n["src"], n["bucket"], n["first"], n["rows"], n["size"])

    # Pass 2: the rank inside a bucket, and with it the place, which meets the row where it lies.
    order = Window.partitionBy(n["src"], n["bucket"]).orderBy(
        n["key"], *[F.col(f"`{k}`") for k in key], F.xxhash64(*comparable(rows)))
    ranked = keyed.withColumn(n["rank"], F.row_number().over(order) - 1)
    if (starts.agg(F.max(n["rows"])).first()[0] or 0) <= ARRAY_ROWS:
        held = place.groupBy(n["src"], n["bucket"]).agg(F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "pos"))), lambda x: x["pos"]).alias(n["pos"]))
        out = ranked.join(held.hint("merge"), [n["src"], n["bucket"]]).withColumn(n["pos"], F.get(n["pos"], F.col(n["rank"])))
    else:  # very many rows of one key: their places don't fit one array and are met one by one
        out = ranked.join(starts, [n["src"], n["bucket"]]).withColumn(n["rank"], F.col(n["rank"]) + F.col(n["first"]))
        out = out.join(place.select(n["src"], F.col("rank").alias(n["rank"]), F.col("pos").alias(n["pos"])), [n["src"], n["rank"]])
    out = out.withColumn(n["of"], of)
    cut = F.call_function("div", F.col(n["pos"]) * shards, F.col(n["of"]))
    out = out.select(*[F.col(f"`{c}`") for c in rows.columns if c not in (shard, slot)], n["pos"], n["of"], cut.cast("int").alias(shard))
    first = F.call_function("div", F.col(shard).cast("long") * F.col(n["of"]) + (shards - 1), F.lit(shards).cast("long"))
    return out.withColumn(slot, (F.col(n["pos"]) - first).cast("long")).drop(n["pos"], n["of"])

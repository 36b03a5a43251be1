"""Centroid clustering with space-filling-curve zone maps.

Vectors of whole numbers are laid out once in Hilbert order and packed into blocks
of neighbours; each block keeps its box (least and greatest value per component).
In every round the boxes are compared first: a centroid whose least distance to the
box is above another one's greatest distance can be nearest to no vector of the
block.  The block's vectors are compared exactly with the candidates that are left.

A round is one pass over the staged blocks that sends, per task, one row of sums for
each centroid.  The centroids, ``k`` vectors, are the only data that reach the driver.
Hilbert transform: Skilling, "Programming the Hilbert curve", AIP Conf. Proc. 707, 2004.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import staged

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Vectors of a block, bits per component in the Hilbert order.
BLOCK, BITS = 128, 2

#: Largest whole number of a component: distances then stay within 64 bits.
LARGEST = 1 << 27


def hilbert_keys(cells, bits: int = BITS):
    """Position on the Hilbert curve, as big-endian bytes, of every row of ``cells`` (whole numbers below ``2 ** bits``)."""
    import numpy as np
    x = np.array(cells, np.int64).T.copy()  # a row per axis
    for bit in range(bits - 1, 0, -1):  # undo the turns of the finer levels
        low = (1 << bit) - 1
        for axis in x:
            turn = (axis >> bit & 1).astype(bool)
            swap = np.where(turn, 0, (x[0] ^ axis) & low)
            x[0] ^= np.where(turn, low, swap)
            axis ^= swap
    for i in range(1, len(x)):  # Gray code over the axes
        x[i] ^= x[i - 1]
    turns = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, 0, -1):
        turns ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turns
    planes = np.concatenate([x >> bit & 1 for bit in range(bits - 1, -1, -1)]).T
    return np.packbits(planes.astype(np.uint8), axis=1)


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", dims: int = 64,
                  scale: int = 256) -> DataFrame:
    """``row, vec_id, v``: ``floor(scale * x)`` of every vector with exactly ``dims`` components, none null or not finite."""
    v = F.col(f"`{embedding}`")

    def finite(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    scaled = F.transform(v, lambda x: F.lit(float(scale)) * x.cast("double"))
    good = v.isNotNull() & (F.size(v) == dims) & F.forall(v, finite)
    large = F.exists(scaled, lambda x: F.abs(x) > LARGEST)
    ints = F.transform(scaled, lambda x: F.floor(x).cast("long"))
    said = F.raise_error(F.lit(f"a component is above {LARGEST} / {scale}")).cast("array<bigint>")
    return vectors.where(good).select(F.monotonically_increasing_id().alias("row"), F.col(f"`{vec_id}`").alias("vec_id"),
                                      F.when(large, said).otherwise(ints).alias("v"))


def zone_maps(rows: DataFrame, dims: int, block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """``ids, data, low, high``: blocks of ``block`` vectors that are neighbours on the Hilbert curve, with their boxes.

    ``rows`` (``row, vec_id, v``) are staged.  The grid of the curve is laid
    between each component's least and greatest value.  ``row`` ends the sort key,
    so many equal vectors are parted among tasks like any others.
    """
    ends = rows.agg(F.array(*[F.min(F.col("v")[i]) for i in range(dims)]).alias("low"),
                    F.array(*[F.max(F.col("v")[i]) for i in range(dims)]).alias("high")).first()
    kind = rows.schema["vec_id"].dataType.simpleString()

    def keyed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        low, high = np.array(ends["low"], np.int64), np.array(ends["high"], np.int64)
        for frame in frames:
            if len(frame):
                v = np.stack(frame["v"].to_numpy()).astype(np.int64)
                keys = hilbert_keys((v - low << bits) // (high - low + 1), bits)
                yield frame[["row", "vec_id"]].assign(key=[k.tobytes() for k in keys],
                                                      v=[x.tobytes() for x in v.astype(np.int32)])

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        def blocks(ids: list, data):
            v = data.reshape(-1, dims)
            return pd.DataFrame({"ids": [ids], "data": [data.tobytes()], "low": [v.min(0).tobytes()], "high": [v.max(0).tobytes()]})
        ids, held = [], b""
        for frame in frames:
            ids += frame["vec_id"].astype(object).where(frame["vec_id"].notna(), None).tolist()
            held += b"".join(frame["v"])
            data, at = np.frombuffer(held, np.int32).reshape(-1, dims), 0
            while len(ids) - at >= block:
                yield blocks(ids[at:at + block], data[at:at + block])
                at += block
            ids, held = ids[at:], data[at:].tobytes()
        if ids:
            yield blocks(ids, np.frombuffer(held, np.int32))
    laid = rows.mapInPandas(keyed, f"row long, vec_id {kind}, key binary, v binary").repartitionByRange("key", "row")
    return staged(laid.sortWithinPartitions("key", "row").select("vec_id", "v").mapInPandas(
        packed, f"ids array<{kind}>, data binary, low binary, high binary"), "zone-maps")


def candidates(low, high, centroids):
    """Numbers of the centroids that can be nearest to a vector inside the box, ascending."""
    import numpy as np
    under, over = low - centroids, centroids - high
    least = np.square(np.maximum(np.maximum(under, over), 0)).sum(1)
    most = np.square(np.maximum(-under, -over)).sum(1)
    return np.flatnonzero(least <= most.min())


def nearest(v, low, high, centroids):
    """Number and squared distance of each vector's nearest centroid (ties: the smaller number)."""
    import numpy as np
    some = candidates(low, high, centroids)
    near = centroids[some]
    if max(np.abs(v).max(), np.abs(near).max()) <= 1 << 22 and v.shape[1] <= 64:
        # Below 2^53 doubles hold every sum exactly.
        x, c = v.astype(np.float64), near.astype(np.float64)
        apart = (np.square(x).sum(1)[:, None] - 2 * (x @ c.T) + np.square(c).sum(1)[None, :]).astype(np.int64)
    else:
        apart = np.stack([np.square(v - c).sum(1) for c in near], 1)
    best = apart.argmin(1)
    return some[best], apart[np.arange(len(v)), best]


def _each_block(frames: Iterator[pd.DataFrame], centroids, dims: int):
    import numpy as np
    for frame in frames:
        for ids, data, low, high in zip(frame["ids"], frame["data"], frame["low"], frame["high"]):
            v = np.frombuffer(data, np.int32).reshape(-1, dims).astype(np.int64)
            yield ids, v, *nearest(v, np.frombuffer(low, np.int32).astype(np.int64),
                                   np.frombuffer(high, np.int32).astype(np.int64), centroids)


def moved(blocks: DataFrame, centroids, dims: int):
    """The centroids after one round: the floor of their vectors' mean; without vectors they stay."""
    import numpy as np

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = np.zeros(len(centroids), np.int64), np.zeros((len(centroids), dims), np.int64)
        for _, v, at, _ in _each_block(frames, centroids, dims):
            n += np.bincount(at, minlength=len(centroids))
            np.add.at(total, at, v)
        has = np.flatnonzero(n)
        yield pd.DataFrame({"cluster": has, "n": n[has], "total": list(total[has])})
    parts = blocks.mapInPandas(sums, "cluster int, n long, total array<long>")
    out = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(dims)]).alias("total")).collect():
        out[r["cluster"]] = [x // r["n"] for x in r["total"]]  # at most k rows
    return out


def cluster(vectors: DataFrame, k: int, rounds: int, seed: str = "2", vec_id: str = "vec_id", embedding: str = "embedding",
            dims: int = 64, scale: int = 256, block: int = BLOCK, bits: int = BITS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    A vector is kept if it has exactly ``dims`` components, none null or not
    finite; component x counts as ``floor(scale * x)``, and one beyond 2^27 fails
    the job, as distances would leave 64 bits.  Centroids start as the ``k`` kept
    vectors with the smallest sha256 of ``<seed>:<vec_id>`` (null ids last, equal
    ids by their components; fewer vectors: fewer centroids).  ``rounds`` times
    every vector goes to the nearest centroid, of equally near ones to the smaller
    number, and every centroid with vectors moves to the floor of their mean; then
    vectors are assigned once more.  ``distance`` is squared, ``cluster_inertia``
    and ``inertia`` are its sums over the cluster and over all.  Repeated rows are
    vectors of their own; an empty table stays empty; other columns are left out.
    """
    import numpy as np
    spark = vectors.sparkSession
    rows = staged(whole_vectors(vectors, vec_id, embedding, dims, scale), "whole-vectors")
    kind = rows.schema["vec_id"].dataType.simpleString()
    first = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    start = rows.select(first.alias("h"), "v").orderBy(F.col("h").asc_nulls_last(), "v").limit(k).collect()
    if not start:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    centroids = np.array([r["v"] for r in start], np.int64)
    blocks = zone_maps(rows, dims, block, bits)
    for _ in range(rounds):
        centroids = moved(blocks, centroids, dims)

    def assigned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, _, at, distance in _each_block(frames, centroids, dims):
            yield pd.DataFrame({"vec_id": pd.Series(list(ids), dtype=object), "cluster": at, "distance": distance})
    found = staged(blocks.mapInPandas(assigned, f"vec_id {kind}, cluster int, distance long"), "clustered")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long").alias("cluster_inertia"))
    total = found.agg(F.sum(F.col("distance").cast("decimal(38,0)")).cast("long")).scalar()
    named = spark.createDataFrame(list(enumerate(digests)), "cluster int, centroid_sha256 string")
    # Both sides of this join have a row per centroid, k at most.
    each = F.broadcast(sums.join(F.broadcast(named), "cluster"))
    return found.join(each, "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", total.alias("inertia"),
                                              "centroid_sha256")

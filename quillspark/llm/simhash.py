"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are reduced to distinct values, sorted by Gray rank (the position
of a code in the reflected Gray sequence: neighbours there share long runs of
bits) and cut into nodes of consecutive values.  A node keeps the bits that all
its members share as a masked pattern (AND and OR of the members); nodes are
grouped into upper nodes the same way until few remain.  Two nodes whose
patterns differ in more shared bits than allowed hold no linked pair, so whole
groups are pruned on the way down; only pairs of bottom nodes that survive are
compared, in small subgroups pruned by the same rule.

Every level is an equi-join on the parent's key; the top level has at most
``TOP`` nodes.  No fingerprint list, link or component passes the driver.
Method: Tang, Yu, Aref, Malluhi, Ouzzani, "Efficient Processing of
Hamming-Distance-Based Similarity-Search Queries over MapReduce", EDBT 2015.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import bounded_batches, comparable, free_name, staged
from quillspark.llm.graph import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words in a shingle, seed of the hash, most differing bits of a link.
SHINGLE, SEED, MAX_BITS = 3, 42, 2

#: Fingerprints in a bottom node, nodes under one upper node, most top nodes,
#: fingerprints in a subgroup that is pruned or compared inside a task.
NODE, FAN, TOP, GROUP = 2048, 16, 256, 32

#: Long texts are cut into pieces of about so many bytes, at white space.
PIECE = 4 << 20


def word_runs(data: bytes, piece: int = PIECE) -> Iterator[list[bytes]]:
    """Words of ``data`` in order, a list per piece."""
    import re
    space, at = re.compile(rb"[\x20\x09-\x0D]"), 0
    while at < len(data):
        m = space.search(data, min(at + piece, len(data)))
        end = m.end() if m else len(data)
        yield data[at:end].split()
        at = end


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED, piece: int = PIECE) -> int:
    """64-bit SimHash as a signed long: bit i is set if set in over half the
    hashes of the text's word shingles.  Null and wordless texts give 0."""
    import numpy as np
    from xxhash import xxh64_intdigest

    if not text:
        return 0
    ones, total, kept = np.zeros(64, np.int64), 0, []
    for words in word_runs(text.encode("utf-8", "surrogatepass").lower(), piece):
        words = kept + words
        count = len(words) - shingle + 1
        if count < 1:
            kept = words
            continue
        hashes = np.fromiter((xxh64_intdigest(s, seed) for s in
                              map(b" ".join, zip(*(words[i:] for i in range(shingle))))), np.uint64, count)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(count, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        total += count
        kept = words[len(words) - shingle + 1:]
    if not total:
        if not kept:
            return 0
        one = np.array([xxh64_intdigest(b" ".join(kept), seed)], np.uint64)
        return int(one.view(np.int64)[0])
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def fingerprint_column(text: str, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: fingerprint(t, shingle, seed)).astype("int64")
    return of(F.col(f"`{text}`"))


def gray_rank(fp: Column) -> Column:
    """Position of a code in the reflected Gray sequence: each bit is the parity of the bits above."""
    for k in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, k))
    return fp


def _build_nodes(size: int):
    """Sorted fingerprints of one partition -> bottom nodes of ``size`` of them."""
    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        from pyspark import TaskContext
        part, at, rest = TaskContext.get().partitionId(), 0, np.empty(0, np.int64)

        def node(values):
            nonlocal at
            at += 1
            return pd.DataFrame({"part": [part], "node": [(part << 32) + at - 1], "low": [int(np.bitwise_and.reduce(values))],
                                 "high": [int(np.bitwise_or.reduce(values))], "fps": [values.tobytes()]})
        for frame in frames:
            rest = np.concatenate([rest, frame["fp"].to_numpy(np.int64)])
            while len(rest) >= size:
                yield node(rest[:size])
                rest = rest[size:]
        if len(rest):
            yield node(rest)
    return build


def _compare(max_bits: int, group: int):
    """Pairs of bottom nodes -> a spanning forest of the links in each pair."""
    def popcount(x):
        import numpy as np
        return np.bitwise_count(x)

    def split(raw):
        import numpy as np
        v = np.frombuffer(raw, np.uint64)
        v = np.concatenate([v, np.repeat(v[-1:], -len(v) % group)]).reshape(-1, group)
        return v, np.bitwise_and.reduce(v, 1), np.bitwise_or.reduce(v, 1)

    def compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np
        for frame in frames:
            for row in frame.itertuples(index=False):
                a, a_low, a_high = split(row.a_fps)
                b, b_low, b_high = split(row.b_fps)
                shared = ~(a_low ^ a_high)[:, None] & ~(b_low ^ b_high)[None, :]
                apart = popcount((a_low[:, None] ^ b_low[None, :]) & shared)
                i, j = np.nonzero(apart <= max_bits)
                parent: dict[int, int] = {}

                def root(x):
                    while parent.setdefault(x, x) != x:
                        parent[x] = x = parent[parent[x]]
                    return x
                for at in range(0, len(i), 1024):
                    x, y = a[i[at:at + 1024]], b[j[at:at + 1024]]
                    k, p, q = np.nonzero(popcount(x[:, :, None] ^ y[:, None, :]) <= max_bits)
                    u, v = x[k, p].view(np.int64), y[k, q].view(np.int64)
                    apart2 = u != v
                    for s, t in zip(u[apart2].tolist(), v[apart2].tolist()):
                        s, t = root(s), root(t)
                        if s != t:
                            parent[max(s, t)] = min(s, t)
                links = [(x, r) for x in list(parent) if (r := root(x)) != x]
                if links:
                    yield pd.DataFrame(links, columns=["u", "v"])
    return compare


def _apart(max_bits: int) -> Column:
    """Shared bits of two nodes in which their patterns differ, at most ``max_bits``."""
    shared = F.bitwise_not(F.col("a_low").bitwiseXOR(F.col("a_high"))).bitwiseAND(
        F.bitwise_not(F.col("b_low").bitwiseXOR(F.col("b_high"))))
    return F.bit_count(F.col("a_low").bitwiseXOR(F.col("b_low")).bitwiseAND(shared)) <= max_bits


def _side(level: DataFrame, side: str) -> DataFrame:
    return level.select(*[F.col(c).alias(f"{side}_{c}") for c in level.columns])


def links(fps: DataFrame, max_bits: int = MAX_BITS, node: int = NODE, fan: int = FAN, top: int = TOP,
          group: int = GROUP) -> DataFrame:
    """``(u, v)``: links that connect exactly what all pairs of distinct
    fingerprints ``fp`` within ``max_bits`` bits connect.

    Of the links inside one pair of bottom nodes a spanning forest is kept, so a
    dense group leaves at most one row per fingerprint and pair of nodes.
    """
    parts = max(1, fps.count() // (4 * node))
    ranked = fps.select("fp", gray_rank(F.col("fp")).alias("rank")).repartitionByRange(parts, "rank")
    nodes = staged(ranked.sortWithinPartitions("rank").select("fp").mapInPandas(
        _build_nodes(node), "part long, node long, low long, high long, fps binary"), "gray-nodes")

    # Upper levels: a partition of the sort, then `fan` neighbours, and so on.
    bottom = nodes.select(F.col("node").alias("key"), F.col("part").alias("up"), "low", "high")
    levels = [bottom]
    count, step = (nodes.agg(F.max("part")).first()[0] or 0) + 1, 1
    while True:
        is_top = count <= top
        child = levels[-1]
        levels.append(child.groupBy(F.col("up").alias("key")).agg(F.bit_and("low").alias("low"), F.bit_or("high").alias("high"))
                      .select("key", (F.lit(0) if is_top else F.floor(F.col("key") / fan)).cast("long").alias("up"), "low", "high"))
        if is_top:
            break
        count, step = -(-count // fan), step + 1
    first = levels.pop()
    pairs = (_side(first, "a").withColumn("to", F.explode(F.sequence(F.col("a_key"), F.lit(count - 1).cast("long"))))
             .join(_side(first, "b"), F.col("to") == F.col("b_key")).where(_apart(max_bits))
             .select(F.col("a_key").alias("a"), F.col("b_key").alias("b")))
    while levels:
        level = levels.pop()
        pairs = (pairs.join(_side(level, "a"), F.col("a") == F.col("a_up")).join(_side(level, "b"), F.col("b") == F.col("b_up"))
                 .where((F.col("a_key") <= F.col("b_key")) & _apart(max_bits))
                 .select(F.col("a_key").alias("a"), F.col("b_key").alias("b")))
    pairs = staged(pairs, "gray-pairs")
    held = nodes.select("node", "fps")
    both = (pairs.join(held.toDF("a", "a_fps"), "a").join(held.toDF("b", "b_fps"), "b").select("a_fps", "b_fps"))
    return both.mapInPandas(_compare(max_bits, group), "u long, v long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE,
                    seed: int = SEED, max_bits: int = MAX_BITS, node: int = NODE, fan: int = FAN, top: int = TOP,
                    group: int = GROUP, row: str | None = None) -> DataFrame:
    """``doc_id, fp, component_id, component_fp, text_a, text_b`` for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links of at most
    ``max_bits`` differing bits reach.  Null and empty texts have fingerprint
    zero and are linked like any other; equal texts and repeated rows share a
    component; a null ``doc_id`` names no component (null only if no linked row
    has an id).  ``component_fp`` is the smallest fingerprint of the component,
    which names it also where ids repeat or are null; ``text_a`` and ``text_b``
    are hashes of the row's text.  ``row`` names a column that is carried along as
    ``row``.  An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    a, b = _text_key(F.col(f"`{text}`"))
    rows = staged(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), fingerprint_column(text, shingle, seed).alias("fp"),
                              a.alias("text_a"), b.alias("text_b"), *[F.col(f"`{c}`").alias("row") for c in (row,) if c]),
                  "fingerprints")
    fps = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    linked = components(links(fps.select("fp"), max_bits, node, fan, top, group))
    named = (fps.join(linked, fps["fp"] == linked["node"], "left")
             .select("fp", "first", F.coalesce("component", "fp").alias("component")))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    return rows.join(named.join(smallest, "component").select("fp", "component_id", F.col("component").alias("component_fp")), "fp").select(
        "doc_id", "fp", "component_id", "component_fp", "text_a", "text_b", *["row" for c in (row,) if c])


def _text_key(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def keep_first(docs: DataFrame, found: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component of ``found``: the smallest id, of its texts the smallest hash.

    The decision is by row, id and text, so rows of one id with different texts
    stand for themselves; a null id comes after the others.  Of rows that repeat
    id and text one stays.
    """
    columns = ["doc_id", "text_a", "text_b"]
    keyed = staged(found.groupBy("component_fp", *columns).agg(F.count(F.lit(1)).alias("rows")), "near-duplicates")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), *columns)
    first = keyed.groupBy("component_fp").agg(F.min(key).alias("first"))
    a, b, c = names = [free_name(docs, n) for n in ("_id", "_text_a", "_text_b")]

    def named(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(x).alias(y) for x, y in zip(columns, names)])

    def same(rows: DataFrame, keys: DataFrame) -> Column:
        x, y = _text_key(rows[text])
        return rows[doc_id].eqNullSafe(keys[a]) & (x == keys[b]) & (y == keys[c])
    gone = staged(named(keyed.join(first, "component_fp").where(~key.eqNullSafe(F.col("first")))), "removed")
    out = docs.join(gone, same(docs, gone), "left_anti")
    again = staged(named(keyed.where("rows > 1")), "repeated")
    if again.isEmpty():
        return out
    once = out.join(again, same(out, again), "left_anti")
    rest = out.join(again, same(out, again), "left_semi")
    x, y = _text_key(F.col(f"`{text}`"))
    one = rest.groupBy(F.col(f"`{doc_id}`").alias(a), x.alias(b), y.alias(c)).agg(
        F.min_by(F.struct(*[F.col(f"`{n}`") for n in docs.columns]), F.struct(*comparable(docs))).alias("_row"))
    return once.unionByName(one.select("_row.*"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each component of near duplicates: the smallest id
    (null ids last), of its texts the smallest hash, of equal rows the first.

    Rows are numbered in a staged copy and decided by number alone: the decision
    is a partial minimum per component over narrow rows, and the texts move once,
    to the numbers that stay.  That plan is the same at every size.  All columns,
    of any type, are kept as they are; an empty table stays empty.
    """
    row = free_name(docs, "_row")
    rows = staged(docs.select("*", F.monotonically_increasing_id().alias(row)), "numbered")
    found = near_duplicates(rows, text, doc_id, row=row, **settings)
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_a", "text_b", "row")
    first = found.groupBy("component_fp").agg(F.min(key).alias("first")).select(F.col("first.row").alias(row))
    return rows.join(first.hint("merge"), row, "left_semi").select([F.col(f"`{c}`") for c in docs.columns])

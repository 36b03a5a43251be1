"""Mixing sources to target weights.

Each document gets a hash-random key.  Within a source the key range is cut into
equal ranges; token counts are summed per (source, range) with a partial sum
before the shuffle, and running sums over the ranges show in which range a
source's budget ends.  Only the rows of that one range are sorted, to find the
key and the word where the budget is met exactly.  A budget beyond the source's
size repeats whole epochs first.  Applying the cut is a join with one row per
source, so texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import SPACE_WORD, checked_broadcast, free_name, staged

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: The mix's size against all sizes, and the most epochs of one source.
SHARE, EPOCHS = 1.5, 2


def source_key(source: Column) -> Column:
    """A non-null join key: null is a source of its own, after all others."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("t"))


def order_key(doc_id: Column, text: Column, seed: int) -> Column:
    """Hash-random hex key of a document; equal only for repeats of a document."""
    name = F.coalesce(doc_id.cast("string"), F.lit("null"))
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), name).cast("binary")),
                    F.lpad(F.hex(F.crc32(F.coalesce(text, F.lit("")).cast("binary"))), 8, "0"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            epochs: int = EPOCHS) -> DataFrame:
    """``(src, source_size)`` -> the same with ``target``.

    ``share`` of all sizes is split by the repeating ``weights``; a source stops
    at ``epochs`` times its size and the excess goes to the others by weight,
    until none is above.  That fixed point fills sources in the order of limit
    over weight up to one common level.
    """
    w = F.array(*[F.lit(x) for x in weights])
    by_name = Window.orderBy("src")  # one row per source
    t = sizes.withColumn("w", F.element_at(w, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    t = t.withColumn("lim", F.col("source_size") * epochs)
    fill = Window.orderBy(F.col("lim") / F.col("w"), "src")
    full = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    t = (t.withColumn("n", F.row_number().over(fill))
         .withColumn("left", F.sum("source_size").over(everything) * F.lit(share)
                     - F.coalesce(F.sum("lim").over(full), F.lit(0)))
         .withColumn("ws", F.sum("w").over(rest)))
    open_at = F.min(F.when(F.col("lim") / F.col("w") > F.col("left") / F.col("ws"), F.col("n"))).over(everything)
    t = t.withColumn("open_at", open_at)
    at_level = lambda c: F.max(F.when(F.col("n") == F.col("open_at"), F.col(c))).over(everything)
    t = t.withColumn("left", at_level("left")).withColumn("ws", at_level("ws"))
    target = F.when(F.col("open_at").isNull() | (F.col("n") < F.col("open_at")), F.col("lim").cast("double")).otherwise(
        F.col("w") * F.col("left") / F.col("ws"))
    return t.select("src", "source_size", target.alias("target"))


def plan_mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS,
             range_rows: int | None = None) -> DataFrame:
    """One row per source of ``sized(src, okey, size)``.

    ``src, source_size, target, full`` (whole epochs), ``cut_key`` (documents of
    smaller keys are taken once more; null: none) and ``cut_words`` (words taken
    of the document at ``cut_key``; repeats of one document share them evenly,
    rounded down).

    A range holds ``range_rows`` rows on average.  By default a source has as many
    ranges as rows in each, the square root of its rows, so neither its ranges nor
    the rows of the one that is sorted are many in one task.
    """
    sizes = sized.groupBy("src").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    t = staged(targets(sizes, weights, share, epochs).join(sizes.select("src", "rows"), "src"), "mix-targets")
    budget = F.floor(F.col("target") + 0.5).cast("long")
    some = F.col("source_size") > 0
    full = F.when(some, F.call_function("div", budget, F.greatest("source_size", F.lit(1)))).otherwise(F.lit(0))
    t = (t.withColumn("full", full).withColumn("left", budget - F.col("full") * F.col("source_size"))
         .withColumn("ranges", F.ceil(
                 F.sqrt("rows") if range_rows is None else F.col("rows") / range_rows).cast("long")))
    # The first 8 hex digits of a key are a uniform number below 2^32.
    at = F.shiftright(F.conv(F.substring("okey", 1, 8), 16, 10).cast("long") * F.col("ranges"), 32)
    placed = sized.join(checked_broadcast(t.select("src", "left", "ranges")), "src").where("left > 0 and size > 0")
    placed = placed.withColumn("range", at)
    run = Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = (placed.groupBy("src", "range").agg(F.sum("size").alias("words"), F.first("left").alias("left"))
            .withColumn("before", F.coalesce(F.sum("words").over(run), F.lit(0))))
    last = staged(sums.where("before < left and before + words >= left").select("src", "range", "before"), "mix-ranges")
    run = Window.partitionBy("src").orderBy("okey").rowsBetween(Window.unboundedPreceding, -1)
    docs = (placed.join(checked_broadcast(last), ["src", "range"])
            .groupBy("src", "okey").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("copies"),
                                        F.first("left").alias("left"), F.first("before").alias("before"))
            .withColumn("before", F.col("before") + F.coalesce(F.sum("words").over(run), F.lit(0))))
    cut = (docs.where("before < left and before + words >= left")
           .select("src", F.col("okey").alias("cut_key"),
                   F.call_function("div", F.col("left") - F.col("before"), F.col("copies")).alias("cut_words")))
    return staged(t.join(cut, "src", "left").select("src", "source_size", "target", "full", "cut_key", "cut_words"),
                  "mix-plan")


def mix(docs: DataFrame, seed: int = 23, source: str = "source", doc_id: str = "doc_id", text: str = "text",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, carry: tuple[str, ...] | None = None,
        range_rows: int | None = None) -> DataFrame:
    """``docs`` (its columns, or those in ``carry``) with ``mix``: a struct of
    ``size, source_size, target, full, again, taken``.

    ``full`` is how often the whole document is taken, ``again`` the words of
    one more, cut copy (0: none), ``taken`` all words taken.  A source's taken
    words add up to its target, rounded (repeats of one document at the cut may
    leave a few words).  Null text counts no words; null is a source of its own;
    an empty table stays empty; documents without words are repeated with the
    documents around them and take nothing.
    """
    names = {k: free_name(docs, f"_m_{k}") for k in ("src", "okey", "size")}
    keyed = docs.select(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)],
                        source_key(F.col(f"`{source}`")).alias(names["src"]),
                        order_key(F.col(f"`{doc_id}`"), F.col(f"`{text}`"), seed).alias(names["okey"]),
                        word_count(F.col(f"`{text}`")).alias(names["size"]))
    if carry is not None:  # narrow rows: read the texts once
        keyed = staged(keyed, "mix-sizes")
        sized = keyed
    else:
        sized = staged(keyed.select(*names.values()), "mix-sizes")
    plan = plan_mix(sized.select(*[F.col(v).alias(k) for k, v in names.items()]), weights, share, epochs, range_rows)
    p = plan.select(F.struct(*plan.columns).alias(free_name(keyed, "_m_plan")), F.col("src").alias(names["src"]))
    plan_col = p.columns[0]
    f = lambda c: F.col(f"{plan_col}.{c}")
    size, okey = F.col(names["size"]), F.col(names["okey"])
    below = F.coalesce(okey < f("cut_key"), F.lit(False))
    whole = (f("full") + F.when(below, 1).otherwise(0)).cast("long")
    again = F.when(okey == f("cut_key"), f("cut_words")).otherwise(F.lit(0)).cast("long")
    whole_cut = F.when((again == size) & (size > 0), 1).otherwise(0)
    out = F.struct(size.alias("size"), f("source_size").alias("source_size"), f("target").alias("target"),
                   (whole + whole_cut).alias("full"), F.when(whole_cut == 1, F.lit(0)).otherwise(again).alias("again"),
                   (whole * size + again).alias("taken"))
    return (keyed.join(checked_broadcast(p), names["src"])
            .select(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry) if c != "mix"], out.alias("mix")))


def repeat_rows(mixed: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The mix itself: each document as often as taken, the copy at a source's
    cut shortened to its words (white space between them kept)."""
    cols = [c for c in mixed.columns if c != "mix"]
    n = free_name(mixed, "_m_copy")
    copies = F.when(F.col("mix.full") + F.when(F.col("mix.again") > 0, 1).otherwise(0) > 0, F.sequence(
        F.lit(1).cast("long"), F.col("mix.full") + F.when(F.col("mix.again") > 0, 1).otherwise(0)))
    rows = mixed.withColumn(n, F.explode(copies))
    cut = F.col(n) > F.col("mix.full")
    words = F.split(F.col(f"`{text}`"), r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    part = F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("mix.again").cast("int"), F.lit(1))), "")
    out = {text: F.when(cut, part).otherwise(F.col(f"`{text}`"))}
    if n_chars in cols:
        out[n_chars] = F.when(cut, F.char_length(part).cast(mixed.schema[n_chars].dataType)).otherwise(
            F.col(f"`{n_chars}`"))
    return rows.select(*[out[c].alias(c) if c in out else F.col(f"`{c}`") for c in cols])

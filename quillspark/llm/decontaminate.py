"""Benchmark decontamination by a distributed positional inverted index.

Test items are cut into windows of consecutive words.  The corpus frequency of
every test term is counted; each window is looked up by its rarest term.  For
those terms the index stores postings: document, position, and the terms at the
positions around it.  A posting's position minus the term's place in a window is
a start, and the window's other terms are compared with the terms that the posting
holds at their offsets, rarest first.  So no second list is stored, moved or
intersected: this verification stands in for the intersection of offset-adjusted
lists (the README says why).  What is left are exact phrase matches.
``proximity`` finds windows whose terms all occur within a span of words, in any
order, from the same kind of postings.

All of it is DataFrame operations.  Tokens never cross the network: they are
joined with the list of test terms where they are read (a broadcast whose bytes
are measured; beyond the limit a shuffle join gives the same rows), and the
postings of the rarest terms are a small share of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import ascii_lower, checked_broadcast, fits, free_name, staged

#: Consecutive words of a window.
WINDOW = 10

#: A word: letters, digits and anything beyond ASCII; and what separates words.
#: A-Z are lower-cased before words are taken.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(ANY_CASE_WORD)), F.lit(0)).cast("long")


def windows(items: DataFrame, item_id: str = "item_id", text: str = "text", size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``(window, terms)`` and ``(window, item_id)``.

    An item of fewer than ``size`` words, but not none, is one window; items
    without words have none.
    """
    w = F.col("w")
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (size - 1), F.lit(1))), lambda i: F.slice(w, i, size))
    rows = (items.select(F.col(f"`{item_id}`").cast("string").alias("item_id"), words(F.col(f"`{text}`")).alias("w"))
            .where("size(w) > 0").select("item_id", F.explode(cut).alias("terms"))
            .select(F.sha2(F.array_join("terms", " ").cast("binary"), 256).alias("window"), "item_id", "terms"))
    rows = staged(rows, "test-windows")
    return rows.groupBy("window").agg(F.first("terms").alias("terms")), rows.select("window", "item_id").distinct()


def rarest(found: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """``(window, term, at, others)``: each window's rarest term and its place, and the
    other places with their terms, rarest first.

    Frequencies are counted over all tokens of all documents; a term that the
    corpus lacks counts zero, so its window has no postings at all.
    """
    places = found.select("window", F.posexplode("terms").alias("at", "term"))
    vocabulary = staged(places.select("term").distinct(), "test-terms")
    tokens = docs.select(F.explode(words(F.col(f"`{text}`"))).alias("term"))
    seen = tokens.join(checked_broadcast(vocabulary), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    seen = staged(vocabulary.join(seen, "term", "left").select("term", F.coalesce("df", F.lit(0)).alias("df")), "term-frequencies")
    ranked = F.array_sort(F.collect_list(F.struct("df", "at", "term")))
    ranked = (places.join(checked_broadcast(seen), "term").groupBy("window").agg(ranked.alias("r"))
              .select("window", F.col("r")[0]["term"].alias("term"), F.col("r")[0]["at"].alias("at"),
                      F.transform(F.slice("r", 2, F.size("r")), lambda p: F.struct(p["at"].alias("at"), p["term"].alias("term")))
                      .alias("others")))
    return ranked


def _postings(docs: DataFrame, text: str, anchors: DataFrame, around: int) -> DataFrame:
    """Postings ``(doc, pos, term, near)`` of the anchors' terms, written as a table.

    ``near`` holds the words from ``around`` before to ``around`` after the
    position.  With the terms broadcast it is cut only for tokens that match.
    """
    terms = staged(anchors.select("term").distinct(), "anchor-terms")
    w = docs.select("doc", words(F.col(f"`{text}`")).alias("w"))
    tokens = w.select("doc", "w", F.posexplode("w").alias("pos", "term"))
    cols = ["doc", "pos", "term", F.slice("w", F.greatest(F.col("pos") - (around - 1), F.lit(1)), F.least(
        F.col("pos"), F.lit(around)) + around + 1).alias("near")]
    if fits(terms):
        found = tokens.join(F.broadcast(terms), "term").select(*cols)
    else:  # a shuffle: send the few words, not the whole list
        found = tokens.select(*cols).join(terms, "term")
    return staged(found.select("doc", "pos", "term", "near"), "postings")


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with ``doc``: equal for rows of equal id and text."""
    return docs.withColumn("doc", F.struct(F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h")))


def phrases(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Exact phrase matches ``(doc, window, start, length)``, and ``(window, item_id)``."""
    docs = _keyed(docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), doc_id, text)
    found, owners = windows(items, item_id, item_text, size)
    found = staged(found, "distinct-windows")
    anchors = staged(rarest(found, docs, text), "anchors")
    around = size - 1
    posts = _postings(docs, text, anchors, around)
    # `near` begins at word max(0, pos - around) of the document.
    first = F.greatest(F.col("pos") - around, F.lit(0))
    start = F.col("pos") - F.col("at")
    met = F.forall("others", lambda o: F.coalesce(F.get("near", start - first + o["at"]) == o["term"], F.lit(False)))
    return (posts.join(checked_broadcast(anchors), "term").where((start >= 0) & met)
            .select("doc", "window", start.alias("start"), (F.size("others") + 1).alias("length")), owners)


def proximity(docs: DataFrame, items: DataFrame, span: int, doc_id: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """``(doc_id, item_id, window, pos)``: places where all distinct terms of a window
    occur within ``span`` consecutive words, in any order; ``pos`` is the place of
    the window's rarest term."""
    docs = _keyed(docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), doc_id, text)
    found, owners = windows(items, item_id, item_text, size)
    found = staged(found, "distinct-windows")
    anchors = staged(rarest(found, docs, text), "anchors")
    posts = _postings(docs, text, anchors, span - 1)
    near = F.col("near")
    begin = F.greatest(F.col("pos") - (span - 1), F.lit(0))  # the first word of `near`
    left = F.sequence(F.lit(1), F.col("pos") - begin + 1)
    close = F.exists(left, lambda i: F.size(F.array_except(F.col("terms"), F.slice(near, i, span))) == 0)
    return (posts.join(anchors, "term").join(checked_broadcast(found), "window").where(close)
            .join(owners, "window").select(F.col("doc.id").alias("doc_id"), "item_id", "window", "pos").distinct())


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_hit, items`` (sorted item ids as strings).

    ``n_hit`` counts the words inside any occurrence of a window, each once.
    Null texts have no words; items without words never match; rows that repeat
    an id with other text are judged by their own text.
    """
    found, owners = phrases(docs, items, doc_id, text, item_id, item_text, size)
    found = staged(found, "matches")
    # Words covered: a running end over the starts of one document, in their order.
    places = F.array_sort(F.collect_set(F.struct("start", "length")))
    cover = F.aggregate(places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), lambda acc, x: F.struct(
        F.greatest(acc["end"], x["start"] + x["length"]).alias("end"),
        (acc["n"] + F.greatest(x["start"] + x["length"] - F.greatest(acc["end"], x["start"]), F.lit(0))).alias("n")))
    hit = found.select("doc", "start", "length").groupBy("doc").agg(cover["n"].cast("long").alias("n_hit"))
    named = (found.select("doc", "window").distinct().join(checked_broadcast(staged(owners, "owners")), "window")
             .groupBy("doc").agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    all_docs = _keyed(docs.select(F.col(f"`{doc_id}`"), F.col(f"`{text}`")), doc_id, text).select(
        "doc", F.col(f"`{doc_id}`").alias("doc_id"), count_words(F.col(f"`{text}`")).alias("n_words"))
    per_doc = staged(hit.join(named, "doc"), "contaminated")
    return (all_docs.join(per_doc, all_docs["doc"].eqNullSafe(per_doc["doc"]), "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold an occurrence of a window."""
    found, _ = phrases(docs, items, doc_id, text, item_id, item_text, size)
    gone = staged(found.select("doc").distinct(), "leaks").withColumnRenamed("doc", free_name(docs, "_leak"))
    doc = F.struct(docs[doc_id].alias("id"), F.xxhash64(docs[text]).alias("h"))
    return docs.join(checked_broadcast(gone), doc.eqNullSafe(gone[gone.columns[0]]), "left_anti")

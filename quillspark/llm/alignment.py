"""Alignment of two tokenizers by lockstep vectorised merging.

Every text is encoded by a byte-level BPE file (A) and a sentencepiece model (B).
At a single space between two other characters both tokenizers begin a new token
in any case, so a text is the sequence of its units between such spaces, and a
worker encodes each distinct unit once.  The tokens of many documents are merged
at once: one state vector holds a pointer into A's tokens and one into B's for
every document, or stretch of a long one; a step compares the byte offsets where
the tokens end, advances the pointer that lags (or both), emits a link and a cut
where they meet, and compacts away what is finished.

Links are counted per document and distinct id pair before anything is shuffled.
The corpus-wide counts of the pairs and each B id's highest count are an ordinary
aggregate; they meet the documents' pairs in an equi-join, broadcast only if the
table's measured size allows it.
"""

from __future__ import annotations

import re
import sys
import types
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillspark.llm.common import bounded_batches, checked_broadcast, staged
from quillspark.llm.transducer import byte_letters

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Units of a stretch that is merged as one, and units that are merged together.
STRETCH, BUFFER = 256, 1 << 17

#: Distinct units, and their characters, after which a worker forgets them and starts anew.
MOST_UNITS, MOST_CHARS = 1 << 19, 1 << 25

#: Characters of a text that are split into units at once.
SLICE = 1 << 20

#: Units are parted by a single space between two characters that are no white space.
SEAM = re.compile(r"(?<=\S) (?=\S)")


class Units(dict):
    """Distinct units, numbered as they come; ``new`` are those to encode."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        self[unit] = number = len(self)
        self.new.append(unit)
        return number


class Encoders:
    """Both tokenizers, and each id's bytes and decimal forms."""

    def __init__(self, a_path: str, b_path: str):
        import os

        import numpy as np
        import sentencepiece
        from tokenizers import Tokenizer
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = byte_letters()
        names = {i: s for s, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(letters.get(c, 63) for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.b_bytes = [bytes([int(s[3:5], 16)]) if self.b.is_byte(i) else s.replace("▁", " ").encode()
                        for i, s in ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))]
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)
        # A unit is encoded as it would be inside its text if no piece goes on behind a character and a space.
        self.parted = not any(re.search(r".▁", s.lstrip("▁")) for s in map(self.b.id_to_piece, range(self.b.get_piece_size())))
        self.forget()
        #: Decimal ids with what follows them: A inside and at the end of a group, B the same.
        n, m = len(self.a_bytes), len(self.b_bytes)
        self.written = [f"{i}," for i in range(n)] + [f"{i}|" for i in range(n)] + [f"{i}," for i in range(m)] + [
            f"{i};" for i in range(m)]
        self.at = (0, n, 2 * n, 2 * n + m)

    def forget(self) -> None:
        """Start with no unit known."""
        self.units, self.chars = Units(), 0
        #: Of each unit: where its ids begin in the flat lists, and whether both tokenizers give it back whole.
        self.a_ids, self.b_ids, self.a_from, self.b_from = array("i"), array("i"), array("q", [0]), array("q", [0])
        self.whole = array("b")

    def split(self, text: str) -> list[int]:
        return list(map(self.units.__getitem__, SEAM.split(text) if self.parted else [text]))

    def encode_new(self) -> None:
        texts, self.units.new = self.units.new, []
        self.chars += sum(map(len, texts))
        a = self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)
        for t, x, y in zip(texts, a, self.b.encode(texts, num_threads=1)):
            x, whole = x.ids, b" " + t.encode()
            self.whole.append(b"".join(map(self.a_bytes.__getitem__, x)) == whole
                              and b"".join(map(self.b_bytes.__getitem__, y)) == whole)
            self.a_ids.extend(x)
            self.b_ids.extend(y)
            self.a_from.append(len(self.a_ids))
            self.b_from.append(len(self.b_ids))


def gathered(flat, start, size):
    """The stretches ``flat[start : start + size]`` one after the other."""
    import numpy as np
    ends = np.cumsum(size)
    return flat[np.repeat(start - (ends - size), size) + np.arange(ends[-1])].astype(np.int64)


def lockstep(a_end, b_end, a_from, b_from, a_to):
    """Marks of the A and of the B tokens that end together, for parts ``[from, to)`` of equal bytes.

    ``a_end`` and ``b_end`` are the byte offsets where the tokens of all parts end.
    """
    import numpy as np
    a_cut, b_cut = np.zeros(len(a_end), bool), np.zeros(len(b_end), bool)
    live = a_from < a_to
    a, b, stop = a_from[live], b_from[live], a_to[live]
    while len(a):
        x, y = a_end[a], b_end[b]
        meet = x == y
        a_cut[a[meet]] = True
        b_cut[b[meet]] = True
        a = a + (x <= y)
        b = b + (y <= x)
        live = a < stop
        if not live.all():
            a, b, stop = a[live], b[live], stop[live]
    return a_cut, b_cut


class Document:
    """What is known so far of one document."""

    def __init__(self):
        import hashlib
        self.whole, self.n_a, self.n_b, self.groups, self.pairs = True, 0, 0, 0, []
        self.digest, self.empty = hashlib.sha256(), True

    def add(self, n_a, n_b, written: str, pairs) -> None:
        self.n_a += n_a
        self.n_b += n_b
        self.groups += len(pairs)
        self.pairs.append(pairs)
        self.digest.update((written if self.empty else ";" + written).encode())
        self.empty = False

    def row(self) -> tuple:
        """``n_a, n_b, n_groups, groups_sha256, pairs, counts``; a text that is not given back whole has no tokens."""
        import numpy as np
        if not self.whole or self.empty:
            return 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs, counts = np.unique(np.concatenate(self.pairs), return_counts=True)
        return self.n_a, self.n_b, self.groups, self.digest.hexdigest(), pairs, counts


def align_units(encoders: Encoders, owners: list[Document], units: list[list[int]], stretch: int) -> None:
    """Merge the documents' ``units`` in lockstep and hand each result to its document."""
    import numpy as np
    encoders.encode_new()
    whole = np.array(encoders.whole, bool)
    kept = []
    for owner, own in zip(owners, units):
        own = np.array(own, np.int64)
        if owner.whole and whole[own].all():
            kept.append((owner, own))
        else:
            owner.whole = False
    if not kept:
        return
    every = np.concatenate([own for _, own in kept])
    doc_at = np.cumsum([0] + [len(own) for _, own in kept])
    a_from, b_from = np.array(encoders.a_from), np.array(encoders.b_from)
    a_size, b_size = (a_from[1:] - a_from[:-1])[every], (b_from[1:] - b_from[:-1])[every]
    a_ids = gathered(np.array(encoders.a_ids), a_from[every], a_size)
    b_ids = gathered(np.array(encoders.b_ids), b_from[every], b_size)
    a_at, b_at = np.append(0, np.cumsum(a_size)), np.append(0, np.cumsum(b_size))
    lanes = np.concatenate([np.arange(x, y, stretch) for x, y in zip(doc_at, doc_at[1:])])
    a_cut, b_cut = lockstep(np.cumsum(encoders.a_size[a_ids]), np.cumsum(encoders.b_size[b_ids]), a_at[lanes], b_at[lanes],
                            a_at[np.append(lanes[1:], len(every))])
    a_last, b_last = np.flatnonzero(a_cut), np.flatnonzero(b_cut)
    pairs = a_ids[a_last] << 32 | b_ids[b_last]
    # Every token's place when each group's A tokens and then its B tokens are written.
    a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
    order = np.empty(len(a_ids) + len(b_ids), np.int64)
    base = encoders.at
    order[np.arange(len(a_ids)) + np.append(0, b_last + 1)[a_group]] = a_ids + np.where(a_cut, base[1], base[0])
    order[np.arange(len(b_ids)) + (a_last + 1)[b_group]] = b_ids + np.where(b_cut, base[3], base[2])
    a_at, b_at = a_at[doc_at], b_at[doc_at]
    group_at = np.searchsorted(a_last, a_at)
    written = encoders.written
    for i, (owner, _) in enumerate(kept):
        text = "".join(map(written.__getitem__, order[a_at[i] + b_at[i]:a_at[i + 1] + b_at[i + 1]].tolist()))
        owner.add(int(a_at[i + 1] - a_at[i]), int(b_at[i + 1] - b_at[i]), text[:-1], pairs[group_at[i]:group_at[i + 1]])


def align_texts(encoders: Encoders, texts, stretch: int = STRETCH, buffer: int = BUFFER) -> list[tuple]:
    """``Document.row()`` of each text."""
    found, owners, held, length = [], [], [], 0

    def flush() -> None:
        nonlocal owners, held, length
        align_units(encoders, owners, held, stretch)
        owners, held, length = [], [], 0
        if len(encoders.units) > MOST_UNITS or encoders.chars > MOST_CHARS:
            encoders.forget()
    for text in texts:
        found.append(Document())
        at, seen = 0, text or ""
        while at < len(seen):
            # A very long text comes in slices that end at a seam.
            seam = SEAM.search(seen, at + SLICE) if encoders.parted and len(seen) - at > SLICE else None
            end = seam.start() if seam else len(seen)
            own = encoders.split(seen[at:end])
            at = end + 1
            owners.append(found[-1])
            held.append(own)
            length += len(own)
            if length >= buffer:
                flush()
    if held:
        flush()
    return [d.row() for d in found]


def encoders_of(a_path: str, b_path: str) -> Encoders:
    """The worker's tokenizers; a worker keeps them from task to task."""
    kept = sys.modules.setdefault("_kept_encoders", types.ModuleType("_kept_encoders")).__dict__
    key = f"{a_path}\n{b_path}"
    if key not in kept:
        kept[key] = Encoders(a_path, b_path)
    return kept[key]


def alignments(docs: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id",
               stretch: int = STRETCH, buffer: int = BUFFER) -> DataFrame:
    """``row, doc_id, n_a, n_b, n_groups, groups_sha256, pairs, counts`` for every row of ``docs``, staged.

    ``pairs`` holds the distinct linked ids (``a << 32 | b``) and ``counts`` how
    often the document links them.  ``row`` numbers the rows, so repeated and null
    ids stay apart.
    """
    bounded_batches(docs.sparkSession)

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoders = encoders_of(a_path, b_path)
        for frame in frames:
            found = align_texts(encoders, frame["text"], stretch, buffer)
            out = pd.DataFrame(found, columns=["n_a", "n_b", "n_groups", "groups_sha256", "pairs", "counts"])
            yield pd.concat([frame[["row", "doc_id"]], out], axis=1)
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").alias("doc_id"),
                       F.col(f"`{text}`").alias("text"))
    return staged(rows.mapInPandas(align, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, "
                                          "groups_sha256 string, pairs array<long>, counts array<long>"), "alignments")


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, a, b, count, best``: links of each id pair in the corpus, and whether no other pair of ``b`` has more."""
    each = found.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).groupBy(F.col("p.pairs").alias("pair")).agg(
        F.sum("p.counts").alias("count"))
    each = staged(each.select("pair", F.shiftright("pair", 32).cast("int").alias("a"),
                              F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("b"), "count"), "pair-counts")
    most = each.groupBy("b").agg(F.max("count").alias("most"))
    return each.join(most, "b").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", doc_id: str = "doc_id", **settings) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row of ``docs``.

    Tokens of A (``a_path``, a byte-level BPE file, fed a space and the text) and
    of B (``b_path``, a sentencepiece model that adds the space itself) are cut
    into groups at the byte offsets where both end.  No token is empty, so each
    cut links exactly one A token with one B token, the last ones of its group.
    ``n_best`` counts the links whose id pair has the highest corpus-wide count of
    its B id (ties included), ``count_sum`` sums the pairs' counts over the links.

    Null and empty texts, and texts that a tokenizer does not give back whole, have
    no tokens: zeros and an empty digest, and their links count nowhere.  Texts of
    any length are aligned whole; repeated rows, and rows of one or no id, each
    give a row of their own; an empty table stays empty; other columns are left out.
    """
    found = alignments(docs, a_path, b_path, text, doc_id, **settings)
    table = checked_broadcast(staged(pair_counts(found).select("pair", "count", "best"), "pair-table"))
    links = found.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256",
                         F.explode_outer(F.arrays_zip("pairs", "counts")).alias("p"))
    links = links.select("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", F.col("p.pairs").alias("pair"),
                         F.col("p.counts").alias("n"))
    # `row` alone would do; grouping by the carried columns too spares a sort.
    sums = links.join(table, "pair", "left").groupBy("row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_links"),
        F.coalesce(F.sum(F.when(F.col("best"), F.col("n"))), F.lit(0)).alias("n_best"),
        F.coalesce(F.sum(F.col("n") * F.col("count")), F.lit(0)).alias("count_sum"))
    return sums.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

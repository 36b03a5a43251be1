"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of a bounded sample of labelled rows inside Spark tasks
and sums them per (language, bucket); the log-probability matrix, ``BUCKETS`` x
languages, is the model and is broadcast.  A batch of texts is scored at once with
numpy, as a sparse matrix of n-gram buckets times the log probabilities.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import bounded_batches

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hash buckets (2^BITS) and n-gram lengths.
BITS, LENGTHS = 15, (1, 2, 3)

#: Expected number of training rows per language, drawn by a hash of doc_id.
TRAIN_ROWS = 3000

#: Characters of a piece of a long text, and grams that are scored at once, about.
PIECE, BATCH_GRAMS = 1 << 18, 1 << 19

#: Most languages: the matrix, 128 KB for each of them, is broadcast.
MOST_LANGS = 512

UNKNOWN = "und"


def _is_letter():
    import numpy as np
    return np.array([chr(c).isalpha() for c in range(0x10000)], bool)


class Grams:
    """Text -> arrays of hash buckets."""

    def __init__(self, bits: int = BITS, lengths: tuple[int, ...] = LENGTHS):
        self.bits, self.lengths, self.letters = bits, lengths, None

    def _is_letter(self, c):
        import numpy as np
        if self.letters is None:
            self.letters = _is_letter()
        letter = self.letters[np.minimum(c, 0xFFFF)]
        far = np.flatnonzero(c > 0xFFFF)
        if len(far):
            kinds, back = np.unique(c[far], return_inverse=True)
            letter[far] = np.array([chr(k).isalpha() for k in kinds.tolist()], bool)[back]
        return letter

    def buckets(self, text: str) -> Iterator:
        """Buckets of all n-grams of the lower-cased text, an array per piece and
        length.  Letters are what ``str.isalpha`` says; runs of anything else count
        as one space after a letter.  A gram across two pieces belongs to the second."""
        import numpy as np
        longest = max(self.lengths)
        before, in_word = np.empty(0, np.uint64), False
        for at in range(0, max(len(text), 1), PIECE):
            c = np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
            if not len(c):
                continue
            letter = self._is_letter(c)
            keep = letter.copy()
            keep[1:] |= letter[:-1]
            keep[0] |= in_word
            in_word = bool(letter[-1])
            c = np.concatenate([before, np.where(letter, c, 32).astype(np.uint64)[keep]])
            h = np.zeros(len(c), np.uint64)
            for n in range(1, longest + 1):
                if len(c) < n:
                    break
                h = (h[:len(c) - n + 1] if n == 1 else h[:-1]) * np.uint64(0x100000001B3) + c[n - 1:]
                if n in self.lengths:
                    # Grams that end in what stood before were counted with it.
                    new = h[max(0, len(before) - n + 1):]
                    yield ((new + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)
            before = c[len(c) - min(len(c), longest - 1):]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    """``langs`` and, for each bucket, the log probability under each of them."""
    langs: list[str]
    prior: object
    logp: object
    bits: int
    lengths: tuple[int, ...]

    def predict(self, texts, grams: Grams) -> list[tuple[str, float]]:
        """Most probable language of each text and its posterior; ``und`` and 0 if there
        is no text, no letter in it, or no language was learned.

        A batch is one sparse matrix, a row per text: its bucket numbers one after the
        other and where each row begins.  Its product with the log probabilities is
        one gather and one segmented sum; very many grams go in several of them.
        """
        import numpy as np
        texts = list(texts)
        known = [i for i, t in enumerate(texts) if t and self.langs and has_letter(t)]
        total = np.tile(np.asarray(self.prior, float), (len(texts), 1))
        held, rows, size = [], [], 0

        def add() -> None:
            nonlocal held, rows, size
            if held:
                starts = np.cumsum([0] + [len(x) for x in held[:-1]])
                sums = np.add.reduceat(self.logp[np.concatenate(held)], starts, axis=0, dtype=np.float64)
                np.add.at(total, rows, sums)
            held, rows, size = [], [], 0
        for i in known:
            for idx in grams.buckets(texts[i]):
                if len(idx):
                    held.append(idx)
                    rows.append(i)
                    size += len(idx)
                if size >= BATCH_GRAMS:
                    add()
        add()
        out = [(UNKNOWN, 0.0)] * len(texts)
        for i in known:
            p = np.exp(total[i] - total[i].max())
            best = int(p.argmax())
            out[i] = self.langs[best], float(p[best] / p.sum())
        return out


def train(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_lang: int = TRAIN_ROWS,
          bits: int = BITS, lengths: tuple[int, ...] = LENGTHS, smoothing: float = 0.5) -> Model:
    """Learn from labelled ``rows``.

    Rows with a null text or language are left out.  About ``per_lang`` rows of
    each language are used, those with the smallest hashes of ``key``; the
    language counts, which give the priors, cover all rows.  One row per language
    reaches the driver, its ``2 ** bits`` counts packed in 4 bytes each.
    """
    import numpy as np
    spark = rows.sparkSession
    bounded_batches(spark)
    rows = rows.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"),
                       F.xxhash64(F.lit(5), F.col(f"`{key}`")).alias("h")).where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(MOST_LANGS + 1).collect()}
    if len(sizes) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} different values of {lang}: not a language column?")
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros(0), np.zeros((1 << bits, 0), np.float32), bits, lengths)
    spread = F.shiftright("h", 32) + F.lit(2 ** 31)
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(int(2 ** 32 * min(1.0, per_lang / sizes[k]))))])
    sample = rows.where(spread < F.element_at(share, F.col("lang")))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grams, seen = Grams(bits, lengths), {}
        for frame in frames:
            for t, k in zip(frame["text"], frame["lang"]):
                own = seen.setdefault(k, np.zeros(1 << bits, np.int64))
                for idx in grams.buckets(t):
                    own += np.bincount(idx.astype(np.int64), minlength=1 << bits)
        for k, own in seen.items():
            at = np.nonzero(own)[0]
            yield pd.DataFrame({"lang": k, "bucket": at, "n": own[at]})

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros(1 << bits, np.float32)
        own[frame["bucket"].to_numpy()] = frame["n"]
        return pd.DataFrame({"lang": frame["lang"].iloc[:1], "counts": [own.tobytes()]})

    counts = np.zeros((1 << bits, len(langs)))
    for r in (sample.select("text", "lang").mapInPandas(count, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
              .groupBy("lang").applyInPandas(pack, "lang string, counts binary").collect()):
        counts[:, langs.index(r["lang"])] = np.frombuffer(r["counts"], np.float32)
    logp = np.log(counts + smoothing) - np.log(counts.sum(0) + smoothing * (1 << bits))
    prior = np.log(np.array([sizes[k] for k in langs], float) / sum(sizes.values()))
    return Model(langs, prior, logp.astype(np.float32), bits, lengths)


def predict_column(spark: SparkSession, model: Model, text: str = "text") -> Column:
    """Struct ``lang, score`` of a text column, by the broadcast model."""
    bounded_batches(spark)
    # Plain values: unlike the function, a broadcast is pickled by reference.
    shared = spark.sparkContext.broadcast((model.langs, model.prior, model.logp, model.bits, model.lengths))

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = Model(*shared.value)
        grams = Grams(m.bits, m.lengths)
        for texts in batches:
            yield pd.DataFrame(m.predict(texts, grams), columns=["lang", "score"])
    return predict(F.col(f"`{text}`"))


def fold(doc_id: str = "doc_id", parts: int = 3) -> Column:
    """crc32 of the id as text, modulo ``parts``."""
    return F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % parts


def identify(docs: DataFrame, training: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
             out: str = "language", **settings) -> DataFrame:
    """``docs`` with a struct ``out`` of ``lang`` and ``score``, learned from ``training``.

    Null, empty and letterless texts are ``und`` with score 0; any other text
    gets a learned language and a score in (0, 1].  Repeated rows are scored
    alike; empty tables stay empty.
    """
    model = train(training, text, lang, doc_id, **settings)
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out],
                       predict_column(docs.sparkSession, model, text).alias(out))

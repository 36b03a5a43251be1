"""Toxicity: gradient-boosted trees over dense features, calibrated.

Features of a text: densities of a lexicon, how often its words stand near a
second-person word, shares of capitals and punctuation, obfuscation rates.  The
lexicon is learned: the words that the labelled training rows set apart (a caller
may add words of its own).  Spark ML fits the trees on part of a bounded sample of
those rows, less exact and near copies, and an isotonic curve on the rest, which turns the trees' output into a
probability.
"""

from __future__ import annotations

import re
import sys
from dataclasses import dataclass, field

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillspark.llm.common import bounded_batches, checked_broadcast, free_name, staged
from quillspark.llm.simhash import near_duplicates

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Expected number of labelled rows that are used, drawn by a hash of the id; half of them of each class if it has so many.
TRAIN_ROWS = 20000
#: Of them, one part in so many calibrates.
CALIBRATION = 4
#: Learned words: at most so many, each in so many different toxic texts, with log odds so far above
#: the others' (also in standard deviations).
LEXICON_SIZE, LEXICON_TEXTS, LEXICON_ODDS, LEXICON_Z = 200, 5, 1.0, 5.0
TREES, DEPTH, STEP = 20, 3, 0.3
#: A leaf holds at least so many different texts, however many there are (less if few are toxic).
LEAF_TEXTS = 5
#: Words on either side in which a second-person word counts as near.
NEAR = 3

SECOND_PERSON = frozenset(("you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "tu", "te", "toi",
                           "ton", "ta", "vous", "votre", "tú", "ti", "usted", "ustedes", "vos"))
#: Signs that stand for letters.
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, "'": None})
WORD = re.compile(r"[^\W_]+(?:[@$*!'][^\W_]+)*")
RUN = re.compile(r"([^\W\d_])\1\1")
FEATURES = ("lexicon_density", "lexicon_count", "lexicon_weight", "lexicon_top", "near_you", "capitals", "shouted_words",
            "exclamations", "punctuation", "obfuscated", "letter_runs", "length", "word_length")


def features(text: str | None, lexicon: dict[str, float]) -> list[float]:
    """Dense features of a whole text; all zero for null and empty texts."""
    import math
    if not text:
        return [0.0] * len(FEATURES)
    words = WORD.findall(text.lower())
    n = len(words) or 1
    hits, odd = [], 0
    for i, w in enumerate(words):
        if w in lexicon:
            hits.append((i, w))
        elif not w.isalpha() and not w.isdigit():
            plain = w.translate(LEET)
            odd += plain.isalpha()
            if plain in lexicon:
                hits.append((i, plain))
    weights = [lexicon[w] for _, w in hits]
    near = sum(1 for i, _ in hits if not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR):i + NEAR + 1]))
    size = len(text)
    kept = re.sub(r"[\w\s]+", "", text)
    upper = sum(1 for c in re.findall(r"[^\W\d_]", text) if c.isupper()) if not text.islower() else 0
    return [len(hits) / n, math.log1p(len(hits)), sum(weights) / n, max(weights, default=0.0), near / n, upper / size,
            sum(1 for w in text.split() if len(w) > 2 and w.isupper()) / n, text.count("!") / size, len(kept) / size, odd / n,
            len(RUN.findall(text)) / n, math.log1p(len(words)), sum(map(len, words)) / n]


def features_column(lexicon: dict[str, float], text: str = "text") -> Column:
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: features(t, lexicon))
    return of(F.col(f"`{text}`"))


@dataclass
class Model:
    """``rate`` alone scores if the labels have one class only."""
    lexicon: dict[str, float]
    rate: float
    trees: object = None
    curve: object = field(default=None)


def learn_lexicon(rows: DataFrame, size: int = LEXICON_SIZE, least: int = LEXICON_TEXTS, least_odds: float = LEXICON_ODDS,
                  z: float = LEXICON_Z, words: tuple[str, ...] = ()) -> dict[str, float]:
    """Word -> weight, from ``rows(id, text, label)`` without copies; ``words`` are in it anyway.

    A word's evidence is the number of toxic texts and of others that hold it.
    Words enter that ``least`` toxic texts hold and whose log odds lie
    ``least_odds`` above the others', with a signed root of the likelihood ratio
    of at least ``z``: a rare word that only toxic texts hold passes however
    many labels there are.  At most ``size`` of them reach the driver.
    """
    w = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda x: x != "")
    seen = (rows.select("id", "label", F.explode(w).alias("word")).distinct().groupBy("word")
            .agg(F.sum("label").cast("double").alias("a"), F.sum(1 - F.col("label")).cast("double").alias("b")))
    seen = staged(seen.where(F.col("a") >= least), "toxic-words")
    pos, neg = (float(x or 0) for x in rows.agg(F.sum("label"), F.sum(1 - F.col("label"))).first())
    a, b = F.col("a"), F.col("b")
    odds = F.log((a + 0.5) / (pos + 1 - a)) - F.log((b + 0.5) / (neg + 1 - b))

    def part(x, total, rate):
        return F.when(x > 0, x * F.log(x / (total * rate))).otherwise(0.0)
    rate = (a + b) / (pos + neg)
    ratio = part(a, pos, rate) + part(b, neg, rate) + part(pos - a, pos, 1 - rate) + part(neg - b, neg, 1 - rate)
    best = (seen.select("word", odds.alias("w"), F.sqrt(F.greatest(2 * ratio, F.lit(0.0))).alias("z"))
            .where((F.col("w") >= least_odds) & (F.col("z") >= z)).orderBy(F.desc("z"), "word").limit(size).collect())
    out = {k: 2.0 for k in words}
    out.update({r["word"]: float(r["w"]) for r in best})
    return out


def sampled(labels: DataFrame, key: str = "doc_id", label: str = "toxic", bound: int = TRAIN_ROWS, seed: int = 11) -> DataFrame:
    """About ``bound`` of the labelled rows, of each class those with the smallest hashes of ``key``,
    as a table whose size the planner knows; rows with a null label are left out.

    A class of at most half the bound is taken whole.  ``weight`` says how many
    labelled rows a row stands for.
    """
    labels = labels.where(F.col(f"`{label}`").isNotNull())
    positive = F.col(f"`{label}`").cast("int") > 0
    n, toxic = labels.agg(F.count(F.lit(1)), F.count_if(positive)).first()
    few = min(toxic, n - toxic)
    taken = min(few, bound // 2)
    share = {few == toxic: taken / max(1, few), few != toxic: min(1.0, (bound - taken) / max(1, n - few))}
    h = F.shiftright(F.xxhash64(F.lit(seed), F.col(f"`{key}`")), 32) + F.lit(2 ** 31)
    limit = lambda c: F.lit(int(2 ** 32 * share[c]))
    weight = F.when(positive, 1 / max(share[True], 1e-300)).otherwise(1 / max(share[False], 1e-300))
    return checked_broadcast(staged(labels.where(h < F.when(positive, limit(True)).otherwise(limit(False)))
                                    .withColumn("weight", weight), "toxic-labels"))


def different(rows: DataFrame) -> DataFrame:
    """``rows(text, label, weight)`` less exact and near copies: of each component of near copies one row per label."""
    rows = staged(rows.withColumn("id", F.monotonically_increasing_id()), "toxic-rows")
    found = near_duplicates(rows, doc_id="id").select(F.col("doc_id").alias("id"), "component_id")
    # A component may hold much of the sample: the ids meet the texts only after the reduction.
    first = rows.select("id", "label").join(found, "id").groupBy("component_id", "label").agg(F.min("id").alias("id"))
    return rows.join(first.select("id", "component_id"), "id")


def train(rows: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", trees: int = TREES,
          depth: int = DEPTH, step: float = STEP, seed: int = 11, words: tuple[str, ...] = ()) -> Model:
    """Fit on labelled ``rows``, a sample of bounded size; null texts are empty,
    rows with a null label are left out.

    Exact and near copies are dropped first; a row's ``weight``, if there is
    such a column, weighs it in the trees and in the calibration.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import IsotonicRegression
    bounded_batches(rows.sparkSession)
    weight = F.col("weight").cast("double") if "weight" in rows.columns else F.lit(1.0)
    rows = rows.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), F.col(f"`{label}`").cast("int").alias("label"),
                       weight.alias("weight"))
    rows = staged(rows.where("label is not null"), "toxic-sample")
    n, toxic = rows.agg(F.sum("weight"), F.sum(F.col("label") * F.col("weight"))).first()
    n, toxic = n or 0, toxic or 0
    rate = (toxic + 1) / (n + 2)
    if not toxic or toxic == n:
        return Model({w: 2.0 for w in words}, rate)
    # Near copies of different labels are on the same side.
    part = F.pmod(F.xxhash64(F.lit(seed + 1), F.col("component_id")), F.lit(CALIBRATION))
    rows = staged(different(rows).select("id", "text", "label", "weight", (part == 0).alias("held")), "toxic-texts")
    if rows.where("not held").select("label").distinct().count() < 2:
        rows = rows.withColumn("held", F.lit(False))  # too few texts to hold any back
    lexicon = learn_lexicon(rows.where("not held"), words=words)
    data = staged(rows.select("held", F.col("label").cast("double").alias("label"), "weight",
                              features_column(lexicon).alias("f")), "toxic-features")
    data = data.select("held", "label", "weight", array_to_vector("f").alias("f"))
    fit = data.where("not held")
    least = max(1, min(LEAF_TEXTS, fit.where("label = 1").count() // 4))
    model = GBTClassifier(featuresCol="f", labelCol="label", weightCol="weight", maxIter=trees, maxDepth=depth, stepSize=step,
                          seed=seed, minInstancesPerNode=least).fit(fit)
    held = _raw(model, data.where("held"))
    curve = (IsotonicRegression(featuresCol="p", labelCol="label", weightCol="weight").fit(held)
             if held.select("label").distinct().count() == 2 else None)
    return Model(lexicon, rate, model, curve)


def _raw(trees, data: DataFrame) -> DataFrame:
    """``data`` with ``p``: the trees' own probability from the vector ``f``."""
    from pyspark.ml.functions import vector_to_array
    out = trees.transform(data)
    return out.select(*data.columns, vector_to_array("probability")[1].alias("p"))


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "toxicity") -> DataFrame:
    """``docs`` with ``out``, 0 to 1.

    Null and empty texts are scored like any text, by features that are all
    zero.  A thousandth of the uncalibrated probability is mixed in, so that the
    calibration's steps leave no ties between different outputs.
    """
    from pyspark.ml.functions import array_to_vector
    bounded_batches(docs.sparkSession)
    cols = [c for c in docs.columns if c != out]
    if model.trees is None:
        return docs.select(*[F.col(f"`{c}`") for c in cols], F.lit(float(model.rate)).alias(out))
    row = free_name(docs, "_row")
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols if c != text]).alias(row),
                       *([F.col(f"`{text}`").alias("_text")]),
                       array_to_vector(features_column(model.lexicon, text)).alias("f"))
    held = _raw(model.trees, held)
    if model.curve is None:
        value = F.col("p")
    else:
        held = model.curve.setPredictionCol("_calibrated").transform(held)
        value = 0.999 * F.least(F.greatest(F.col("_calibrated"), F.lit(0.0)), F.lit(1.0)) + 0.001 * F.col("p")
    return held.select(*[F.col("_text").alias(text) if c == text else F.col(f"{row}.`{c}`").alias(c) for c in cols],
                       value.alias(out))

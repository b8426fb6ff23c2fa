"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

The lexicon, the trees and the calibration are learned from a bounded sample of labelled rows; all
documents are scored, whole. Features are densities and rates, so that a text's length alone says
nothing: words of the lexicon, second-person words, how near the two stand, capitals, punctuation,
repeated marks, obfuscated spellings.

The lexicon holds words and word beginnings that the labels tie to toxicity beyond chance, added to a
short fixed list. Words are compared in lower case, with usual letter substitutes undone.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkindex.llm.common import fresh, quoted, staged
from linkindex.llm.tokens import Cache

#: Labelled rows that lexicon, trees and calibration are fitted on, at most.
SAMPLE_ROWS = 20_000
#: Words and beginnings of the lexicon, at most.
LEXICON_SIZE = 5_000
#: Of a word's documents the share that must be toxic, and the deviations below its estimate.
LEXICON_SHARE, LEXICON_DEVIATIONS = 0.5, 2.5
#: Lengths of word beginnings that can enter the lexicon.
STEMS = range(4, 9)
#: Words between a second-person word and one of the lexicon that still count as near.
NEAR = 3

# Plain insults, second-person words and letter substitutes.
INSULTS = frozenset(
    "bastard clown creep disgusting dumb fool freak garbage idiot imbecile loser moron pathetic scum"
    " stupid trash ugly vermin worthless".split())
SECOND_PERSON = frozenset(
    "you your yours yourself yourselves u ur du dich dir dein deine deiner deinem deinen euch euer"
    " tu te toi ton tes vous votre vos ti tus usted ustedes vosotros vuestro".split())
SUBSTITUTES = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a",
                             "$": "s", "!": "i"})

FEATURES = ("lexicon", "lexicon_kinds", "second_person", "near", "capitals", "shouted", "punctuation",
            "repeats", "obfuscated", "digits")

_INNER_MARKS = re.compile(r"(?<=\w)[*.\-_](?=\w)")
_EDGES = ".,;:!?\"'()[]{}<>|*%&$#@~`-_=+/\\"
_REPEATS = re.compile(r"([^\w\s])\1")


def plain(word: str) -> tuple[str, bool]:
    """A word in lower case without marks and letter substitutes, and whether it had any inside."""
    bare = word.strip(_EDGES).lower()
    if bare.isalpha() or not any(c.isalpha() for c in bare):
        return bare, False
    undone = _INNER_MARKS.sub("", bare).translate(SUBSTITUTES)
    return undone, undone != bare


def stems(word: str) -> list[str]:
    return [word[:n] for n in STEMS if len(word) > n]


class Features:
    """Dense features of whole texts, from cached facts on each distinct word."""

    def __init__(self, words: frozenset[str], beginnings: frozenset[str]):
        self.words, self.beginnings = words, beginnings
        self.facts = Cache(self.fact, 100_000)

    def fact(self, word: str) -> int:
        """Counts of one word, side by side in one number: sums of numbers are sums of counts."""
        bare, altered = plain(word)
        hit = bool(bare) and (bare in self.words or any(s in self.beginnings for s in stems(bare)))
        marks = sum(not c.isalnum() for c in word)
        capitals = sum(c.isupper() for c in word)
        shouted = capitals == len(word.strip(_EDGES)) and capitals > 2
        flags = (hit, hit and altered, bare in SECOND_PERSON, shouted, capitals, marks,
                 sum(c.isdigit() for c in word), len(word), len(_REPEATS.findall(word)), 1)
        return sum(int(n) << (40 * k) for k, n in enumerate(flags))

    def of(self, text: str | None) -> list[float]:
        words = (text or "").split()
        facts = list(map(self.facts.__getitem__, words))
        total, mask = sum(facts), (1 << 40) - 1
        (hits, altered, second, shouted, capitals, marks, digits, chars, repeats, n) = (
            total >> (40 * k) & mask for k in range(10))
        if not n:
            return [0.0] * len(FEATURES)
        kinds = near = 0
        if hits:
            at = [i for i, f in enumerate(facts) if f & mask]
            kinds = len({plain(words[i])[0] for i in at})
            if second:
                you = np.array([i for i, f in enumerate(facts) if f >> 80 & mask])
                place = np.searchsorted(you, at)
                before = np.abs(you[np.maximum(place - 1, 0)] - at)
                after = np.abs(you[np.minimum(place, len(you) - 1)] - at)
                near = int((np.minimum(before, after) <= NEAR).sum())
        return [hits / n, kinds / (kinds + 3), second / n, near / n, capitals / chars, shouted / n,
                marks / chars, repeats / n, altered / n, digits / chars]


_made = cache(Features)


def _features(words: frozenset[str], beginnings: frozenset[str]) -> Features:
    """One per Python worker and lexicon."""
    features = _made(words, beginnings)
    features.facts.alone()
    return features


@dataclass(frozen=True)
class Model:
    """A fitted lexicon and the fitted stages that turn its features into a score."""

    words: frozenset[str]
    beginnings: frozenset[str]
    trees: PipelineModel


def learn_lexicon(texts: DataFrame, size: int = LEXICON_SIZE) -> tuple[frozenset, frozenset]:
    """Words and beginnings whose documents are toxic beyond chance, of ``text, label``.

    Kept are those of whose documents, by the lower end of Wilson's interval, at least
    ``LEXICON_SHARE`` are toxic; the highest ends first.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                words = {plain(w)[0] for w in (text or "").split()} - {""}
                found = {("w", w) for w in words} | {("b", s) for w in words for s in stems(w)}
                counts[label == 1].update(found)
            names = list(counts[True].keys() | counts[False].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in names], pa.string()), pa.array([w for _, w in names], pa.string()),
                 pa.array([counts[True][x] for x in names], pa.int64()),
                 pa.array([counts[False][x] for x in names], pa.int64())],
                names=["kind", "word", "toxic", "clean"])

    z2 = LEXICON_DEVIATIONS**2
    n = F.col("toxic") + F.col("clean")
    share = F.col("toxic") / n
    low = (share + z2 / (2 * n) - LEXICON_DEVIATIONS * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))
           ) / (1 + z2 / n)
    kept = (
        texts.select("text", "label").mapInArrow(counted, "kind string, word string, toxic long, clean long")
        .groupBy("kind", "word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter("toxic > 0").withColumn("low", low).filter(F.col("low") >= LEXICON_SHARE)
        .orderBy(F.desc("low"), "kind", "word").limit(size).select("kind", "word").collect()
    )
    return (frozenset(r["word"] for r in kept if r["kind"] == "w") | INSULTS,
            frozenset(r["word"] for r in kept if r["kind"] == "b"))


def with_features(docs: DataFrame, words: frozenset, beginnings: frozenset, text: Column,
                  out: str) -> DataFrame:
    """``docs`` with an array of features in the column ``out``."""
    lexicon = docs.sparkSession.sparkContext.broadcast((words, beginnings))  # bounded by LEXICON_SIZE

    @F.pandas_udf("array<double>")
    def features(texts: pd.Series) -> pd.Series:
        of = _features(*lexicon.value).of
        return texts.map(of, na_action=None)

    return docs.withColumn(out, features(F.coalesce(text, F.lit(""))))


def remainder(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % 5


def sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``text, label, part``: at most ``rows`` labelled rows outside the held-out fold, in an order
    of hashes. Rows without a label, and labels without a row, take no part; of an id labelled twice
    the higher label counts, of an id with several rows the lowest text."""
    fold = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col("toxic").cast("int").alias("label")).dropna()
    fold = fold.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = (
        fold.withColumn("part", remainder(F.col("doc_id"))).filter("part != 0")
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    # one row an id, reduced before the shuffle: repeated rows do not widen the sample
    return staged(texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label", "part")
                  .agg(F.min("text").alias("text")).select("text", "label", "part"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model | None:
    """Fit on the sample: three folds for lexicon and trees, the fourth for the calibration.

    Without any toxic or any clean row there is nothing to learn, and no model.
    """
    rows_of = sample(docs, labels, rows)
    counts = {r["label"]: r["n"] for r in rows_of.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
              .collect()}  # two rows
    if not counts.get(0) or not counts.get(1):
        return None
    learned = rows_of.filter("part != 4")
    words, beginnings = learn_lexicon(learned)
    data = staged(with_features(rows_of, words, beginnings, F.col("text"), "features")
                  .select("label", "part", *(F.col("features")[k].alias(f) for k, f in enumerate(FEATURES))).coalesce(2))  # of SAMPLE_ROWS at most
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="vector")
    trees = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=10, maxDepth=3, stepSize=0.3,
                          seed=7).fit(assembler.transform(data.filter("part != 4")))
    # calibrated on the rows that the trees have not seen; on all where the fold lacks a label
    fold = data.filter("part = 4")
    if fold.select("label").distinct().count() < 2:
        fold = data
    raw = trees.transform(assembler.transform(fold)).select(
        vector_to_array("probability")[1].alias("raw"), F.col("label").cast("double").alias("label"))
    # one weighted row a score: most clean texts share one, and the fit deals rows by score
    raw = raw.groupBy("raw").agg(F.avg("label").alias("label"), F.count(F.lit(1)).cast("double").alias("weight"))
    curve = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight",
                               predictionCol="score").fit(raw)
    return Model(words, beginnings, PipelineModel([assembler, trees, curve]))


def scored(docs: DataFrame, model: Model | None, out: str, *, text_column: str = "text") -> DataFrame:
    """``docs`` with the score, from 0 to 1, in the column ``out``; no shuffle. 0 without a model."""
    if model is None:
        return docs.withColumn(out, F.lit(0.0))
    assembler, trees, curve = model.trees.stages
    packed = fresh(docs, "packed")
    key = fresh(docs, "key")
    # only the features go through the trees: no column of the documents can clash with theirs
    frame = docs.select(F.struct(*(quoted(c) for c in docs.columns)).alias(key),
                        quoted(text_column).alias(packed))
    frame = with_features(frame, model.words, model.beginnings, F.col(packed), "features").drop(packed)
    frame = frame.select(key, *(F.col("features")[k].alias(f) for k, f in enumerate(FEATURES)))
    frame = trees.transform(assembler.transform(frame)).withColumn(
        "raw", vector_to_array("probability")[1])
    frame = curve.transform(frame).select(key, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")).alias("score"))
    return frame.select(*(F.col(key).getField(c).alias(c) for c in docs.columns),
                        F.col("score").alias(out))


def score_documents(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row's whole text.

    Null and empty texts have features of 0 and the score that the model gives those. A null id counts
    as the empty text for the fold. Repeated rows each give a row; an empty table gives none; other
    columns, label, language and source among them, are no inputs.
    """
    model = fit(docs, labels, rows)
    narrow = docs.select(F.col("doc_id"), F.col("text"))
    return scored(narrow, model, "score").select(
        "doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    score = fresh(docs, "score")
    return scored(docs, fit(docs, labels), score).filter(F.col(score) < threshold).drop(score)

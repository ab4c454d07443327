"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The lexicon is learned, not given: words and word beginnings that stand in toxic texts far more often than chance says,
from one part of the labelled rows. Another part trains the trees, a third the calibration, so none of the three sees
its own errors. Labelled rows of the held-out fold are never read. Features are densities of the lexicon by strength,
second-person words and their nearness to lexicon words, shares of capitals, punctuation, digits and obfuscated words.

Defined results: null and empty texts have the features of an empty text and get a score like any other; null labels and
labels without a document are not used; repeated labels count once each; rows that repeat are scored once each; without
labels of both classes every score is the share of toxic labels (0 without any); an empty table gives no rows; of other
columns only doc_id and text are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import limit_for, spread_bits, stored

#: At most about so many labelled rows are used to fit (chosen by a hash of their id); lexicon entries kept.
LABELLED = 16_000
LEXICON = 2_000
FOLDS, HELD_OUT = 5, 0
_LEXICON_FOLDS, _TREE_FOLDS, _CALIBRATION_FOLDS = (1, 2), (3,), (4,)
_SURE = 5.0
_NEARNESS = 4
_TREES, _DEPTH, _RATE = 24, 4, 0.2
_CACHE = 200_000
#: Letters of a word at most; longer runs of letters are looked up from every letter on.
LONGEST_WORD = 40

#: Second-person words of the languages in use.
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine deiner ihr euch tu toi te ton ta tes vous votre vos tú ti usted ustedes vosotros tus".split())
#: Characters that stand for letters in disguised words.
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")
_SIGNS = re.compile(r"[\W\d_]+")


def fold(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % folds


def plain_word(word: str) -> tuple[str, bool]:
    """The letters of a lower-case word, and whether signs or digits inside it were hiding them."""
    core = word.strip(".,;:!?\"'()[]{}<>*#%&$|-_…")
    if core.isalpha():
        return core, False
    letters = _SIGNS.sub("", core.translate(LOOKALIKES))
    known = _SIGNS.sub("", core)
    return letters, bool(known) and len(letters) >= 3 and "://" not in core and sum(map(str.isdigit, core)) <= 2 * len(known)


def _parts(word: str) -> Iterator[str]:
    """What a run of characters without blanks is made of: the letters between signs, and of letters too many for a word
    what begins at each of them."""
    for part in _SIGNS.split(word):
        if len(part) > LONGEST_WORD:
            yield from (part[i : i + 8] for i in range(len(part)))
        elif len(part) < len(word):
            yield part


@dataclass(frozen=True)
class Lexicon:
    """Weights of whole words (key ends in a blank) and word beginnings."""

    weight: dict[str, float]

    def of(self, word: str) -> float:
        get = self.weight.get
        return max([get(word + " ", 0.0), *(get(word[:k], 0.0) for k in range(4, min(8, len(word)) + 1))])


class _Words(dict):
    """word -> weight, with second person as 1000 and disguise as 2000 added; forgets all when full."""

    def __init__(self, lexicon: Lexicon):
        super().__init__()
        self.lexicon = lexicon

    def __missing__(self, word: str) -> float:
        if len(self) >= _CACHE:
            self.clear()
        letters, disguised = plain_word(word)
        forms = {letters, *_parts(word)}
        value = max(map(self.lexicon.of, forms)) + 1000.0 * any(f in SECOND_PERSON for f in forms) + 2000.0 * disguised
        if len(word) <= 100:
            self[word] = value
        return value


def features(text: str | None, words: _Words) -> list[float]:
    text = text or ""
    split = text.lower().split()
    n, chars = len(split), max(1, len(text))
    value = np.array([words[w] for w in split], dtype=np.float64)
    disguised, value = value >= 2000, value % 2000
    second, weight = value >= 1000, value % 1000
    hits = np.flatnonzero(weight >= 1.5)
    near = 0
    if len(hits) and second.any():
        you = np.flatnonzero(second)
        at = np.searchsorted(you, hits)
        gap = np.minimum(np.abs(you[np.minimum(at, len(you) - 1)] - hits), np.abs(you[np.maximum(at - 1, 0)] - hits))
        near = int((gap <= _NEARNESS).sum())
    top = np.sort(weight)[-3:] if n else np.zeros(1)
    burst = int((np.searchsorted(hits, hits + 100) - np.arange(len(hits))).max()) if len(hits) else 0
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    upper = ((raw >= 65) & (raw <= 90)).sum()
    letter = upper + ((raw >= 97) & (raw <= 122)).sum()
    loud = ((raw == 33) | (raw == 63)).sum()
    sign = ((raw > 32) & (raw < 48) | (raw > 57) & (raw < 65) | (raw > 90) & (raw < 97) | (raw > 122) & (raw < 127)).sum()
    digit = ((raw >= 48) & (raw <= 57)).sum()
    many = max(1, n)
    densities = [float((weight >= t).sum()) for t in (0.7, 1.5, 2.5, 3.5)]
    return [
        math.log1p(n), *(d / many for d in densities), math.log1p(densities[1]), math.log1p(densities[3]), float(weight.sum()) / many,
        float(top[-1]), float(top.mean()), float(burst), float(second.sum()) / many, near / many, float(upper) / max(1, letter),
        float(loud) / chars, float(sign) / chars, float(digit) / chars, float(disguised.sum()) / many,
    ]


def with_features(docs: DataFrame, lexicon: Lexicon, keep: list[str], text: str = "text") -> DataFrame:
    """Columns `keep` and `features`, an array of doubles; the text travels once, whether it is kept or not."""
    kinds = dict(docs.dtypes)
    sent = keep if text in keep else [text, *keep]
    at, kept = sent.index(text), [sent.index(c) for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words(lexicon)
        for batch in batches:
            rows = [features(t.as_py(), words) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in kept), pa.array(rows, pa.list_(pa.float64()))], names=[*keep, "features"])

    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "features array<double>"])
    return docs.select(*sent).mapInArrow(run, schema)


def learned_lexicon(rows: DataFrame, size: int = LEXICON) -> Lexicon:
    """From (text, toxic): the `size` surest words and word beginnings, by how far counts in toxic texts pass chance."""
    letters = F.transform(F.split(F.lower("text"), r"[\s]+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    words = rows.dropDuplicates(["text"]).select("toxic", F.explode(F.array_distinct(letters)).alias("word")).where("length(word) between 3 and 40")
    per_word = words.groupBy("word").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("all"))
    starts = F.filter(F.array(*[F.substring("word", 1, k) for k in range(4, 9)]), lambda p: F.length(p) <= F.length("word"))
    units = per_word.select(F.explode(F.array_union(F.array(F.concat("word", F.lit(" "))), starts)).alias("unit"), "bad", "all")
    per_unit = units.groupBy("unit").agg(F.sum("bad").alias("bad"), F.sum("all").alias("all")).where("bad >= 4")
    total = per_word.agg(F.sum("bad").alias("b"), F.sum("all").alias("a")).first()
    if not total or not total["b"] or total["b"] == total["a"]:
        return Lexicon({})
    share = total["b"] / total["a"]
    expected = F.col("all") * share
    good = F.col("all") - F.col("bad")
    odds = F.log((F.col("bad") + 0.5) / (good + 0.5)) - math.log(share / (1 - share))
    sure = (F.col("bad") - expected) / F.sqrt(expected)
    best = per_unit.select("unit", odds.alias("odds"), sure.alias("sure")).where(F.col("sure") >= _SURE).where(F.col("odds") >= 0.7)
    return Lexicon({r["unit"]: round(float(r["odds"]), 4) for r in best.orderBy(F.desc("sure"), "unit").limit(size).collect()})


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    trees: object | None
    calibration: object | None
    prior: float

    def scores(self, docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
        """`keep` and `score`, the calibrated probability of label 1."""
        if self.trees is None:
            return docs.select(*keep, F.lit(self.prior).alias("score"))
        rows = with_features(docs, self.lexicon, keep, text).withColumn("features", array_to_vector("features"))
        raw = _raw(self.trees.transform(rows), keep)
        fitted = self.calibration.transform(raw)
        # The step function of the calibration, and within a step the order of the trees.
        return fitted.select(*keep, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("fit") * 0.999 + F.col("raw") * 0.001)).alias("score"))


def _raw(scored: DataFrame, keep: list[str]) -> DataFrame:
    return scored.select(*keep, vector_to_array("probability")[1].alias("raw"))


def train(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """Fit on at most about `labelled` labelled rows outside the held-out fold."""
    known = labels.where("toxic is not null and doc_id is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"), fold().alias("fold"))
    known = known.where(F.col("fold") != HELD_OUT)
    n = known.count()
    chosen = stored(known.where(spread_bits("doc_id") < F.lit(limit_for(labelled, n))))  # its files tell the optimizer its size
    texts = docs.select(F.col("doc_id").alias("__id"), "text").join(chosen, F.col("__id") == F.col("doc_id"))
    rows = stored(texts.select("text", "toxic", "fold"))
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    prior = counts.get(1, 0) / sum(counts.values()) if counts else 0.0
    if not (counts.get(0) and counts.get(1)):
        return Model(Lexicon({}), None, None, prior)
    lexicon = learned_lexicon(rows.where(F.col("fold").isin(*_LEXICON_FOLDS)))
    later = rows.where(~F.col("fold").isin(*_LEXICON_FOLDS))
    table = stored(with_features(later, lexicon, ["toxic", "fold"]))
    table = table.select("fold", F.col("toxic").cast("double").alias("toxic"), array_to_vector("features").alias("features"))
    learn, check = table.where(F.col("fold").isin(*_TREE_FOLDS)), table.where(F.col("fold").isin(*_CALIBRATION_FOLDS))
    if learn.select("toxic").distinct().count() < 2 or check.select("toxic").distinct().count() < 2:
        return Model(Lexicon({}), None, None, prior)
    boost = GBTClassifier(labelCol="toxic", maxIter=_TREES, maxDepth=_DEPTH, stepSize=_RATE, minInstancesPerNode=5, subsamplingRate=0.8, seed=7)
    trees = boost.fit(learn)
    points = _raw(trees.transform(check), ["toxic"])
    calibration = IsotonicRegression(labelCol="toxic", featuresCol="raw", predictionCol="fit").fit(points)
    return Model(lexicon, trees, calibration, prior)


def score(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = train(docs, labels, labelled)
    out = model.scores(docs.select("doc_id", "text"), ["doc_id"])
    held = F.coalesce(fold() == HELD_OUT, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def kept_documents(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """The documents scored below one half, with all their columns."""
    model = train(docs, labels, labelled)
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    out = model.scores(rows, list(names.values()), names["text"]).where("score < 0.5")
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])

"""Secret scans: wide candidate search, then a random forest that removes false findings.

Candidates are runs of 12 or more key characters with a digit, and values of 6 or more characters given to names such as
token or password, quoted ones to the closing quote of their line; a run that begins before such a value stands for it. The forest
looks at length, entropy, character classes and their changes, how likely the character transitions are in words, how
much of the candidate is covered by dictionary words, the path, and the neighbouring words; weights of path and
neighbours are learned from one part of the labelled findings, the forest from another. Dictionary and transitions come
from a fixed public vocabulary. Findings are labelled by the caller, or by `labelled`: published key formats and quoted
credentials are true, addresses, dates, versions, plain numbers and dictionary words are false, the rest has no label.

Defined results: null and empty texts have no candidates; a null path is the empty path; rows that repeat are scanned
once each; without labels of both classes the score is the share of true labels (0 without any); an empty table gives no
rows; of other columns only doc_id, text and the path column are read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import limit_for, spread_bits, stored
from .language import vocabulary

#: Labelled findings of each class used to fit, at most about (chosen by a hash of document and place).
PER_CLASS = 8_000
FOLDS, HELD_OUT = 5, 0
_NEIGHBOUR_FOLDS = (1, 2)
TREES, DEPTH = 40, 8

_RUN = re.compile(r"[A-Za-z0-9+/_=.@:\-]{12,}")
#: Names that credentials are given to.
NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "private_key", "auth", "credential")
_NAME = re.compile("(?i)" + "|".join(n.replace("_", "[_-]?") for n in NAMES))
# a whole word and the sign after it, possessive: every character is passed once
_SIGN = re.compile(r"(?<![A-Za-z0-9_\-])[A-Za-z0-9_\-]++[\"']?\s*+(?:=>|[:=]{1,2}+)\s*+")
_QUOTED = re.compile(r"\"((?:[^\"\\\n]|\\.)++)\"|'((?:[^'\\\n]|\\.)++)'")
_BARE = re.compile(r"[\"']?([^\s\"',;]{6,})")
#: Published formats of keys.
FORMATS = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[0-9A-Za-z]{16,}|AIza[0-9A-Za-z_\-]{35}|eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+")
_PLAIN = re.compile(r"[0-9.:/\-]+|(?:[0-9]{1,3}\.){3}[0-9]{1,3}\S*|\S*[A-Za-z0-9.\-]@[A-Za-z0-9.\-]+\S*|(?i:https?:|www\.)\S*|v?[0-9]+(?:\.[0-9]+)+\S*")
_WORD = re.compile(r"\w+")
_AROUND = 48
_OUT = "doc_id long, path string, start long, length long, before string, after string, numbers array<double>, label int"


@lru_cache(maxsize=1)
def _public_words() -> tuple[frozenset[str], dict[str, float]]:
    """Words of four or more letters of the public vocabulary, and log probabilities of letter pairs in it."""
    words = [p.lstrip("▁") for p in vocabulary()]
    pairs = Counter(a + b for w in words for a, b in zip(w, w[1:], strict=False))
    total = sum(pairs.values())
    return frozenset(w for w in words if len(w) >= 4), {p: math.log(n / total) for p, n in pairs.items()}


def covered(text: str) -> float:
    """Share of the characters inside dictionary words, taken longest first from the left."""
    words, _ = _public_words()
    text, at, hit = text.lower(), 0, 0
    while at < len(text):
        step = next((k for k in range(min(16, len(text) - at), 3, -1) if text[at : at + k] in words), 0)
        hit, at = hit + step, at + max(1, step)
    return hit / max(1, len(text))


def _kind(c: str) -> int:
    return 0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3


def numbers_of(value: str, before: str, after: str, path: str) -> list[float]:
    """Dense features that need no training."""
    n = len(value)
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    kinds = [_kind(c) for c in value]
    share = [kinds.count(k) / n for k in range(4)]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / n
    low = value.lower()
    _, pairs = _public_words()
    logs = [pairs.get(low[i : i + 2], -14.0) for i in range(n - 1)]
    near = before[-24:].lower()
    return [
        entropy, len(counts) / n, *share, changes, float(np.mean(logs)) if logs else -14.0, covered(value),
        float(all(c in "0123456789abcdef" for c in low)), float(bool(_NAME.search(near))),
        float(before.rstrip("\"' ")[-1:] in ("=", ":")), float(before[-1:] in ("\"", "'") and after[:1] in ("\"", "'")),
        float(low.count(".")), float(low.count("/")), float("@" in low), float(path.count("/")), float(len(path)),
        float(any(w in path.lower() for w in ("test", "example", "doc", "sample"))),
    ]


def given(text: str) -> list[tuple[int, int]]:
    """Places of the values given to names of credentials: to the closing quote of the line, or to a blank, quote or comma."""
    out, at = [], 0
    while m := _SIGN.search(text, at):
        at = m.end()
        if _NAME.search(m.group()):
            quoted = _QUOTED.match(text, at)
            value = quoted if quoted and len(quoted[quoted.lastindex]) >= 6 else None if quoted else _BARE.match(text, at)
            if value:
                out.append(value.span(value.lastindex))
                at = value.end()
    return out


def label_of(value: str, before: str, after: str, named: bool | None = None) -> int | None:
    """`named` tells whether the value is given to a name; without it, that is looked up in `before`."""
    if FORMATS.fullmatch(value):
        return 1
    if _PLAIN.fullmatch(value) or covered(value) > 0.6:
        return 0
    quoted = before[-1:] in ("\"", "'") and after[:1] in ("\"", "'")
    if named is None:
        named = bool(given(before + value + (before[-1:] if quoted else "")))
    if quoted and named and len(value) >= 16 and any(map(str.isdigit, value)):
        return 1
    return None if named else 0


def _places(text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Places of the candidates, each once, and of the values given to names."""
    found = [m.span() for m in _RUN.finditer(text) if any(map(str.isdigit, m.group()))]
    values = given(text) if "=" in text or ":" in text else []
    starts, more, shorter = [a for a, _ in found], [], set()
    for a, b in values:
        first, last = bisect_left(starts, a), bisect_left(starts, b)
        if first and found[first - 1][1] > a:
            continue  # a run that begins before the value stands for it
        if first < last and found[last - 1][1] > b:
            continue
        # a run that begins with the value is part of it
        if first < last and starts[first] == a:
            shorter.add(found[first])
        more.append((a, b))
    return sorted([f for f in found if f not in shorter] + more), values


def spans_of(text: str) -> list[tuple[int, int]]:
    """Places of the candidates, each once."""
    return _places(text)[0]


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """A row per candidate, with its place in characters, its neighbourhood, features and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            rows: list[tuple] = []
            for doc_id, text, where in zip(whole.column(0).to_pylist(), whole.column(1), whole.column(2).to_pylist(), strict=True):
                text = text.as_py() or ""
                places, values = _places(text)
                ends = [e for _, e in values]
                for a, b in places:
                    before, after, value = text[max(0, a - _AROUND) : a], text[b : b + _AROUND], text[a:b]
                    at = bisect_left(ends, a + 1)
                    named = at < len(values) and values[at][0] < b
                    numbers = [math.log1p(b - a), *numbers_of(value, before, after, where or "")]
                    rows.append((doc_id, where or "", a, b - a, before, after, numbers, label_of(value, before, after, named)))
                if len(rows) >= 5_000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    return docs.select(F.col("doc_id").cast("long"), "text", F.col(path).cast("string")).mapInArrow(run, _OUT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.float64()), pa.int32()]
    names = ["doc_id", "path", "start", "length", "before", "after", "numbers", "label"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def _units() -> Column:
    """Neighbouring words and the parts of the path, marked by their place."""
    def part(column: str, mark: str, last: bool) -> Column:
        words = F.regexp_extract_all(F.lower(column), F.lit(r"[\p{L}_]+"), F.lit(0))
        chosen = F.slice(F.reverse(words), 1, 2) if last else F.slice(words, 1, 2)
        return F.transform(chosen, lambda w: F.concat(F.lit(mark), w))

    where = F.transform(F.split(F.lower("path"), r"[/.\\]"), lambda w: F.concat(F.lit("p:"), w))
    return F.array_distinct(F.concat(part("before", "b:", True), part("after", "a:", False), where))


def _weighed(rows: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Features with the least, largest and summed weight of the neighbourhood."""
    table = F.create_map(*[F.lit(x) for k, w in sorted(weights.items()) for x in (k, w)]) if weights else F.create_map(F.lit(""), F.lit(0.0))
    found = F.transform(_units(), lambda u: F.coalesce(F.try_element_at(table, u), F.lit(0.0)))
    rows = rows.withColumn("__w", F.concat(F.array(F.lit(0.0)), found))
    total = F.aggregate("__w", F.lit(0.0), lambda a, b: a + b)
    return rows.withColumn("features", array_to_vector(F.concat("numbers", F.array(F.array_min("__w"), F.array_max("__w"), total)))).drop("__w")


def scan(docs: DataFrame, path: str = "source", findings: DataFrame | None = None, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, start, length, held_out, score, is_secret for every candidate.

    `findings` (doc_id, start, label) replaces the labels of `label_of`.
    """
    rows = stored(candidates(docs, path))
    known = rows
    if findings is not None:
        known = rows.drop("label").join(findings.select("doc_id", "start", "label"), ["doc_id", "start"])
    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    known = known.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).withColumn("fold", fold).where(F.col("fold") != HELD_OUT)
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    prior = counts.get(1, 0) / sum(counts.values()) if counts else 0.0
    score: DataFrame | None = None
    if counts.get(0) and counts.get(1):
        limit = F.when(F.col("label") == 1, F.lit(limit_for(per_class, counts[1]))).otherwise(F.lit(limit_for(per_class, counts[0])))
        chosen = stored(known.where(spread_bits("doc_id", "start") < limit))
        near = chosen.where(F.col("fold").isin(*_NEIGHBOUR_FOLDS)).select("label", F.explode(_units()).alias("unit"))
        table = near.groupBy("unit").agg(F.sum("label").alias("yes"), F.count(F.lit(1)).alias("all")).where("all >= 5")
        odds = F.log((F.col("yes") + 0.5) / (F.col("all") - F.col("yes") + 0.5))
        strong = table.select("unit", odds.alias("w")).orderBy(F.desc(F.abs("w")), "unit").limit(500)  # a table of 500 weights
        weights = {r["unit"]: round(float(r["w"]), 4) for r in strong.collect()}
        learn = _weighed(chosen.where(~F.col("fold").isin(*_NEIGHBOUR_FOLDS)), weights).select(F.col("label").cast("double").alias("label"), "features")
        if learn.select("label").distinct().count() == 2:
            forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=11).fit(learn)
            score = forest.transform(_weighed(rows, weights)).withColumn("score", vector_to_array("probability")[1])
    if score is None:
        score = rows.withColumn("score", F.lit(prior))
    held = F.coalesce(fold == HELD_OUT, F.lit(False))
    return score.select("doc_id", "start", "length", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("is_secret"), "label")

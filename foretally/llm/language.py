"""Language ID with segmentation-marginalised unigrams.

Every language has probabilities over the pieces of a fixed public vocabulary. The probability of a word is the sum over
all ways to put it together from pieces (forward algorithm); that of a text is the product over its words. The piece
probabilities are fitted by expectation-maximisation over word counts: Spark sums expected piece counts, a table of
languages x pieces, which is all that reaches the driver.

Words are runs of letters in lower case, of any length. Words of up to `TOGETHER` letters are summed many at once; longer ones
one by one, in logarithms, so that no product gets too small for a number.

Defined results: null texts and texts without letters give `und` and score 0; equal scores go to the language first by
code point; without learned languages all texts give `und`; rows that repeat are predicted once each; rows without lang
teach nothing; an empty table gives no rows; of other columns only doc_id and text are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import limit_for, spread_bits, stored

#: Labelled documents per language to learn from, at most about (chosen by a hash of their id); rounds of fitting.
PER_LANGUAGE = 1_500
ROUNDS = 4
FOLDS, HELD_OUT = 3, 1
VOCABULARY = "piece_bpe_32k.model"
TOGETHER = 32
UNKNOWN = "und"
#: Probability of any one character outside the vocabulary, the same in all languages and not fitted.
_OUTSIDE = 1e-7
_SMOOTH = 0.05
_WORD = re.compile(r"[^\W\d_]+")
_CACHE = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=2)
def vocabulary(name: str = VOCABULARY) -> list[str]:
    """The vocabulary's pieces of letters; a leading mark stands for the start of a word."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public_tokenizers.path(name))
    found = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return sorted({p for p in found if p.removeprefix("▁").isalpha() and p == p.lower()})


class Pieces:
    """Finds the pieces of a vocabulary in many words at once, by a hash of each substring."""

    def __init__(self, pieces: list[str]):
        self.n = len(pieces)
        self.longest = max(map(len, pieces))
        hashes, lengths = self.hashes(pieces)
        value = hashes[np.arange(self.n), lengths]
        self.bits = 17
        slot = self._slot(value)
        order = np.argsort(slot, kind="stable")
        rank = np.arange(self.n) - np.searchsorted(slot[order], slot[order])
        self.table_hash = np.zeros((rank.max() + 1, 1 << self.bits), dtype=np.uint64)
        self.table_id = np.full(self.table_hash.shape, -1, dtype=np.int32)
        self.table_hash[rank, slot[order]] = value[order]
        self.table_id[rank, slot[order]] = order

    def _slot(self, value: np.ndarray) -> np.ndarray:
        return ((value * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits)).astype(np.int64)

    @staticmethod
    def hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Prefix hashes (word x position) and lengths; with them any substring's hash takes one multiplication."""
        lengths = np.array([len(w) for w in words])
        widest = int(lengths.max())
        flat = np.frombuffer("".join(w.ljust(widest, "\0") for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = flat.reshape(len(words), widest).astype(np.uint64)
        out = np.zeros((len(words), widest + 1), dtype=np.uint64)
        for i in range(widest):
            out[:, i + 1] = out[:, i] * _BASE + codes[:, i] + np.uint64(1)
        return out, lengths

    def ids(self, hashes: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, words, piece) for every substring that is a piece, by end."""
        power = np.cumprod(np.r_[np.uint64(1), np.full(self.longest, _BASE)])
        for end in range(1, hashes.shape[1]):
            alive = np.flatnonzero(lengths >= end)
            for start in range(max(0, end - self.longest), end):
                value = hashes[alive, end] - hashes[alive, start] * power[end - start]
                slot, found = self._slot(value), np.full(len(alive), -1, dtype=np.int32)
                for row_hash, row_id in zip(self.table_hash, self.table_id, strict=True):
                    same = row_hash[slot] == value
                    found[same] = row_id[slot[same]]
                hit = found >= 0
                if hit.any():
                    yield start, end, alive[hit], found[hit]


    def steps(self, word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, piece) for every substring of one word that is a piece, by end."""
        hashes, power = self.hashes([word])[0][0], np.cumprod(np.r_[np.uint64(1), np.full(self.longest, _BASE)])
        found = []
        for n in range(1, min(self.longest, len(word)) + 1):
            value = hashes[n:] - hashes[:-n] * power[n]
            slot, piece = self._slot(value), np.full(len(value), -1, dtype=np.int32)
            for row_hash, row_id in zip(self.table_hash, self.table_id, strict=True):
                same = row_hash[slot] == value
                piece[same] = row_id[slot[same]]
            start = np.flatnonzero(piece >= 0)
            found.append((start, start + n, piece[start]))
        start, end, piece = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.argsort(end, kind="stable")
        return start[order], end[order], piece[order]


@lru_cache(maxsize=2)
def pieces_of(name: str = VOCABULARY) -> Pieces:
    return Pieces(vocabulary(name))


def marked(word: str) -> str:
    return "▁" + word


def _log_sum(parts: np.ndarray) -> np.ndarray:
    top = parts.max(axis=0)
    return top + np.log(np.exp(parts - top).sum(axis=0))


def forward_long(word: str, prob: np.ndarray, pieces: Pieces):
    """Logarithms of the forward sums (place x language) of one word, and its pieces as `Pieces.steps` gives them."""
    start, end, piece = pieces.steps(word)
    log = np.log(prob.T)
    first = np.searchsorted(end, np.arange(len(word) + 2))
    alpha = np.zeros((len(word) + 1, prob.shape[0]))
    for at in range(1, len(word) + 1):
        some = slice(first[at], first[at + 1])
        alpha[at] = _log_sum(np.concatenate([alpha[at - 1 : at] + log[-1], alpha[start[some]] + log[piece[some]]]))
    return alpha, (start, end, piece)


def expected_long(word: str, count: float, prob: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Expected uses of each piece in one word of one language."""
    alpha, (start, end, piece) = forward_long(word, prob[None, :], pieces)
    alpha, log, total = alpha[:, 0], np.log(prob), alpha[-1, 0]
    order = np.argsort(start, kind="stable")
    first = np.searchsorted(start[order], np.arange(len(word) + 1))
    beta = np.zeros(len(word) + 1)
    for at in range(len(word) - 1, -1, -1):
        some = order[first[at] : first[at + 1]]
        beta[at] = _log_sum(np.append(beta[end[some]] + log[piece[some]], beta[at + 1] + log[-1]))
    out = np.zeros(pieces.n + 1)
    np.add.at(out, piece, count * np.exp(alpha[start] + log[piece] + beta[end] - total))
    out[-1] += count * np.exp(alpha[:-1] + log[-1] + beta[1:] - total).sum()
    return out


def log_probability(words: list[str], prob: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Log probability (word x language), summed over all segmentations."""
    out = np.zeros((len(words), prob.shape[0]))
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    short = sum(len(w) <= TOGETHER for w in words)
    for at in range(0, short, 4000):  # words of like length together
        part = order[at : min(short, at + 4000)]
        out[part] = forward([words[i] for i in part], prob, pieces)
    for i in order[short:]:
        out[i] = forward_long(words[i], prob, pieces)[0][-1]
    return out


def expected_uses(words: list[str], count: np.ndarray, prob: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Expected uses of each piece in the words of one language."""
    out, short = np.zeros(pieces.n + 1), np.array([len(w) <= TOGETHER for w in words], dtype=bool)
    if short.any():
        out += expected([w for w, s in zip(words, short, strict=True) if s], count[short], prob, pieces)
    for i in np.flatnonzero(~short):
        out += expected_long(words[i], count[i], prob, pieces)
    return out


def forward(words: list[str], prob: np.ndarray, pieces: Pieces, keep_steps: bool = False):
    """Log probability (word x language) of each unit, summed over all its segmentations.

    prob is language x (piece, and last the probability of a single character outside the vocabulary).
    """
    hashes, lengths = pieces.hashes(words)
    alpha = np.zeros((hashes.shape[1], len(words), prob.shape[0]))
    alpha[0] = 1.0
    steps, done = [], 0
    by_piece = np.ascontiguousarray(prob.T)
    for start, end, rows, found in pieces.ids(hashes, lengths):
        while done < end - 1:  # a character outside the vocabulary
            done += 1
            alpha[done] += alpha[done - 1] * by_piece[-1]
        alpha[end, rows] += alpha[start, rows] * by_piece[found]
        if keep_steps:
            steps.append((start, end, rows, found))
    while done < alpha.shape[0] - 1:
        done += 1
        alpha[done] += alpha[done - 1] * by_piece[-1]
    total = alpha[lengths, np.arange(len(words))]
    return (np.log(total), alpha, steps, lengths) if keep_steps else np.log(total)


def expected(words: list[str], count: np.ndarray, prob: np.ndarray, pieces: Pieces) -> np.ndarray:
    """Expected uses of each piece in the words of one language (forward-backward)."""
    log_total, alpha, steps, lengths = forward(words, prob[None, :], pieces, keep_steps=True)
    alpha, scale = alpha[:, :, 0], count / np.exp(log_total[:, 0])
    beta = np.zeros_like(alpha)
    beta[lengths, np.arange(len(words))] = 1.0
    out = np.zeros(pieces.n + 1)
    at = len(steps)
    for end in range(alpha.shape[0] - 1, 0, -1):
        while at and steps[at - 1][1] == end:
            at -= 1
            start, _, rows, found = steps[at]
            use = prob[found] * beta[end, rows]
            np.add.at(out, found, alpha[start, rows] * use * scale[rows])
            beta[start, rows] += use
        use = prob[-1] * beta[end]
        out[-1] += float((alpha[end - 1] * use * scale).sum())
        beta[end - 1] += use
    return out


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prob: np.ndarray
    name: str = VOCABULARY


def _normalised(counts: np.ndarray) -> np.ndarray:
    counts = counts[:, :-1] + _SMOOTH
    return np.c_[counts / counts.sum(axis=1, keepdims=True), np.full(len(counts), _OUTSIDE)]


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, rounds: int = ROUNDS, name: str = VOCABULARY) -> Model:
    """Learn from rows whose fold is not held out and whose lang is not null."""
    known = docs.where("lang is not null and text is not null").where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != HELD_OUT)
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row per language
    languages = tuple(sorted(counts))
    if not languages:
        return Model((), np.zeros((0, 0)), name)
    limits = F.create_map(*[F.lit(x) for k in languages for x in (k, limit_for(per_language, counts[k]))])
    chosen = known.where(spread_bits("doc_id") < F.element_at(limits, F.col("lang")))

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            for lang, part in frame.groupby("lang"):
                found: dict[str, int] = {}
                for text in part["text"]:
                    for w in _WORD.findall(text.lower()):
                        found[w] = found.get(w, 0) + 1
                yield pd.DataFrame({"lang": lang, "word": list(found), "n": list(found.values())})

    words = chosen.select("lang", "text").mapInPandas(counted, "lang string, word string, n long")
    words = stored(words.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    place = {k: i for i, k in enumerate(languages)}
    prob = _normalised(np.zeros((len(languages), len(vocabulary(name)) + 1)))
    for _ in range(rounds):

        def step(batches: Iterator[pd.DataFrame], prob: np.ndarray = prob) -> Iterator[pd.DataFrame]:
            sums = np.zeros_like(prob)
            for frame in batches:
                for lang, part in frame.groupby("lang"):
                    sums[place[lang]] += expected_uses([marked(w) for w in part["word"]], part["n"].to_numpy(dtype=np.float64), prob[place[lang]], pieces_of(name))
            lang, piece = np.nonzero(sums)
            yield pd.DataFrame({"lang": lang, "piece": piece, "n": sums[lang, piece]})

        table = words.mapInPandas(step, "lang int, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        counts_now = np.zeros_like(prob)
        counts_now[table["lang"].to_numpy(), table["piece"].to_numpy()] = table["n"].to_numpy()
        prob = _normalised(counts_now)
    return Model(languages, prob, name)


class Scorer:
    """Log probabilities of words by language, remembered; forgets all when full."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, pieces_of(model.name)
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.languages)))

    def _learn(self, fresh: list[str]) -> None:
        value = log_probability([marked(w) for w in fresh], self.model.prob, self.pieces)
        start = len(self.rows)
        self.rows = np.concatenate([self.rows, value])
        self.known.update((w, start + i) for i, w in enumerate(fresh))

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        split = [[w for w in _WORD.findall(t.lower()) if w.isalpha() or any(map(str.isalpha, w))] if t else [] for t in texts]
        if len(self.known) > _CACHE:
            self.known, self.rows = {}, self.rows[:0]
        fresh = list(dict.fromkeys(w for ws in split for w in ws if w not in self.known))
        if fresh:
            self._learn(fresh)
        out = []
        for ws in split:
            if not ws:
                out.append((UNKNOWN, 0.0))
                continue
            total = self.rows[np.fromiter(map(self.known.__getitem__, ws), dtype=np.int64, count=len(ws))].sum(axis=0)
            best = int(total.argmax())
            out.append((self.model.languages[best], float(1.0 / np.exp(total - total[best]).sum())))
        return out


def predict(docs: DataFrame, model: Model, batch: int = 256) -> DataFrame:
    """doc_id, lang_pred, score for every document; only doc_id (to carry) and text are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model) if model.languages else None
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                part = whole.slice(at, batch)
                found = scorer.predict(part.column(1).to_pylist()) if scorer else [(UNKNOWN, 0.0)] * part.num_rows
                lang, score = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    return predict(docs, train(docs, per_language)).select("doc_id", held.alias("held_out"), "lang_pred", "score")

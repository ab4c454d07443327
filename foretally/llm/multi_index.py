"""Approximate nearest neighbours by an inverted multi-index, for the largest inner product.

Two codebooks quantise the two halves of the vectors, fitted on a bounded sample; a cell is a pair of centroids. A query
takes cells in falling order of its summed inner products with both centroids, from a heap over the two sorted lists,
until they hold `share` of all vectors and at least `least` of them. Vectors of the taken cells are ranked again by the
exact inner product. Cells are dealt to shards of about `SHARD` vectors; a cell larger than that is cut into several, so
a vector that is very common does not fill one task. Each shard keeps its best `top` per query before anything moves.

Defined results: vectors that are null, empty, zero, of another length than most, or hold null or non-finite components
take no part; ties go to the smaller vec_id; rows with the query's own id are no candidates; of rows that repeat a query's
id the least vector asks; other repeated rows are found as often as they stand there; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

TOP = 20
EVERY = 20
#: Vectors to fit the codebooks on, at most about (chosen by a hash of their id); rounds of fitting; centroids per half.
SAMPLE = 20_000
ROUNDS = 8
CENTROIDS = 24
#: A query takes cells until they hold this share of all vectors, and this many.
SHARE, LEAST = 0.62, 2_000
SHARD = 4_096
#: Queries that meet a shard in one group.
QUERY_BLOCK = 20_000
_QUERIES = 512
#: Pairs that are summed at once; share of a score that a blocked product may be off by.
_PAIRS = 100_000
_MARGIN = 1e-9


def usable(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id and vector (array of doubles) of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    # comparisons with NaN: Spark holds NaN above all numbers, so it fails the upper bound
    fine = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_col).isNotNull() & F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("vec_id"), v.alias("vector"))


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Centroids of a sample; empty ones restart at the worst-placed points."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        away = (x**2).sum(1)[:, None] - 2 * x @ centres.T + (centres**2).sum(1)
        near = away.argmin(1)
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, x)
        worst = np.argsort(-away.min(1))[: (n == 0).sum()]
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
        centres[n == 0] = x[worst]
    return centres


@dataclass(frozen=True)
class Index:
    halves: tuple[np.ndarray, np.ndarray]
    cut: int

    def cells(self, x: np.ndarray) -> np.ndarray:
        out = []
        for part, centres in zip((x[:, : self.cut], x[:, self.cut :]), self.halves, strict=True):
            out.append(((centres**2).sum(1) - 2 * part @ centres.T).argmin(1))
        return out[0] * len(self.halves[1]) + out[1]

    def taken(self, q: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
        """Non-empty cells in falling order of summed inner products, until they hold `enough` vectors."""
        first, second = self.halves[0] @ q[: self.cut], self.halves[1] @ q[self.cut :]
        a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        width, out, held = len(second), [], 0
        heap = [(-(first[a[0]] + second[b[0]]), 0, 0)]
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            if j + 1 < width:
                heapq.heappush(heap, (-(first[a[i]] + second[b[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(first):
                heapq.heappush(heap, (-(first[a[i + 1]] + second[b[0]]), i + 1, 0))
            cell = int(a[i]) * width + int(b[j])
            if counts[cell]:
                out.append(cell)
                held += int(counts[cell])
        return out


def fit(vectors: DataFrame, n: int, sample: int = SAMPLE, centroids: int = CENTROIDS) -> Index | None:
    """Codebooks from at most about `sample` vectors of the most frequent length."""
    part = min(1.0, sample / max(1, n))
    rows = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < max(1, int(part * 1_000_000))).select("vector").toPandas()
    if not len(rows):
        rows = vectors.select("vector").limit(1).toPandas()
    if not len(rows):
        return None
    x = np.stack(rows["vector"].to_numpy())
    different = np.unique(x, axis=0)
    cut = max(1, x.shape[1] // 2)
    return Index(tuple(kmeans(h, min(centroids, len(h))) for h in (different[:, :cut], different[:, cut:])), cut)


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    return query[rank < top], ids[rank < top], score[rank < top]


def inner(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the pairs a[i], b[j], each summed in the same order wherever it is computed: a matrix product rounds
    differently in blocks of different size, and equal vectors must get equal scores."""
    out = np.empty(len(i))
    for at in range(0, len(i), _PAIRS):
        part = slice(at, at + _PAIRS)
        out[part] = (a[i[part]] * b[j[part]]).sum(axis=1)
    return out


def search(vectors: DataFrame, is_query: Column, top: int = TOP, share: float = SHARE, least: int = LEAST, centroids: int = CENTROIDS, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the best `top` of the cells each query takes. `is_query` is a condition on vec_id."""
    rows = stored(usable(vectors))
    sizes = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    empty = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return vectors.sparkSession.createDataFrame([], empty)
    d, n = sizes[0]["d"], sizes[0]["count"]
    rows = rows.where(F.size("vector") == d)
    index = fit(rows, n, centroids=centroids)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield f.assign(cell=index.cells(np.stack(f["vector"].to_numpy())).astype("int32"))

    placed = stored(rows.mapInPandas(place, "vec_id long, vector array<double>, cell int"))
    cells = len(index.halves[0]) * len(index.halves[1])  # bounded by the square of `centroids`
    counts = np.zeros(cells, dtype=np.int64)
    for r in placed.groupBy("cell").count().collect():
        counts[r["cell"]] = r["count"]
    # Shards: whole small cells in order, large cells cut by a hash of the id.
    first, pieces, room, current = np.zeros(cells, dtype=np.int64), np.maximum(1, -(-counts // shard)), 0, 0
    for c in range(cells):
        if pieces[c] > 1 or room + counts[c] > shard:
            current, room = current + 1, 0
        first[c] = current
        room += int(counts[c])
        if pieces[c] > 1:
            current, room = current + int(pieces[c]), 0
    enough = max(least, int(np.ceil(share * n)))
    shards_of = [np.arange(first[c], first[c] + pieces[c]) for c in range(cells)]

    asking = stored(placed.where(is_query).groupBy("vec_id").agg(F.min("vector").alias("vector")))
    blocks = max(1, -(-asking.count() // QUERY_BLOCK))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            part = first[f["cell"]] + f["spread"].to_numpy() % pieces[f["cell"]]
            for block in range(blocks):
                yield pd.DataFrame({"shard": part, "block": block, "vec_id": f["vec_id"], "cell": f["cell"], "vector": f["vector"], "cells": None})

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for vec_id, block, v in zip(f["vec_id"], f["block"], f["vector"], strict=True):
                by_shard: dict[int, list[int]] = {}
                for c in index.taken(v, counts, enough):
                    for s in shards_of[c].tolist():
                        by_shard.setdefault(s, []).append(c)
                out += [(s, block, vec_id, None, v, cs) for s, cs in by_shard.items()]
            yield pd.DataFrame(out, columns=["shard", "block", "vec_id", "cell", "vector", "cells"])

    def rank(_key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        own = f["cells"].isna()
        entries, asked = f[own], f[~own]
        keep: list[tuple] = []
        if len(entries) and len(asked):
            matrix, ids, cell = np.stack(entries["vector"].to_numpy()), entries["vec_id"].to_numpy(), entries["cell"].to_numpy().astype(np.int64)
            for at in range(0, len(asked), _QUERIES):
                part = asked.iloc[at : at + _QUERIES]
                score = np.stack(part["vector"].to_numpy()) @ matrix.T
                open_cells = np.zeros((len(part), cells), dtype=bool)
                for i, cs in enumerate(part["cells"]):
                    open_cells[i, np.asarray(cs, dtype=np.int64)] = True
                allowed = open_cells[:, cell] & (ids[None, :] != part["vec_id"].to_numpy()[:, None])
                score = np.where(allowed, score, -np.inf)
                if score.shape[1] > top:  # what may be a tie at the edge stays in until it is ranked by exact score and id
                    edge = -np.partition(-score, top - 1, axis=1)[:, top - 1 : top]
                    allowed &= score >= np.where(np.isfinite(edge), edge - _MARGIN * (1 + np.abs(edge)), edge)
                i, j = np.nonzero(allowed)
                keep.append(_best(part["vec_id"].to_numpy()[i], ids[j], inner(np.stack(part["vector"].to_numpy()), matrix, i, j), top))
        if not keep:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype({"query_id": "int64", "vec_id": "int64"})
        query, ids, score = (np.concatenate(x) for x in zip(*keep, strict=True))
        return pd.DataFrame({"query_id": query, "vec_id": ids, "score": score})

    schema = "shard long, block int, vec_id long, cell int, vector array<double>, cells array<int>"
    dealt = placed.withColumn("spread", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))).mapInPandas(deal, schema)
    asked = asking.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).mapInPandas(ask, schema)
    best = dealt.unionByName(asked).groupBy("shard", "block").applyInPandas(rank, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # Spark keeps `top` per partition before it moves rows
    out = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest(vectors: DataFrame, every: int = EVERY, top: int = TOP) -> DataFrame:
    return search(vectors, F.pmod("vec_id", F.lit(every)) == 0, top)

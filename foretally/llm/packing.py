"""Packing documents into sequences by best-fit decreasing.

Documents are tokenized where they lie; only piece lengths and checksums travel. An overlong document is first cut into
full windows, each a sequence by itself. Tails are packed in groups of about `GROUP` pieces, longest first: a segment
tree over remaining capacities finds the tightest open window that still takes the piece.

Defined results: null and empty texts are one piece, the closing id alone; rows that repeat are packed once each; an
empty table gives no rows; of other columns only doc_id and text are read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

WINDOW = 2048
END_ID = 1
#: Pieces per group on average; the groups are what tasks work on.
GROUP = 2_048
VOCABULARY = "byte_bpe_50k"
#: Unbroken runs beyond this go to the library whose merges stay quick on them; both give the same ids.
_LONG_RUN = r"[^\s]{4000}|\s{4000}"
_TEXT_BATCH = 256
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def _encoders(vocabulary: str):
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
    with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    added = [t.content for t in slow.get_added_tokens_decoder().values()]
    by_slow = re.compile("|".join([_LONG_RUN, *map(re.escape, added)]))
    return slow, tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), by_slow


def token_ids(text: str | None, vocabulary: str = VOCABULARY) -> np.ndarray:
    """The ids of `tokenizers` for the vocabulary, then the closing id. A string that the vocabulary adds as a token of its own
    gets that token's id inside a text too.

    The vocabulary's rank file gives the same ids several times quicker, but slows down on very long unbroken runs and
    knows no added tokens; such texts go to the library itself.
    """
    slow, quick, by_slow = _encoders(vocabulary)
    text = text or ""
    ids = slow.encode(text, add_special_tokens=False).ids if by_slow.search(text) else quick.encode_ordinary(text)
    return np.array([*ids, END_ID], dtype="<u4")


def cut(ids: np.ndarray, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of the full windows and the tail."""
    return [(at, len(part), zlib.crc32(part.tobytes())) for at in range(0, len(ids), window) for part in [ids[at : at + window]]]


class OpenWindows:
    """Open windows by remaining capacity, in a segment tree whose nodes count the windows below them."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.at: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, capacity: int, which: int) -> None:
        self.at[capacity].append(which)
        self._change(capacity, 1)

    def _change(self, capacity: int, by: int) -> None:
        node = capacity + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Takes out the window of the least capacity >= length: (capacity, window)."""
        node = length + self.size
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.size
        self._change(capacity, -1)
        return capacity, self.at[capacity].pop()


def best_fit(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset for pieces given longest first."""
    where, offset, free, opened = np.empty(len(lengths), dtype=np.int64), np.empty(len(lengths), dtype=np.int64), OpenWindows(window), 0
    for i, n in enumerate(lengths.tolist()):
        found = free.tightest(n)
        if found is None:
            found, opened = (window, opened), opened + 1
        capacity, which = found
        where[i], offset[i] = which, window - capacity
        if capacity > n:
            free.add(capacity - n, which)
    return where, offset


def pieces(docs: DataFrame, window: int = WINDOW, vocabulary: str = VOCABULARY) -> DataFrame:
    """A row per piece of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXT_BATCH):
                part = batch.slice(at, _TEXT_BATCH)
                out: list[tuple] = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    ids = token_ids(text.as_py(), vocabulary)
                    out += [(doc_id, *p, len(ids)) for p in cut(ids, window)]
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def pack(docs: DataFrame, window: int = WINDOW, group: int = GROUP, vocabulary: str = VOCABULARY) -> DataFrame:
    """The pieces with sequence_id and offset. Sequences of different groups never share an id."""
    rows = stored(pieces(docs, window, vocabulary).withColumn("row", F.monotonically_increasing_id()))
    n = max(1, -(-rows.count() // group))

    def run(_key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "start", "row"], ascending=[False, True, True, True], kind="stable")
        where, offset = best_fit(frame["length"].to_numpy(), window)
        frame["sequence_id"] = frame["group"].astype("int64") * (1 << 32) + where
        frame["offset"] = offset
        return frame[[*names, "sequence_id", "offset"]]

    names = [c.split()[0] for c in PIECES.split(", ")]
    rows = rows.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(n)).cast("int"))
    return rows.groupBy("group").applyInPandas(run, f"{PIECES}, sequence_id long, offset long")

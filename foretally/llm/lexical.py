"""Ranked lexical search with Block-Max MaxScore.

The index is a table of segments. A segment holds some thousands of documents in order of doc_id; each of its terms has
its postings (document number in the segment, occurrences) as variable-length bytes in blocks of `BLOCK`, and for every block
the pairs of occurrences and document length that no other pair of the block beats. What a posting is worth depends on
statistics of the whole corpus, which come later; its bound in a block is the best of those few pairs, so it is exact.

A search joins the index with the terms asked for, a block of queries at a time, and works on each (segment, block of queries)
by itself: lists are ordered by their bound over the segment, lists whose bounds together cannot pass the least score of the
best `k` are non-essential, only the others are read for candidates, and a candidate is given up when its score so far
plus the block maxima of the non-essential lists cannot pass, before any of those blocks is decompressed. The best `k` of each
segment are merged to the best `k` of all.

Scores are integers: a term's weight w is floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is 50 + 50 n N div L, and a
document scores the sum over the terms of a query of w (10^9 tf div (1000 tf + 20 m)), each term once.

Defined results: null and empty texts, and texts without a term, count for nothing and are never found; queries without a term find nothing;
queries of equal id are one query with the terms of all; rows of documents that repeat are documents of their own and are
found once each; equal scores go by doc_id, null ids last; only scores above 0 are results; an empty table of
documents or queries gives no rows; of other columns only the id and text columns are read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

#: Documents and bytes of text of a segment at most (a longer text is a segment of its own); postings of a block; queries that are worked on together.
SEGMENT, SEGMENT_BYTES = 8_192, 16 << 20
BLOCK = 64
QUERY_BLOCK = 512
#: Document numbers that are scored at once.
STRIDE = 1_024
TOP = 50
#: Terms in lower-case UTF-8: letters and digits of ASCII and everything beyond it.
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
_FAR = np.int64(np.iinfo(np.int64).max)
INDEX = "segment string, term binary, df int, postings binary, last array<int>, ends array<int>, points array<int>, tf array<int>, length array<int>"
DOCUMENTS = "segment string, ids array<long>, n array<int>"


def terms(text: bytes) -> list[bytes]:
    return _TERM.findall(text.lower())  # lower() of bytes changes A-Z only


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of unsigned numbers, seven bits in each, and the place where each number ends."""
    size = np.ones(len(values), dtype=np.int64)
    for k in range(1, 5):
        size += values >= (1 << (7 * k))
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for k in range(5):
        has = size > k
        more = (size[has] > k + 1).astype(np.uint8) << 7
        out[(ends - size)[has] + k] = ((values[has] >> (7 * k)) & 127).astype(np.uint8) | more
    return out, ends


def unpacked(raw: np.ndarray) -> np.ndarray:
    """The numbers behind bytes of `packed`."""
    last = raw < 128
    number = np.cumsum(last) - last
    firsts = np.flatnonzero(np.concatenate([[True], last[:-1]]))
    shift = (np.arange(len(raw)) - firsts[number]) * 7
    return np.add.reduceat((raw & 127).astype(np.int64) << shift, firsts)


class Held:
    """Documents of a segment to be: each as numbers of its terms and how often it holds them."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {}
        self.docs: list[tuple[int | None, np.ndarray, np.ndarray]] = []
        self.bytes = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        self.bytes += len(text)
        counts = Counter(terms(text))
        if counts:
            number = np.fromiter((self.number.setdefault(t, len(self.number)) for t in counts), dtype=np.int32, count=len(counts))
            self.docs.append((doc_id, number, np.fromiter(counts.values(), dtype=np.int32, count=len(counts))))


def segment_of(name: str, held: Held) -> tuple[pa.RecordBatch, pa.RecordBatch] | None:
    """Index rows and the row of documents of one segment; documents without terms are left out."""
    docs, number = sorted(held.docs, key=lambda x: (x[0] is None, x[0] or 0)), held.number
    if not docs:
        return None
    sizes = np.array([len(t) for _, t, _ in docs])
    term = np.concatenate([t for _, t, _ in docs]).astype(np.int64)
    tf = np.concatenate([c for _, _, c in docs]).astype(np.int64)
    doc = np.repeat(np.arange(len(docs)), sizes)
    length = np.array([int(c.sum()) for _, _, c in docs], dtype=np.int64)
    order = np.argsort(term, kind="stable")
    term, tf, doc = term[order], tf[order], doc[order]
    first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    df = np.diff(np.append(first, len(term)))
    place = np.arange(len(term)) - np.repeat(first, df)
    # blocks: numbers are differences, but for the first of a block, so a block can be read alone
    opens = place % BLOCK == 0
    delta = np.where(opens, doc, doc - np.concatenate([[0], doc[:-1]]))
    raw, ends = packed(np.stack([delta, tf], axis=1).ravel())
    block = np.cumsum(opens) - 1
    starts = np.flatnonzero(opens)
    closes = np.append(starts[1:], len(term)) - 1
    per_term = -(-df // BLOCK)
    term_blocks = np.concatenate([[0], np.cumsum(per_term)])
    byte_of_term = np.concatenate([[0], ends[2 * (first + df) - 1]])
    byte_ends = ends[2 * closes + 1] - np.repeat(byte_of_term[:-1], per_term)
    # pairs (tf, length) that no other of the block beats: by falling tf, each length below all before it
    best = np.lexsort((length[doc], -tf, block))
    key = length[doc][best] - block[best] * (1 << 40)
    low = np.minimum.accumulate(key)
    stays = np.concatenate([[True], key[1:] < low[:-1]])
    best = best[stays]
    points = np.bincount(block[best], minlength=len(starts))
    point_of_term = np.concatenate([[0], np.cumsum(points)])[term_blocks]

    def lists(offsets: np.ndarray, values: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

    index = pa.RecordBatch.from_arrays([
        pa.array([name] * len(df), pa.string()), pa.array(list(number), pa.binary()), pa.array(df, pa.int32()),
        pa.BinaryArray.from_buffers(pa.binary(), len(df), [None, pa.py_buffer(byte_of_term.astype(np.int32).tobytes()), pa.py_buffer(raw.tobytes())]),
        lists(term_blocks, doc[closes]), lists(term_blocks, byte_ends), lists(term_blocks, points), lists(point_of_term, tf[best]), lists(point_of_term, length[doc][best]),
    ], names=[c.split()[0] for c in INDEX.split(", ")])
    ids = pa.array([[d for d, _, _ in docs]], pa.list_(pa.int64()))
    return index, pa.RecordBatch.from_arrays([pa.array([name]), ids, pa.array([length], pa.list_(pa.int32()))], names=["segment", "ids", "n"])


def _segments(docs: DataFrame, segment: int) -> DataFrame:
    """Index rows and rows of documents in one table: a row of documents has a null term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held, made = Held(), 0

        def made_of(docs: Held) -> Iterator[pa.RecordBatch]:
            nonlocal made
            both = segment_of(f"{TaskContext.get().partitionId()}-{made}", docs)
            made += 1
            if both:
                index, one = both
                empty = [pa.nulls(1, f.type) for f in index.schema]
                yield pa.RecordBatch.from_arrays([*index.columns, pa.nulls(len(index), pa.list_(pa.int64())), pa.nulls(len(index), pa.list_(pa.int32()))], names=names)
                yield pa.RecordBatch.from_arrays([one.column(0), *empty[1:], one.column(1), one.column(2)], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                raw = text.as_py() or b""
                if held.docs and (len(held.docs) >= segment or held.bytes + len(raw) > SEGMENT_BYTES):
                    yield from made_of(held)
                    held = Held()
                held.add(doc_id, raw)
        yield from made_of(held)

    names = [*(c.split()[0] for c in INDEX.split(", ")), "ids", "n"]
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"{INDEX}, ids array<long>, n array<int>")


def index(docs: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The index of `docs` (doc_id, text), written to the shared folder: a row per segment and term, and one per segment."""
    return stored(_segments(docs, segment))


class Lists:
    """The postings of one segment that some queries ask for."""

    def __init__(self, rows: pa.Table, n: np.ndarray, total: int, words: int):
        self.m = 50 + (50 * n.astype(np.int64) * total) // max(1, words)
        self.df = rows.column("df").to_numpy()
        self.w = rows.column("w").to_numpy()
        flat = {c: rows.column(c).combine_chunks() for c in ("postings", "last", "ends", "points", "tf", "length")}
        self.raw = [np.frombuffer(b.as_buffer(), dtype=np.uint8) if len(b.as_buffer()) else np.zeros(0, np.uint8) for b in flat["postings"]]
        self.last, self.ends, points, tf, length = ([x.values.to_numpy() for x in flat[c]] for c in ("last", "ends", "points", "tf", "length"))
        self.most = []
        for k in range(len(self.df)):
            m = 50 + (50 * length[k].astype(np.int64) * total) // max(1, words)
            worth = self._worth(tf[k].astype(np.int64), m)
            self.most.append(self.w[k] * np.maximum.reduceat(worth, np.cumsum(points[k]) - points[k]))
        self.bound = np.array([x.max() for x in self.most])
        self.read: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    @staticmethod
    def _worth(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * tf) // (1000 * tf + 20 * m)

    def block(self, k: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Document numbers of a block and what its postings are worth; decompressed once for all queries."""
        if (k, b) not in self.read:
            numbers = unpacked(self.raw[k][self.ends[k][b - 1] if b else 0 : self.ends[k][b]])
            doc = np.cumsum(numbers[::2])
            self.read[k, b] = (doc, self.w[k] * self._worth(numbers[1::2], self.m[doc]))
        return self.read[k, b]


def best_of(lists: Lists, asked: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and scores of the `k` best documents of a segment for the terms `asked`, best first; equal ones by number."""
    asked = asked[np.argsort(lists.bound[asked], kind="stable")]
    upto = np.cumsum(lists.bound[asked])  # the least lists together
    top_doc, top_score = np.zeros(0, np.int64), np.zeros(0, np.int64)
    least, essential = np.int64(0), 0  # a document must pass `least`: numbers rise, so an equal score comes too late
    size = len(lists.m)
    for low in range(0, size, STRIDE):
        high = min(size, low + STRIDE)
        while essential < len(asked) and upto[essential] <= least:
            essential += 1
        if essential == len(asked):
            break
        score, seen = np.zeros(high - low, np.int64), np.zeros(high - low, bool)
        for t in asked[essential:]:
            last = lists.last[t]
            for b in range(int(np.searchsorted(last, low)), int(np.searchsorted(last, high - 1)) + 1):
                if b == len(last):
                    break
                doc, worth = lists.block(t, b)
                inside = slice(*np.searchsorted(doc, (low, high))) if doc[0] < low or doc[-1] >= high else slice(None)
                score[doc[inside] - low] += worth[inside]
                seen[doc[inside] - low] = True
        doc = np.flatnonzero(seen)
        score = score[doc]
        doc = doc + low
        if essential:
            # block maxima of all non-essential lists, then from the largest: exact scores replace maxima
            blocks, most = [], np.zeros((essential, len(doc)), np.int64)
            for i in range(essential):
                t = asked[i]
                at = np.searchsorted(lists.last[t], doc)
                blocks.append(at)
                most[i] = np.append(lists.most[t], 0)[at]
            rest = np.cumsum(most, axis=0)
            alive = np.arange(len(doc))
            for i in range(essential - 1, -1, -1):
                alive = alive[score[alive] + rest[i][alive] > least]
                t = asked[i]
                at = blocks[i][alive]
                for b in np.unique(at[at < len(lists.last[t])]):
                    held, worth = lists.block(t, b)
                    mine = alive[at == b]
                    where = np.searchsorted(held, doc[mine])
                    where[where == len(held)] = 0
                    hit = held[where] == doc[mine]
                    score[mine[hit]] += worth[where[hit]]
            doc, score = doc[alive], score[alive]
        passed = score > least
        if passed.any():
            top_doc, top_score = np.concatenate([top_doc, doc[passed]]), np.concatenate([top_score, score[passed]])
            order = np.lexsort((top_doc, -top_score))[:k]
            top_doc, top_score = top_doc[order], top_score[order]
            if len(top_doc) == k:
                least = top_score[-1]
    return top_doc, top_score


def asked_terms(queries: DataFrame, item: str) -> DataFrame:
    """item_id, term: of every query each term once."""
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.regexp_extract_all(lower, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0))
    each = queries.select(F.col(item).cast("long").alias("item_id"), F.explode(found).alias("term"))
    return each.select("item_id", F.encode("term", "utf-8").alias("term")).distinct()


def search(found: DataFrame, queries: DataFrame, k: int = TOP, item: str = "item_id", block: int = QUERY_BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score: the best `k` documents of the index `found` for every query (item, text)."""
    asked = stored(asked_terms(queries, item))
    docs = stored(found.where("term is null").select("segment", "ids", "n"))
    whole = docs.agg(F.sum(F.size("n")).cast("long").alias("total"), F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, b: a + b)).alias("words")).first()
    total, words = int(whole["total"] or 0), int(whole["words"] or 0)
    # queries of a block share their postings; a block is known by a hash of the query's id
    blocks = max(1, -(-asked.select("item_id").distinct().count() // block))
    spread = F.pmod(F.xxhash64("item_id"), F.lit(blocks)).cast("int")
    by_term = stored(asked.groupBy(spread.alias("block"), "term").agg(F.collect_list(F.struct("item_id")).alias("items")))  # at most the queries of a block
    lists = stored(found.where("term is not null").join(by_term, "term").drop("ids", "n"))
    df = lists.select("segment", "term", "df").distinct().groupBy("term").agg(F.sum("df").cast("long").alias("all"))
    weight = F.floor(1000 * F.log((F.lit(2 * total + 2).cast("double")) / (2 * F.col("all") + 1)))
    weighed = lists.join(df.select("term", weight.cast("long").alias("w")), "term").where("w > 0")
    parts = weighed.select("segment", "block", "df", "w", "postings", "last", "ends", "points", "tf", "length", "items")

    def run(key: tuple, rows: pa.Table, one: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return out.empty_table()
        ids, n = one.column("ids")[0].values, one.column("n")[0].values.to_numpy()
        held = Lists(rows, n, total, words)
        wanted: dict[int | None, list[int]] = {}
        for at, items in enumerate(rows.column("items").to_pylist()):
            for i in items:
                wanted.setdefault(i["item_id"], []).append(at)
        item_ids, doc_ids, scores = [], [], []
        for i, at in wanted.items():
            doc, score = best_of(held, np.array(at), k)
            item_ids += [i] * len(doc)
            doc_ids.append(ids.take(pa.array(doc)))
            scores.append(score)
        return pa.Table.from_arrays([pa.array(item_ids, pa.int64()), pa.concat_arrays(doc_ids), pa.array(np.concatenate(scores))], schema=out)

    out = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])
    # each block of queries meets the documents of a segment once, whatever its terms
    met = docs.join(parts.select("segment", "block").distinct(), "segment").select(F.col("segment").alias("in_segment"), F.col("block").alias("of_block"), "ids", "n")
    best = parts.groupBy("segment", "block").cogroup(met.groupBy("in_segment", "of_block")).applyInArrow(run, "item_id long, doc_id long, score long")
    by_score = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return stored(best).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

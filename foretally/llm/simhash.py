"""SimHash near-dedup with a Gray-order hierarchical index.

Distinct fingerprints meet in groups: of four 16-bit blocks two fingerprints at 3 or fewer differing bits share one, and
of four parts of the other 48 bits again one, which gives 16 keys of 28 bits. Inside a group fingerprints are sorted by
Gray rank, so that neighbours share bits; runs of them become nodes holding the mask and pattern of the bits all members
share, and so on upwards. A search goes down from the root, adds up differences on the bits that a node newly fixes, and
drops the whole node when they exceed the limit. A group beyond `LARGEST_GROUP` is passed on and split by parts of its
remaining bits, as often as needed, so no task holds a large group and no pair is lost.

Defined results: a text without words (null, empty, blanks) has fingerprint zero and links like any other; texts of one or
two words are one shingle; equal fingerprints are linked; rows with a null doc_id take part, and component_id is the
smallest id that is not null (null if there is none); an empty table gives no rows; other columns are not read by
`fingerprints` and pass through `kept_documents`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, roots, stored
from .components import components

SHINGLE = 3
SEED = 42
NEAR = 3
LARGEST_GROUP = 4096
_FAN = 8
_BLOCK = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_PAIRS = 4_000_000


def _word_blocks(text: bytes) -> Iterator[list[bytes]]:
    """Words of the text, in blocks of about a megabyte."""
    at = 0
    while at < len(text):
        end = _BLANK.search(text, at + _BLOCK) if len(text) - at > _BLOCK else None
        stop = end.start() if end else len(text)
        yield text[at:stop].split()
        at = stop


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64 majority bits of the hashes of all shingles."""
    count, total, tail = np.zeros(64, dtype=np.int64), 0, []
    for words in _word_blocks((text or b"").lower()):
        words = tail + words
        if len(words) >= shingle:
            parts = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
            hashes = np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), dtype=np.uint64)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            count += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        tail = words[-(shingle - 1) :] if shingle > 1 else []
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED) if tail else 0
    return int(np.packbits(2 * count > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, text_key (a hash that tells rows of one id apart), fp (the fingerprint as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found.view(np.int64))], names=["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


def gray_rank(code: np.ndarray) -> np.ndarray:
    """Place of each code in the order of the reflected Gray code."""
    code = code.copy()
    for by in (1, 2, 4, 8, 16, 32):
        code ^= code >> np.uint64(by)
    return code


class GrayIndex:
    """Hierarchical indexes over the codes of many groups at once; `group` is sorted and counts from 0."""

    def __init__(self, group: np.ndarray, code: np.ndarray, fan: int = _FAN):
        self.group, self.code = group, code
        everything = np.full(len(code), np.iinfo(np.uint64).max, dtype=np.uint64)
        # Per level, leaves first: masks and patterns of shared bits, last leaf below, first and last child.
        self.levels = [(everything, code, np.arange(len(code)), None)]
        owner = group
        while len(owner) > group[-1] + 1:
            mask, pattern, last, _ = self.levels[-1]
            first_of_group = np.searchsorted(owner, owner)
            node = (np.arange(len(owner)) - first_of_group) // fan
            start = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (node[1:] != node[:-1])])
            stop = np.r_[start[1:], len(owner)]
            differ = np.bitwise_or.reduceat(pattern ^ np.repeat(pattern[start], stop - start), start)
            shared = np.bitwise_and.reduceat(mask, start) & ~differ
            self.levels.append((shared, pattern[start] & shared, last[stop - 1], (start, stop)))
            owner = owner[start]

    def pairs(self, query: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later code of its group) at `near` or fewer differing bits."""
        node, q = self.group[query], query
        mask, pattern, last, children = self.levels[-1]
        apart = np.bitwise_count((self.code[q] ^ pattern[node]) & mask[node]).astype(np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            near_enough = (apart <= near) & (last[node] > q)
            q, node, apart = q[near_enough], node[near_enough], apart[near_enough]
            start, stop = children
            width = stop[node] - start[node]
            child = np.arange(width.sum()) + np.repeat(start[node] - np.r_[0, np.cumsum(width)[:-1]], width) if len(node) else node
            known = np.repeat(mask[node], width)
            q, apart = np.repeat(q, width), np.repeat(apart, width)
            mask, pattern, last, children = self.levels[level - 1]
            apart += np.bitwise_count((self.code[q] ^ pattern[child]) & mask[child] & ~known)
            node = child
        hit = (apart <= near) & (node > q)
        return q[hit], node[hit]


def link_groups(group: np.ndarray, code: np.ndarray, near: int = NEAR) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect, inside every group, all codes linked at `near` or fewer bits; a forest, not all pairs."""
    sizes = np.unique(group, return_counts=True)[1]
    many = np.repeat(sizes > 1, sizes)
    group, code = group[many], code[many]
    if not len(code):
        return code, code
    group = np.cumsum(np.r_[0, group[1:] != group[:-1]])
    order = np.lexsort((gray_rank(code), group))
    code = code[order]
    index, label = GrayIndex(group, code), np.arange(len(code))
    work = np.cumsum(np.repeat(sizes[sizes > 1], sizes[sizes > 1]))
    for part in np.split(np.arange(len(code)), np.searchsorted(work, np.arange(_PAIRS, work[-1], _PAIRS))):
        if len(part):
            a, b = index.pairs(part, near)
            fresh = label[a] != label[b]
            a, b = a[fresh], b[fresh]
            if len(a):
                label = roots(np.r_[np.arange(len(code)), a], np.r_[label, b], len(code))
    child = np.flatnonzero(label != np.arange(len(code)))
    return code[child], code[label[child]]


def _parts(mask: int) -> list[int]:
    """The bits outside `mask`, as up to four masks; codes that differ in 3 or fewer of them agree on one (or on all)."""
    free = [i for i in range(64) if not mask >> i & 1]
    cuts = [round(len(free) * k / (NEAR + 1)) for k in range(NEAR + 2)]
    return [sum(1 << i for i in free[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _solve(batches: Iterator[pa.RecordBatch], largest: int) -> Iterator[pa.RecordBatch]:
    """Rows (mask, value, fp) sorted by key; gives edges (a, b, null) and codes of too large groups (fp, null, mask)."""

    def out(a: np.ndarray, b: np.ndarray | None, mask: np.ndarray | None = None) -> pa.RecordBatch:
        none = pa.nulls(len(a), pa.int64())
        columns = [pa.array(a.view(np.int64)), none if b is None else pa.array(b.view(np.int64)), none if mask is None else pa.array(mask)]
        return pa.RecordBatch.from_arrays(columns, names=["a", "b", "mask"])

    def solved(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        fresh = np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]
        group = np.cumsum(fresh) - 1
        large = np.bincount(group)[group] > largest
        if large.any():
            yield out(rows[large, 2].copy(), None, rows[large, 0].copy())
        if not large.all():
            yield out(*link_groups(group[~large], rows[~large, 2].copy().view(np.uint64)))

    held: list[np.ndarray] = []
    passing: tuple[int, int] | None = None  # the key of a large group whose rows go straight through
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy() for i in range(3)], axis=1)
        if passing:
            same = (rows[:, :2] == passing).all(axis=1)
            if same.any():
                yield out(rows[same, 2].copy(), None, rows[same, 0].copy())
            if same.all():
                continue
            rows, passing = rows[~same], None
        held.append(rows)
        if sum(map(len, held)) < max(100_000, 2 * largest):
            continue
        rows = np.concatenate(held)
        last = (rows[:, :2] == rows[-1, :2]).all(axis=1)
        if last.sum() > largest:
            passing, held = (int(rows[-1, 0]), int(rows[-1, 1])), []
            yield out(rows[last, 2].copy(), None, rows[last, 0].copy())
        else:
            held = [rows[last]]
        if not last.all():
            yield from solved(rows[~last])
    if held and sum(map(len, held)):
        yield from solved(np.concatenate(held))


def links(codes: DataFrame, largest: int = LARGEST_GROUP) -> DataFrame:
    """Edges (a, b) between the distinct codes of column fp that connect all codes within `NEAR` bits."""
    full = (1 << 64) - 1
    deeper = {0: [m | p for m in _parts(0) for p in _parts(m)]}
    rows = codes.select("fp", F.lit(0).cast("long").alias("mask"))
    found: DataFrame | None = None
    while True:
        wider = F.create_map(*[F.lit(x) for m, ways in deeper.items() for x in (_signed(m), [_signed(w) for w in ways])])
        keyed = rows.select("fp", F.explode(F.element_at(wider, F.col("mask"))).alias("mask"))
        keyed = keyed.select("mask", F.col("mask").bitwiseAND(F.col("fp")).alias("value"), "fp")
        keyed = keyed.repartition("mask", "value").sortWithinPartitions("mask", "value")
        solved = stored(keyed.mapInArrow(lambda batches: _solve(batches, largest), "a long, b long, mask long"))
        edges = solved.where("b is not null").select("a", "b")
        found = edges if found is None else found.union(edges)
        rows = solved.where("mask is not null").select(F.col("a").alias("fp"), "mask").distinct()
        deeper = {w: [w | p for p in _parts(w) if p] for ways in deeper.values() for w in ways if w != full}
        if not deeper or rows.isEmpty():
            return found


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, largest: int = LARGEST_GROUP) -> DataFrame:
    """doc_id, text_key, fp, component_id, kept for every document."""
    prints = stored(fingerprints(docs, shingle))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first")
    codes = stored(prints.groupBy("fp").agg(first))
    joined = components(links(codes, largest)).select(F.col("node").alias("fp"), "root")
    known = stored(codes.join(joined, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))
    least = known.groupBy("root").agg(F.min("first").alias("first"))
    classes = stored(known.select("fp", "root").join(stored(least), "root").select("fp", "first"))
    kept = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.col("text_key").eqNullSafe(F.col("first.text_key"))
    return prints.join(classes, "fp").select("doc_id", "text_key", "fp", F.col("first.doc_id").alias("component_id"), kept.alias("kept"))


def hexadecimal(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def kept_documents(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all columns; rows that repeat both id and text
    count as one document."""
    gone = near_duplicates(docs, shingle).where("not kept").select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    rows, names = numbered(docs)
    same = F.col(names["doc_id"]).cast("long").eqNullSafe(F.col("id")) & (F.xxhash64(names["text"]) == F.col("key"))
    return rows.join(stored(gone.distinct()), same, "left_anti").select(*[F.col(n).alias(c) for c, n in names.items()])

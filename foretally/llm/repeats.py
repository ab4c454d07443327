"""Substring dedup by maximal repeats of an enhanced suffix array.

A corpus-wide suffix array is built in pieces that need nothing from each other. Every `LEAST`-byte window has an anchor:
the `ANCHOR` bytes inside it with the least hash. Equal windows have equal anchors, so all windows with one anchor go to
one place, as short strings that cover runs of neighbouring windows. There the suffixes are sorted, common prefixes of
neighbours are computed, and a stack scan walks the tree of common-prefix intervals: an interval of `LEAST` or more bytes
whose members differ in the byte to their left is a maximal repeat, and all its occurrences are known. In every repeat
the occurrences beyond the smallest doc_id are marked. Anchors that occur in one document only are dropped before any
text moves.

Defined results: null counts as empty; a row without doc_id comes after all others, and such rows do not mark each other;
rows of equal doc_id do not mark each other either (each is judged against smaller ids); an empty table gives no rows;
columns other than doc_id and text are not read by the operator and pass through `kept_documents`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

LEAST, ANCHOR = 50, 16
_LAST = (1 << 63) - 1
#: Bytes scanned at once; longer texts are scanned in such blocks, which overlap by LEAST - 1 bytes.
BLOCK = 1 << 20
#: Rows of one anchor held at once; of more, only the distinct strings and their least documents are kept.
HELD = 100_000
_POS = np.uint64((1 << 24) - 1)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on, as one number."""
    n = len(text) - 7
    out, raw = np.empty(n, dtype=np.uint64), text.tobytes()
    for off in range(min(8, n)):
        count = (n - off + 7) // 8
        out[off::8] = np.frombuffer(raw, dtype="<u8", count=count, offset=off)
    return out


def _anchor_hash(text: np.ndarray) -> np.ndarray:
    w = _words(text)
    h = w[:-8] * np.uint64(0x9E3779B97F4A7C15) + w[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def runs(lengths: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor, for parts that stand one after the other in `text` (2**24 bytes at most).

    Gives per run the part, the place in `text`, the length in bytes, and the anchor's hash.
    """
    none = np.zeros(0, dtype=np.int64)
    if len(text) < LEAST:
        return none, none, none, none.astype(np.uint64)
    hashes = _anchor_hash(text)
    least = (hashes & ~_POS) | np.arange(len(hashes), dtype=np.uint64)
    width, span = 1, LEAST - ANCHOR + 1
    while width < span:  # minima over windows of doubling width
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    anchor = (least & _POS).astype(np.int64)
    part = np.repeat(np.arange(len(lengths)), lengths)
    inside = part[: len(anchor)] == part[LEAST - 1 :]
    fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (part[1 : len(anchor)] != part[: len(anchor) - 1])]
    start = np.flatnonzero(inside & fresh)
    if not len(start):
        return none, none, none, none.astype(np.uint64)
    # a run ends before the next start, or where windows stop fitting their part
    stop = np.minimum(np.r_[start[1:], len(anchor)], np.cumsum(lengths)[part[start]] - LEAST + 1)
    return part[start], start, stop - start + LEAST - 1, hashes[anchor[start]]


def _portions(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(text number, offset in it, length) of parts and their bytes, about `BLOCK` at a time."""
    which, offset, raw, size = [], [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LEAST + 1), BLOCK):
            piece = t[at : at + BLOCK + LEAST - 1]
            which.append(i), offset.append(at), raw.append(piece)
            size += len(piece)
            if size >= BLOCK:
                yield np.array(which), np.array(offset), np.array([len(x) for x in raw]), np.frombuffer(b"".join(raw), dtype=np.uint8)
                which, offset, raw, size = [], [], [], 0
    if raw:
        yield np.array(which), np.array(offset), np.array([len(x) for x in raw]), np.frombuffer(b"".join(raw), dtype=np.uint8)


def _gather(text: np.ndarray, start: np.ndarray, length: np.ndarray) -> pa.Array:
    """Slices of `text` as a binary array."""
    ends = np.cumsum(length)
    at = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - length), length)
    offsets = pa.py_buffer(np.r_[0, ends].astype(np.int32).tobytes())
    return pa.Array.from_buffers(pa.binary(), len(start), [None, offsets, pa.py_buffer(text[at].tobytes())])


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text) -> (anchor, doc), each once per text."""
    for batch in batches:
        doc, texts = batch.column(0).to_numpy(), [t.as_py() for t in batch.column(1)]
        for which, _, lengths, text in _portions(texts):
            part, _, _, anchor = runs(lengths, text)
            owner = which[part]
            order = np.lexsort((anchor, owner))
            owner, anchor = owner[order], anchor[order]
            if len(anchor):
                once = np.r_[True, (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])]
                yield pa.RecordBatch.from_arrays([pa.array(anchor[once].view(np.int64)), pa.array(doc[owner[once]])], names=["anchor", "doc"])


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, key, text, upper halves of anchors) -> (anchor, doc, key, bytes, starts): the runs with one of the anchors
    (and the odd one with the same half, which then meets no other); equal ones of a text as one row."""
    for batch in batches:
        doc, key, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy(), [t.as_py() for t in batch.column(2)]
        lists = batch.column(3)
        wanted, owner = lists.flatten().to_numpy().astype(np.int64).view(np.uint64), np.repeat(np.arange(len(doc)), lists.value_lengths().to_numpy())
        salt = np.uint64(0x9E3779B97F4A7C15)
        wanted = np.sort(wanted + owner.astype(np.uint64) * salt)
        for which, offset, lengths, text in _portions(texts):
            part, start, length, anchor = runs(lengths, text)
            mixed = (anchor.view(np.int64) >> 32).view(np.uint64) + which[part].astype(np.uint64) * salt
            place = np.searchsorted(wanted, mixed)
            hit = (place < len(wanted)) & (wanted[np.minimum(place, len(wanted) - 1)] == mixed) if len(wanted) else np.zeros(len(mixed), dtype=bool)
            if not hit.any():
                continue
            part, start, length, anchor = part[hit], start[hit], length[hit], anchor[hit]
            first = np.cumsum(lengths) - lengths
            coded = _gather(text, start, length).dictionary_encode()
            code, owner, place = coded.indices.to_numpy(), which[part], start - first[part] + offset[part]
            order = np.lexsort((place, code, owner))
            head = np.flatnonzero(np.r_[True, (code[order][1:] != code[order][:-1]) | (owner[order][1:] != owner[order][:-1])])
            at = order[head]
            starts = pa.ListArray.from_arrays(pa.array(np.r_[head, len(order)].astype(np.int32)), pa.array(place[order]))
            columns = [pa.array(anchor[at].view(np.int64)), pa.array(doc[owner[at]]), pa.array(key[owner[at]]), coded.dictionary.take(pa.array(code[at])), starts]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "doc", "key", "bytes", "starts"])


def maximal_repeats(group: np.ndarray, strings: list[bytes], least: int = LEAST) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, strings, places) of every maximal repeat of `least` or more bytes among strings of one group; all its
    occurrences in them. Strings are different within a group."""
    size = np.array([len(s) for s in strings])
    windows = size - least + 1
    owner = np.repeat(np.arange(len(strings)), windows)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    widest = int(size.max())
    text = np.frombuffer(b"".join(s.ljust(2 * widest, b"\0") for s in strings), dtype=np.uint8)
    at = owner * 2 * widest + place
    matrix = np.empty((len(owner), 8 + widest), dtype=np.uint8)
    matrix[:, :8] = group[owner].astype(">u8").view(np.uint8).reshape(-1, 8)
    matrix[:, 8:] = np.lib.stride_tricks.sliding_window_view(text, widest)[at]
    order = np.argsort(matrix.view(f"V{matrix.shape[1]}").ravel().view(f"S{matrix.shape[1]}"), kind="stable")
    matrix, owner, place = matrix[order], owner[order], place[order]
    differ = matrix[1:] != matrix[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), matrix.shape[1]) - 8
    rest = size[owner] - place
    common = np.minimum(common, np.minimum(rest[1:], rest[:-1]))
    # the byte to the left; the start of a string is like no other
    left = np.where(place > 0, text[np.maximum(owner * 2 * widest + place - 1, 0)].astype(np.int64), -1 - owner)
    long = common >= least
    edges = np.flatnonzero(np.diff(np.r_[False, long, False].astype(np.int8)))
    for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        # suffixes lo..hi share `least` bytes each with the next: scan their tree of intervals
        depth, seen = [*common[lo:hi].tolist(), -1], left[lo : hi + 1].tolist()
        stack: list[list] = []  # [depth, first suffix, left byte or None for several]
        for i, d in enumerate(depth):
            first, byte = i, seen[i]
            while stack and stack[-1][0] > d:
                top, first, was = stack.pop()
                byte = was if was == byte else None
                if byte is None:
                    yield top, owner[lo + first : lo + i + 1], place[lo + first : lo + i + 1]
            if d < 0:
                break
            if stack and stack[-1][0] == d:
                stack[-1][2] = stack[-1][2] if stack[-1][2] == byte else None
            else:
                stack.append([d, first, byte])


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `_strings`, sorted by anchor and doc -> (doc, key, start, stop): bytes that a smaller doc has as well."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def solved(part: pa.Table) -> pa.RecordBatch:
        anchor, doc = part.column("anchor").to_numpy(), part.column("doc").to_numpy()
        group = np.cumsum(np.r_[True, anchor[1:] != anchor[:-1]]) - 1
        coded = part.column("bytes").combine_chunks().dictionary_encode()
        code = coded.indices.to_numpy()
        # distinct strings of each group; rows are sorted by doc, so the first row has the least
        order = np.lexsort((code, group))
        head = np.flatnonzero(np.r_[True, (group[order][1:] != group[order][:-1]) | (code[order][1:] != code[order][:-1])])
        string = np.empty(len(order), dtype=np.int64)
        string[order] = np.repeat(np.arange(len(head)), np.diff(np.r_[head, len(order)]))
        at = order[head]
        owner_group, least = group[at], doc[at]
        size = np.array([len(b) for b in coded.dictionary.to_pylist()])[code[at]]
        # repeats of one whole string
        found = [(np.arange(len(at)), np.zeros(len(at), dtype=np.int64), size, least)]
        several = np.flatnonzero(np.bincount(owner_group)[owner_group] > 1)
        if len(several):
            strings = coded.dictionary.take(pa.array(code[at][several])).to_pylist()
            for length, members, places in maximal_repeats(owner_group[several], strings):
                members = several[members]
                found.append((members, places, np.full(len(members), length), np.full(len(members), least[members].min())))
        member, place, length, low = (np.concatenate(x) for x in zip(*found, strict=True))
        # to every row, the repeats of its string that begin in a smaller doc
        by_string = np.argsort(member, kind="stable")
        place, length, low = place[by_string], length[by_string], low[by_string]
        first, n = np.searchsorted(member[by_string], string), np.bincount(member, minlength=len(at))[string]
        row = np.repeat(np.arange(len(string)), n)
        which = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        later = low[which] < doc[row]
        row, which = row[later], which[later]
        # ranges of one row that overlap or touch become one: rows are laid out one after the other
        room = int(size.max()) + 1
        laid = row * room + place[which]
        union = merged(np.stack([laid, laid + length[which]], axis=1))
        row, from_, to = union[:, 0] // room, union[:, 0] % room, union[:, 1] - union[:, 0] // room * room
        starts = part.column("starts").combine_chunks()
        flat, many = starts.flatten().to_numpy(), starts.value_lengths().to_numpy().astype(np.int64)
        begin = np.cumsum(many) - many
        again = np.repeat(np.arange(len(row)), many[row])
        pick = np.arange(len(again)) + np.repeat(begin[row] - (np.cumsum(many[row]) - many[row]), many[row])
        columns = [doc[row][again], part.column("key").to_numpy()[row][again], flat[pick] + from_[again], flat[pick] + to[again]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc", "key", "start", "stop"])

    def firsts(part: pa.Table) -> pa.Table:
        """One row without places for each distinct string of the one anchor."""
        code = part.column("bytes").combine_chunks().dictionary_encode().indices.to_numpy()
        keep = part.take(pa.array(np.sort(np.unique(code, return_index=True)[1])))
        none = pa.ListArray.from_arrays(pa.array(np.zeros(len(keep) + 1, dtype=np.int32)), pa.array([], pa.int64()))
        return keep.set_column(keep.schema.get_field_index("starts"), "starts", none)

    limit = HELD
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < limit:
            continue
        whole = _as_table(held)
        anchor = whole.column("anchor").to_numpy()
        cut = int(np.searchsorted(anchor == anchor[-1], True))
        if cut:
            yield solved(whole.slice(0, cut))
        rest = whole.slice(cut)
        if len(rest) >= limit:  # one anchor with very many rows: later rows only need its strings
            yield solved(rest)
            rest = firsts(rest)
        held, rows = rest.to_batches(), len(rest)
        limit = HELD + 2 * rows
    if rows:
        yield solved(_as_table(held))


def _as_table(batches: list[pa.RecordBatch]) -> pa.Table:
    kinds = pa.schema([("anchor", pa.int64()), ("doc", pa.int64()), ("key", pa.int64()), ("bytes", pa.binary()), ("starts", pa.list_(pa.int64()))])
    return pa.Table.from_batches([pa.RecordBatch.from_arrays([b.column(i).cast(f.type) for i, f in enumerate(kinds)], schema=kinds) for b in batches])


def _keyed(docs: DataFrame) -> DataFrame:
    """doc (null ids last), key (tells texts of one id apart), bytes of the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64(text).alias("key"), text.cast("binary").alias("text"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc, key, spans) per text with spans: arrays of byte ranges, which may overlap, covered by `LEAST`-byte strings
    that also start in a document of smaller doc_id. The key is 0 where one row alone has the id."""
    rows = _keyed(docs)
    anchors = rows.select("doc", "text").mapInArrow(_anchors, "anchor long, doc long")
    same = Window.partitionBy("anchor")
    shared = anchors.withColumn("low", F.min("doc").over(same)).withColumn("high", F.max("doc").over(same)).where("low < high")
    lists = shared.groupBy("doc").agg(F.collect_list(F.shiftright("anchor", 32).cast("int")).alias("anchors"))  # bounded by the text's length
    several = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("doc", F.lit(True).alias("several"))
    lists = stored(lists.join(several, "doc", "left"))
    # the key is noise that does not compress; it travels only with ids that several rows have
    key = F.when(F.col("several"), F.col("key")).otherwise(F.lit(0)).alias("key")
    strings = rows.join(lists, "doc").select("doc", key, "text", "anchors").mapInArrow(_strings, "anchor long, doc long, key long, bytes binary, starts array<long>")
    sorted_ = strings.repartition("anchor").sortWithinPartitions("anchor", "doc")
    spans = stored(sorted_.mapInArrow(_spans, "doc long, key long, start long, stop long"))
    return spans.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def merged(spans: np.ndarray) -> np.ndarray:
    """Ranges (start, stop) as disjoint ranges that do not touch."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    head = np.flatnonzero(np.r_[True, spans[1:, 0] > reach[:-1]])
    return np.stack([spans[head, 0], reach[np.r_[head[1:] - 1, len(spans) - 1]]], axis=1)


def cut_texts(docs: DataFrame) -> DataFrame:
    """doc_id, bytes (what is left of the text), n_bytes, n_removed, n_spans for every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.xxhash64(text).alias("key"), text.cast("binary").alias("text"))
    found = stored(repeated_spans(docs)).select(F.col("doc").alias("of"), F.col("key").alias("of_key"), "spans")
    both = rows.join(found, (F.col("doc") == F.col("of")) & ((F.col("of_key") == 0) | (F.col("key") == F.col("of_key"))), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                left, counts = [], []
                for value, spans in zip(batch.column(1), batch.column(2), strict=True):
                    raw, gone = value.as_py(), np.zeros((0, 2), dtype=np.int64)
                    if spans.is_valid and len(spans.values):
                        gone = merged(np.stack([spans.values.field(0).to_numpy(), spans.values.field(1).to_numpy()], axis=1))
                    keep = np.r_[0, gone[:, 1]], np.r_[gone[:, 0], len(raw)]
                    left.append(b"".join(raw[a:b] for a, b in zip(keep[0].tolist(), keep[1].tolist(), strict=True)))
                    counts.append((len(raw), int((gone[:, 1] - gone[:, 0]).sum()), len(gone)))
                columns = [batch.column(0), pa.array(left, pa.binary()), *(pa.array(c, pa.int64()) for c in zip(*counts, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "bytes", "n_bytes", "n_removed", "n_spans"])

    chosen = both.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "spans")
    return chosen.mapInArrow(run, "doc_id long, bytes binary, n_bytes long, n_removed long, n_spans long")

"""Fill-in-the-middle transformation with a piece table.

A document is a list of descriptors (buffer, start, length) over two buffers that never change: its text in UTF-8 and
the sentinels. Cutting splits a descriptor, an arrangement permutes descriptors and puts sentinels between them, and
restoring finds the sentinels in an output, cuts there, drops them and applies the inverse permutation. Hashes read the
descriptors one after the other; a text is only put together where it is returned.

Where a document is cut, and in which form it comes out, depends on the sha256 of seed and doc_id alone, so a rerun, or
another split of the table into tasks, gives the same rows.

Defined results: null texts count as empty; empty texts and texts that contain a sentinel come out as they are (form
plain, null sizes); n is the number of lines all the same; a null doc_id is hashed as an empty id; rows that repeat are
transformed once each, to equal results; cuts may fall on the ends of the text, so prefix, middle or suffix may be empty; an
empty table gives no rows; of other columns only doc_id and text are read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEED = 7
#: Percent of the documents that are cut, and percent of those that come with the suffix first.
RATE, SUFFIX_FIRST = 100, 50
#: The sentinels before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = PREFIX + SUFFIX + MIDDLE
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: For each form the sentinels in order, and for each the part of the text (prefix 0, middle 1, suffix 2) that follows it.
ARRANGED = {PSM: ((PREFIX, 0), (SUFFIX, 2), (MIDDLE, 1)), SPM: ((SUFFIX, 2), (PREFIX, 0), (MIDDLE, 1))}
_TEXT, _SENTINEL = 0, 1
_ROWS = 256
TRANSFORMED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string, output_sha256 string"


@dataclass(frozen=True)
class PieceTable:
    """Descriptors (buffer, start, length) over buffers of bytes."""

    buffers: tuple[bytes, ...]
    pieces: tuple[tuple[int, int, int], ...]

    @classmethod
    def of(cls, text: bytes) -> PieceTable:
        return cls((text, SENTINELS), ((_TEXT, 0, len(text)),))

    def cut(self, at: int) -> PieceTable:
        """The piece that holds place `at` of the document is split there; empty pieces are kept."""
        out, passed = [], 0
        for i, (buffer, start, length) in enumerate(self.pieces):
            if passed <= at <= passed + length:
                left = at - passed
                parts = ((buffer, start, left), (buffer, start + left, length - left))
                return PieceTable(self.buffers, (*out, *parts, *self.pieces[i + 1 :]))
            out.append((buffer, start, length))
            passed += length
        raise ValueError(f"place {at} lies behind the end {passed}")

    def arranged(self, order: Sequence[int]) -> PieceTable:
        """The pieces named in `order`; those not named are dropped."""
        return PieceTable(self.buffers, tuple(self.pieces[i] for i in order))

    def with_marks(self, marks: Sequence[bytes]) -> PieceTable:
        """A sentinel before each piece."""
        both = [p for mark, piece in zip(marks, self.pieces, strict=True) for p in ((_SENTINEL, SENTINELS.index(mark), len(mark)), piece)]
        return PieceTable(self.buffers, tuple(both))

    def parts(self) -> Iterator[memoryview]:
        views = [memoryview(b) for b in self.buffers]
        for buffer, start, length in self.pieces:
            yield views[buffer][start : start + length]

    def sha256(self) -> str:
        digest = hashlib.sha256()
        for part in self.parts():
            digest.update(part)
        return digest.hexdigest()

    def joined(self) -> bytes:
        return b"".join(self.parts())


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits that depend on seed and doc_id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))


def line_ends(text: bytes) -> np.ndarray:
    """Places in bytes where lines end, with 0 first: entry k is the end of the first k lines."""
    ends = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 10) + 1
    if text and not text.endswith(b"\n"):
        ends = np.append(ends, len(text))
    return np.concatenate([[0], ends]).astype(np.int64)


def characters(part: memoryview) -> int:
    """Code points: bytes that do not continue one."""
    return int(((np.frombuffer(part, dtype=np.uint8) & 0xC0) != 0x80).sum())


def transform(text: bytes, doc_id: int | None, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple[int, str, PieceTable, int | None, int | None]:
    """Lines, form, the output as a piece table, and the code points of prefix and middle."""
    table, ends = PieceTable.of(text), line_ends(text)
    n = len(ends) - 1
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
        return n, PLAIN, table, None, None
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    table = table.cut(int(ends[second])).cut(int(ends[first]))
    prefix, middle, _ = table.parts()
    form = SPM if h4 % 100 < suffix_first else PSM
    marks, order = zip(*ARRANGED[form], strict=True)
    return n, form, table.arranged(order).with_marks(marks), characters(prefix), characters(middle)


def restore(output: bytes, form: str) -> PieceTable:
    """The text behind an output, as descriptors over the output."""
    table = PieceTable.of(output)
    if form == PLAIN:
        return table
    marks, order = zip(*ARRANGED[form], strict=True)
    at = 0
    for mark in marks:  # a sentinel is no part of a cut text, so the first one found is the one that was put there
        at = output.index(mark, at)
        table = table.cut(at).cut(at + len(mark))
        at += len(mark)
    # pieces: what stands before the first sentinel (nothing), then sentinel and part in turns
    inverse = sorted(range(3), key=lambda k: order[k])
    return table.arranged([2 + 2 * k for k in inverse])


def transformed(docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output (the text to train on), output_sha256 for every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                part = whole.slice(at, _ROWS)
                rows = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()), strict=True):
                    n, form, table, prefix, middle = transform(text.as_py() or b"", doc_id, seed, rate, suffix_first)
                    rows.append((doc_id, n, form, prefix, middle, table.joined(), table.sha256()))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                columns[5] = pa.StringArray.from_buffers(len(rows), *columns[5].buffers()[1:])  # bytes of a text stay as they were
                yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in TRANSFORMED.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, TRANSFORMED)


def restored(rows: DataFrame, texts: bool = True) -> DataFrame:
    """All columns of `rows` but `output`, which becomes `restored`, the original text; `restored_sha256` is added.

    Only `output` and `form` are looked at. Without `texts` the column `restored` is left out.
    """
    keep = [c for c in rows.columns if c not in ("output", "restored", "restored_sha256")]
    kinds = dict(rows.dtypes)
    at_output, at_form = len(keep), keep.index("form")
    names = [*keep, *(["restored"] if texts else []), "restored_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                part = whole.slice(at, _ROWS)
                outputs = part.column(at_output).cast(pa.binary())
                tables = [restore(o.as_py() or b"", form) for o, form in zip(outputs, part.column(at_form).to_pylist(), strict=True)]
                columns = [part.column(i) for i in range(at_output)]
                if texts:
                    joined = pa.array([t.joined() for t in tables], pa.binary())
                    columns.append(pa.StringArray.from_buffers(len(tables), *joined.buffers()[1:]))
                yield pa.RecordBatch.from_arrays([*columns, pa.array([t.sha256() for t in tables], pa.string())], names=names)

    schema = [f"`{c}` {kinds[c]}" for c in keep] + (["restored string"] if texts else []) + ["restored_sha256 string"]
    return rows.select(*[F.col(f"`{c}`") for c in keep], "output").mapInArrow(run, ", ".join(schema))

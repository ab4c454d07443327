import hashlib
import random

import numpy as np
import pytest

from foretally.llm import repeats


def brute(rows, least=50):
    """Per row (doc_id, n_bytes, n_removed, n_spans, sha256 of the rest), from the definition."""
    first: dict[bytes, int] = {}
    raw = [((1 << 63) - 1 if d is None else d, (t or "").encode()) for d, t in rows]
    for d, t in sorted(raw, key=lambda x: x[0]):
        for i in range(len(t) - least + 1):
            first.setdefault(t[i : i + least], d)
    out = []
    for (d, t), (doc_id, _) in zip(raw, rows, strict=True):
        gone = np.zeros(len(t) + 2, dtype=bool)
        for i in range(len(t) - least + 1):
            if first[t[i : i + least]] < d:
                gone[i + 1 : i + least + 1] = True
        spans = int((np.diff(gone.astype(int)) == 1).sum())
        out.append((doc_id, len(t), int(gone.sum()), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone[1:], strict=False) if not g)).hexdigest()))
    return sorted(out, key=str)


def made(seed, n, long=400):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(30, 140))) for _ in range(6)]
    rows = []
    for d in range(n):
        text = ""
        while len(text) < rng.randint(0, long):
            text += rng.choice(passages) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh ü") for _ in range(rng.randint(1, 60)))
            if rng.random() < 0.3 and text:
                k = rng.randrange(len(text))
                text = text[:k] + rng.choice("xyz") + text[k + 1 :]
        rows.append((d, text))
    return rows


def got(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = repeats.cut_texts(df).withColumn("sha", F.sha2("bytes", 256)).drop("bytes")
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in out.collect()), key=str)


@pytest.mark.parametrize("block,held", [(1 << 20, 100_000), (97, 40)])
def test_against_definition(spark, monkeypatch, block, held):
    # workers are forked or started anew, so small blocks are tried on the functions themselves below
    rows = made(1, 60) + [(None, "z" * 120), (None, "z" * 130), (7, None), (8, ""), (9, "short"), (61, "ab" * 200), (62, "ab" * 150), (63, "x" + "ab" * 30)]
    rows += [(64, "repeated row " * 20)] * 3 + [(3, "repeated row " * 20)]
    if block == 97:
        monkeypatch.setattr(repeats, "BLOCK", block)
        monkeypatch.setattr(repeats, "HELD", held)
        assert local(rows) == brute(rows)
    else:
        assert got(spark, rows) == brute(rows)


def local(rows):
    """The same steps without Spark."""
    import pyarrow as pa

    raw = [((1 << 63) - 1 if d is None else d, (t or "").encode()) for d, t in rows]
    every = []
    for n, (d, t) in enumerate(raw):
        for batch in [pa.record_batch({"doc": pa.array([d]), "text": pa.array([t], pa.binary())})]:
            anchors = sorted({a >> 32 for b in repeats._anchors(iter([batch])) for a in b.column(0).to_pylist()})
        full = pa.record_batch({"doc": pa.array([d]), "key": pa.array([n]), "text": pa.array([t], pa.binary()), "anchors": pa.array([anchors], pa.list_(pa.int32()))})
        every += [b for b in repeats._strings(iter([full])) if b.num_rows]
    whole = repeats._as_table(every).sort_by([("anchor", "ascending"), ("doc", "ascending")])
    spans: dict[int, list] = {}
    for b in repeats._spans(iter(whole.to_batches(max_chunksize=7))):
        for _, key, start, stop in zip(*(c.to_pylist() for c in b.columns), strict=True):
            spans.setdefault(key, []).append((start, stop))
    out = []
    for n, ((_, t), (doc_id, _)) in enumerate(zip(raw, rows, strict=True)):
        gone = repeats.merged(np.array(spans.get(n, []), dtype=np.int64).reshape(-1, 2))
        keep = b"".join(t[a:b] for a, b in zip([0, *gone[:, 1]], [*gone[:, 0], len(t)], strict=True))
        out.append((doc_id, len(t), int((gone[:, 1] - gone[:, 0]).sum()), len(gone), hashlib.sha256(keep).hexdigest()))
    return sorted(out, key=str)


def test_maximal_repeats_have_all_occurrences():
    strings = [b"xABCDEFGHy", b"zABCDEFGHw", b"qABCDEFr"]
    found = {(n, tuple(sorted(zip(s.tolist(), p.tolist(), strict=True)))) for n, s, p in repeats.maximal_repeats(np.zeros(3, dtype=np.int64), strings, 5)}
    assert found == {(8, ((0, 1), (1, 1))), (6, ((0, 1), (1, 1), (2, 1)))}


def test_empty_table(spark):
    assert got(spark, []) == []


def test_query_against_definition(spark, duck):
    from foretally.llm.queries import op5_repeats
    from tests.conftest import SF

    rows = duck.execute("select doc_id, text from documents").fetchall()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op5_repeats(spark, SF).collect()), key=str)
    assert found == brute(rows)

import math
import random
import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from foretally.llm import lexical as L
from tests.conftest import SF

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    counted = [(d, Counter(split(t))) for d, t in docs]
    counted = [(d, c, sum(c.values())) for d, c in counted if c]
    total, words, df = len(counted), sum(n for _, _, n in counted), Counter(t for _, c, _ in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(split(t))
    out = {}
    for i, wanted in asked.items():
        rows = []
        for at, (d, c, n) in enumerate(counted):
            m = 50 + 50 * n * total // words
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                rows.append((-score, d is None, d or 0, at))
        for rank, (score, none, d, _) in enumerate(sorted(rows)[:k], 1):
            out[i, rank] = (None if none else d, -score)
    return out


@given(st.lists(st.integers(0, 2**31 - 1), min_size=1, max_size=50))
def test_packed_numbers(values):
    raw, ends = L.packed(np.array(values, dtype=np.int64))
    assert L.unpacked(raw).tolist() == values and ends[-1] == len(raw)


def made(seed, n, words=60, most=80):
    rng = random.Random(seed)
    pool = [f"w{i}" for i in range(words)]
    weights = [1 / (i + 1) for i in range(words)]
    return [(i, " ".join(rng.choices(pool, weights, k=rng.randint(0, most)))) for i in range(n)], rng


def one_segment(docs):
    held = L.Held()
    for d, t in docs:
        held.add(d, (t or "").encode())
    return L.segment_of("s", held)


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 12))
def test_block_maxima_are_bounds_and_best_of_is_exact(seed, k):
    import pyarrow as pa

    docs, rng = made(seed, 300)
    index, one = one_segment(docs)
    n = one.column("n")[0].values.to_numpy()
    total, words = len(n), int(n.sum())
    df = index.column("df").to_numpy()
    w = np.floor(1000 * np.log((2 * total + 2) / (2 * df + 1))).astype(np.int64)
    table = pa.Table.from_batches([index]).append_column("w", pa.array(w)).filter(pa.array(w > 0))
    lists = L.Lists(table, n, total, words)
    for t in range(len(lists.df)):
        for b in range(len(lists.last[t])):
            doc, worth = lists.block(t, b)
            assert worth.max() == lists.most[t][b] and doc[-1] == lists.last[t][b]
    names = {t: i for i, t in enumerate(table.column("term").to_pylist())}
    wanted = rng.sample(sorted(names), min(8, len(names)))
    L_STRIDE, L.STRIDE = L.STRIDE, 50
    try:
        doc, score = L.best_of(L.Lists(table, n, total, words), np.array([names[t] for t in wanted]), k)
    finally:
        L.STRIDE = L_STRIDE
    ids = one.column("ids")[0].values.to_pylist()
    want = brute(docs, [(0, " ".join(t.decode() for t in wanted))], k)
    assert [(ids[d], s) for d, s in zip(doc.tolist(), score.tolist(), strict=True)] == [want[0, r + 1] for r in range(len(want))]


def test_candidates_are_given_up_before_blocks_are_read():
    import pyarrow as pa

    rng = random.Random(1)
    docs = [(i, "common " * rng.randint(1, 3) + ("rare " * 8 if i < 60 else "") + " ".join(rng.choices(["x", "y"], k=10))) for i in range(6_000)]
    index, one = one_segment(docs)
    n = one.column("n")[0].values.to_numpy()
    df = index.column("df").to_numpy()
    w = np.floor(1000 * np.log((2 * len(n) + 2) / (2 * df + 1))).astype(np.int64)
    table = pa.Table.from_batches([index]).append_column("w", pa.array(np.maximum(w, 1)))
    lists = L.Lists(table, n, len(n), int(n.sum()))
    at = {t: i for i, t in enumerate(table.column("term").to_pylist())}
    L.best_of(lists, np.array([at[b"rare"], at[b"common"]]), 20)
    blocks = sum(len(x) for t, x in enumerate(lists.last) if t in (at[b"rare"], at[b"common"]))
    assert len(lists.read) < 0.5 * blocks


def test_odd_rows_and_many_segments(spark):
    docs, rng = made(7, 400)
    docs += [(None, "w1 w2 w50 Ünïcode"), (None, "w1 w2 w50 Ünïcode"), (3, "w1 w50"), (3, "w1 w50"), (900, None), (901, ""), (902, "!!! ..."), (903, "W50 É é " * 40_000), (904, "nul\x00w50")]
    items = [(1, "w1 w50 W50 w59"), (1, "w7"), (2, None), (3, "?!"), (4, "ünïcode É absent"), (None, "w3 w4"), (5, " ".join(f"w{i}" for i in range(60)))]
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, n int, term string")
    asked = spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, rank int")
    want = brute(docs, items)
    for segment, block in ((L.SEGMENT, L.QUERY_BLOCK), (7, 2)):
        got = {(r.item_id, r.rank): (r.doc_id, r.score) for r in L.search(L.index(frame, segment), asked, block=block).collect()}
        assert got == want
    assert L.search(L.index(frame.limit(0)), asked).count() == 0
    assert L.search(L.index(frame), asked.limit(0)).count() == 0


def test_query_against_sql_and_all_documents(spark, duck):
    from foretally.llm.queries import QUERIES, SQL

    df = QUERIES["op12_lexical"](spark, SF)
    got = {(r.item_id, r.rank): (r.doc_id, r.score) for r in df.collect()}
    cur = duck.execute(SQL["op12_lexical"])
    assert [c[0] for c in cur.description] == df.columns
    assert {(i, r): (d, s) for i, r, d, s in cur.fetchall()} == got
    docs = duck.execute("select doc_id, text from documents").fetchall()
    assert brute(docs, duck.execute("select item_id, text from benchmark").fetchall()) == got
    assert SF.endswith("0.001")

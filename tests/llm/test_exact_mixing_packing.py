import zlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foretally.llm import exact, mixing, packing
from foretally.llm.queries import SQL, op6_exact_dedup, op8_mixing, op9_packing
from tests.conftest import SF


def same_as_sql(spark, duck, query, name):
    want = duck.execute(SQL[name]).fetch_df()
    got = query(spark, SF).toPandas()[list(want.columns)]
    return sorted(map(tuple, got.astype(object).values.tolist())) == sorted(map(tuple, want.astype(object).values.tolist()))


# exact dedup


def test_exact_query_against_sql(spark, duck):
    assert same_as_sql(spark, duck, op6_exact_dedup, "op6_exact_dedup")


def test_chunks_give_the_text_back(spark):
    texts = ["", "a", "né " * 3000, "x" * 30_000, "then the other\n" * 900, "\n" * 9000, "中文字" * 5000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", "t", exact.chunks("t").alias("c")).collect()
    assert all("".join(r.c) == r.t and all(r.c) for r in rows) and all(len(c) <= exact.LARGEST for r in rows for c in r.c)
    moved = df.select(exact.chunks(F.concat(F.lit("a new beginning "), "t")).alias("c"), "i").where("i = 4").first().c
    assert len(set(moved) & set(rows[4].c)) >= 0.7 * len(set(rows[4].c))


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_odd_rows_and_clashing_hashes(spark, bits):
    rows = [(1, "a", "x"), (2, "a", "y"), (2, "a", "y"), (None, "a", None), (3, None, "x"), (4, "", "x"), (5, "b " * 2000, "x"), (6, "b " * 2000, None), (7, "c", "x"), (8, "d", "x"), (9, "e", "x"), (10, "f", "x"), (None, "g", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keep_id string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.groups(docs, bits).collect()), key=str)
    assert got == sorted([(1, 2, 4, False), (2, 2, 4, True), (2, 2, 4, False), (None, 2, 4, False), (3, 4, 2, False), (4, 4, 2, True), (5, 6, 2, False), (6, 6, 2, True), (7, 7, 1, True), (8, 8, 1, True), (9, 9, 1, True), (10, 10, 1, True), (None, None, 1, True)], key=str)
    kept = exact.kept_documents(docs, bits)
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(["2", "4", "6", "7", "8", "9", "10", "None"])
    assert exact.groups(docs.limit(0), bits).count() == 0


# mixing


def test_mixing_query_against_sql(spark, duck):
    assert same_as_sql(spark, duck, op8_mixing, "op8_mixing")


def level_targets(sizes, weights):
    """Reshare until none is above twice its size."""
    goal, capped, left = {}, set(), 1.5 * sum(sizes.values())
    while True:
        free = [s for s in sizes if s not in capped]
        total = sum(weights[s] for s in free)
        over = [s for s in free if left * weights[s] / total > 2 * sizes[s] + 1e-9]
        if not over:
            return goal | {s: left * weights[s] / total for s in free}
        for s in over:
            goal[s] = 2.0 * sizes[s]
            capped.add(s)
            left -= goal[s]


def test_mixing_reaches_its_targets(spark):
    rows = [(i, "w " * (1 + i % 9), None if i % 3 == 0 else f"s{i % 7}", "z") for i in range(6000)]
    rows += [(None, None, "s1", "z"), (1, "", "s2", "z"), (8, "w", "s1", "z"), (8, "w", "s1", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies string")
    got = mixing.mix(docs).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    source = {(r[0], len((r[1] or "").split())): r[2] for r in rows}
    for r in got:
        assert r.taken <= 2 * r.size
        s = source[r.doc_id, r.size]
        sizes[s] += r.size
        taken[s] += r.taken
        target[s] = r.target
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    want = level_targets(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)})
    for s in order:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - target[s]) <= 9
    assert sorted(map(tuple, mixing.mix(docs.repartition(5)).collect()), key=str) == sorted(map(tuple, got), key=str)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns and sum(len((r.text or "").split()) for r in mixed.collect()) == sum(taken.values())
    assert mixing.mix(docs.limit(0)).count() == 0


# packing


@settings(max_examples=60, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(1, 32), max_size=80))
def test_best_fit_against_a_plain_search(lengths):
    lengths = sorted(lengths, reverse=True)
    import numpy as np

    where, offset = packing.best_fit(np.array(lengths, dtype=np.int64), 32)
    free: list[int] = []
    for n, w, o in zip(lengths, where.tolist(), offset.tolist(), strict=True):
        fits = [f for f in free if f >= n]
        if fits:
            assert 32 - o == free[w] == min(fits)
        else:
            free.append(32)
            assert w == len(free) - 1 and o == 0
        free[w] -= n


def plain_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(f"{packing.VOCABULARY}.json"))


@settings(max_examples=80, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(max_size=300))
def test_ids_are_those_of_the_tokenizer(text):
    slow = plain_tokenizer()
    text = text.encode("utf-8", "replace").decode()
    assert packing.token_ids(text).tolist() == [*slow.encode(text, add_special_tokens=False).ids, packing.END_ID]


def test_ids_of_unusual_texts():
    slow = plain_tokenizer()
    assert 50256 in packing.token_ids("a <|endoftext|> b")
    for text in ("", "<|endoftext|> a", "a <|endoftext|><|endoftext|>b", "<|endoftext", "a" * 3999, "ab" * 30_000, " " * 5000 + "x", "\n\r\n\t" * 50, "日本語テキスト " * 20, "don't I'LL we've", "é‍🏳️‍🌈"):
        assert packing.token_ids(text).tolist()[:-1] == slow.encode(text, add_special_tokens=False).ids


def test_packing_is_a_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").union(spark.createDataFrame([(-1, None, "x", "y", 0), (-2, "", None, None, None), (-3, "word " * 9000, "x", "y", 1), (-3, "word " * 9000, "x", "y", 1)], "doc_id long, text string, lang string, source string, n_chars long"))
    rows = packing.pack(docs, group=64).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(r.text)
    for doc_id, copies in texts.items():
        ids = packing.token_ids(copies[0])
        want = [(s, n, c, len(ids)) for s, n, c in packing.cut(ids)] * len(copies)
        assert sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by_doc[doc_id]) == sorted(want)
    assert zlib.crc32(packing.token_ids("").tobytes()) == by_doc[-2][0].ids_crc32
    assert packing.pack(docs.limit(0)).count() == 0


def test_little_padding(spark):
    rows = op9_packing(spark, SF).collect()
    used = sum(r.length for r in rows)
    assert 1 - used / (packing.WINDOW * len({r.sequence_id for r in rows})) < 0.02

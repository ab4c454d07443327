import random

import numpy as np
import pytest
import xxhash

from foretally.llm import simhash
from foretally.llm.components import components


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({i: " " for i in range(9, 14)}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, near=3):
    codes = sorted(set(codes))
    root = {c: c for c in codes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(codes):
        for b in codes[:i]:
            if bin(a ^ b).count("1") <= near:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {c: find(c) for c in codes}


def family(rng, n, flips, centre=None):
    centre = rng.getrandbits(64) if centre is None else centre
    out = set()
    while len(out) < n:
        x = centre
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


def test_fingerprint_against_brute_force():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 400):
        for _ in range(5):
            text = "".join(rng.choice(["a", "B", "é", "ÀB", " ", "\n", "\x0b", " ", "Z "]) for _ in range(n * 3))
            assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)
    assert simhash.fingerprint(None) == 0


def test_blocks_do_not_change_a_fingerprint(monkeypatch):
    text = " ".join(str(i % 97) for i in range(5000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "_BLOCK", 100)
    assert simhash.fingerprint(text.encode()) == whole == brute_fingerprint(text)


def test_gray_rank_orders_codes_by_one_flip():
    codes = np.arange(1024, dtype=np.uint64)
    ordered = codes[np.argsort(simhash.gray_rank(codes))]
    assert all(int(a ^ b).bit_count() == 1 for a, b in zip(ordered, ordered[1:], strict=False))


@pytest.mark.parametrize("n,flips", [(2, 3), (40, 4), (300, 6), (900, 9)])
def test_index_finds_every_pair(n, flips):
    rng = random.Random(n)
    codes = np.array(family(rng, n, flips), dtype=np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    a, b = simhash.GrayIndex(np.zeros(n, dtype=np.int64), codes).pairs(np.arange(n), 3)
    want = {(i, j) for i in range(n) for j in range(i + 1, n) if int(codes[i] ^ codes[j]).bit_count() <= 3}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want and len(a) == len(want)


def roots_of(spark, codes, **more):
    df = spark.createDataFrame([(simhash._signed(c),) for c in codes], "fp long")
    found = {r.node % (1 << 64): r.root for r in components(simhash.links(df, **more)).collect()}
    out = {}
    for c in codes:
        out.setdefault(found.get(c, simhash._signed(c)), set()).add(c)
    return sorted(map(sorted, out.values()))


@pytest.mark.parametrize("largest", [simhash.LARGEST_GROUP, 16])
def test_links_connect_what_brute_force_connects(spark, largest):
    rng = random.Random(3)
    codes = {0, 7, (1 << 64) - 1}
    for n, flips in ((200, 3), (150, 8), (60, 12)):
        codes |= set(family(rng, n, flips))
    codes |= {rng.getrandbits(64) for _ in range(200)}
    want = {}
    for c, r in brute_components(codes).items():
        want.setdefault(r, set()).add(c)
    assert roots_of(spark, sorted(codes), largest=largest) == sorted(map(sorted, want.values()))


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert len({got[i] for i in range(201)}) == 1 and len({got[i] for i in range(1000, 1300)}) == 1 and len(got) == 501


def test_odd_rows(spark):
    rows = [(3, "a b c", "x"), (1, "A b C", "y"), (None, "a b c", "z"), (7, None, None), (9, "", "q"), (8, " \n", "q"), (3, "a b c", "x"), (3, "other words here", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id, r.component_id, r.fp) for r in simhash.near_duplicates(docs).collect()), key=str)
    assert [(a, b) for a, b, _ in got] == [(1, 1), (3, 1), (3, 1), (3, 3), (7, 7), (8, 7), (9, 7), (None, 1)]
    kept = simhash.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 7]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark, duck):
    from foretally.llm.queries import op2_simhash
    from tests.conftest import SF

    rows = duck.execute("select doc_id, text from documents").fetchall()
    prints = {d: brute_fingerprint(t) for d, t in rows}
    root = brute_components(prints.values())
    least = {}
    for d, p in prints.items():
        least[root[p]] = min(d, least.get(root[p], d))
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in op2_simhash(spark, SF).collect()}
    assert got == {(d, f"{p:016x}", least[root[p]]) for d, p in prints.items()}

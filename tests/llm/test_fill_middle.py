import hashlib
import random
import re

from hypothesis import given
from hypothesis import strategies as st

from foretally.llm import fill_middle as M
from tests.conftest import SF


def brute(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(lines)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h4 % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@given(st.integers(0, 10**9), st.text(alphabet=st.sampled_from("aé\n\r<PSM>日\x00 "), max_size=60))
def test_round_trip_and_forms(doc_id, text):
    n, form, table, prefix, middle = M.transform(text.encode(), doc_id)
    want = brute(doc_id, text)
    assert (n, form, prefix, middle) == want[:4]
    output = table.joined()
    assert output == want[4].encode() and table.sha256() == hashlib.sha256(output).hexdigest()
    back = M.restore(output, form)
    assert back.joined() == text.encode() and back.sha256() == hashlib.sha256(text.encode()).hexdigest()


def test_cutting_never_touches_the_buffers():
    table = M.PieceTable.of("añb\ncd".encode())
    cut = table.cut(3).cut(0).cut(7)
    assert cut.buffers is table.buffers or cut.buffers == table.buffers
    assert [bytes(p) for p in cut.parts()] == [b"", "añ".encode(), b"b\ncd", b""] and cut.joined() == table.joined()
    assert cut.arranged([2, 1]).joined() == "b\ncdañ".encode()


def test_odd_rows(spark):
    rng = random.Random(3)
    long = "\n".join("x" * rng.randrange(50) for _ in range(20_000))
    rows = [(1, None, "a"), (2, "", "b"), (3, "one line", "c"), (3, "one line", "c"), (4, "has <M> inside\n", None), (None, "no id\nat all\n", "d"), (5, long, "e"), (6, "\n\n\n", "f"), (7, "nul \x00 and\r\nreturns", "g")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, form string, output string, n int")
    out = M.transformed(docs)
    assert out.count() == len(rows) and M.transformed(docs.limit(0)).count() == 0
    back = M.restored(out).collect()
    by = {(r.doc_id, r.restored) for r in back}
    assert by == {(d, t or "") for d, t, _ in rows}
    for r in out.collect():
        text = next(t for d, t, _ in rows if d == r.doc_id)
        want = brute("" if r.doc_id is None else r.doc_id, text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == want


def test_query_against_sql_and_the_plain_way(spark, duck):
    from foretally.llm.queries import QUERIES, SQL

    df = QUERIES["op11_fill_middle"](spark, SF)
    got = sorted(tuple(r) for r in df.collect())
    cur = duck.execute(SQL["op11_fill_middle"])
    assert [c[0] for c in cur.description] == df.columns and sorted(cur.fetchall()) == got
    for r in df.collect()[:20]:
        assert r.restored_sha256 and r.form in ("spm", "psm", "plain")


def test_rate_and_share(spark):
    docs = spark.createDataFrame([(i, f"a{i}\nb\nc\n") for i in range(400)], "doc_id long, text string")
    count = {r.form: r["count"] for r in M.transformed(docs, rate=50, suffix_first=20).groupBy("form").count().collect()}
    assert 150 < count["plain"] < 250 and count["spm"] < count["psm"]

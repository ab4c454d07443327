import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from foretally.llm import personal_data as P
from tests.conftest import SF

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    """The spans that stay, found the plain way: (start, kind number, end)."""
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": lambda m=m: True, "ip": lambda m=m: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda d=digits: 12 <= len(d) <= 19 and luhn(d), "phone": lambda d=digits: 9 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{P.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def odd_texts():
    rng = random.Random(4)
    out = [
        None, "", "a@b.c_d@e.f.g", "x@y@z.w", "mail..a@b-c.d.e-", "a@b. c@d", "1.2.3.4.5.6.7.8", "300.1.2.3.4.5.6", "1.2.3 4.5.6.7", "007.0.0.255", "0000256.1.1.1",
        "4111111111111111", "4111 1111-1111 1111", "4111  1111 1111 1111", "41111111111111112222222", "x4111111111111111y", "1 4111111111111111", "4111111111111111 1", "- 4111-1111-1111-1111-",
        "+1 (555) 010-9999 ext", "+49 30 1234567", "+1234", "+1-2-3-4-5-6-7-8-9-", "+1 555 010 9999 +1 555 010 9998", "+ 123456789", "++123456789", "+123456789)(", "+1234567890123456", "+1((((((((23456789",
        "日本 a@b.c é +1 (555) 010-9999 ñ 10.0.0.1 ü 4111111111111111", "a@b.c a@b.c a@b.c",
    ]
    for _ in range(400):
        out.append("".join(rng.choice("0123456789.@+- ()ab_é") for _ in range(rng.randint(0, 40))))
    for _ in range(200):
        out.append("".join(rng.choice("0123456789 -") for _ in range(rng.randint(10, 30))))
    return out


def test_strict_spans_against_the_plain_patterns(spark):
    rows = list(enumerate(odd_texts()))
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "doc_id long, text string, spans string, kind int")
    got = {r.doc_id: r for r in P.personal_data(docs).collect()}
    assert len(got) == len(rows)
    for d, text in rows:
        want = brute(text)
        r = got[d]
        assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest(), text
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == j for _, k, _ in want) for j in range(4)]
        spans = [s for s in r.spans.split(",") if s]
        assert set(filter(None, listed(want).split(","))) <= set(spans) and r.n_added == len(spans) - len(want)


def test_runs_of_any_length_are_read_once(spark):
    parts = ["a" * 300_000, "1" * 300_000, "1 " * 150_000, "1." * 150_000, "+1" + " " * 300_000, "+1(" * 100_000, "a@" * 150_000, "@" * 200_000, "1-" * 150_000, "1234 " * 60_000, "a.b@c.d " * 40_000, "ab:" * 90_000, "a at b " * 40_000]
    docs = spark.createDataFrame(list(enumerate(parts)), "doc_id long, text string")
    got = {r.doc_id: r for r in P.personal_data(docs).collect()}
    assert got[10].n_email == 40_000 and all(r.n_email + r.n_card + r.n_phone == 0 for d, r in got.items() if d != 10)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(1, "write a@b.com"), (1, "write a@b.com"), (None, "a@b.com 10.0.0.1"), (None, None), (2, "")]
    got = P.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.spans) for r in got) == [(0, ""), (0, "email:0:7,ip:8:16"), (1, "email:6:13"), (1, "email:6:13"), (2, "")]
    assert P.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def made(seed, n):
    """Texts with spans that only the wider patterns propose, and lookalikes: (text, true spans, false spans)."""
    rng = random.Random(seed)
    words = "the engine reads every value from a table and writes one report about stations".split()
    out = []
    for i in range(n):
        lead, tail = " ".join(rng.choices(words, k=8)), " ".join(rng.choices(words, k=8))
        a, b, c, d = (rng.randrange(100, 999) for _ in range(4))
        true = rng.random() < 0.6
        value, intro = rng.choice([
            (f"user{i} [at] mail{a} [dot] com", "mail"), (f"({a}) {b}-{c}{d % 10}", "call"), (f"{i % 9000 + 1000:04d}.{a}1.{b}2.{c}3", "card"), (f"user{i}@mail{a}.example.com", "contact"),
        ] if true else [(f"{a}-{b}-{c}{d % 10}", "serial"), (f"{a}{b}{c}{d}{a}{b % 100}"[:16], "order"), (f"999.{a}.{b}.{c}", "version")])
        out.append((f"{lead} {intro} {value} {tail}", value, true))
    return out


def test_added_spans_of_planted_texts(spark):
    rows = made(5, 900)
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in P.personal_data(docs).collect()}
    hit = wrong = asked = 0
    for i, (text, value, true) in enumerate(rows):
        at = text.index(value)
        spans = {tuple(map(int, s.split(":")[1:])) for s in got[i].spans.split(",") if s}
        if not true:
            wrong += any(a < at + len(value) and b > at for a, b in spans) and not brute(text)
        elif not value.count(".") == 3 or luhn(re.sub("[^0-9]", "", value)):
            asked += 1
            hit += (at, at + len(value)) in spans
    assert asked > 300 and hit >= 0.9 * asked and wrong <= 0.05 * len(rows)


def test_reliabilities_are_found_again(spark):
    """Votes drawn with known shares: the estimate comes near them, and the posterior tells true spans from false."""
    rng = random.Random(9)
    given = {"pattern": (0.05, 0.25, 0.7, 0.6, 0.35, 0.05), "gazetteer": (0.2, 0.1, 0.7, 0.7, 0.1, 0.2), "words_for": (0.0, 0.4, 0.6, 0.0, 0.95, 0.05),
             "words_against": (0.05, 0.95, 0.0, 0.5, 0.5, 0.0), "ends": (0.1, 0.1, 0.8, 0.6, 0.2, 0.2), "shape": (0.3, 0.4, 0.3, 0.3, 0.4, 0.3)}
    rows = []
    for i in range(6_000):
        y = rng.random() < 0.35
        rows.append((0, int(y), *(rng.choices((-1, 0, 1), given[j][:3] if y else given[j][3:])[0] for j in P.LABELERS)))
    votes = spark.createDataFrame(rows, "kind int, y int, " + ", ".join(f"{j} int" for j in P.LABELERS))
    known = P.reliabilities(votes)
    assert known.share[0] == pytest.approx(0.35, abs=0.04)
    for j in P.LABELERS:
        assert known.given[0, j, 1] == pytest.approx(given[j][:3], abs=0.08) and known.given[0, j, 0] == pytest.approx(given[j][3:], abs=0.08)
    right = votes.withColumn("p", known.posterior()).where(((F.col("p") >= 0.5).cast("int")) == F.col("y")).count()
    assert right >= 0.93 * len(rows)


def test_query_against_the_plain_patterns(spark, duck):
    from foretally.llm.queries import QUERIES

    texts = duck.execute("select doc_id, text from documents").fetchall()
    df = QUERIES["op13_personal_data"](spark, SF)
    assert df.columns[:7] == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    got = {r.doc_id: r for r in df.collect()}
    assert len(got) == len(texts)
    for d, text in texts:
        want = brute(text)
        assert got[d].base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest()
        assert not got[d].n_added or want  # nothing is added to texts without personal data

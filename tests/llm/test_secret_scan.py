import random
import string
import time

from foretally.llm import secret_scan as S


def made(seed, n):
    rng = random.Random(seed)
    words = "the engine reads every value from a table and writes one report about stations".split()
    rows = []
    for d in range(n):
        parts = [rng.choice(words) for _ in range(30)]
        kind = rng.choice(["hex", "aws", "card", "mail", "version", "plain"])
        secret = None
        if kind == "hex":
            secret = "".join(rng.choice("0123456789abcdef") for _ in range(40))
            parts.insert(rng.randrange(30), f'{rng.choice(["token", "api_key", "password"])} = "{secret}"')
        elif kind == "aws":
            secret = "AKIA" + "".join(rng.choice(string.ascii_uppercase + string.digits) for _ in range(16))
            parts.insert(rng.randrange(30), f'key "{secret}"')
        elif kind != "plain":
            parts.insert(rng.randrange(30), {"card": "4929 49294929492949", "mail": f"user{d}@mail.example.com", "version": f"release-10.{d}.3.20240101"}[kind])
        rows.append((d, " ".join(parts), "src/main/app.py" if rng.random() < 0.5 else None, secret))
    return rows


def test_finds_planted_secrets_of_the_held_out_fold(spark):
    rows = made(1, 900)
    docs = spark.createDataFrame([(d, t, p, "x") for d, t, p, _ in rows], "doc_id long, text string, source string, label string")
    got = S.scan(docs).collect()
    text = {d: t for d, t, _, _ in rows}
    found = {(r.doc_id, text[r.doc_id][r.start : r.start + r.length]) for r in got if r.is_secret}
    want = {(d, s) for d, _, _, s in rows if s}
    assert len(found & want) >= 0.97 * len(want) and len(found - want) <= 0.02 * len(want)
    held = [r for r in got if r.held_out and r.label is not None]
    assert held and sum(r.is_secret == r.label for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_candidates_against_a_plain_search():
    text = 'a password: hunter2x, token="0123456789abcdef0123" and 10.0.0.255:8080/abc plus abcdefghijklmnop'
    assert [text[a:b] for a, b in S.spans_of(text)] == ["hunter2x", "0123456789abcdef0123", "10.0.0.255:8080/abc"]
    assert S.spans_of("") == [] and S.spans_of("é " * 1000) == []
    assert S.label_of("10.0.0.255", "", "") == 0 and S.label_of("AKIA" + "A1" * 8, "", "") == 1
    long = "a1" * 50_000
    assert S.spans_of(long) == [(0, 100_000)] and len(S.numbers_of(long, "", "", "")) == 19


def test_values_given_in_other_shapes():
    shapes = {
        'db_password          = "Tr0ub4dor"': "Tr0ub4dor", "'password' => 'Tr0ub4dor'": "Tr0ub4dor", 'password1 = "Tr0ub4dor"': "Tr0ub4dor",
        'my_very_long_service_prod_password = "Tr0ub4dor"': "Tr0ub4dor", "api-key: qwertzui": "qwertzui", "token_of_the_second_server:    qwertzui": "qwertzui",
        'password = "correct horse battery staple"': "correct horse battery staple", "x = secret = 'it is \\'so\\' 12'": "it is \\'so\\' 12",
        'password: "open end': None, 'passwort = "Tr0ub4dor"': None,
    }
    for text, value in shapes.items():
        found = [text[a:b] for a, b in S.spans_of(text)]
        assert found == ([value] if value else []), text
    for text in ("token" * 40_000, "token " * 40_000, "token" + " " * 200_000, "token='" * 30_000, 'token="\\' * 30_000):
        start = time.process_time()
        S.spans_of(text)
        assert time.process_time() - start < 5


def test_odd_rows_and_given_labels(spark):
    docs = spark.createDataFrame([(1, None, None), (None, "token = 'abcdef0123456789'", "p"), (2, "", "p")], "doc_id long, text string, source string")
    got = S.scan(docs).collect()
    assert [(r.doc_id, r.start, r.length, r.score) for r in got] == [(None, 9, 16, 0.0)]
    assert S.scan(docs.limit(0)).count() == 0
    given = spark.createDataFrame([(5, 8, 1)], "doc_id long, start long, label int")
    again = spark.createDataFrame([(5, "token = 'abcdef0123456789'", "p")], "doc_id long, text string, source string")
    assert [r.score for r in S.scan(again, findings=given).collect()] == [0.0]

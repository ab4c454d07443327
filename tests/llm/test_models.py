import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from foretally.llm import language, multi_index, toxicity

# toxicity

RUDE = ["blockhead", "numbskull", "stinker", "halfwit"]


def rude_corpus(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    docs, labels = [], []
    for d in range(n):
        text, bad = [rng.choice(words) for _ in range(rng.randint(20, 120))], rng.random() < 0.3
        for _ in range(rng.randint(2, 6) if bad else 0):
            word = rng.choice(RUDE)
            text.insert(rng.randrange(len(text)), rng.choice([word, word.upper() + "!", word.replace("o", "0")]))
        docs.append((d, " ".join(text), "x"))
        labels.append((d, int(bad)))
    return docs, labels


def test_toxicity_on_the_held_out_fold(spark):
    docs, labels = rude_corpus(1, 1500)
    docs += [(None, "you blockhead, you halfwit, you stinker " * 5, "x"), (5000, None, "x"), (5001, "", "x"), (5002, "calm words " * 40_000, "x"), (7, docs[7][1], "y")]
    df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    marks = spark.createDataFrame([*labels, (9999, 1), (3, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score(df, marks).collect()
    assert len(got) == len(docs) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 200 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    by_id = {r.doc_id: r for r in got}
    assert by_id[None].predicted == 1 and by_id[5000].predicted == by_id[5001].predicted == by_id[5002].predicted == 0
    kept = toxicity.kept_documents(df, marks)
    assert kept.columns == df.columns and kept.count() == sum(1 - r.predicted for r in got)


def test_toxicity_without_labels(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    assert [r.score for r in toxicity.score(df, spark.createDataFrame([], "doc_id long, toxic int")).collect()] == [0.0]
    assert toxicity.score(df.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, toxic int")).count() == 0


def test_toxicity_features_count_what_they_say():
    words = toxicity._Words(toxicity.Lexicon({"idiot ": 4.0, "stup": 2.0}))
    values = toxicity.features("You IDIOT! so st1pid stupendous 1d10t.", words)
    assert values[4] == pytest.approx(2 / 6) and values[2] == pytest.approx(3 / 6) and values[11] == pytest.approx(1 / 6) and values[12] > 0
    assert toxicity.plain_word("1d10t.") == ("idiot", True) and toxicity.plain_word("word,") == ("word", False)
    assert toxicity.features("", words) == toxicity.features(None, words)


# language


def brute_forward(unit, prob, index):
    reach = [1.0] + [0.0] * len(unit)
    for end in range(1, len(unit) + 1):
        reach[end] += reach[end - 1] * prob[-1]
        for start in range(end):
            if unit[start:end] in index:
                reach[end] += reach[start] * prob[index[unit[start:end]]]
    return np.log(reach[-1])


def test_forward_sums_all_segmentations():
    pieces, index = language.pieces_of(), {p: i for i, p in enumerate(language.vocabulary())}
    prob = np.random.default_rng(1).random((2, pieces.n + 1))
    prob /= prob.sum(axis=1, keepdims=True)
    words = ["▁the", "▁" + "x" * 31, "▁unglaublich", "ation", "▁q", "▁中文ment"]
    want = [[brute_forward(w, p, index) for p in prob] for w in words]
    assert np.allclose(language.forward(words, prob, pieces), want, rtol=1e-9)


def test_expected_counts_are_slopes_of_the_likelihood():
    pieces = language.pieces_of()
    prob = np.random.default_rng(2).random(pieces.n + 1)
    prob /= prob.sum()
    words, count = ["▁nation", "▁station", "ing"], np.array([2.0, 1.0, 3.0])
    found = language.expected(words, count, prob, pieces)
    for k in np.argsort(-found)[:5]:
        moved = prob.copy()
        moved[k] *= 1 + 1e-6
        slope = (count * (language.forward(words, moved[None], pieces) - language.forward(words, prob[None], pieces))[:, 0]).sum() / 1e-6
        assert found[k] == pytest.approx(slope, rel=1e-3)


def test_words_of_any_length_are_summed_whole():
    pieces, index = language.pieces_of(), {p: i for i, p in enumerate(language.vocabulary())}
    prob = np.random.default_rng(3).random((2, pieces.n + 1))
    prob /= prob.sum(axis=1, keepdims=True)
    words = ["▁" + ("unglaublichenation" * 3)[:40], "▁" + "x" * 40, "▁the", "▁" + "therestation" * 8]
    want = [[brute_forward(w, p, index) for p in prob] for w in words]
    assert np.allclose(language.log_probability(words, prob, pieces), want, rtol=1e-9)
    count = np.array([2.0, 1.0, 3.0, 1.0])
    found = language.expected_uses(words, count, prob[0], pieces)
    for k in [*np.argsort(-found[:-1])[:5], pieces.n]:
        moved = prob[0].copy()
        moved[k] *= 1 + 1e-6
        slope = (count * (language.log_probability(words, moved[None], pieces) - language.log_probability(words, prob[:1], pieces))[:, 0]).sum() / 1e-6
        assert found[k] == pytest.approx(slope, rel=1e-3)
    far = language.log_probability(["▁" + "中" * 5_000], prob * 0 + 1e-7, pieces)
    assert np.isfinite(far).all() and far[0, 0] <= 5_000 * np.log(2e-7) * 0.999


def test_bounded_samples_of_large_classes_are_not_empty(spark):
    from foretally.llm.common import limit_for, spread_bits

    assert limit_for(1_500, 10**10) / (1 << 60) == pytest.approx(1_500 / 10**10) and limit_for(10, 3) == 1 << 60 and limit_for(10, 0) == 1 << 60
    rows = spark.range(100_000)
    assert 800 < rows.where(spread_bits("id") < limit_for(1_000, 100_000)).count() < 1_200


def test_lexicon_words_inside_long_runs():
    words = toxicity._Words(toxicity.Lexicon({"idiot ": 3.0, "idio": 2.0}))
    assert words["idiot"] == 3.0 and words["x" * 250 + ".idiot"] % 1000 == 3.0 and words["well.idiot.you"] % 2000 == 1003.0
    assert words["x" * 250 + "idiotic" + "y" * 90] % 1000 == 2.0 and words["plain-word"] % 1000 == 0
    assert toxicity.features("x" * 250 + ".idiot", words)[3] > 0


def test_language_query_on_the_held_out_fold(spark):
    from foretally.llm.queries import op7_language
    from tests.conftest import SF

    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op7_language(spark, SF).collect()
    held = [r for r in got if r.held_out and lang[r.doc_id]]
    assert len(got) == len(lang) and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_odd_rows(spark):
    text = {"en": "the nation was in the station and they were there", "fr": "le chat est dans la maison avec une souris et nous"}
    rows = [(d, text[k] + " " * (d % 3), k, "x") for d in range(60) for k in text]
    rows += [(1, None, "en", "x"), (2, "123 !?", None, "x"), (3, "", "fr", "x"), (None, "the station", None, "x"), (4, "x" * 50_000, "en", "x"), (6, "DANS LA MAISON", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = language.identify(docs).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert Counter(r.lang_pred for r in got)["und"] == 3
    assert [r.lang_pred for r in got if r.doc_id is None] == ["en"] and "fr" in [r.lang_pred for r in got if r.doc_id == 6]
    assert {r.lang_pred for r in language.identify(docs.where("lang is null")).collect()} == {"und"}
    assert language.identify(docs.limit(0)).count() == 0


# nearest neighbours


def brute_nearest(rows, every, top):
    fine = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, matrix = np.array([i for i, _ in fine]), np.stack([v for _, v in fine])
    out = {}
    for i, v in fine:
        if i % every == 0:
            score = matrix @ v
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:top]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_all_cells_give_the_exact_answer(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(300)]
    rows += [(1000 + i, rows[5][1]) for i in range(150)] + [(2000, None), (2020, [0.0] * 6), (2040, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2060, [float("nan")] + [1.0] * 5), (2080, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (2100, []), (2120, [1.0] * 5)]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    exact = [(r.vec_id, [float(x) if x is not None else None for x in r.embedding] if r.embedding is not None else None) for r in table.collect()]
    want = brute_nearest([r for r in exact if r[1] is None or len(r[1]) != 5], 20, 20)
    got = {}
    for r in multi_index.search(table, F.expr("vec_id % 20 = 0"), share=1.0, centroids=4, shard=64).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == set(want)
    for q, hits in got.items():
        hits.sort()
        assert [h[0] for h in hits] == list(range(1, 21))
        assert [h[1] for h in hits] == [w[0] for w in want[q]] and np.allclose([h[2] for h in hits], [w[1] for w in want[q]], rtol=1e-12)


def test_heap_takes_cells_in_order():
    rng = np.random.default_rng(4)
    index = multi_index.Index((rng.normal(size=(5, 3)), rng.normal(size=(7, 3))), 3)
    q, counts = rng.normal(size=6), rng.integers(0, 4, size=35)
    score = (index.halves[0] @ q[:3])[:, None] + (index.halves[1] @ q[3:])[None, :]
    want = [c for c in np.argsort(-score.ravel()) if counts[c]]
    assert index.taken(q, counts, 10**9) == want
    few = index.taken(q, counts, 10)
    assert few == want[: len(few)] and counts[few].sum() >= 10 > counts[few[:-1]].sum()


def test_recall_of_the_query(spark):
    from foretally.llm.queries import op4_multi_index
    from tests.conftest import SF

    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, got = brute_nearest(rows, 20, 20), {}
    for r in op4_multi_index(spark, SF).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert sum(len(got[q] & {i for i, _ in w}) for q, w in want.items()) >= 0.9 * sum(map(len, want.values()))


def test_equal_vectors_are_ranked_by_id_wherever_they_lie(spark):
    rng = np.random.default_rng(5)
    same, other = rng.normal(size=24), rng.normal(size=(150, 24))
    rows = [(i, [float(x) for x in (same if i % 3 else other[i % 150])]) for i in range(450)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = multi_index.search(docs, F.pmod("vec_id", F.lit(7)) == 0, top=10, share=1.0, centroids=4, shard=20).collect()
    x = np.array([v for _, v in rows])
    for q in range(0, 450, 7):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        score = np.array([float((x[q] * x[i]).sum()) for i in range(450)])
        order = [i for i in np.lexsort((np.arange(450), -score)) if i != q][:10]
        assert [(v, s) for _, v, s in mine] == [(i, score[i]) for i in order]


def test_no_vectors(spark):
    assert multi_index.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert multi_index.nearest(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")).count() == 0

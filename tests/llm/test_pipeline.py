from pyspark.sql import functions as F

import corpus_pipeline
from foretally.llm import exact, mixing, simhash, toxicity
from foretally.llm.common import drop_scratch, stored, table
from foretally.llm.queries import QUERIES, SQL
from tests.conftest import SF
from tests.llm.test_simhash import brute_components, brute_fingerprint


def test_each_stage_against_its_own_input(spark):
    docs, columns = table(spark, SF, "documents"), table(spark, SF, "documents").columns
    labels = table(spark, SF, "labels")
    toxic = {r.doc_id for r in toxicity.score(docs, labels).collect() if r.predicted}
    after = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF))
        assert docs.columns == columns
        after.append(docs)
    first, second, third, fourth = ([(r.doc_id, r.text, r.source) for r in d.collect()] for d in after)
    every = {r.doc_id for r in table(spark, SF, "documents").select("doc_id").collect()}
    assert {r[0] for r in first} == every - toxic
    largest = {}
    for d, text, _ in first:
        largest[text or ""] = max(d, largest.get(text or "", d))
    assert sorted(r[0] for r in second) == sorted(largest.values())
    prints = {d: brute_fingerprint(t) for d, t, _ in second}
    root, least = brute_components(prints.values()), {}
    for d, p in prints.items():
        least[root[p]] = min(d, least.get(root[p], d))
    assert sorted(r[0] for r in third) == sorted(least.values())
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(after[2]).collect()}
    counts = {d: sum(1 for r in fourth if r[0] == d) for d, _, _ in third}
    assert all(n * size == words for d, n in counts.items() for words, size in [taken[d]])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r[0] for r in fourth}
    assert sum(1 for r in packed if r.start == 0) == len(fourth)


def test_stages_on_an_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF))
        assert docs.count() == 0


def test_clashing_columns_pass_through(spark):
    rows = [(1, "a b c d", "s", "v"), (2, "a b c d", "s", "w"), (3, "entirely different words here", None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, `keep.id` string").withColumnRenamed("keep.id", "kept")
    for kept in (exact.kept_documents(docs), simhash.kept_documents(docs)):
        assert kept.columns == docs.columns and kept.count() == 2
    assert mixing.mixed_documents(docs).columns == docs.columns


def test_columns_named_like_those_the_stages_add(spark):
    rows = [(1, "a b c d", "s", "mine", 1), (2, "a b c d", "s", "yours", 2), (2, "a b c d", "s", "yours", 2), (3, "other words are in here", None, "x", 3)]
    names = ["target", "copies", "source_size", "threshold", "copy", "__id", "__sha", "__key", "id", "sha", "key", "row", "a.b", "__c0"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, value string, n int")
    for name in names:
        docs = docs.withColumn(name, F.col("value"))
    for kept in (exact.kept_documents(docs), simhash.kept_documents(docs), mixing.mixed_documents(docs)):
        assert kept.columns == docs.columns
        found = kept.collect()
        assert found and all(set(r[5:]) == {r.value} for r in found)
    assert len(exact.kept_documents(docs).collect()) == 2


def test_every_query_without_sql_is_known():
    assert set(QUERIES) - set(SQL) == {
        "op1_toxicity", "op2_simhash", "op3_lines", "op4_multi_index", "op5_repeats", "op7_language", "op9_packing", "op10_secret_scan", "op13_personal_data",
    } and set(SQL) <= set(QUERIES) and corpus_pipeline.ORACLE_SQL is None


def test_scratch_tables_can_be_dropped(spark):
    df = stored(spark.range(5).toDF("id"))
    assert df.count() == 5 and drop_scratch(spark) >= 1

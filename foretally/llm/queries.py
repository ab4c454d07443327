"""Registered queries of the training-data operators and their DuckDB checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact, fill_middle, language, lexical, lines, mixing, multi_index, packing, personal_data, repeats, secret_scan, simhash, toxicity
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup_lines(table(spark, sf_dir, "documents"))


def op4_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(table(spark, sf_dir, "embeddings"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.cut_texts(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("bytes", 256).alias("kept_sha256"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.groups(table(spark, sf_dir, "documents"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).drop("label")


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.transformed(table(spark, sf_dir, "documents"))
    return fill_middle.restored(rows, texts=False)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


_ALL = (
    op1_toxicity, op2_simhash, op3_lines, op4_multi_index, op5_repeats, op6_exact_dedup, op7_language, op8_mixing, op9_packing, op10_secret_scan,
    op11_fill_middle, op12_lexical, op13_personal_data,
)
QUERIES: dict[str, Query] = {f.__name__: f for f in _ALL}

SQL: dict[str, str] = {}

SQL["op6_exact_dedup"] = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""

SQL["op8_mixing"] = r"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
           ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as hash
    from documents
), per as (
    select source, sum(size)::bigint as source_size, [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight
    from sized group by source
), filled as (
    select *, sum(source_size) over () as all_size, sum(weight) over () as all_weight,
           coalesce(sum(2 * source_size) over earlier, 0) as before_cap, coalesce(sum(weight) over earlier, 0) as before_weight
    from per
    window earlier as (order by 2 * source_size / weight::double, source nulls last rows between unbounded preceding and 1 preceding)
), flagged as (
    select *, before_cap + 2 * source_size / weight::double * (all_weight - before_weight) <= all_size * 1.5::double as capped from filled
), level as (
    select coalesce(sum(2 * source_size) filter (capped), 0)::double as cs, coalesce(sum(weight) filter (capped), 0) as cw from flagged
), goal as (
    select source, source_size,
           case when capped then (2 * source_size)::double else (all_size::double * 1.5::double - cs) / nullif(all_weight - cw, 0)::double * weight end as target
    from flagged, level
), rest as (
    select *, case when source_size = 0 then 0 else least(2, floor(target / source_size)) end::bigint as base from goal
), ordered as (
    select s.doc_id, s.size, r.source_size, r.target, r.base, r.target - r.base * r.source_size as goal_left,
           sum(s.size) over (partition by s.source order by s.hash) as upto, sum(s.size) over (partition by s.source, s.hash) as same_hash
    from sized s join rest r on s.source is not distinct from r.source
)
select doc_id, size, source_size, target,
       (size * case when base >= 2 then 2 when upto <= goal_left or upto - same_hash / 2.0::double <= goal_left then base + 1 else base end)::bigint as taken
from ordered
"""

SQL["op11_fill_middle"] = r"""
with hashed as (
    select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') as lines,
           sha256('7:' || coalesce(doc_id::varchar, '')) as hex
    from documents
), drawn as (
    select *, len(lines)::bigint as n, ('0x' || substr(hex, 1, 8))::bigint % (len(lines) + 1) as c1, ('0x' || substr(hex, 9, 8))::bigint % (len(lines) + 1) as c2,
           text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or ('0x' || substr(hex, 17, 8))::bigint % 100 >= 100 as plain,
           ('0x' || substr(hex, 25, 8))::bigint % 100 < 50 as suffix_first
    from hashed
), cut as (
    select *, coalesce(array_to_string(lines[1:least(c1, c2)], ''), '') as prefix,
           coalesce(array_to_string(lines[least(c1, c2) + 1:greatest(c1, c2)], ''), '') as middle,
           coalesce(array_to_string(lines[greatest(c1, c2) + 1:], ''), '') as suffix
    from drawn
)
select doc_id, n, case when plain then 'plain' when suffix_first then 'spm' else 'psm' end as form,
       case when not plain then length(prefix) end::bigint as prefix_chars, case when not plain then length(middle) end::bigint as middle_chars,
       sha256(case when plain then text when suffix_first then '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   else '<P>' || prefix || '<S>' || suffix || '<M>' || middle end) as output_sha256,
       sha256(text) as restored_sha256
from cut
"""

SQL["op12_lexical"] = r"""
with found as (
    select row_number() over () as row, doc_id,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents
), docs as (
    select row, doc_id, terms, len(terms)::bigint as n from found where len(terms) > 0
), whole as (
    select count(*)::bigint as total, sum(n)::bigint as words from docs
), asked as (
    select distinct item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
), postings as (
    select row, term, count(*)::bigint as tf from (select row, unnest(terms) as term from docs) group by row, term
), weights as (
    select term, floor(1000 * ln((2 * total + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from postings, whole where term in (select term from asked) group by term, total
), scored as (
    select a.item_id, d.row, d.doc_id, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (50 + (50 * d.n * total) // words))))::bigint as score
    from asked a join weights w using (term) join postings p using (term) join docs d using (row), whole
    group by a.item_id, d.row, d.doc_id
), ranked as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last, row)::int as rank, doc_id, score from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""

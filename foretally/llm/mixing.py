"""Mixing sources to target weights with hash-threshold histograms.

Every document has a 60-bit hash. Tokens are summed by source and hash bucket; running sums over a source's 4,096
buckets show which bucket the budget ends in. Only that bucket is split again by the next 12 bits, until it is a single
hash. What remains is one threshold per source, and the documents are filtered by it without any sort.

Defined results: a null text has size 0; null is a source of its own, last in order; an empty table gives an empty mix;
rows that repeat, and rows with equal doc_id, get equal decisions; columns of the input other than doc_id, text and
source pass through `mixed_documents` untouched, whatever their names; `apply_plan` replaces those of `PLAN_COLUMNS`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, numbered, running_totals, stored

#: Weights by rank of the source, repeating; share of all words to give out; most copies of a document.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
COPIES = 2
_BITS, _STEP = 60, 12
PLAN_COLUMNS = ("source_size", "target", "copies")


def words_in(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def spread(doc_id: str | Column) -> Column:
    """60 uniform bits that depend on the id alone."""
    digest = F.md5(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit("")).cast("string"))
    return F.conv(F.substring(digest, 1, _BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, hash; written once, since counting the words is the expensive part."""
    return stored(docs.select("doc_id", "source", words_in("text").alias("size"), spread(F.col("doc_id").cast("string")).alias("hash")))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """(source_null, source_key, source_size, target) per source.

    The excess of capped sources is reshared by weight: target = min(copies x size, level x weight). Sources ordered by
    cap / weight are capped up to some point, which running totals over sources show.
    """
    per = sizes.groupBy(F.col("source").isNull().alias("source_null"), F.coalesce("source", F.lit("")).alias("source_key"))
    per = per.agg(F.sum("size").alias("source_size"), F.lit(1).cast("long").alias("one"))
    ranked = running_totals(per, ["source_null", "source_key"], ["one"])
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("before_one") % len(weights) + 1).cast("int")).cast("long")
    weighed = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * copies)
    weighed = weighed.withColumn("fill", F.col("cap") / F.col("weight"))
    rows = stored(running_totals(weighed, ["fill", "source_null", "source_key"], ["cap", "weight"]))
    whole = rows.agg(F.sum("source_size").alias("all_size"), F.sum("weight").alias("all_weight"))
    at_cap = F.col("before_cap") + F.col("fill") * (F.col("all_weight") - F.col("before_weight")) <= F.col("all_size") * share
    rows = rows.crossJoin(F.broadcast(whole)).withColumn("capped", at_cap)  # one row without a key
    level = rows.agg(
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))), F.lit(0)).alias("capped_size"),
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("weight"))), F.lit(0)).alias("capped_weight"),
    )
    rows = rows.crossJoin(F.broadcast(level))  # one row without a key
    free = (F.col("all_size") * share - F.col("capped_size")) / F.nullif(F.col("all_weight") - F.col("capped_weight"), F.lit(0))
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(free * F.col("weight"))
    return rows.select("source_null", "source_key", "source_size", target.alias("target"))


def plan(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """Per source: `base` copies of every document, and one more of those with a hash below `threshold`."""
    goal = targets(sizes, weights, share, copies)
    base = F.least(F.lit(copies), F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0)))).cast("int")
    goal = goal.withColumn("base", F.coalesce(base, F.lit(0)))
    goal = goal.withColumn("rest", F.col("target") - F.col("base") * F.col("source_size"))
    state = stored(goal.select("*", F.col("rest").alias("left"), F.lit(0).cast("long").alias("prefix"), F.lit(False).alias("open")))
    rows = sizes.select(F.col("source").isNull().alias("source_null"), F.coalesce("source", F.lit("")).alias("source_key"), "size", "hash")
    keys = ["source_null", "source_key"]
    for shift in range(_BITS - _STEP, -1, -_STEP):
        last = shift == 0
        inside = rows.join(state.where(~F.col("open")).select(*keys, "prefix"), keys)
        inside = inside.where(F.shiftright("hash", shift + _STEP) == F.col("prefix"))
        sums = inside.groupBy(*keys, F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"))
        upto = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)  # 4,096 rows at most
        sums = sums.withColumn("upto", F.sum("words").over(upto)).join(state.select(*keys, "left"), keys)
        over = sums.where(F.col("upto") > F.col("left")).groupBy(*keys)
        edge = over.agg(F.min_by(F.struct("bucket", "words", "upto"), "bucket").alias("edge"))
        state = state.join(edge, keys, "left")
        before = F.col("edge.upto") - F.col("edge.words")
        found = F.col("edge").isNotNull()
        if last:  # a single hash: it is taken if that comes nearer to the target
            near = (before + F.col("edge.words") / 2 <= F.col("left")).cast("long")
            ends = F.when(found & ~F.col("open"), F.col("edge.bucket") + near)
        else:
            ends = F.when(found & ~F.col("open"), F.col("edge.bucket"))
        state = state.select(
            *keys, "source_size", "target", "base", "rest",
            F.when(found, F.col("left") - before).otherwise(F.col("left")).alias("left"),
            F.coalesce(ends, F.col("prefix")).alias("prefix"), (F.col("open") | ~found).alias("open"),
        )
        state = stored(state)
    threshold = F.when(F.col("base") >= copies, F.lit(0)).when(F.col("open"), F.lit(1 << _BITS)).otherwise(F.col("prefix"))
    return state.select(*keys, "source_size", "target", "base", threshold.alias("threshold"))


def apply_plan(rows: DataFrame, thresholds: DataFrame, source: str = "source", hashed: Column | None = None) -> DataFrame:
    """`rows` with source_size, target and copies; the thresholds join by source, whose table is small enough to
    broadcast in the usual case, as the optimizer sees from its files."""
    hashed = spread(F.col("doc_id").cast("string")) if hashed is None else hashed
    t = thresholds.select(*[F.col(c).alias(f"__mix_{c}") for c in thresholds.columns])
    on = (F.col(source).isNull() == F.col("__mix_source_null")) & (F.coalesce(F.col(source), F.lit("")) == F.col("__mix_source_key"))
    out = rows.join(t, on)
    more = (hashed < F.col("__mix_threshold")).cast("int")
    added = [F.col("__mix_source_size").alias("source_size"), F.col("__mix_target").alias("target"), (F.col("__mix_base") + more).alias("copies")]
    return out.select(*[F.col(f"`{c}`") for c in rows.columns if c not in PLAN_COLUMNS], *added)


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    sizes = sized(docs)
    out = apply_plan(sizes, plan(sizes, weights, share, copies), hashed=F.col("hash"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, copies: int = COPIES) -> DataFrame:
    """The documents themselves, each as often as the mix takes it."""
    thresholds = plan(sized(docs), weights, share, copies)
    rows, names = numbered(docs)
    out = apply_plan(rows, thresholds, names["source"], spread(F.col(names["doc_id"]).cast("string")))
    repeat = F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("copy")
    return out.select(*names.values(), repeat).select(*[F.col(n).alias(c) for c, n in names.items()])

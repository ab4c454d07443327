"""Declarative data-quality rules, fused into few passes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """kind: not_null, range, format, enum, unique, referential."""

    name: str
    kind: str
    columns: tuple[str, ...]
    min: float | None = None
    max: float | None = None
    pattern: str | None = None
    values: tuple = field(default=())
    ref: str | None = None  # referenced table
    ref_columns: tuple[str, ...] = ()


def from_mapping(spec: dict) -> Rule:
    """Rule from a parsed rule file entry."""
    cols = spec.get("columns") or [spec["column"]]
    ref = spec.get("reference") or {}
    return Rule(
        spec.get("name") or f"{spec['type']}_{'_'.join(cols)}", spec["type"].replace("referential_integrity", "referential"), tuple(cols),
        spec.get("min"), spec.get("max"), spec.get("pattern"), tuple(spec.get("values", ())), ref.get("table"), tuple(ref.get("columns", ())) or ((ref["column"],) if "column" in ref else ()))


def _breaks(r: Rule) -> Column:
    c = F.col(r.columns[0])
    if r.kind == "not_null":
        out = F.lit(False)
        for n in r.columns:
            out = out | F.col(n).isNull()
        return out
    if r.kind == "range":
        low = (c < r.min) if r.min is not None else F.lit(False)
        high = (c > r.max) if r.max is not None else F.lit(False)
        return F.coalesce(low | high, F.lit(False))
    if r.kind == "format":
        return F.coalesce(~c.rlike(r.pattern), F.lit(False))
    return F.coalesce(~c.isin(*r.values), F.lit(False))


def check(df: DataFrame, rules: list[Rule], tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """(rule, kind, rows, violations): all row rules share one aggregate over the table."""
    simple = [r for r in rules if r.kind in ("not_null", "range", "format", "enum")]
    parts = []
    if simple:
        one = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(_breaks(r)).alias(f"v{i}") for i, r in enumerate(simple)])
        items = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), F.col(f"v{i}").alias("violations")) for i, r in enumerate(simple)])
        parts.append(one.select("rows", F.explode(items).alias("x")).select("x.rule", "x.kind", "rows", "x.violations"))
    for r in rules:
        if r.kind == "unique":
            # Rows beyond the first of each key; equal keys meet as counts, not as rows.
            n = df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("n"))
            parts.append(n.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations")).select(
                F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), "rows", "violations"))
        if r.kind == "referential":
            ref = tables[r.ref].select(*[F.col(a).alias(f"_{b}") for a, b in zip(r.ref_columns, r.columns)]).distinct().withColumn("_hit", F.lit(True))
            # Count per key first, so a busy key is one row of the join.
            keys = df.groupBy(*r.columns).agg(F.count(F.lit(1)).alias("n"))
            full = F.lit(True)
            for c in r.columns:
                full = full & F.col(c).isNotNull()
            j = keys.join(ref, [F.col(c) == F.col(f"_{c}") for c in r.columns], "left")
            parts.append(j.agg(F.sum("n").alias("rows"), F.coalesce(F.sum(F.when(full & F.col("_hit").isNull(), F.col("n"))), F.lit(0)).alias("violations")).select(
                F.lit(r.name).alias("rule"), F.lit(r.kind).alias("kind"), "rows", "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityError(RuntimeError):
    """Raised by the gate when a rule is broken."""


def gate(results: DataFrame, fail_on_error: bool = True) -> DataFrame:
    """Stop the job when any rule has violations; the results are one row per rule."""
    if fail_on_error:
        bad = results.filter("violations > 0").select("rule", "violations").collect()
        if bad:
            raise QualityError(", ".join(f"{b.rule}: {b.violations}" for b in bad))
    return results

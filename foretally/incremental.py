"""Interval runs, chunked backfill, table comparison and coverage."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.carry import Carry, complete
from .operators.merge import write_interval
from .plans.registry import Models

# Days per run of a model family: tight, normal, wide.
BATCH_DAYS = {"wide": 1, "normal": 30, "narrow": 90}


def run_interval(spark: SparkSession, inputs: dict[str, DataFrame], name: str, start: str, end: str) -> DataFrame:
    """Rows of a model for [start, end), with all earlier history as context."""
    return Models(spark, inputs, start=start, end=end).output(name)


def chunks(start: date, end: date, days: int | None = 30) -> Iterator[tuple[date, date]]:
    """Half-open chunks covering [start, end): fixed days, or calendar years when days is None."""
    at = start
    while at < end:
        nxt = min(date(at.year + 1, 1, 1) if days is None else at + timedelta(days=days), end)
        yield at, nxt
        at = nxt


def bundle(days: list[date], size: int = 30) -> list[tuple[date, date]]:
    """Daily partition keys to runs of at most `size` keys: (first, last + 1 day)."""
    s = sorted(days)
    return [(part[0], part[-1] + timedelta(days=1)) for part in (s[i : i + size] for i in range(0, len(s), size))]


@dataclass(frozen=True)
class Chunk:
    """A finished chunk [start, end) and what it read: rows of the inputs by name, and rows of state by history operator."""

    start: date
    end: date
    inputs: dict[str, DataFrame]
    states: dict[str, DataFrame]

    def rows_read(self, *names: str) -> tuple[int, int]:
        """Rows of the named inputs, and of all states."""
        return sum(self.inputs[n].count() for n in names), sum(s.count() for s in self.states.values())


def model_path(path: str, names: str | list[str], name: str) -> str:
    return path if isinstance(names, str) else f"{path}/{name}"


def backfill(
    spark: SparkSession, inputs: dict[str, DataFrame], names: str | list[str], path: str, start: date, end: date, days: int | None = 30,
    on_chunk: Callable[[Chunk], None] | None = None,
) -> int:
    """Run models chunk by chunk into tables partitioned by day; the first failure stops the run.

    A chunk reads its own days and the state that the chunk before left: partial sums per key, the last rows of each
    entity, runs that are still open (`operators.carry`). The first chunk reads all days before it. Totals over the whole
    history (season totals, league medians) come from one pass over [first day, end), so the tables equal a run over all days.

    Each chunk replaces its own days, and its states are marked complete last. A stopped run is resumed by starting again
    at the chunk that failed, and a finished one is extended by starting at its end; both read the state at `start`. A single name is
    written to `path`, several to a folder each. Returns the number of chunks done.
    """
    states, done = f"{path}/_states", 0
    whole = Models(spark, inputs, end=end.isoformat())
    before = start if complete(spark, states, start) else None
    for lo, hi in chunks(start, end, days):
        carry = Carry(spark, states, lo, hi, before)
        m = Models(spark, inputs, start=lo.isoformat(), end=hi.isoformat(), carry=carry, whole=whole)
        for name in [names] if isinstance(names, str) else names:
            write_interval(m.output(name), model_path(path, names, name), "game_date", lo, hi)
        carry.commit()
        if on_chunk:
            on_chunk(Chunk(lo, hi, m.inputs, carry.read))
        m.close()
        done, before = done + 1, hi
    whole.close()
    return done


def table_diff(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """(column, added, removed, changed): rows only in b, only in a, and differing values per column.

    Columns that only one side has are reported as changed in every shared row.
    """
    cols = [c for c in dict.fromkeys([*a.columns, *b.columns]) if c not in key]
    left = a.select(*key, F.struct(*[c for c in a.columns if c not in key], F.lit(1).alias("_in")).alias("_a"))
    right = b.select(*key, F.struct(*[c for c in b.columns if c not in key], F.lit(1).alias("_in")).alias("_b"))
    both = left.join(right, key, "full")
    in_both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    sums = []
    for c in cols:
        shared = c in a.columns and c in b.columns
        differs = ~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")) if shared else F.lit(True)
        sums.append(F.count_if(in_both & differs).alias(f"c_{c}"))
    one = both.agg(F.count_if(F.col("_a").isNull()).alias("added"), F.count_if(F.col("_b").isNull()).alias("removed"), F.count_if(in_both).alias("shared"), *sums)
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c_{c}").alias("changed")) for c in cols])
    return one.select("added", "removed", "shared", F.explode(items).alias("x")).select("x.column_name", "added", "removed", "shared", "x.changed")


def schema_diff(a: DataFrame, b: DataFrame) -> dict[str, list[str]]:
    """Column names added, removed and retyped between two versions."""
    x, y = dict(a.dtypes), dict(b.dtypes)
    return {"added": sorted(set(y) - set(x)), "removed": sorted(set(x) - set(y)), "retyped": sorted(c for c in x if c in y and x[c] != y[c])}


def coverage(df: DataFrame, first_year: int, last_year: int, day: str = "game_date") -> DataFrame:
    """First and last day, rows, and the share of the wanted years that have rows."""
    per_year = df.groupBy(F.year(day).alias("y")).agg(F.count(F.lit(1)).alias("n"), F.min(day).alias("lo"), F.max(day).alias("hi"))
    return per_year.agg(
        F.min("lo").alias("first_day"), F.max("hi").alias("last_day"), F.sum("n").alias("rows"),
        F.count_if(F.col("y").between(first_year, last_year)).alias("years"),
        (F.count_if(F.col("y").between(first_year, last_year)) / float(last_year - first_year + 1)).alias("share_of_years"))


def best_version(versions: dict[str, DataFrame], column: str) -> DataFrame:
    """Versions of a table by how many non-zero values they hold in a column, best first by `rank`."""
    from pyspark.sql import Window

    parts = [df.agg(F.count_if(F.col(column) != 0).alias("filled"), F.count(F.lit(1)).alias("rows")).withColumn("version", F.lit(v)) for v, df in versions.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # One row per version.
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("filled"), "version")))

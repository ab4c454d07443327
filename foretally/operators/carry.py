"""History in parts: what a chunk of days needs to know about all earlier days.

A history operator called inside `Carry.of(model)` sees the rows of one chunk only. What earlier chunks left behind it gets as
state, and it leaves the state for the next chunk:

* `earlier_days`  - partial aggregates per (keys, day); days out of reach of every day-limited frame are summed up in one
  row per key, so state has one row per key and day in reach.
* `earlier_rows`  - the last rows of each entity, as deep as the deepest row frame, with their place in the whole history.
* `latest`        - the last known value of each key.

A state is a Parquet table under the folder of the day it was reached on, named by model and call. A chunk's states are
written after its rows, and marked complete last, so a chunk that failed is run again from the same state.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ACTIVE: ContextVar[Carry | None] = ContextVar("carry", default=None)
_DONE = "_done"


class Carry:
    """States read and written by one chunk [start, end); without `before` the chunk is the first one."""

    def __init__(self, spark: SparkSession, folder: str, start: date, end: date, before: date | None):
        self.spark, self.folder, self.start, self.end, self.before = spark, folder, start, end, before
        self._calls: list[list] = []
        self.kept: dict[str, DataFrame] = {}
        self.read: dict[str, DataFrame] = {}

    @contextmanager
    def of(self, model: str) -> Iterator[None]:
        """History operators called in this block, in order, have states of their own under the model's name."""
        self._calls.append([model, 0])
        token = _ACTIVE.set(self)
        try:
            yield
        finally:
            _ACTIVE.reset(token)
            self._calls.pop()

    def _path(self, day: date, name: str) -> str:
        return f"{self.folder}/{day.isoformat()}/{name}"

    def call(self) -> tuple[str, DataFrame | None]:
        """Name of this call, and its state after the chunk before."""
        self._calls[-1][1] += 1
        name = "{}-{}".format(*self._calls[-1])
        if self.before is None:
            return name, None
        if name not in self.read:
            self.read[name] = self.spark.read.parquet(self._path(self.before, name))
        return name, self.read[name]

    def keep(self, name: str, state: DataFrame) -> None:
        self.kept[name] = state

    def commit(self) -> None:
        """Write the states of this chunk; the mark comes last."""
        for name, state in self.kept.items():
            state.write.mode("overwrite").parquet(self._path(self.end, name))
        self.spark.range(1).write.mode("overwrite").parquet(self._path(self.end, _DONE))


def complete(spark: SparkSession, folder: str, day: date) -> bool:
    """Whether the states of the chunk that ended on `day` are all there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{day.isoformat()}/{_DONE}/_SUCCESS")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


@contextmanager
def nothing_carried() -> Iterator[None]:
    """History operators called in this block see all rows, whatever chunk is being worked on around it."""
    token = _ACTIVE.set(None)
    try:
        yield
    finally:
        _ACTIVE.reset(token)


def active() -> Carry | None:
    return _ACTIVE.get()


def earlier_days(daily: DataFrame, by: list[str], day: str, merge: dict[str, str], reach: int = 0) -> DataFrame:
    """`daily` (by, day, partials) and what earlier chunks knew; `merge` names the aggregate that joins each partial.

    `reach` is the number of days that the longest day-limited frame looks back: such days stay apart.
    """
    carry = active()
    if carry is None:
        return daily
    name, state = carry.call()
    both = daily if state is None else daily.unionByName(state.select(daily.columns))
    kinds = dict(daily.dtypes)
    first = carry.end - timedelta(days=reach)
    far = F.lit(first - timedelta(days=1))
    folded = both.withColumn(day, F.when(F.col(day) < F.lit(first), far).otherwise(F.col(day))).groupBy(*by, day)
    carry.keep(name, folded.agg(*[getattr(F, fn)(c).cast(kinds[c]).alias(c) for c, fn in merge.items()]).select(daily.columns))
    return both


def earlier_rows(rows: DataFrame, by: list[str], place: str, depth: int) -> DataFrame:
    """`rows`, placed in the whole history, and the last `depth` rows of each entity before them; `_old` marks those."""
    carry = active()
    if carry is None:
        return rows.withColumn("_old", F.lit(False))
    name, state = carry.call()
    both = rows.withColumn("_old", F.lit(False))
    if state is not None:
        both = both.unionByName(state.select(rows.columns).withColumn("_old", F.lit(True)))
    entity = F.struct(*by)
    last = both.groupBy(entity.alias("_entity")).agg(F.max(place).alias("_last"))
    kept = both.withColumn("_entity", entity).join(last, "_entity").where(F.col(place) > F.col("_last") - depth)
    carry.keep(name, kept.select(rows.columns))
    return both


def latest(table: DataFrame, by: list[str], day: str) -> DataFrame:
    """`table` (by, day, values; one row per key and day) and the last row of each key before it."""
    carry = active()
    if carry is None:
        return table
    name, state = carry.call()
    both = table if state is None else table.unionByName(state.select(table.columns))
    rest = [c for c in table.columns if c not in by]
    top = both.where(F.col(day).isNotNull()).groupBy(*by).agg(F.max_by(F.struct(*rest), day).alias("_r"))
    carry.keep(name, top.select(*[F.col(c) if c in by else F.col(f"_r.{c}").alias(c) for c in table.columns]))
    return both

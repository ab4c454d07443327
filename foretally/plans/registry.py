"""Models by name, built on demand from staging frames.

A model is a function from `Models` to a DataFrame. Models used by many others
are written once to the shared folder of the cluster (`spark.checkpoint.dir`) and
read back, so plans stay small and a lost executor costs one stage, not a chain.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cached_property

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.carry import Carry, nothing_carried
from ..operators.entity_rows import to_entity_rows
from ..operators.scratch import written_by

_BUILDERS: dict[str, Callable[[Models], DataFrame]] = {}
_TABLES: dict[str, str | None] = {}
_WHOLE: set[str] = set()
_ON_BUCKETS: set[str] = set()
#: Models built at the same time; each is a chain of stages, many of them too small for all cores.
AT_ONCE = 3


def model(name: str, table: bool = False, whole: bool = False, by: str | None = None, on_buckets: bool = False):
    """Register a model; `table=True` writes it once per `Models` object, `by` names the column it is bucketed and sorted by.

    `on_buckets=True` marks a table without buckets that is joined from bucketed ones.

    `whole=True` marks totals over the whole history (a row per team, player, year or league): a run in chunks takes them
    from one pass over all days, as every row of a run over all days does.
    """

    def add(fn):
        _BUILDERS[name] = fn
        if table:
            _TABLES[name] = by
        if whole:
            _WHOLE.add(name)
        if on_buckets:
            _ON_BUCKETS.add(name)
        return fn

    return add


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, from the session's settings; a fixed local one only where the master is local."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = "file:/tmp/foretally-scratch"
    return path.rstrip("/")


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


_SETTINGS = threading.RLock()
_HELD: dict[str, tuple[int, str | None]] = {}


@contextmanager
def held(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting has this value in the block. Blocks of several threads share it; the last to end puts back what was there."""
    with _SETTINGS:
        users, before = _HELD.get(key, (0, None))
        if not users:
            before = spark.conf.get(key, None)
            spark.conf.set(key, value)
        _HELD[key] = users + 1, before
    try:
        yield
    finally:
        with _SETTINGS:
            users, before = _HELD.pop(key)
            if users > 1:
                _HELD[key] = users - 1, before
            elif before is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, before)


def shuffle_files_removed(spark: SparkSession):
    """Shuffle files of what is written in this block go when it is written, not when the driver next collects garbage."""
    return held(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


#: From this many columns on, a table is written without dictionaries.
WIDE = 100


def write_options(df: DataFrame) -> dict[str, str]:
    """Parquet settings of a table: looking every value of hundreds of numeric columns up in a dictionary takes most of the time of
    writing them, and plain values packed by zstd take no more room."""
    return {"parquet.enable.dictionary": "false", "compression": "zstd"} if len(df.columns) >= WIDE else {}


def write_table(df: DataFrame, spark: SparkSession, name: str, root: str | None = None) -> DataFrame:
    """Write a frame under the shared folder and return it as a fresh scan."""
    path = f"{root or shared_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    with shuffle_files_removed(spark):
        df.write.mode("overwrite").options(**write_options(df)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_bucketed(df: DataFrame, spark: SparkSession, name: str, root: str, by: str) -> tuple[DataFrame, str]:
    """Write a frame in buckets of `by`, one sorted file each; joins of such tables on `by` move no rows.

    There are as many buckets as shuffle partitions, so what is shuffled by `by` meets them without moving them either.
    """
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"foretally_{name}_{uuid.uuid4().hex[:12]}"
    with parts_like_buckets(spark), shuffle_files_removed(spark):
        df.repartition(n, by).write.format("parquet").options(**write_options(df)).bucketBy(n, by).sortBy(by).option("path", f"{root}/{table}").saveAsTable(table)
    return spark.table(table), table


def with_updated_at(df: DataFrame, stamp: str | None = None) -> DataFrame:
    """Add the load time of a feature table: now, or the time the run was given."""
    return df.withColumn("updated_at", F.lit(stamp).cast("timestamp_ntz") if stamp else F.localtimestamp())


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def limit_methods(spark: SparkSession) -> None:
    """Let Spark split generated code where a stage's one method has over 8,000 bytes, which the JVM would interpret row by row.

    Wide projections here (forty rounded columns and more) are that long. A limit the session has set stays.
    """
    if spark.conf.get(_METHOD_LIMIT) == "65535":
        spark.conf.set(_METHOD_LIMIT, "8000")


_FIRST_PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Parts a shuffle starts with (up to 200 are written without sorting); Spark joins small ones together, but never cuts one too large for memory.
PARTS = 200


def many_parts(spark: SparkSession) -> None:
    """Let shuffles start with `PARTS` parts where the session asks for fewer, so a task's rows do not grow as fast as the
    tables and spill. A number the session has set stays."""
    if spark.conf.get(_FIRST_PARTS, None) is None and int(spark.conf.get("spark.sql.shuffle.partitions")) < PARTS:
        spark.conf.set(_FIRST_PARTS, str(PARTS))


def parts_like_buckets(spark: SparkSession):
    """What is planned in this block shuffles into as many parts as bucketed tables have, so it meets them without moving again."""
    return held(spark, _FIRST_PARTS, spark.conf.get("spark.sql.shuffle.partitions"))


_BUCKET_ORDER = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def trust_bucket_order(spark: SparkSession) -> None:
    """Let Spark join bucketed tables in the order their files have: `write_bucketed` leaves one sorted file per bucket, so
    sorting the wide rows again, with a buffer per join and task, gives nothing. Spark itself sorts where a bucket has more files."""
    if spark.conf.get(_BUCKET_ORDER) == "false":
        spark.conf.set(_BUCKET_ORDER, "true")


_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def one_key_enough(spark: SparkSession):
    """What is planned in this block joins on several keys without moving rows that lie together by one of them."""
    return held(spark, _ALL_KEYS, "false")


class Models:
    """The model graph over one set of staging frames.

    `start` / `end` are half-open day bounds: rows from `end` on are not read at
    all, rows before `start` serve as history and are dropped from the output.
    `loaded_at` is the load time that feature tables show, by default the time they are made.
    """

    def __init__(
        self, spark: SparkSession, inputs: dict[str, DataFrame], start=None, end=None, as_of=None, loaded_at: str | None = None, carry: Carry | None = None,
        whole: Models | None = None,
    ):
        self.spark = spark
        limit_methods(spark)
        trust_bucket_order(spark)
        many_parts(spark)
        self.start, self.end, self.as_of = start, end, as_of
        self.loaded_at, self.carry, self.whole = loaded_at, carry, whole
        self.inputs = {k: self._cut(v) for k, v in inputs.items()}
        self._built: dict[str, DataFrame] = {}
        self._root: str | None = None
        self._tables: list[str] = []
        self._lock, self._locks = threading.Lock(), {}

    def written(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """The frame as a table of this graph, bucketed by `by` if given, which `close` deletes."""
        with self._lock:
            self._root = self._root or f"{shared_dir(self.spark)}/foretally-{uuid.uuid4().hex}"
        if by is None and name not in _ON_BUCKETS:
            return write_table(df, self.spark, name, self._root)
        if by is None:
            with parts_like_buckets(self.spark):
                return write_table(df, self.spark, name, self._root)
        out, table = write_bucketed(df, self.spark, name, self._root, by)
        self._tables.append(table)
        return out

    def together(self, names: Iterable[str]) -> None:
        """Build models at the same time, as their stages are mostly too small for all cores; a model that several need is
        built by the first. A chunk's states are numbered by the order of calls, so chunked runs build one after another."""
        if self.carry:
            return
        with ThreadPoolExecutor(AT_ONCE) as pool:
            list(pool.map(inheritable_thread_target(self.spark)(self.__getitem__), names))

    def close(self) -> None:
        """Delete all tables of the graph; frames that read them cannot be used any more."""
        for table in self._tables:
            self.spark.sql(f"drop table if exists {table}")
        if self._root:
            remove_folder(self.spark, self._root)
        self._root, self._built, self._tables = None, {}, []

    def _cut(self, df: DataFrame) -> DataFrame:
        """With carried state, rows of earlier chunks are not read. Injury reports count up to the day after a game."""
        day, late = ("game_date", 0) if "game_date" in df.columns else ("capture_date", 1)
        if day not in df.columns:
            return df
        if self.end is not None and (day == "game_date" or self.carry):
            df = df.filter(F.col(day) < F.date_add(F.lit(self.end).cast("date"), late))
        if self.carry and self.carry.before is not None:
            df = df.filter(F.col(day) >= F.date_add(F.lit(self.start).cast("date"), late))
        return df

    @staticmethod
    def names() -> list[str]:
        return sorted(_BUILDERS)

    def __getitem__(self, name: str) -> DataFrame:
        if name in self.inputs:
            return self.inputs[name]
        if self.whole and name in _WHOLE:
            return self.whole[name]
        with self._lock:
            lock = self._locks.setdefault(name, threading.RLock())
        with lock:
            if name not in self._built:
                with self.carry.of(name) if self.carry else nothing_carried(), written_by(self.written):
                    df = _BUILDERS[name](self)
                self._built[name] = self.written(df, name, _TABLES[name]) if name in _TABLES else df
            return self._built[name]

    def output(self, name: str) -> DataFrame:
        """The model's rows of [start, end)."""
        df = self[name]
        if self.start is None or "game_date" not in df.columns:
            return df
        return df.filter(F.col("game_date") >= F.lit(self.start).cast("date"))

    # Frames every model starts from.

    @property
    def games(self) -> DataFrame:
        return self.inputs["stg_games"]

    @cached_property
    def played(self) -> DataFrame:
        return self.games.filter(F.col("home_score").isNotNull() & F.col("away_score").isNotNull())

    @cached_property
    def tg(self) -> DataFrame:
        """One row per played game and side."""
        return to_entity_rows(self.played)

    @cached_property
    def decided(self) -> DataFrame:
        """Played games with a winner, per side."""
        return self.tg.filter(F.col("winner_team_id").isNotNull())

"""Small tables of an operator, written before the plan that joins them is made.

Spark knows the size of a written table, so it sends a small one to the rows; a table that is only planned counts as large as
the rows it is made from, and all rows would be moved to it. Where nobody offers a place to write, tables stay planned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame

_WRITE: ContextVar[Callable[[DataFrame, str], DataFrame] | None] = ContextVar("write", default=None)


@contextmanager
def written_by(write: Callable[[DataFrame, str], DataFrame]) -> Iterator[None]:
    """Operators called in this block write their small tables by `write`, which returns them as fresh scans."""
    token = _WRITE.set(write)
    try:
        yield
    finally:
        _WRITE.reset(token)


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table, or as it is."""
    write = _WRITE.get()
    return df if write is None else write(df, name)

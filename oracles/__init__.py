"""DuckDB statements that check the registered queries."""

from __future__ import annotations

from .sql import compose


def all_sql() -> dict[str, str]:
    from . import assembly, jobs, ml, models, sources

    out: dict[str, str] = {}
    for part in (models, assembly, sources, jobs, ml):
        out |= part.SQL
    return {k: compose(v) for k, v in out.items()}

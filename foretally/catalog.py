"""All registered queries: name -> callable(spark, folder of base tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .functions.numeric import rounded
from .plans import assembly, context, core, mart, players, trends  # noqa: F401  (register their models)
from .plans.registry import Models
from .plans.views import staging_from_star

Query = Callable[[SparkSession, str], DataFrame]

_GRAPHS: dict[tuple[str, str], Models] = {}
_HELPERS = {"team_box_rows", "team_form", "team_game_context", "team_rest_rows", "injury_star_reports", "player_appearances", "light_mart", "training_split", "training_weighted", "league_recent_form", "league_form", "league_pace", "game_keys"}


def graph(spark: SparkSession, sf_dir: str) -> Models:
    """One model graph per session and data folder; shared models are written once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _GRAPHS:
        _GRAPHS[key] = Models(spark, staging_from_star(spark, sf_dir), loaded_at="2024-01-01 00:00:00")
    return _GRAPHS[key]


def _model_query(name: str) -> Query:
    return lambda spark, sf_dir: rounded(graph(spark, sf_dir)[name])


def _rounded(q: Query) -> Query:
    return lambda spark, sf_dir: rounded(q(spark, sf_dir))


def queries() -> dict[str, Query]:
    from . import catalog_jobs, catalog_ml, catalog_sources

    out: dict[str, Query] = {n: _model_query(n) for n in Models.names() if n not in _HELPERS}
    for part in (catalog_sources.QUERIES, catalog_jobs.QUERIES, catalog_ml.QUERIES):
        out |= {n: _rounded(q) for n, q in part.items()}
    return out

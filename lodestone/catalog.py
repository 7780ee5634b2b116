"""Every query by name, with its DuckDB statement where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: name -> (Spark query, DuckDB statement or None)
CATALOG: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(name: str, sql: str | None = None):
    """Registers a query (spark, sf_dir) -> DataFrame."""

    def keep(f):
        CATALOG[name] = (f, sql)
        return f

    return keep


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confluence: keys that showed at least two families of events in the 48 hours up to a fixed time."""
    return queries()["a18_confluence"](spark, sf_dir)


def _load() -> None:
    import lodestone.plans  # noqa: F401  (registers every query)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return {k: f for k, (f, _) in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {k: s for k, (_, s) in CATALOG.items() if s}

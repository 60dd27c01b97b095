"""Named queries over the driver's tables, each with its SQL oracle.

``@register(name, oracle)`` records a callable ``(spark, sf_dir) ->
DataFrame`` and the DuckDB SQL that must return the same rows.  The
oracle is written independently (plain SQL, window functions, CASE) so
that it checks the Spark plan rather than repeating it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


class Tables:
    """Lazy access to the driver tables: ``Tables(spark, d).orders``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:  # one file listing / footer read per table
            self._cache[name] = read_table(self.spark, self.sf_dir, name)
        return self._cache[name]

"""Registry of the queries and their SQL equivalents."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from ..sources.adapters import duck_ctes, table, view

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}

_MODULES = ("filters", "words", "enrichment", "aggregates", "investigations", "features", "sources", "streams", "models")


@dataclass(frozen=True)
class Data:
    """Tables and views of one data folder."""

    spark: SparkSession
    sf_dir: str

    def view(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)


def query(name: str, views=(), sql: str | None = None):
    """Register a function of ``Data`` under a name. ``sql`` is the body that
    follows the common table expressions of ``views``."""

    def add(build: Callable[[Data], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Data(configure(spark), sf_dir))

        _QUERIES[name] = run
        if sql is not None:
            _ORACLE[name] = (duck_ctes(views) + "\n" if views else "") + sql.strip()
        return build

    return add


def _load() -> None:
    for module in _MODULES:
        importlib.import_module(f"{__package__}.{module}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)

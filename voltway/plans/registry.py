"""All queries of the session analytics, each with its DuckDB SQL twin."""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltway import plans


def _modules():
    for found in sorted(pkgutil.iter_modules(plans.__path__), key=lambda m: m.name):
        if found.name.startswith("q_"):
            yield importlib.import_module(f"voltway.plans.{found.name}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """name -> callable(spark, sf_dir) of every module ``plans.q_*``."""
    return {name: run for module in _modules() for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """name -> DuckDB SQL of every module ``plans.q_*``."""
    return {name: sql for module in _modules() for name, sql in module.ORACLE.items()}

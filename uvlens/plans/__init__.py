"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and the DuckDB
SQL that checks each one. Importing the submodules fills the registry."""

from uvlens.plans.registry import QUERIES, ORACLE, register  # noqa: F401
from uvlens.plans import uv, calendar, reports, streams, tablejobs  # noqa: F401,E402

__all__ = ["QUERIES", "ORACLE", "register"]

"""JSON columns to typed columns and back (Q5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LENIENT = {"allowUnquotedFieldNames": "true", "allowSingleQuotes": "true"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_map(c) -> Column:
    """JSON object text -> map<string,string>; blank or malformed -> null."""
    return F.from_json(_c(c), "map<string,string>", LENIENT)


def to_list(c, element: str = "string") -> Column:
    return F.from_json(_c(c), f"array<{element}>", LENIENT)


def to_struct(c, schema: str) -> Column:
    return F.from_json(_c(c), schema, LENIENT)


def sorted_json(m) -> Column:
    """Map -> JSON text with keys in sorted order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(_c(m)))))

"""Registered queries over the driver tables, each with the SQL that checks it."""

from lodestrata.catalog import (  # noqa: F401  (importing registers the queries)
    bronze_silver,
    files,
    gold,
    link,
    operations,
    runs,
    scalar,
    streams,
    web,
)
from lodestrata.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

"""All registered queries of the registry engine, and their DuckDB SQL."""

from __future__ import annotations

from .plans.oracles import SQL
from .plans.queries import QUERIES

__all__ = ["QUERIES", "SQL"]

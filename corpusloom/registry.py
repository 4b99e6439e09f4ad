"""Every query of the engine by name, and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from corpusloom.plans import files, relational, sequences, streams, timelines  # noqa: F401  they register their queries
from corpusloom.plans.catalog import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]

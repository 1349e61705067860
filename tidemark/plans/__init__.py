"""Named queries over the driver tables and their DuckDB oracles."""

from tidemark.plans.registry import notes, oracles, queries, register

__all__ = ["notes", "oracles", "queries", "register"]

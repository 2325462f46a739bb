"""Registered queries: every operator on the given tables, with the SQL that gives the same rows."""

from __future__ import annotations

from registered.registry import ORACLE, QUERIES

from registered import aggregates, catalog, decoding, lookups, projections, scalars, sources, streams  # noqa: F401,E402

__all__ = ["ORACLE", "QUERIES"]

"""Registered queries over the given tables, each with the SQL that must agree with it."""

from basketry.queries.registry import oracles, queries

__all__ = ["oracles", "queries"]

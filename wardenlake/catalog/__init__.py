"""Registered queries: one Spark callable per operator, most with an equivalent SQL text."""

from __future__ import annotations

from .registry import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]

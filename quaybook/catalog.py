"""The registered queries of the order-book engine, and their oracles."""

from __future__ import annotations

from quaybook.plans.oracle import ORACLE_SQL
from quaybook.plans.queries import QUERIES


__all__ = ["ORACLE_SQL", "QUERIES"]

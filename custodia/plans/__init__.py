"""Registered queries over the given tables, one module for each family of operators."""

from __future__ import annotations

from . import coverage, judging, packages, reconciling, scalars, sourcing

_MODULES = (coverage, scalars, reconciling, judging, packages, sourcing)

QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLE_SQL = {k: s for m in _MODULES for k, s in m.ORACLE_SQL.items()}

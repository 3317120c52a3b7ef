"""The operators run on the benchmark tables, each with the SQL that states its result.

Every module has ``QUERIES`` (name -> function of session and folder) and ``ORACLES``
(name -> SQL over the same tables). Nothing here limits or samples its input.
"""

from __future__ import annotations

from acervo.workloads import lines, pages, relations, stored, warehouse

_MODULES = [warehouse, relations, lines, pages, stored]


def all_queries() -> dict:
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql.strip() for module in _MODULES for name, sql in module.ORACLES.items()}

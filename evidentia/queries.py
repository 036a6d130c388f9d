"""The engine's own queries over the tables, and the SQL that each is held against."""

from __future__ import annotations

from evidentia.catalog import evidence, planning, runs

_FAMILIES = (planning, evidence, runs)

QUERIES: dict = {}
ORACLE_SQL: dict = {}
for _family in _FAMILIES:
    QUERIES |= _family.QUERIES
    ORACLE_SQL |= _family.ORACLE_SQL

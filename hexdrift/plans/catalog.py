"""All queries of the library by name, with the SQL that checks them."""

from __future__ import annotations

from . import coverage, geometry, scopes, tables, validation

QUERIES: dict = coverage.QUERIES | tables.QUERIES | validation.QUERIES | geometry.QUERIES | scopes.QUERIES
ORACLES: dict[str, str] = coverage.ORACLES | tables.ORACLES | validation.ORACLES | geometry.ORACLES | scopes.ORACLES

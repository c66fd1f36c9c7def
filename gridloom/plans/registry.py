"""Registered queries of the table operators, with their SQL."""

from __future__ import annotations

from gridloom.plans import queries_cells, queries_chains, queries_files, queries_tables

QUERIES = {**queries_cells.QUERIES, **queries_tables.QUERIES, **queries_chains.QUERIES, **queries_files.QUERIES}
ORACLE_SQL = {**queries_cells.ORACLE_SQL, **queries_tables.ORACLE_SQL, **queries_chains.ORACLE_SQL, **queries_files.ORACLE_SQL}

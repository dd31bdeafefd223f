"""All queries of the library but those of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

from acreframe.plans import map_queries, sample_queries, series_queries, table_queries

_ALL = {**series_queries.QUERIES, **sample_queries.QUERIES, **map_queries.QUERIES, **table_queries.QUERIES}
QUERIES = {name: query for name, (query, _) in _ALL.items()}
ORACLE = {name: sql for name, (_, sql) in _ALL.items() if sql}

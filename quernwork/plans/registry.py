"""Queries of the core: name -> callable, and name -> SQL."""

from __future__ import annotations

from . import catalog_queries, corpus_queries, model_queries, pipeline_queries, text_queries, training_queries

MODULES = (text_queries, catalog_queries, corpus_queries, model_queries, pipeline_queries, training_queries)


def queries() -> dict:
    return {name: query for m in MODULES for name, query in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.ORACLES.items()}

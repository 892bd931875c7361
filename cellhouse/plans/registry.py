"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and the DuckDB
text that computes the same result from the same parquet tables."""

from __future__ import annotations

from typing import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all():
    from . import cell_queries, partition_queries, stream_queries, text_queries  # noqa: F401

    return QUERIES, ORACLES

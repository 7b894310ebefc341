"""Queries of the llm operators: name -> callable(spark, sf_dir); the DuckDB SQL of those that SQL expresses."""

from __future__ import annotations

from inkspar.llm import queries_models, queries_records, queries_text

QUERIES: dict = {}
ORACLES: dict = {}

for _module in (queries_records, queries_text, queries_models):
    QUERIES |= _module.QUERIES
    ORACLES |= _module.ORACLES

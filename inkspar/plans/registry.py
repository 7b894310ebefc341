"""All named queries of the engine: name -> callable(spark, sf_dir), and name -> DuckDB SQL."""

from __future__ import annotations

from inkspar.plans import audits, captures, exports, pages, relational, reviewed, search, sources, texts, verified

QUERIES: dict = {}
ORACLES: dict = {}

for _module in (search, texts, captures, relational, audits, pages, sources, exports, verified, reviewed):
    QUERIES |= _module.PLANS.queries
    ORACLES |= _module.PLANS.oracles

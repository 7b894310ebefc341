"""Registration of a module's queries."""

from __future__ import annotations

from collections.abc import Callable


class Plans:
    """queries by name, and the DuckDB SQL of those that have one."""

    def __init__(self):
        self.queries: dict = {}
        self.oracles: dict = {}

    def query(self, sql: str | None = None) -> Callable:
        def register(f):
            self.queries[f.__name__] = f
            if sql:
                self.oracles[f.__name__] = sql
            return f

        return register

"""Registration of queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable


class Book:
    """Queries of one module, by name, and their SQL twins where there are any."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable:
        def register(fn: Callable) -> Callable:
            self.queries[fn.__name__] = fn
            if sql:
                self.oracles[fn.__name__] = sql
            return fn

        return register

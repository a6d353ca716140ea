"""Names of the library's queries, each with its DataFrame form and its SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}


def register(name: str, run: Callable, sql: str | None = None) -> None:
    if name in _QUERIES:
        raise ValueError(f"two queries are called {name}")
    _QUERIES[name] = run
    if sql is not None:
        _SQL[name] = sql


#: Modules that register queries when they are imported.
MODULES = ("state_queries", "box_queries", "eval_queries", "misc_queries")


def _load() -> None:
    for name in MODULES:
        import_module(f"gridlens.plans.{name}")


def queries() -> dict[str, Callable]:
    _load()
    return _QUERIES


def oracle_sql() -> dict[str, str]:
    _load()
    return _SQL


def query(name: str, sql: str | None = None):
    """Registers a function of the derived tables; its SQL gets the tables that it names."""
    from gridlens.plans.views import Tables, with_views

    def mark(make: Callable) -> Callable:
        register(name, lambda spark, sf_dir: make(Tables(spark, sf_dir)), None if sql is None else with_views(sql))
        return make

    return mark

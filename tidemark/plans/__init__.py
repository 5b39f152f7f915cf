"""Queries of the library's operators over the driver's tables."""

from importlib import import_module

from tidemark.plans.registry import QUERIES, SQL

_MODULES = ("alignment", "ordered", "evaluation", "trading", "splitting", "tables", "lookups", "jobs")


def all_queries() -> dict:
    for name in _MODULES:
        import_module(f"tidemark.plans.{name}")
    return dict(QUERIES)


def all_sql() -> dict:
    all_queries()
    return dict(SQL)

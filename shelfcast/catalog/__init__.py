"""Named queries over the test tables, each next to its SQL counterpart."""

from importlib import import_module

MODULES = [
    "source_queries",
    "cleanse_queries",
    "join_queries",
    "rollup_queries",
    "series_queries",
    "plan_queries",
    "stream_queries",
]


def _load():
    for name in MODULES:
        import_module(f"shelfcast.catalog.{name}")


def all_queries() -> dict:
    _load()
    from shelfcast.catalog.registry import QUERIES

    return dict(QUERIES)


def all_sql() -> dict:
    _load()
    from shelfcast.catalog.registry import SQL

    return dict(SQL)

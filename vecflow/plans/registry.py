"""All queries of the change-log library by key, with the SQL each one must agree with."""

from __future__ import annotations

_QUERIES: dict = {}
_SQL: dict = {}


def query(key: str, sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under a key, with its SQL twin if one exists."""

    def put(fn):
        if key in _QUERIES:
            raise ValueError(f"query {key} is registered twice")
        _QUERIES[key] = fn
        if sql is not None:
            _SQL[key] = sql
        return fn

    return put


def _load() -> None:
    from vecflow.plans import catalogue  # noqa: F401  registers as it is imported


def queries() -> dict:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict:
    _load()
    return dict(_SQL)

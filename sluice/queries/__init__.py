"""The registered queries and their SQL counterparts."""

from sluice.queries import features, scalars, storage, tables

_MODULES = (scalars, features, tables, storage)


def all_queries():
    return {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}


def all_sql():
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}

"""Every registered query of the engine with the SQL that it is held against."""

from . import dialog_queries, function_queries, media_queries, turn_queries

_MODULES = (turn_queries, function_queries, dialog_queries, media_queries)


def queries():
    return {name: query for module in _MODULES for name, (query, _) in module.QUERIES.items()}


def oracle_sql():
    return {name: sql for module in _MODULES for name, (_, sql) in module.QUERIES.items() if sql}

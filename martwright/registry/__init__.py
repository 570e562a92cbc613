"""All registered queries: Spark builders and their SQL oracles.

``queries()`` maps a name to ``(spark, sf_dir) -> DataFrame``; ``oracle_sql()``
maps the same names to SQL over the raw tables.  Queries without an SQL form
are listed in ``queries()`` only.
"""

from __future__ import annotations

from martwright.registry import collections, columns, rows, sales, tables

_MODULES = [sales, columns, collections, rows, tables]


def queries():
    out = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql():
    out = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out

"""One self-contained SQL statement per registered query."""

from __future__ import annotations

from oracle import dashboards, operators, warehouse
from oracle.sqltext import with_tables


def oracle_sql() -> dict[str, str]:
    tables = warehouse.tables()
    found = {**dashboards.SQL, **operators.SQL}
    return {name: with_tables(tables, sql) for name, sql in found.items()}

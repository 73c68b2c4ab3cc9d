"""All oracle bodies by query name."""

from __future__ import annotations


def oracle_bodies() -> dict[str, str]:
    from oracle import sql_analytics, sql_cmdb, sql_entity, sql_finance, sql_ops, sql_pages, sql_refresh, sql_star, sql_tickets
    out: dict[str, str] = {}
    for mod in (sql_tickets, sql_cmdb, sql_finance, sql_entity, sql_analytics, sql_pages, sql_ops, sql_refresh, sql_star):
        out.update(mod.SQL)
    return out

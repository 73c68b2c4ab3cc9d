"""Shared pieces of the oracle SQL: label look-ups and the facts that several marts state once.

Every piece is one row per thing (ticket, person, category), so that joins to it never multiply rows.
"""

from __future__ import annotations

from oracle.adapter_sql import AS_OF_SQL

NOW = AS_OF_SQL


def label(code: str, words: dict, other: str | None = None) -> str:
    """The word of a code; ``other`` (or NULL) where the code has none."""
    found = "MAP {" + ", ".join(f"{k}: '{v}'" for k, v in words.items()) + f"}}[{code}]"
    return found if other is None else f"coalesce({found}, '{other}')"


def band(value: str, *bands: tuple[str | None, str | None, str]) -> str:
    """The word of the band (from, up to but not including; None: open) that holds the value; NULL for NULL."""
    rows = ", ".join(f"({low or 'NULL'}, {high or 'NULL'}, '{word}')" for low, high, word in bands)
    return (f"(SELECT word FROM (VALUES {rows}) AS bands(low, high, word) "
            f"WHERE {value} IS NOT NULL AND (low IS NULL OR {value} >= low) AND (high IS NULL OR {value} < high))")


def share(part: str, whole: str, digits: int) -> str:
    return f"round(100.0 * CAST({part} AS DOUBLE) / CAST(nullif({whole}, 0) AS DOUBLE), {digits})"


def calendar(ts: str, year: str, month: str) -> str:
    return (f"strftime({ts}, '%Y-%m') AS year_month, CAST(extract(year FROM {ts}) AS INTEGER) AS {year}, "
            f"CAST(extract(month FROM {ts}) AS INTEGER) AS {month}")


#: Live tickets.  ``late`` compares the due time with the solution where the ticket is done, else with now; it is
#: unknown without a due time or without the solution of a done ticket.
TICKET = f"""facts AS (
  SELECT k.*, date_sub('minute', opened, solved) AS minutes, CASE WHEN done THEN solved ELSE {NOW} END > due AS late
  FROM (SELECT id, entities_id, name, status, priority, type, itilcategories_id, slas_id_ttr, date AS opened,
               solvedate AS solved, closedate AS closed, takeintoaccountdate AS taken, date_mod, time_to_resolve AS due,
               solve_delay_stat, close_delay_stat, status IN (5, 6) AS done
        FROM glpi_tickets WHERE is_deleted = 0) k)"""

#: Smallest requester, technician and group of each ticket.
ROLES = """roles AS (
  SELECT tickets_id, min(users_id) FILTER (WHERE type = 1) AS requester, min(users_id) FILTER (WHERE type = 2) AS technician
  FROM glpi_tickets_users GROUP BY tickets_id),
teams AS (SELECT tickets_id, min(groups_id) AS team FROM glpi_groups_tickets WHERE type = 2 GROUP BY tickets_id)"""

#: Users with the first of their default addresses and, by name, the first of their groups.
PEOPLE = """mail AS (SELECT users_id, min(email) AS address FROM glpi_useremails WHERE is_default = 1 GROUP BY users_id),
membership AS (SELECT users_id, min(g.name) AS first_name, min(m.groups_id) AS first_id
               FROM glpi_groups_users m LEFT JOIN glpi_groups g ON m.groups_id = g.id GROUP BY users_id),
people AS (SELECT u.id, u.firstname, u.realname, u.is_active, u.is_deleted, mail.address, membership.first_name AS group_name,
             membership.first_id AS group_id, concat_ws(' ', coalesce(u.firstname, ''), coalesce(u.realname, '')) AS shown,
             u.firstname || ' ' || u.realname AS full_name
           FROM glpi_users u LEFT JOIN mail ON mail.users_id = u.id LEFT JOIN membership ON membership.users_id = u.id)"""

#: Categories with their path taken apart.
CATEGORY = """category AS (
  SELECT id, name, completename, level, itilcategories_id, string_split(completename, ' > ') AS steps FROM glpi_itilcategories)"""
ROOT = "CASE WHEN len(steps) > 1 THEN steps[1] ELSE name END"

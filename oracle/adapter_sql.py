"""DuckDB oracle: the driver-table adapter rules re-stated as SQL CTEs.

This is an independent restatement of ``tessera.sources.adapter`` used only
to check the Spark results.  Dialect notes (DuckDB vs the Spark code):
``CAST(double AS INT)`` rounds in DuckDB, so truncation is explicit;
``SUM(int)`` is HUGEINT, so sums are cast to BIGINT; ``dayofweek`` is
Sunday = 0; whole-unit differences use ``date_sub`` (truncates toward zero)
except months, where the day-of-month rule is spelled out.
"""

from __future__ import annotations

AS_OF_SQL = "TIMESTAMP '2001-08-01 00:00:00'"
AS_OF_DATE_SQL = "DATE '2001-08-01'"
OFF = "1000000000000"


def month_diff(a: str, b: str) -> str:
    """Whole months from date ``a`` to date ``b`` (day-of-month rule)."""
    d = f"((year({b})*12+month({b})) - (year({a})*12+month({a})))"
    return (f"(CASE WHEN {d} > 0 AND day({b}) < day({a}) THEN {d} - 1 "
            f"WHEN {d} < 0 AND day({b}) > day({a}) THEN {d} + 1 ELSE {d} END)")


def itemtype(k: str) -> str:
    return (f"(CASE {k} % 4 WHEN 0 THEN 'Computer' WHEN 1 THEN 'NetworkEquipment' "
            f"WHEN 2 THEN 'Monitor' ELSE 'Printer' END)")


def _asset(kind: int, prefix_sql: str, with_user: bool) -> str:
    user = ", p_partkey AS users_id" if with_user else ""
    return f"""SELECT p_partkey AS id, CAST(p_partkey % 25 + 100 AS BIGINT) AS entities_id,
      {prefix_sql} || p_partkey AS name, 'SN' || p_partkey AS serial,
      p_partkey // 20 + {OFF} AS users_id_tech, CAST(p_partkey % 25 + 1 AS BIGINT) AS locations_id,
      CAST(p_size % 3 + 1 AS BIGINT) AS states_id, CAST(substr(p_brand, 7, 3) AS BIGINT) AS manufacturers_id,
      p_partkey AS models_id, CAST(p_size AS BIGINT) AS types_id,
      CASE WHEN p_partkey % 97 = 0 THEN 1 ELSE 0 END AS is_deleted,
      TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(p_partkey % 1000 AS INTEGER)) AS date_creation,
      TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(p_partkey % 1000 AS INTEGER)) + to_days(p_size) AS date_mod
      {user}
    FROM part WHERE p_partkey % 4 = {kind}"""


def _itil(event_type: str, prefix: str) -> str:
    status = "CAST(CASE WHEN value > 200 THEN 6 WHEN value > 100 THEN 5 ELSE event_id % 4 + 1 END AS INTEGER)"
    solved = "ts + to_minutes(CAST(trunc(value * 60) AS BIGINT))"
    return f"""SELECT event_id AS id, CAST(user_id % 25 + 100 AS BIGINT) AS entities_id,
      '{prefix}' || event_id AS name, ts AS date,
      CASE WHEN {status} IN (5, 6) THEN {solved} END AS solvedate,
      CASE WHEN {status} = 6 THEN {solved} + to_days(1) END AS closedate,
      {status} AS status, CAST(event_id % 6 + 1 AS INTEGER) AS priority,
      CAST(event_id % 5 + 1 AS INTEGER) AS urgency, CAST(user_id % 5 + 1 AS INTEGER) AS impact,
      user_id AS itilcategories_id, CASE WHEN event_id % 40 = 0 THEN 1 ELSE 0 END AS is_deleted
    FROM events WHERE event_type = '{event_type}'"""


def _ticket_links(event_type: str, key: str) -> str:
    return f"""SELECT event_id AS {key}, (event_id * 3) // 2 AS tickets_id FROM events WHERE event_type = '{event_type}'
    UNION ALL SELECT event_id AS {key}, (event_id * 3) // 2 + 1 AS tickets_id FROM events WHERE event_type = '{event_type}'"""


def _tech_links(event_type: str, key: str) -> str:
    return f"""SELECT event_id AS {key}, event_id // 100 + {OFF} AS users_id, 2 AS type FROM events WHERE event_type = '{event_type}'
    UNION ALL SELECT event_id AS {key}, event_id // 100 + 1 + {OFF} AS users_id, 2 AS type FROM events
      WHERE event_type = '{event_type}' AND event_id % 3 = 0
    UNION ALL SELECT event_id AS {key}, user_id AS users_id, 1 AS type FROM events WHERE event_type = '{event_type}'"""


def _item_links(event_type: str, key: str) -> str:
    return f"""SELECT event_id * 2 AS id, event_id AS {key}, 'Computer' AS itemtype, user_id * 4 AS items_id
      FROM events WHERE event_type = '{event_type}'
    UNION ALL SELECT event_id * 2 + 1 AS id, event_id AS {key}, 'NetworkEquipment' AS itemtype, user_id * 4 + 1 AS items_id
      FROM events WHERE event_type = '{event_type}' AND value > 150"""


SLA_DAYS_CASE = "CASE priority WHEN 1 THEN 1200 WHEN 2 THEN 900 WHEN 3 THEN 600 WHEN 4 THEN 450 WHEN 5 THEN 300 WHEN 6 THEN 180 END"

CTES: list[tuple[str, str]] = [
    ("glpi_entities", """
    SELECT CAST(0 AS BIGINT) AS id, 'Sede' AS name, 'Sede' AS completename, 0 AS level, CAST(NULL AS BIGINT) AS entities_id
    UNION ALL SELECT CAST(r_regionkey + 1 AS BIGINT), r_name, 'Sede > ' || r_name, 1, CAST(0 AS BIGINT) FROM region
    UNION ALL SELECT CAST(n_nationkey + 100 AS BIGINT), n_name, 'Sede > ' || r_name || ' > ' || n_name, 2,
      CAST(n_regionkey + 1 AS BIGINT) FROM nation JOIN region ON n_regionkey = r_regionkey"""),
    ("glpi_locations", "SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, 'Local ' || n_name AS name FROM nation"),
    ("glpi_groups", """SELECT CAST(n_nationkey + 1 AS BIGINT) AS id, n_name AS name, 'GRP-' || n_nationkey AS code,
      'Grupo ' || n_name AS comment, CASE WHEN n_nationkey % 6 = 5 THEN 0 ELSE 1 END AS is_assign FROM nation"""),
    ("glpi_users", f"""
    SELECT c_custkey AS id, c_name AS name,
      CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) END AS firstname,
      c_name AS realname, CAST(c_nationkey + 100 AS BIGINT) AS entities_id, 1 AS is_active, 0 AS is_deleted FROM customer
    UNION ALL
    SELECT s_suppkey + {OFF}, s_name, CASE WHEN s_suppkey % 10 = 0 THEN NULL ELSE 'Tecnico' END, s_name,
      CAST(s_nationkey + 100 AS BIGINT), CASE WHEN s_suppkey % 17 = 16 THEN 0 ELSE 1 END, 0 FROM supplier"""),
    ("glpi_useremails", f"""
    SELECT c_custkey AS users_id, 'cliente' || c_custkey || '@example.com' AS email, 1 AS is_default FROM customer
    UNION ALL SELECT s_suppkey + {OFF}, 'tec' || s_suppkey || '@example.com', 1 FROM supplier
    UNION ALL SELECT s_suppkey + {OFF}, 'a.tec' || s_suppkey || '@example.com', 1 FROM supplier WHERE s_suppkey % 2 = 0
    UNION ALL SELECT s_suppkey + {OFF}, '0ld' || s_suppkey || '@example.com', 0 FROM supplier"""),
    ("glpi_profiles", "SELECT * FROM (VALUES (CAST(1 AS BIGINT), 'Self-Service'), (3, 'Supervisor'), (4, 'Technician')) v(id, name)"),
    ("glpi_profiles_users", f"""
    SELECT c_custkey AS users_id, CAST(1 AS BIGINT) AS profiles_id FROM customer
    UNION ALL SELECT s_suppkey + {OFF}, 4 FROM supplier
    UNION ALL SELECT s_suppkey + {OFF}, 4 FROM supplier WHERE s_suppkey % 5 = 0"""),
    ("glpi_groups_users", f"""
    SELECT s_suppkey + {OFF} AS users_id, CAST(s_nationkey + 1 AS BIGINT) AS groups_id FROM supplier
    UNION ALL SELECT s_suppkey + {OFF}, CAST((s_nationkey + 7) % 25 + 1 AS BIGINT) FROM supplier WHERE s_suppkey % 3 = 0"""),
    ("order_lines", """
    SELECT l_orderkey, min(CASE WHEN l_shipdate >= o_orderdate THEN l_shipdate END) AS first_ship,
      min(l_partkey) AS min_part, min(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS q1
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey"""),
    ("tickets_base", """
    SELECT o_orderkey AS id, CAST(c_nationkey + 100 AS BIGINT) AS entities_id, 'Pedido ' || o_orderkey AS name,
      o_orderdate AS date,
      CAST(CASE WHEN first_ship IS NULL OR o_orderstatus = 'O' THEN o_orderkey % 4 + 1
                WHEN o_orderstatus = 'P' THEN 5 ELSE 6 END AS INTEGER) AS status,
      CAST(CASE WHEN o_totalprice > 450000.0 THEN 6 ELSE 6 - CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS INTEGER) AS priority,
      CAST(o_orderkey % 2 + 1 AS INTEGER) AS type, CAST(coalesce(min_part, 0) AS BIGINT) AS itilcategories_id,
      first_ship, q1, CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS is_deleted,
      CAST(o_orderkey % 120 AS INTEGER) AS tto, (o_orderkey % 5 = 0) AS nosla
    FROM orders LEFT JOIN order_lines ON o_orderkey = l_orderkey LEFT JOIN customer ON o_custkey = c_custkey"""),
    ("tickets_solved", """
    SELECT *, CASE WHEN status IN (5, 6) THEN first_ship END AS solvedate FROM tickets_base"""),
    ("glpi_tickets", f"""
    SELECT id, entities_id, name, date, solvedate,
      CASE WHEN status = 6 THEN solvedate + to_days(2) END AS closedate,
      date + to_minutes(tto) AS takeintoaccountdate,
      coalesce(CASE WHEN status = 6 THEN solvedate + to_days(2) END, solvedate, date + to_minutes(tto)) AS date_mod,
      status, priority, type, itilcategories_id,
      CAST(CASE WHEN nosla THEN 0 ELSE priority END AS BIGINT) AS slas_id_ttr,
      CASE WHEN nosla THEN NULL ELSE date + to_days({SLA_DAYS_CASE}) END AS time_to_resolve,
      CAST(coalesce(date_sub('second', date, solvedate), 0) AS INTEGER) AS solve_delay_stat,
      CAST(coalesce(date_sub('second', date, CASE WHEN status = 6 THEN solvedate + to_days(2) END), 0) AS INTEGER) AS close_delay_stat,
      is_deleted, q1
    FROM tickets_solved"""),
    ("order_suppliers", "SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem"),
    ("glpi_tickets_users", f"""
    SELECT o_orderkey AS tickets_id, o_custkey AS users_id, 1 AS type FROM orders
    UNION ALL SELECT l_orderkey, l_suppkey + {OFF}, 2 FROM order_suppliers"""),
    ("glpi_groups_tickets", """
    SELECT DISTINCT l_orderkey AS tickets_id, CAST(s_nationkey + 1 AS BIGINT) AS groups_id, 2 AS type
    FROM order_suppliers JOIN supplier ON l_suppkey = s_suppkey"""),
    ("glpi_itilcategories", """
    SELECT p_partkey AS id, p_brand AS name,
      CASE WHEN p_partkey % 10 = 0 THEN p_brand ELSE p_type || ' > ' || p_brand END AS completename,
      CASE WHEN p_partkey % 10 = 0 THEN 1 ELSE 2 END AS level, CAST(0 AS BIGINT) AS itilcategories_id FROM part"""),
    ("glpi_slas", f"""
    SELECT CAST(priority AS BIGINT) AS id, 'SLA P' || priority AS name, 0 AS type,
      CAST(CASE WHEN priority = 6 THEN ({SLA_DAYS_CASE}) * 24 ELSE {SLA_DAYS_CASE} END AS INTEGER) AS number_time,
      CASE WHEN priority = 6 THEN 'hour' ELSE 'day' END AS definition_time
    FROM (SELECT DISTINCT priority FROM glpi_tickets WHERE slas_id_ttr > 0)"""),
    ("glpi_itilfollowups", "SELECT 'Ticket' AS itemtype, conv_id AS items_id, turn AS id FROM conversations"),
    ("glpi_tickettasks", "SELECT conv_id AS tickets_id, turn AS id FROM conversations WHERE role = 'assistant'"),
    ("glpi_ticketsatisfactions", """
    SELECT id, id AS tickets_id,
      CASE WHEN id % 9 = 0 THEN NULL ELSE coalesce(closedate, solvedate) + to_days(1) END AS date_answered,
      CASE WHEN id % 9 = 0 THEN NULL ELSE CAST(CAST(trunc(q1) AS INTEGER) % 5 + 1 AS INTEGER) END AS satisfaction,
      CASE WHEN id % 9 = 0 THEN NULL ELSE CAST(CAST(trunc(q1) AS INTEGER) % 5 + 1 AS DOUBLE) END AS satisfaction_scaled_to_5,
      CASE WHEN id % 9 <> 0 AND CAST(trunc(q1) AS INTEGER) % 5 + 1 <= 2 THEN 'Insatisfeito' END AS comment
    FROM glpi_tickets WHERE status IN (5, 6) AND q1 IS NOT NULL"""),
    ("glpi_computers", _asset(0, "CASE WHEN p_size > 40 THEN 'SRV-' WHEN p_size <= 30 THEN 'WS-' ELSE 'PC-' END", True)),
    ("glpi_networkequipments", _asset(1, "'NET-'", False)),
    ("glpi_monitors", _asset(2, "'MON-'", True)),
    ("glpi_printers", _asset(3, "'PRN-'", False)),
    ("glpi_phones", """SELECT c_custkey AS id, CAST(c_nationkey + 100 AS BIGINT) AS entities_id, c_custkey AS users_id,
      CASE WHEN c_custkey % 45 = 0 THEN 1 ELSE 0 END AS is_deleted FROM customer WHERE c_custkey % 5 = 0"""),
    ("glpi_peripherals", """SELECT c_custkey AS id, CAST(c_nationkey + 100 AS BIGINT) AS entities_id, c_custkey AS users_id,
      0 AS is_deleted FROM customer WHERE c_custkey % 7 = 0"""),
    ("asset_types", "SELECT DISTINCT CAST(p_size AS BIGINT) AS id, 'Tipo-' || p_size AS name FROM part"),
    ("asset_models", "SELECT p_partkey AS id, p_name AS name FROM part"),
    ("glpi_manufacturers", "SELECT DISTINCT CAST(substr(p_brand, 7, 3) AS BIGINT) AS id, p_brand AS name FROM part"),
    ("glpi_states", """SELECT id, CASE id WHEN 1 THEN 'Em uso' WHEN 2 THEN 'Em estoque' WHEN 3 THEN 'Em manutenção' END AS name
      FROM (SELECT DISTINCT CAST(p_size % 3 + 1 AS BIGINT) AS id FROM part)"""),
    ("glpi_items_tickets", f"""SELECT l_orderkey * 8 + l_linenumber AS id, {itemtype('l_partkey')} AS itemtype,
      l_partkey AS items_id, l_orderkey AS tickets_id FROM lineitem"""),
    ("part_first_ship", "SELECT l_partkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_partkey"),
    ("glpi_infocoms", f"""
    SELECT p_partkey * 2 AS id, {itemtype('p_partkey')} AS itemtype, p_partkey AS items_id, p_partkey // 20 AS suppliers_id,
      CAST(first_ship AS DATE) AS buy_date, CAST(first_ship AS DATE) + 7 AS use_date, p_retailprice AS value,
      p_size % 37 AS warranty_duration, CAST(p_size % 37 AS VARCHAR) || ' meses' AS warranty_info
    FROM part LEFT JOIN part_first_ship ON p_partkey = l_partkey
    UNION ALL
    SELECT p_partkey * 2 + 1, {itemtype('p_partkey')}, p_partkey, p_partkey // 20 + 1,
      CAST(first_ship AS DATE), CAST(first_ship AS DATE) + 30, p_retailprice / 2, 12, 'extensão'
    FROM part LEFT JOIN part_first_ship ON p_partkey = l_partkey WHERE p_partkey % 50 = 7"""),
    ("glpi_items_racks", f"""SELECT p_partkey // 50 + 1 AS racks_id, {itemtype('p_partkey')} AS itemtype, p_partkey AS items_id,
      p_size AS position, CASE WHEN p_size > 40 THEN '#ff0000' ELSE '#00aa00' END AS bgcolor FROM part WHERE p_partkey % 8 < 3"""),
    ("glpi_racks", """SELECT id, 'RACK-' || lpad(CAST(id AS VARCHAR), 2, '0') AS name, id % 5 + 1 AS entities_id,
      id % 25 + 1 AS locations_id, 42 AS number_units, CAST(id * 100 + 3000 AS INTEGER) AS max_power
      FROM (SELECT DISTINCT p_partkey // 50 + 1 AS id FROM part)"""),
    ("glpi_operatingsystems", """SELECT id, CASE id WHEN 1 THEN 'Windows' WHEN 2 THEN 'Linux' WHEN 3 THEN 'macOS' END AS name
      FROM (SELECT DISTINCT CAST(p_size % 3 + 1 AS BIGINT) AS id FROM part WHERE p_partkey % 4 = 0)"""),
    ("glpi_operatingsystemversions", """SELECT id, 'v' || id AS name
      FROM (SELECT DISTINCT CAST(p_size % 5 + 1 AS BIGINT) AS id FROM part WHERE p_partkey % 4 = 0)"""),
    ("glpi_items_operatingsystems", """SELECT c.id AS items_id, 'Computer' AS itemtype,
      CAST(p_size % 3 + 1 AS BIGINT) AS operatingsystems_id, CAST(p_size % 5 + 1 AS BIGINT) AS operatingsystemversions_id,
      CAST(c.id % 2 AS INTEGER) AS is_dynamic, c.date_mod AS date_creation
      FROM glpi_computers c JOIN part ON c.id = p_partkey"""),
    ("glpi_softwares", """SELECT p_partkey AS id, p_name AS name, CAST(substr(p_brand, 7, 3) AS BIGINT) AS manufacturers_id,
      CAST(p_partkey % 2 AS INTEGER) AS is_helpdesk_visible, CASE WHEN p_partkey % 89 = 0 THEN 1 ELSE 0 END AS is_deleted,
      CAST(p_partkey % 25 + 100 AS BIGINT) AS entities_id FROM part"""),
    ("glpi_softwareversions", "SELECT p_partkey AS id, p_partkey AS softwares_id, 'v' || p_size AS name FROM part"),
    ("license_rows", f"""SELECT p_partkey AS softwares_id,
      CAST(CASE WHEN p_partkey % 11 = 0 THEN 0 WHEN p_partkey % 11 = 1 THEN NULL ELSE p_size END AS INTEGER) AS number,
      CAST(p_partkey % 2 AS INTEGER) AS allow_overquota,
      CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE {AS_OF_DATE_SQL} + CAST(p_size * 7 - 175 AS INTEGER) END AS expire,
      'LIC-' || p_partkey AS serial, CAST(p_partkey % 3 + 1 AS BIGINT) AS softwarelicensetypes_id
      FROM part WHERE p_partkey % 7 <> 0"""),
    ("glpi_softwarelicenses", """SELECT softwares_id * 2 AS id, * FROM license_rows
      UNION ALL SELECT softwares_id * 2 + 1 AS id, * FROM license_rows WHERE softwares_id % 13 = 0"""),
    ("glpi_softwarelicensetypes", """SELECT id, CASE id WHEN 1 THEN 'Perpétua' WHEN 2 THEN 'Assinatura' WHEN 3 THEN 'OEM' END AS name
      FROM (SELECT DISTINCT CAST(p_partkey % 3 + 1 AS BIGINT) AS id FROM part)"""),
    ("glpi_items_softwareversions", """SELECT l_orderkey * 8 + l_linenumber AS id, l_partkey AS softwareversions_id,
      'Computer' AS itemtype, l_suppkey AS items_id, CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS is_deleted FROM lineitem"""),
    ("glpi_suppliers", """SELECT s_suppkey AS id, s_name AS name, CAST(s_nationkey % 3 + 1 AS BIGINT) AS suppliertypes_id,
      'contato' || s_suppkey || '@fornecedor.example' AS email, '+55 11 9' || lpad(CAST(s_suppkey AS VARCHAR), 7, '0') AS phonenumber,
      'Cidade ' || s_nationkey AS town, 'SP' AS state, 'https://fornecedor' || s_suppkey || '.example' AS website,
      CASE WHEN s_suppkey % 9 = 0 THEN 0 ELSE 1 END AS is_active, CASE WHEN s_suppkey % 23 = 22 THEN 1 ELSE 0 END AS is_deleted,
      CAST(s_nationkey + 100 AS BIGINT) AS entities_id
      FROM supplier"""),
    ("glpi_suppliertypes", """SELECT id, CASE id WHEN 1 THEN 'Distribuidor' WHEN 2 THEN 'Fabricante' WHEN 3 THEN 'Serviços' END AS name
      FROM (SELECT DISTINCT CAST(s_nationkey % 3 + 1 AS BIGINT) AS id FROM supplier)"""),
    ("supplier_first_ship", "SELECT l_suppkey, min(l_shipdate) AS first_ship FROM lineitem GROUP BY l_suppkey"),
    ("glpi_contracts", """SELECT s_suppkey AS id, 'Contrato ' || s_name AS name, 'CT-' || s_suppkey AS num,
      CAST(s_suppkey % 3 + 1 AS BIGINT) AS contracttypes_id, CAST(first_ship AS DATE) AS begin_date,
      CAST(s_suppkey % 60 + 1 AS INTEGER) AS duration,
      CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'Cobertura fornecedor ' || s_suppkey END AS comment,
      CASE WHEN s_suppkey % 31 = 30 THEN 1 ELSE 0 END AS is_deleted, CAST(0 AS BIGINT) AS entities_id
      FROM supplier LEFT JOIN supplier_first_ship ON s_suppkey = l_suppkey"""),
    ("glpi_contracttypes", """SELECT id, CASE id WHEN 1 THEN 'Suporte' WHEN 2 THEN 'Manutenção' WHEN 3 THEN 'Locação' END AS name
      FROM (SELECT DISTINCT CAST(s_suppkey % 3 + 1 AS BIGINT) AS id FROM supplier)"""),
    ("glpi_contracts_suppliers", """SELECT s_suppkey AS contracts_id, s_suppkey AS suppliers_id FROM supplier
      UNION ALL SELECT s_suppkey, s_suppkey + 1 FROM supplier WHERE s_suppkey % 5 = 0"""),
    ("glpi_contracts_items", f"""SELECT l_partkey AS id, l_suppkey AS contracts_id, {itemtype('l_partkey')} AS itemtype,
      l_partkey AS items_id FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)"""),
    ("glpi_knowbaseitems", """SELECT doc_id AS id, 'KB-' || doc_id || ' (' || lang || ')' AS name,
      CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END AS is_faq, n_chars AS view, doc_id AS users_id,
      CAST(NULL AS BIGINT) AS forms_categories_id,
      TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(doc_id % 365 AS INTEGER)) AS date_creation,
      TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(doc_id % 365 AS INTEGER)) + to_days(CAST(n_chars % 30 AS INTEGER)) AS date_mod
      FROM documents"""),
    ("glpi_knowbaseitemcategories", """SELECT * FROM (SELECT CAST(CASE lang WHEN 'de' THEN 1 WHEN 'en' THEN 2 WHEN 'es' THEN 3
      WHEN 'fr' THEN 4 ELSE 1000 + CAST('0x' || substr(md5(lang), 1, 12) AS BIGINT) END AS BIGINT) AS id, lang AS name
      FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL))"""),
    ("glpi_knowbaseitems_items", """SELECT doc_id AS id, doc_id AS knowbaseitems_id,
      CASE WHEN quality = 1 THEN 'Ticket' WHEN toxic = 1 THEN 'Computer' ELSE 'Software' END AS itemtype,
      doc_id AS items_id FROM labels"""),
    ("glpi_problems", _itil("error", "Problema ")),
    ("glpi_changes", _itil("signup", "Mudança ")),
    ("glpi_problems_tickets", _ticket_links("error", "problems_id")),
    ("glpi_problems_users", _tech_links("error", "problems_id")),
    ("glpi_groups_problems", """SELECT event_id AS problems_id, CAST(user_id % 25 + 1 AS BIGINT) AS groups_id, 2 AS type
      FROM events WHERE event_type = 'error'"""),
    ("glpi_items_problems", _item_links("error", "problems_id")),
    ("glpi_changes_tickets", _ticket_links("signup", "changes_id")),
    ("glpi_changes_users", _tech_links("signup", "changes_id")),
    ("glpi_changes_items", _item_links("signup", "changes_id")),
    ("glpi_changetasks", """SELECT event_id * 4 + k AS id, event_id AS changes_id,
      CASE WHEN (event_id + k) % 2 = 0 THEN 2 ELSE 1 END AS state
      FROM (SELECT event_id, unnest(generate_series(0, CASE WHEN event_id % 4 = 0 THEN 2 ELSE 0 END)) AS k
            FROM events WHERE event_type = 'signup')"""),
    ("project_base", f"""SELECT c_custkey, c_nationkey, c_name,
      TIMESTAMP '1996-01-01 00:00:00' + to_days(CAST(c_custkey % 1500 AS INTEGER)) AS ps,
      TIMESTAMP '1996-01-01 00:00:00' + to_days(CAST(c_custkey % 1500 AS INTEGER)) + to_days(CAST(c_custkey % 200 + 30 AS INTEGER)) AS pe,
      CAST(c_custkey % 3 + 1 AS BIGINT) AS st FROM customer"""),
    ("glpi_projects", f"""SELECT c_custkey AS id, CAST(c_nationkey + 100 AS BIGINT) AS entities_id, 'Projeto ' || c_name AS name,
      'P' || c_custkey AS code, CAST(c_custkey % 6 + 1 AS INTEGER) AS priority, st AS projectstates_id,
      c_custkey // 15 + {OFF} AS users_id, CAST(c_nationkey + 1 AS BIGINT) AS groups_id,
      ps AS plan_start_date, pe AS plan_end_date,
      CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE ps + to_days(CAST(c_custkey % 5 AS INTEGER)) END AS real_start_date,
      CASE WHEN st = 3 AND c_custkey % 4 <> 0 THEN pe + to_days(CAST(c_custkey % 40 - 10 AS INTEGER)) END AS real_end_date,
      CAST(CASE WHEN st = 3 THEN 100 ELSE (c_custkey * 7) % 100 END AS INTEGER) AS percent_done,
      CASE WHEN c_custkey % 97 = 0 THEN 1 ELSE 0 END AS is_deleted FROM project_base"""),
    ("glpi_projectstates", """SELECT id, CASE id WHEN 1 THEN 'Novo' WHEN 2 THEN 'Em andamento' WHEN 3 THEN 'Encerrado' END AS name,
      CASE WHEN id = 3 THEN 1 ELSE 0 END AS is_finished FROM (SELECT DISTINCT CAST(c_custkey % 3 + 1 AS BIGINT) AS id FROM customer)"""),
    ("glpi_projecttasks", f"""SELECT t.id, o_custkey AS projects_id, 'Tarefa ' || t.id AS name,
      CASE WHEN t.id % 10 = 0 THEN 1 ELSE 0 END AS is_milestone, t.date AS plan_start_date,
      t.date + to_days(CAST(t.id % 30 + 7 AS INTEGER)) AS plan_end_date, t.takeintoaccountdate AS real_start_date,
      t.solvedate AS real_end_date,
      CAST(CASE WHEN t.status IN (5, 6) THEN 100 ELSE (t.id % 10) * 10 END AS INTEGER) AS percent_done,
      CAST(CASE WHEN t.status IN (5, 6) THEN 2 ELSE 1 END AS BIGINT) AS projectstates_id,
      t.id // 150 + {OFF} AS users_id, t.is_deleted
      FROM glpi_tickets t JOIN orders ON t.id = o_orderkey"""),
    ("glpi_projecttasks_tickets", "SELECT o_orderkey AS projecttasks_id, o_orderkey AS tickets_id FROM orders"),
    ("glpi_projectteams", f"""SELECT c_custkey AS projects_id, c_custkey // 15 + j + {OFF} AS items_id, 'User' AS itemtype
      FROM (SELECT c_custkey, unnest(generate_series(0, c_custkey % 4)) AS j FROM customer)"""),
    ("glpi_itils_projects", """SELECT o_custkey AS projects_id,
      CASE WHEN o_orderkey % 3 = 0 THEN 'Ticket' ELSE 'Problem' END AS itemtype, o_orderkey AS items_id
      FROM orders WHERE o_orderkey % 3 = 0 OR o_orderkey % 7 = 0"""),
]

# the four kinds share one type table and one model table
ALIASES = {
    "glpi_computertypes": "asset_types", "glpi_networkequipmenttypes": "asset_types",
    "glpi_monitortypes": "asset_types", "glpi_printertypes": "asset_types",
    "glpi_computermodels": "asset_models", "glpi_networkequipmentmodels": "asset_models",
    "glpi_monitormodels": "asset_models", "glpi_printermodels": "asset_models",
}


def with_adapter(body: str) -> str:
    """Prefix ``body`` (a SELECT) with every adapter CTE."""
    parts = [f"{name} AS ({sql})" for name, sql in CTES]
    parts += [f"{a} AS (SELECT * FROM {b})" for a, b in ALIASES.items()]
    body = body.strip()
    if body[:4].upper() == "WITH":       # merge the body's own CTEs after ours
        return "WITH " + ",\n".join(parts) + ",\n" + body[4:]
    return "WITH " + ",\n".join(parts) + "\n" + body

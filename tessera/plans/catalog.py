"""Ordered registry of the marts (dependency order of the published deploy).

Each entry: (name, builder(src, as_of) -> DataFrame, group).  Groups follow
the five view files so a deploy can run one group at a time.
"""

from __future__ import annotations

from tessera.plans import marts_cmdb as MC
from tessera.plans import marts_entity as ME
from tessera.plans import marts_finance as MF
from tessera.plans import marts_tickets as MT

MARTS = [
    ("vw_glpi_tickets", MT.build_vw_glpi_tickets, "tickets"),
    ("vw_fact_tickets", MT.build_vw_fact_tickets, "star"),
    ("vw_dim_category", MT.build_vw_dim_category, "star"),
    ("vw_dim_technician", MT.build_vw_dim_technician, "star"),
    ("vw_dim_group", MT.build_vw_dim_group, "star"),
    ("vw_dim_sla", MT.build_vw_dim_sla, "star"),
    ("vw_sla_monthly", MT.build_vw_sla_monthly, "star"),
    ("vw_tech_productivity", MT.build_vw_tech_productivity, "star"),
    ("vw_backlog_open", MT.build_vw_backlog_open, "star"),
    ("vw_volume_trend", MT.build_vw_volume_trend, "star"),
    ("dim_date", MT.build_dim_date_for_tickets, "star"),
    ("vw_dim_asset", MC.build_vw_dim_asset, "extended"),
    ("vw_fact_asset_tickets", MC.build_vw_fact_asset_tickets, "extended"),
    ("vw_fact_asset_incidents", MC.build_vw_fact_asset_incidents, "extended"),
    ("vw_fact_problems", MC.build_vw_fact_problems, "extended"),
    ("vw_fact_changes", MC.build_vw_fact_changes, "extended"),
    ("vw_fact_projects", MC.build_vw_fact_projects, "extended"),
    ("vw_fact_project_tasks", MC.build_vw_fact_project_tasks, "extended"),
    ("vw_cmdb_summary", MC.build_vw_cmdb_summary, "extended"),
    ("vw_dim_supplier", MF.build_vw_dim_supplier, "analytics_v2"),
    ("vw_dim_software", MF.build_vw_dim_software, "analytics_v2"),
    ("vw_fact_software_licenses", MF.build_vw_fact_software_licenses, "analytics_v2"),
    ("vw_fact_asset_financials", MF.build_vw_fact_asset_financials, "analytics_v2"),
    ("vw_fact_supplier_contracts", MF.build_vw_fact_supplier_contracts, "analytics_v2"),
    ("vw_fact_kb_usage", MF.build_vw_fact_kb_usage, "analytics_v2"),
    ("vw_fact_ticket_enrichment", MF.build_vw_fact_ticket_enrichment, "analytics_v2"),
    ("vw_dim_os_inventory", MF.build_vw_dim_os_inventory, "analytics_v2"),
    ("vw_fact_satisfaction_summary", MF.build_vw_fact_satisfaction_summary, "analytics_v2"),
    ("vw_dim_entity", ME.build_vw_dim_entity, "entity"),
    ("vw_entity_overview", ME.build_vw_entity_overview, "entity"),
    ("vw_entity_sla_monthly", ME.build_vw_entity_sla_monthly, "entity"),
    ("vw_entity_asset_distribution", ME.build_vw_entity_asset_distribution, "entity"),
    ("vw_entity_project_performance", ME.build_vw_entity_project_performance, "entity"),
    ("vw_rack_inventory", ME.build_vw_rack_inventory, "entity"),
]


def mart_builders() -> dict:
    return {n: f for n, f, _ in MARTS}

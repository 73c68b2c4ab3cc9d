"""Entity and data-centre marts V28-V33.

Correlated per-entity subqueries of the published views become one
pre-aggregate per source table (one scan each) joined to the entity list;
counts are coalesced to 0, averages stay NULL when there is nothing to
average.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import domains as D
from tessera.functions.labels import code_label
from tessera.functions.ratios import pct
from tessera.functions.time import diff_units, year_month
from tessera.operators.sla import count_when

T = F.col


def _count_if(pred) -> F.Column:
    return count_when(pred)


# -------------------------------------------------------------------- V28
def build_vw_dim_entity(src, as_of: datetime | None = None) -> DataFrame:
    e = src["entities"]
    return e.select(T("id").alias("entity_id"), T("name").alias("entity_name"), T("level").alias("entity_level"),
                    T("completename").alias("entity_full_path"),
                    code_label(T("level"), D.ENTITY_TYPE_LABELS, D.ENTITY_TYPE_OTHER).alias("entity_type")
                    ).orderBy("entity_level", "entity_name")


# -------------------------------------------------------------------- V29
def build_vw_entity_overview(src, as_of: datetime | None = None) -> DataFrame:
    e = src["entities"]
    users = src["users"].groupBy(T("entities_id").alias("_e1")).agg(F.count(F.lit(1)).alias("total_users"))
    t = src["tickets"].where(T("is_deleted") == 0)
    tickets = t.groupBy(T("entities_id").alias("_e2")).agg(
        F.count(F.lit(1)).alias("total_tickets"),
        _count_if(T("status").isin(*D.ENTITY_OPEN_CODES)).alias("open_tickets"),
        _count_if(T("status").isin(*D.RESOLVED_CODES)).alias("closed_tickets"),
        F.round(F.avg(F.when(T("solvedate").isNotNull() & T("date").isNotNull(),
                             diff_units("HOUR", T("date"), T("solvedate")))), 1).alias("avg_resolution_hours"))
    c = src["computers"].where(T("is_deleted") == 0)
    comps = c.groupBy(T("entities_id").alias("_e3")).agg(
        F.count(F.lit(1)).alias("total_computers"), _count_if(T("name").like("SRV-%")).alias("total_servers"),
        _count_if(T("name").like("WS-%")).alias("total_workstations"))
    net = (src["networkequipments"].where(T("is_deleted") == 0).groupBy(T("entities_id").alias("_e4"))
           .agg(F.count(F.lit(1)).alias("total_network_equipment")))
    proj = (src["projects"].where(T("is_deleted") == 0).groupBy(T("entities_id").alias("_e5"))
            .agg(F.count(F.lit(1)).alias("total_projects")))
    j = (e.join(users, T("id") == T("_e1"), "left").join(tickets, T("id") == T("_e2"), "left")
          .join(comps, T("id") == T("_e3"), "left").join(net, T("id") == T("_e4"), "left")
          .join(proj, T("id") == T("_e5"), "left"))
    z = lambda c_: F.coalesce(T(c_), F.lit(0)).cast("bigint").alias(c_)
    return j.select(
        T("id").alias("entity_id"), T("name").alias("entity_name"), T("level").alias("entity_level"),
        z("total_users"), z("total_tickets"), z("open_tickets"), z("closed_tickets"), "avg_resolution_hours",
        z("total_computers"), z("total_servers"), z("total_workstations"), z("total_network_equipment"),
        z("total_projects")).orderBy("entity_level", "entity_name")


# -------------------------------------------------------------------- V30
def build_vw_entity_sla_monthly(src, as_of: datetime | None = None) -> DataFrame:
    """Entity x month.  One shuffle aggregates tickets per (entity, month,
    type); a second, tiny aggregate rolls up to (entity, month) and picks the
    predominant type (highest count, ties -> lowest type code)."""
    t = src["tickets"].where(T("is_deleted") == 0)
    due, solved = T("time_to_resolve"), T("solvedate")
    by_type = t.groupBy(T("entities_id").alias("_eid"), year_month(T("date")).alias("year_month"), "type").agg(
        F.count(F.lit(1)).alias("_n"),
        _count_if(due.isNotNull()).alias("_sla"),
        _count_if(due.isNotNull() & solved.isNotNull() & (solved <= due)).alias("_in"),
        _count_if(due.isNotNull() & solved.isNotNull() & (solved > due)).alias("_out"),
        _count_if(due.isNotNull() & solved.isNull() & ~T("status").isin(*D.RESOLVED_CODES)).alias("_pend"),
        _count_if(due.isNotNull() & solved.isNotNull()).alias("_solved"))
    agg = by_type.groupBy("_eid", "year_month").agg(
        F.sum("_n").alias("total_tickets"), F.sum("_sla").alias("tickets_with_sla"),
        F.sum("_in").alias("within_sla"), F.sum("_out").alias("breached_sla"),
        F.sum("_pend").alias("pending_with_sla"), F.sum("_solved").alias("_solved"),
        F.max_by("type", F.struct(T("_n"), -T("type"))).alias("predominant_type"))
    e = src["entities"].select(T("id").alias("entity_id"), T("name").alias("entity_name"))
    j = agg.join(e, T("_eid") == T("entity_id"))
    return j.select("entity_id", "entity_name", "year_month", "total_tickets", "tickets_with_sla", "within_sla",
                    "breached_sla", "pending_with_sla", pct(T("within_sla"), T("_solved"), 1).alias("sla_compliance_pct"),
                    "predominant_type").orderBy("entity_name", "year_month")


# -------------------------------------------------------------------- V31
def build_vw_entity_asset_distribution(src, as_of: datetime | None = None) -> DataFrame:
    """Entity x asset kind.  Value = first financial record per asset
    (lowest record id); share = kind count / all live assets of six tables.
    The grand total is a one-row aggregate, broadcast to every row."""
    first_value = (src["infocoms"].groupBy(T("itemtype").alias("_vit"), T("items_id").alias("_iid"))
                   .agg(F.min_by("value", "id").alias("_value")))

    def kind(table, itemtype, label, pred=None):
        a = src[table].where(T("is_deleted") == 0)
        if pred is not None:
            a = a.where(pred)
        return a.select("entities_id", T("id").alias("_aid"), F.lit(label).alias("asset_type"),
                        F.lit(itemtype).cast("string").alias("_it"))

    assets = (kind("computers", "Computer", D.ASSET_KIND_SERVER, T("name").like("SRV-%"))
              .unionByName(kind("computers", "Computer", D.ASSET_KIND_WORKSTATION, T("name").like("WS-%")))
              .unionByName(kind("networkequipments", "NetworkEquipment", D.ASSET_KIND_NETWORK))
              .unionByName(kind("monitors", "Monitor", D.ASSET_KIND_MONITOR))
              .unionByName(kind("printers", "Printer", D.ASSET_KIND_PRINTER))
              .unionByName(kind("phones", None, D.ASSET_KIND_PHONE))
              .unionByName(kind("peripherals", None, D.ASSET_KIND_PERIPHERAL)))
    # ONE aggregate of the financial records, ONE join on (item type, id);
    # phones and peripherals carry a NULL item type, so they never match (value 0)
    valued = assets.join(first_value, (T("_it") == T("_vit")) & (T("_aid") == T("_iid")), "left")
    data = valued.groupBy("entities_id", "asset_type").agg(
        F.count(F.lit(1)).alias("total_assets"),
        # money has 2 decimals: rounding the double sum to 2 places gives the exact decimal total
        F.round(F.sum(F.coalesce(T("_value"), F.lit(0.0))), 2).cast("double").alias("total_value_brl"))
    total = None
    for table in ("computers", "networkequipments", "monitors", "printers", "phones", "peripherals"):
        c = src[table].where(T("is_deleted") == 0).select(F.lit(1).alias("_one"))
        total = c if total is None else total.unionByName(c)
    grand = total.agg(F.count(F.lit(1)).alias("_grand"))
    e = src["entities"].select(T("id").alias("entity_id"), T("name").alias("entity_name"))
    j = data.join(e, T("entities_id") == T("entity_id")).crossJoin(F.broadcast(grand))
    return j.select("entity_id", "entity_name", "asset_type", "total_assets", "total_value_brl",
                    pct(T("total_assets"), T("_grand"), 1).alias("pct_of_total_assets")
                    ).orderBy("entity_name", "asset_type")


# -------------------------------------------------------------------- V32
def build_vw_entity_project_performance(src, as_of: datetime | None = None) -> DataFrame:
    """Task counts include deleted tasks (as published)."""
    p = src["projects"].where(T("is_deleted") == 0)
    e = src["entities"].select(T("id").alias("entity_id"), T("name").alias("entity_name"))
    tasks = src["projecttasks"].groupBy(T("projects_id").alias("_p1")).agg(
        F.count(F.lit(1)).alias("total_tasks"), _count_if(T("percent_done") == 100).alias("completed_tasks"))
    links = (src["itils_projects"].where(T("itemtype") == "Ticket").groupBy(T("projects_id").alias("_p2"))
             .agg(F.count(F.lit(1)).alias("linked_tickets")))
    j = (p.join(e, T("entities_id") == T("entity_id")).join(tasks, T("id") == T("_p1"), "left")
          .join(links, T("id") == T("_p2"), "left"))
    return j.select("entity_id", "entity_name", T("id").alias("project_id"), T("name").alias("project_name"),
                    "percent_done", T("plan_start_date").alias("planned_start"), T("plan_end_date").alias("planned_end"),
                    T("real_start_date").alias("real_start"), T("real_end_date").alias("real_end"),
                    T("projectstates_id").alias("project_state_id"), T("code").alias("project_code"),
                    F.coalesce("total_tasks", F.lit(0)).alias("total_tasks"),
                    F.coalesce("completed_tasks", F.lit(0)).cast("bigint").alias("completed_tasks"),
                    F.coalesce("linked_tickets", F.lit(0)).alias("linked_tickets"),
                    F.lit(0).alias("budget_id")).orderBy("entity_name", F.desc("percent_done"))


# -------------------------------------------------------------------- V33
def build_vw_rack_inventory(src, as_of: datetime | None = None) -> DataFrame:
    ir = src["items_racks"]
    r = src["racks"].select(T("id").alias("rack_id"), T("name").alias("rack_name"), T("entities_id").alias("_re"),
                            T("locations_id").alias("_rl"), T("number_units").alias("rack_units"),
                            T("max_power").alias("max_power_w"))
    e = src["entities"].select(T("id").alias("_eid"), T("name").alias("entity_name"))
    loc = src["locations"].select(T("id").alias("_lid"), T("name").alias("location_name"))
    assets = (src["computers"].select(F.lit("Computer").alias("_it"), T("id").alias("_aid"), T("name").alias("asset_name"),
                                      T("serial").alias("asset_serial"))
              .unionByName(src["networkequipments"].select(F.lit("NetworkEquipment").alias("_it"), T("id").alias("_aid"),
                                                           T("name").alias("asset_name"), T("serial").alias("asset_serial"))))
    inc_t = src["tickets"].where((T("type") == 1) & (T("is_deleted") == 0)).select(T("id").alias("_tid"), T("date").alias("_td"))
    incidents = (src["items_tickets"].join(inc_t, T("tickets_id") == T("_tid"))
                 .groupBy(T("itemtype").alias("_iit"), T("items_id").alias("_iid"))
                 .agg(F.count(F.lit(1)).alias("_n"), F.max("_td").alias("last_incident_date")))
    j = (ir.join(r, T("racks_id") == T("rack_id")).join(e, T("_re") == T("_eid"))
           .join(loc, T("_rl") == T("_lid"), "left")
           .join(assets, (T("itemtype") == T("_it")) & (T("items_id") == T("_aid")), "left")
           .join(incidents, (T("itemtype") == T("_iit")) & (T("items_id") == T("_iid")), "left"))
    return j.select("rack_id", "rack_name", "entity_name", "location_name", "rack_units", "max_power_w",
                    T("position").alias("unit_position"), "itemtype", "asset_name", "asset_serial",
                    F.coalesce("_n", F.lit(0)).alias("incident_count"), "last_incident_date",
                    T("bgcolor").alias("slot_color")).orderBy("rack_name", "unit_position")

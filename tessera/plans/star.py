"""Registered queries of the relationship graph (J11, J12, X4) and of scoped marts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.enrich import join_one_to_one
from tessera.plans.analytics import round_doubles
from tessera.plans.measures import evaluate
from tessera.plans.model import Model

T = F.col


def backlog_by_dimension(src, as_of: datetime) -> DataFrame:
    """Backlog by category tree and kind of entity, tickets opened on work days only: two and three edges away."""
    b = Model(src, as_of).star("vw_backlog_open", ["vw_dim_category.category_parent", "vw_dim_entity.entity_type"], {"dim_date.is_workday": 1})
    return b.groupBy("category_parent", "entity_type").agg(
        F.count(F.lit(1)).alias("open_tickets"), F.sum("age_days").alias("age_days"), F.count("sla_due_at").alias("with_sla"))


def productivity_by_team(src, as_of: datetime) -> DataFrame:
    """Productivity by the technician dimension's team, teams of active technicians only."""
    p = Model(src, as_of).star("vw_tech_productivity", ["vw_dim_technician.group_id"], {"vw_dim_technician.group_id": T("group_id") > 0})
    return p.groupBy("group_id", "yr").agg(F.sum("tickets_assigned").alias("tickets_assigned"), F.sum("tickets_resolved").alias("tickets_resolved"),
                                           F.count_distinct("technician_id").alias("technicians"))


def financials_by_supplier(src, as_of: datetime) -> DataFrame:
    """Asset values by kind and state of the active suppliers, joined on the supplier's name."""
    f = Model(src, as_of).star("vw_fact_asset_financials", ["vw_dim_supplier.supplier_type", "vw_dim_supplier.state"], {"vw_dim_supplier.is_active": 1})
    return f.groupBy("supplier_type", "state").agg(F.count(F.lit(1)).alias("assets"), F.round(F.sum("purchase_value"), 2).alias("purchase_value"))


def tickets_by_date_role(src, as_of: datetime) -> DataFrame:
    """Tickets by quarter of the day they were opened, resolved and closed: one active and two inactive relationships."""
    m, out = Model(src, as_of), None
    for role in ("opened", "resolved", "closed"):
        one = evaluate(m, ["total_tickets"], by=["dim_date.year", "dim_date.quarter"], filters={"dim_date.is_weekend": 0},
                       roles=[] if role == "opened" else [role]).withColumn("date_role", F.lit(role))
        out = one if out is None else out.unionByName(one)
    return out


def problems_and_changes_by_quarter(src, as_of: datetime) -> DataFrame:
    """Problems and changes on one calendar, each through its own date edge."""
    m = Model(src, as_of)
    per = [m.star(mart, ["dim_date.year", "dim_date.quarter", "vw_dim_entity.entity_type"]).groupBy("year", "quarter", "entity_type")
           .agg(F.count(F.lit(1)).alias(name), F.sum("linked_assets").alias(f"{name}_assets"))
           for mart, name in (("vw_fact_problems", "problems"), ("vw_fact_changes", "changes"))]
    both = per[0].unionByName(per[1], allowMissingColumns=True)
    return both.groupBy("year", "quarter", "entity_type").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("problems", "problems_assets", "changes", "changes_assets")])


def ticket_enrichment_match(src, as_of: datetime) -> DataFrame:
    """Tickets beside their enrichment by priority, and how the two sides match."""
    m = Model(src, as_of)
    j = join_one_to_one(m.mart("vw_fact_tickets").select("ticket_id", "priority_code", "resolution_min"),
                        m.mart("vw_fact_ticket_enrichment").select("ticket_id", "followup_count", "task_count", "satisfaction"), "ticket_id")
    return round_doubles(j.groupBy("match", "priority_code").agg(
        F.count(F.lit(1)).alias("tickets"), F.sum("r_followup_count").alias("followups"), F.sum("r_task_count").alias("tasks"),
        F.avg("r_satisfaction").alias("avg_satisfaction"), F.avg("resolution_min").alias("avg_resolution_min")))


def region_scope(src, region: str) -> DataFrame:
    """The entities of a regional manager: the region, the head office above it and the entities below it."""
    e = src["entities"]
    own = e.where(T("name") == region).select(T("id").alias("_region"), T("entities_id").alias("_above"))
    j = e.join(own, (T("id") == T("_region")) | (T("id") == T("_above")) | (T("entities_id") == T("_region")), "left_semi")
    return j.select(T("id").alias("entity_id"))


def _scoped(mart: str, region: str = "AMERICA") -> Callable:
    def run(src, as_of: datetime) -> DataFrame:
        return Model(src, as_of, scope=region_scope(src, region)).mart(mart)
    return run


#: marts without an entity of their own, as a reader of one region's entities sees them
SCOPED = ("vw_tech_productivity", "vw_rack_inventory", "vw_dim_os_inventory", "vw_fact_asset_financials", "vw_fact_supplier_contracts",
          "vw_fact_satisfaction_summary", "vw_entity_asset_distribution")

QUERIES = {
    "star_backlog_by_dimension": backlog_by_dimension,
    "star_productivity_by_team": productivity_by_team,
    "star_financials_by_supplier": financials_by_supplier,
    "star_tickets_by_date_role": tickets_by_date_role,
    "star_problems_and_changes_by_quarter": problems_and_changes_by_quarter,
    "ticket_enrichment_match": ticket_enrichment_match,
    **{f"scope_{m.removeprefix('vw_')}": _scoped(m) for m in SCOPED},
}

"""Ticket marts V1-V10 and the calendar V34.

Every builder is ``build_x(src, as_of) -> DataFrame``: ``src`` maps contract
names to DataFrames, ``as_of`` replaces NOW()/CURDATE() so results are
reproducible.  Column order follows the published views.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import domains as D
from tessera.functions.labels import code_label, in_codes
from tessera.functions.ratios import pct
from tessera.functions.time import diff_units, ntz, year_month
from tessera.operators.links import (
    default_email, first_group_name, first_link, full_name, full_name_nullsafe, links_of_role, with_first_links,
)
from tessera.operators.sla import count_when, sla_breached, sla_flag, sla_met, sla_status

T = F.col


def live_tickets(src) -> DataFrame:
    return src["tickets"].where(T("is_deleted") == 0)


def _category_parent(completename, name):
    return (F.when(completename.like("% > %"), F.substring_index(completename, " > ", 1))
            .otherwise(F.coalesce(name, F.lit(D.NO_CATEGORY))))


def _minutes_if(start, end):
    return F.when(end.isNotNull(), diff_units("MINUTE", start, end))


def _mttr_min():
    return F.round(F.avg(_minutes_if(T("date"), T("solvedate"))), 1)


# --------------------------------------------------------------------- V1
# Columns supplied by each left-join block of V1.  Catalyst cannot drop an
# unused left join to a lookup whose key it cannot prove unique, so callers
# that need only some columns (measures, pages) pass ``needs`` and only the
# blocks providing those columns are joined.
V1_JOIN_BLOCKS = {
    "category": ("category_name", "category_full_path", "category_parent"),
    "group": ("assigned_group_id", "assigned_group_name"),
    "requester": ("requester_id", "requester_name", "requester_email"),
    "technician": ("technician_id", "technician_name", "technician_group"),
    "sla": ("sla_name",),
}


def build_vw_glpi_tickets(src, as_of: datetime, needs: set | frozenset | None = None) -> DataFrame:
    """V1.  ``needs=None`` builds every column; otherwise only the join
    blocks that provide a column in ``needs`` (base ticket columns are
    always present)."""
    now = ntz(as_of)
    want = {b for b, cols in V1_JOIN_BLOCKS.items() if needs is None or set(cols) & set(needs)}
    j = live_tickets(src)
    if "category" in want:
        cat = src["itilcategories"].select(T("id").alias("cat_id"), T("name").alias("cat_name"),
                                           T("completename").alias("cat_path"))
        j = j.join(cat, T("itilcategories_id") == T("cat_id"), "left")
    if "group" in want:
        gt = first_link(src["groups_tickets"], "tickets_id", "groups_id", 2, out="gt_group").withColumnRenamed("tickets_id", "k1")
        groups = src["groups"].select(T("id").alias("grp_id"), T("name").alias("grp_name"))
        j = j.join(gt, T("id") == T("k1"), "left").join(groups, T("gt_group") == T("grp_id"), "left")
    if want & {"requester", "technician"}:
        roles = {}
        if "requester" in want:
            roles[1] = "req_uid"
        if "technician" in want:
            roles[2] = "tech_uid"
        j = with_first_links(j, "id", src, "tickets_users", "tickets_id", "users_id", roles)
        users = src["users"].select("id", "firstname", "realname")
        if "requester" in want:
            req_u = users.select(T("id").alias("req_id"), T("firstname").alias("req_first"), T("realname").alias("req_real"))
            mail = default_email(src["useremails"], "req_email").withColumnRenamed("users_id", "mail_uid")
            j = (j.join(req_u, T("req_uid") == T("req_id"), "left")
                  .join(mail, T("req_id") == T("mail_uid"), "left"))
        if "technician" in want:
            tech_u = users.select(T("id").alias("tech_id"), T("firstname").alias("tech_first"), T("realname").alias("tech_real"))
            tgrp = first_group_name(src["groups_users"], src["groups"], "tech_grp").withColumnRenamed("users_id", "tg_uid")
            j = (j.join(tech_u, T("tech_uid") == T("tech_id"), "left")
                  .join(tgrp, T("tech_id") == T("tg_uid"), "left"))
    if "sla" in want:
        sla = src["slas"].select(T("id").alias("sla_pk"), T("name").alias("sla_nm"))
        j = j.join(sla, T("slas_id_ttr") == T("sla_pk"), "left")
    status, due, created = T("status"), T("time_to_resolve"), T("date")
    cols = [
        (None, T("id").alias("ticket_id")), (None, T("entities_id").alias("entity_id")),
        (None, T("name").alias("ticket_title")),
        (None, created.alias("created_at")), (None, T("solvedate").alias("resolved_at")),
        (None, T("closedate").alias("closed_at")),
        (None, T("takeintoaccountdate").alias("assigned_at")), (None, T("date_mod").alias("last_modified_at")),
        (None, year_month(created).alias("created_year_month")), (None, F.year(created).alias("created_year")),
        (None, F.month(created).alias("created_month")), (None, F.quarter(created).alias("created_quarter")),
        (None, F.dayofweek(created).alias("created_weekday")),
        (None, status.alias("status_code")),
        (None, code_label(status, D.STATUS_LABELS, D.STATUS_UNKNOWN).alias("status_label")),
        (None, in_codes(status, D.OPEN_CODES).alias("is_open")),
        (None, in_codes(status, D.RESOLVED_CODES).alias("is_resolved")),
        (None, in_codes(status, (D.CLOSED_CODE,)).alias("is_closed")),
        (None, T("priority").alias("priority_code")),
        (None, code_label(T("priority"), D.PRIORITY_LABELS, D.PRIORITY_UNKNOWN).alias("priority_label")),
        (None, T("type").alias("ticket_type_code")),
        (None, code_label(T("type"), D.TYPE_LABELS, D.TYPE_UNKNOWN).alias("ticket_type_label")),
        (None, T("itilcategories_id").alias("category_id")),
        ("category", F.coalesce(T("cat_name"), F.lit(D.NO_CATEGORY)).alias("category_name")),
        ("category", F.coalesce(T("cat_path"), F.lit(D.NO_CATEGORY)).alias("category_full_path")),
        ("category", _category_parent(T("cat_path"), T("cat_name")).alias("category_parent")),
        ("group", F.coalesce(T("grp_id"), F.lit(0)).cast("bigint").alias("assigned_group_id")),
        ("group", F.coalesce(T("grp_name"), F.lit(D.NO_GROUP)).alias("assigned_group_name")),
        ("requester", T("req_id").alias("requester_id")),
        ("requester", full_name_nullsafe(T("req_first"), T("req_real")).alias("requester_name")),
        ("requester", F.coalesce(T("req_email"), F.lit("")).alias("requester_email")),
        ("technician", T("tech_id").alias("technician_id")),
        ("technician", full_name_nullsafe(T("tech_first"), T("tech_real")).alias("technician_name")),
        ("technician", F.coalesce(T("tech_grp"), F.lit(D.NO_GROUP)).alias("technician_group")),
        (None, T("slas_id_ttr").alias("sla_id")),
        ("sla", F.coalesce(T("sla_nm"), F.lit(D.SLA_NONE)).alias("sla_name")),
        (None, due.alias("sla_due_at")),
        (None, sla_status(now, fallback=D.SLA_NONE).alias("sla_status")),
        (None, sla_flag().alias("sla_compliant")),
        (None, _minutes_if(created, T("solvedate")).alias("resolution_time_min")),
        (None, _minutes_if(created, T("closedate")).alias("closure_time_min")),
        (None, _minutes_if(created, T("takeintoaccountdate")).alias("time_to_own_min")),
        (None, F.when(~status.isin(*D.RESOLVED_CODES), diff_units("MINUTE", created, now)).alias("age_open_min")),
        (None, F.round(T("solve_delay_stat") / 60.0, 2).alias("solve_delay_min")),
        (None, F.round(T("close_delay_stat") / 60.0, 2).alias("close_delay_min")),
    ]
    return j.select(*[c for block, c in cols if block is None or block in want])


# --------------------------------------------------------------------- V2
def build_vw_fact_tickets(src, as_of: datetime) -> DataFrame:
    now = ntz(as_of)
    t = live_tickets(src)
    gt = first_link(src["groups_tickets"], "tickets_id", "groups_id", 2, out="gt_group").withColumnRenamed("tickets_id", "k1")
    j = with_first_links(t.join(gt, T("id") == T("k1"), "left"), "id", src, "tickets_users", "tickets_id", "users_id",
                         {1: "req_uid", 2: "tech_uid"})
    status, created = T("status"), T("date")
    return j.select(
        T("id").alias("ticket_id"), T("name").alias("ticket_title"),
        F.to_date(created).alias("created_date"), F.to_date("solvedate").alias("resolved_date"),
        F.to_date("closedate").alias("closed_date"),
        year_month(created).alias("created_ym"), F.year(created).alias("created_year"),
        F.month(created).alias("created_month"), F.quarter(created).alias("created_quarter"),
        F.coalesce("gt_group", F.lit(0)).cast("bigint").alias("group_id"),
        F.coalesce("itilcategories_id", F.lit(0)).cast("bigint").alias("category_id"),
        F.coalesce("tech_uid", F.lit(0)).cast("bigint").alias("technician_id"),
        F.coalesce("req_uid", F.lit(0)).cast("bigint").alias("requester_id"),
        F.coalesce("slas_id_ttr", F.lit(0)).cast("bigint").alias("sla_id"),
        status.alias("status_code"), T("priority").alias("priority_code"), T("type").alias("ticket_type_code"),
        T("entities_id").alias("entity_id"),
        in_codes(status, D.OPEN_CODES).alias("is_open"), in_codes(status, D.RESOLVED_CODES).alias("is_resolved"),
        in_codes(status, (D.CLOSED_CODE,)).alias("is_closed"),
        sla_flag().alias("sla_met"),
        sla_status(now, fallback=D.SLA_AT_RISK).alias("sla_status"),
        _minutes_if(created, T("solvedate")).alias("resolution_min"),
        _minutes_if(created, T("closedate")).alias("closure_min"),
        _minutes_if(created, T("takeintoaccountdate")).alias("tto_min"),
        F.when(~status.isin(*D.RESOLVED_CODES), diff_units("MINUTE", created, now)).alias("age_open_min"),
        F.lit(1).alias("ticket_count"),
    )


# --------------------------------------------------------------------- V3
def build_vw_dim_category(src, as_of: datetime | None = None) -> DataFrame:
    c = src["itilcategories"]
    nested = T("completename").like("% > %")
    return c.select(
        "id", T("name").alias("category_name"), T("completename").alias("category_full_path"), "level",
        F.when(nested, F.substring_index("completename", " > ", 1)).otherwise(T("name")).alias("category_parent"),
        F.when(nested, F.substring_index("completename", " > ", -1)).alias("category_child"),
        T("itilcategories_id").alias("parent_id"),
        F.when(T("level") == 1, F.lit(D.CATEGORY_ROOT)).otherwise(F.lit(D.CATEGORY_SUB)).alias("category_level_label"))


# --------------------------------------------------------------------- V4
def build_vw_dim_technician(src, as_of: datetime | None = None) -> DataFrame:
    u = src["users"].where((T("is_deleted") == 0) & (T("is_active") == 1))
    prof = src["profiles"].where(T("name") == "Technician").select(T("id").alias("prof_id"))
    pu = src["profiles_users"].join(prof, T("profiles_id") == T("prof_id")).select(T("users_id").alias("pu_uid"))
    gu = first_link(src["groups_users"], "users_id", "groups_id", out="gu_gid").withColumnRenamed("users_id", "gu_uid")
    g = src["groups"].select(T("id").alias("g_id"), T("name").alias("g_name"))
    em = default_email(src["useremails"], "em_email").withColumnRenamed("users_id", "em_uid")
    j = (u.join(pu, T("id") == T("pu_uid"))
          .join(gu, T("id") == T("gu_uid"), "left").join(g, T("gu_gid") == T("g_id"), "left")
          .join(em, T("id") == T("em_uid"), "left"))
    return j.select(
        "id", full_name(T("firstname"), T("realname")).alias("technician_name"), "firstname", "realname",
        F.coalesce("g_name", F.lit(D.NO_GROUP)).alias("team_group"),
        F.coalesce("g_id", F.lit(0)).cast("bigint").alias("group_id"),
        F.coalesce("em_email", F.lit("")).alias("email"))


# --------------------------------------------------------------------- V5
def build_vw_dim_group(src, as_of: datetime | None = None) -> DataFrame:
    return src["groups"].where(T("is_assign") == 1).select(
        "id", T("name").alias("group_name"), T("code").alias("group_code"), T("comment").alias("group_description"))


# --------------------------------------------------------------------- V6
def build_vw_dim_sla(src, as_of: datetime | None = None) -> DataFrame:
    s = src["slas"]
    unit = T("definition_time")
    target = (F.when(unit == "minute", T("number_time")).when(unit == "hour", T("number_time") * 60)
              .when(unit == "day", T("number_time") * 1440).otherwise(T("number_time")))
    return s.select("id", T("name").alias("sla_name"), "number_time", "definition_time",
                    target.alias("sla_target_min"),
                    code_label(T("type"), D.SLA_TYPE_LABELS, D.STATUS_UNKNOWN).alias("sla_type_label"))


# --------------------------------------------------------------------- V7
def build_vw_sla_monthly(src, as_of: datetime | None = None) -> DataFrame:
    """Month x group name x priority.  C1 dedupes multi-group tickets first,
    so each ticket counts once (unlike V27)."""
    t = live_tickets(src).select("id", "date", "status", "priority", "solvedate", "time_to_resolve")
    gt = first_link(src["groups_tickets"], "tickets_id", "groups_id", 2, out="gt_group")
    g = src["groups"].select(T("id").alias("g_id"), T("name").alias("g_name"))
    j = (t.join(gt, T("id") == T("tickets_id"), "left")
          .join(g, T("gt_group") == T("g_id"), "left"))
    with_sla_res = T("time_to_resolve").isNotNull() & T("status").isin(*D.RESOLVED_CODES)
    agg = j.groupBy(year_month(T("date")).alias("year_month"), F.year("date").alias("yr"),
                    F.month("date").alias("mon"), "g_name", "priority").agg(
        F.count(F.lit(1)).alias("total_tickets"),
        count_when(T("status").isin(*D.RESOLVED_CODES)).alias("resolved_tickets"),
        count_when(with_sla_res).alias("tickets_with_sla_resolved"),
        count_when(sla_met()).alias("within_sla"),
        count_when(sla_breached()).alias("breached_sla"),
        _mttr_min().alias("avg_resolution_min"))
    return agg.select(
        "year_month", "yr", "mon", F.coalesce("g_name", F.lit(D.NO_GROUP)).alias("group_name"),
        code_label(T("priority"), D.PRIORITY_LABELS_COMPACT, D.PRIORITY_COMPACT_UNKNOWN).alias("priority_label"),
        "total_tickets", "resolved_tickets", "tickets_with_sla_resolved", "within_sla", "breached_sla",
        pct(T("within_sla"), T("tickets_with_sla_resolved"), 2).alias("sla_compliance_pct"),
        "avg_resolution_min")


# --------------------------------------------------------------------- V8
def build_vw_tech_productivity(src, as_of: datetime | None = None) -> DataFrame:
    t = live_tickets(src).select("id", "date", "status", "solvedate", "time_to_resolve")
    tu = first_link(links_of_role(src, "tickets_users", 2), "tickets_id", "users_id", out="tech_uid")
    u = src["users"].select(T("id").alias("u_id"), "firstname", "realname")
    g = first_group_name(src["groups_users"], src["groups"], "g_name").withColumnRenamed("users_id", "g_uid")
    j = (t.join(tu, T("id") == T("tickets_id")).join(u, T("tech_uid") == T("u_id"))
          .join(g, T("u_id") == T("g_uid"), "left"))
    with_sla_res = T("time_to_resolve").isNotNull() & T("status").isin(*D.RESOLVED_CODES)
    agg = j.groupBy(year_month(T("date")).alias("year_month"), F.year("date").alias("yr"),
                    F.month("date").alias("mon"), "u_id", "firstname", "realname", "g_name").agg(
        F.count(F.lit(1)).alias("tickets_assigned"),
        count_when(T("status").isin(*D.RESOLVED_CODES)).alias("tickets_resolved"),
        count_when(T("status") == D.CLOSED_CODE).alias("tickets_closed"),
        _mttr_min().alias("avg_resolution_min"),
        count_when(sla_met()).alias("_met"), count_when(with_sla_res).alias("_den"))
    return agg.select(
        "year_month", "yr", "mon", full_name(T("firstname"), T("realname")).alias("technician_name"),
        T("u_id").alias("technician_id"), F.coalesce("g_name", F.lit(D.NO_GROUP)).alias("team_group"),
        "tickets_assigned", "tickets_resolved", "tickets_closed", "avg_resolution_min",
        pct(T("_met"), T("_den"), 2).alias("sla_compliance_pct"))


# --------------------------------------------------------------------- V9
V9_JOIN_BLOCKS = {
    "category": ("category_name", "category_parent"),
    "group": ("assigned_group",),
    "technician": ("technician_name",),
}


def build_vw_backlog_open(src, as_of: datetime, needs: set | frozenset | None = None) -> DataFrame:
    """V9 open-ticket snapshot; ``needs`` as for V1 (only the joins whose
    columns are read are added)."""
    now = ntz(as_of)
    want = {b for b, cols in V9_JOIN_BLOCKS.items() if needs is None or set(cols) & set(needs)}
    j = live_tickets(src).where(~T("status").isin(*D.RESOLVED_CODES))
    if "category" in want:
        cat = src["itilcategories"].select(T("id").alias("cat_id"), T("name").alias("cat_name"),
                                           T("completename").alias("cat_path"))
        j = j.join(cat, T("itilcategories_id") == T("cat_id"), "left")
    if "group" in want:
        gt = first_link(src["groups_tickets"], "tickets_id", "groups_id", 2, out="gt_group").withColumnRenamed("tickets_id", "k1")
        grp = src["groups"].select(T("id").alias("grp_id"), T("name").alias("grp_name"))
        j = j.join(gt, T("id") == T("k1"), "left").join(grp, T("gt_group") == T("grp_id"), "left")
    if "technician" in want:
        tu = first_link(links_of_role(src, "tickets_users", 2), "tickets_id", "users_id", out="tech_uid").withColumnRenamed("tickets_id", "k2")
        u = src["users"].select(T("id").alias("u_id"), "firstname", "realname")
        j = j.join(tu, T("id") == T("k2"), "left").join(u, T("tech_uid") == T("u_id"), "left")
    due = T("time_to_resolve")
    urgency = (F.when(due.isNull(), F.lit(D.URGENCY_NONE)).when(now > due, F.lit(D.URGENCY_BREACHED))
               .when(diff_units("HOUR", now, due) < 4, F.lit(D.URGENCY_CRITICAL)).otherwise(F.lit(D.URGENCY_OK)))
    cols = [
        (None, T("id").alias("ticket_id")), (None, T("name").alias("ticket_title")),
        (None, T("date").alias("created_at")),
        (None, diff_units("DAY", T("date"), now).alias("age_days")),
        (None, diff_units("HOUR", T("date"), now).alias("age_hours")),
        (None, code_label(T("status"), {k: v for k, v in D.STATUS_LABELS.items() if k in D.OPEN_CODES})
         .alias("status_label")),
        (None, T("priority").alias("priority_code")),
        (None, code_label(T("priority"), D.PRIORITY_LABELS_COMPACT).alias("priority_label")),
        ("category", F.coalesce("cat_name", F.lit(D.NO_CATEGORY)).alias("category_name")),
        ("category", _category_parent(T("cat_path"), T("cat_name")).alias("category_parent")),
        ("group", F.coalesce("grp_name", F.lit(D.NO_GROUP)).alias("assigned_group")),
        ("technician", full_name_nullsafe(T("firstname"), T("realname")).alias("technician_name")),
        (None, due.alias("sla_due_at")), (None, urgency.alias("sla_urgency")),
        (None, diff_units("MINUTE", now, due).alias("sla_remaining_min")),
    ]
    return j.select(*[c for block, c in cols if block is None or block in want])


# -------------------------------------------------------------------- V10
def build_vw_volume_trend(src, as_of: datetime | None = None) -> DataFrame:
    t = live_tickets(src)
    agg = t.groupBy(year_month(T("date")).alias("year_month"), F.year("date").alias("yr"),
                    F.month("date").alias("mon")).agg(
        F.count(F.lit(1)).alias("tickets_created"),
        count_when(T("status").isin(*D.RESOLVED_CODES)).alias("tickets_resolved"),
        count_when(T("status") == D.CLOSED_CODE).alias("tickets_closed"),
        count_when(T("status").isin(*D.OPEN_CODES)).alias("tickets_open"),
        count_when(T("type") == 1).alias("incidents"),
        count_when(T("type") == 2).alias("requests"),
        _mttr_min().alias("avg_resolution_min"))
    return agg.orderBy("year_month")


# -------------------------------------------------------------------- V34
def build_dim_date(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """Calendar from ``start`` to ``end`` inclusive (one row per day)."""
    s, e = str(start)[:10], str(end)[:10]
    return calendar_from_bounds(spark.range(1).select(F.expr(f"DATE '{s}'").alias("lo"),
                                                      F.expr(f"DATE '{e}'").alias("hi")))


def calendar_from_bounds(bounds: DataFrame) -> DataFrame:
    """``bounds`` has one row (lo, hi); the spine is generated with
    sequence/explode (a single small row, no shuffle)."""
    d = bounds.select(F.explode(F.sequence("lo", "hi")).alias("date"))
    wd = F.weekday("date") + 1                              # Monday = 1
    week_sun = (F.floor((F.dayofyear("date") + F.dayofweek(F.trunc("date", "year")) - 2) / 7) + 1).cast("int")
    return d.select(
        "date", F.year("date").alias("year"), F.month("date").alias("month"),
        F.date_format("date", "MM").alias("month_num"), F.date_format("date", "MMM/yyyy").alias("month_name"),
        F.concat(F.lit("Q"), F.quarter("date").cast("string")).alias("quarter"),
        F.date_format("date", "yyyy-MM").alias("year_month"),
        week_sun.alias("week"), F.weekofyear("date").alias("iso_week"),
        wd.alias("weekday"), F.date_format("date", "EEEE").alias("weekday_name"),
        F.when(wd >= 6, 1).otherwise(0).alias("is_weekend"), F.when(wd <= 5, 1).otherwise(0).alias("is_workday"))


def build_dim_date_for_tickets(src, as_of: datetime | None = None) -> DataFrame:
    """V34 spanning the ticket creation dates (bounds from one global agg)."""
    t = src["tickets"]
    return calendar_from_bounds(t.agg(F.to_date(F.min("date")).alias("lo"), F.to_date(F.max("date")).alias("hi")))

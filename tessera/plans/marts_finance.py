"""Supplier, software, finance, knowledge-base, enrichment, OS and
satisfaction marts V19-V27."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import domains as D
from tessera.functions.labels import code_label
from tessera.functions.time import add_months_ts, date_lit, diff_units, ntz, year_month
from tessera.operators.links import full_name

T = F.col


def _lookup(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.select(T("id").alias(key), T("name").alias(out))


# -------------------------------------------------------------------- V19
def build_vw_dim_supplier(src, as_of: datetime | None = None) -> DataFrame:
    s = src["suppliers"].where(T("is_deleted") == 0)
    j = s.join(_lookup(src["suppliertypes"], "_tid", "supplier_type"), T("suppliertypes_id") == T("_tid"), "left")
    return j.select(T("id").alias("supplier_id"), T("name").alias("supplier_name"), "supplier_type", "email",
                    T("phonenumber").alias("phone"), "town", "state", "website", "is_active")


# -------------------------------------------------------------------- V20
def build_vw_dim_software(src, as_of: datetime | None = None) -> DataFrame:
    """Software x versions x licences (the published per-software fan-out)."""
    sw = src["softwares"].where(T("is_deleted") == 0)
    m = _lookup(src["manufacturers"], "_mid", "manufacturer")
    sv = src["softwareversions"].select(T("id").alias("version_id"), T("softwares_id").alias("_sv_sw"),
                                        T("name").alias("version_name"))
    sl = src["softwarelicenses"].select(T("softwares_id").alias("_sl_sw"), T("number").alias("licenses_qty"),
                                        T("expire").alias("license_expiry"), T("serial").alias("license_serial"),
                                        "softwarelicensetypes_id")
    lt = _lookup(src["softwarelicensetypes"], "_ltid", "license_type")
    j = (sw.join(m, T("manufacturers_id") == T("_mid"), "left").join(sv, T("id") == T("_sv_sw"), "left")
           .join(sl, T("id") == T("_sl_sw"), "left").join(lt, T("softwarelicensetypes_id") == T("_ltid"), "left"))
    return j.select(T("id").alias("software_id"), T("name").alias("software_name"), "manufacturer", "version_id",
                    "version_name", "license_type", "licenses_qty", "license_expiry", "license_serial",
                    T("is_helpdesk_visible").alias("helpdesk_visible"))


# -------------------------------------------------------------------- V21
def build_vw_fact_software_licenses(src, as_of: datetime) -> DataFrame:
    """Licence compliance.  The published view joins licences and installs
    before grouping, so a software with k identical licence rows counts its
    installs k times (kept as ``installations_count``);
    ``installations_distinct`` is the true number.  Computed as
    (licence rows in group) x (installs of the software): no cross product."""
    today = date_lit(as_of)
    sw = src["softwares"].where(T("is_deleted") == 0)
    m = _lookup(src["manufacturers"], "_mid", "manufacturer")
    lic = src["softwarelicenses"].groupBy(T("softwares_id").alias("_lsw"), "number", "allow_overquota", "expire").agg(
        F.count(F.lit(1)).alias("_lic_rows"))
    inst = (src["items_softwareversions"].where(T("is_deleted") == 0)
            .join(src["softwareversions"].select(T("id").alias("_vid"), T("softwares_id").alias("_isw")),
                  T("softwareversions_id") == T("_vid"))
            .groupBy("_isw").agg(F.count(F.lit(1)).alias("_inst")))
    j = (sw.join(m, T("manufacturers_id") == T("_mid"), "left").join(lic, T("id") == T("_lsw"), "left")
           .join(inst, T("id") == T("_isw"), "left"))
    n_inst = F.coalesce("_inst", F.lit(0))
    count = (F.coalesce("_lic_rows", F.lit(1)) * n_inst).cast("bigint")
    j = j.withColumn("installations_count", count).withColumn("installations_distinct", n_inst.cast("bigint"))
    c, n = T("installations_count"), T("number")
    compliance = (F.when(n == 0, F.lit(D.COMPLIANCE_OPEN)).when(c > n, F.lit(D.COMPLIANCE_OVER))
                  .when(c == n, F.lit(D.COMPLIANCE_FULL)).when(c * 10 >= n * 9, F.lit(D.COMPLIANCE_NEAR))
                  .otherwise(F.lit(D.COMPLIANCE_OK)))
    return j.select(
        T("id").alias("software_id"), T("name").alias("software_name"), "manufacturer", T("number").alias("licenses_qty"),
        "allow_overquota", T("expire").alias("license_expiry"),
        F.when(T("expire").isNull() | (T("expire") >= today), F.lit(D.LICENSE_VALID))
         .otherwise(F.lit(D.LICENSE_EXPIRED)).alias("license_status"),
        "installations_count", (n - c).alias("available_qty"), compliance.alias("compliance_status"),
        "installations_distinct")


# -------------------------------------------------------------------- V22
def _asset_names(src) -> DataFrame:
    """Polymorphic target of (itemtype, items_id): one union, one join."""
    parts = []
    for itemtype, table in (("Computer", "computers"), ("NetworkEquipment", "networkequipments"),
                            ("Printer", "printers")):
        parts.append(src[table].select(F.lit(itemtype).alias("_it"), T("id").alias("_aid"),
                                       T("name").alias("_aname"), T("locations_id").alias("_aloc")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_vw_fact_asset_financials(src, as_of: datetime) -> DataFrame:
    today = date_lit(as_of)
    ic = src["infocoms"]
    s = _lookup(src["suppliers"], "_sid", "supplier")
    a = _asset_names(src)
    loc = _lookup(src["locations"], "_lid", "location")
    j = (ic.join(s, T("suppliers_id") == T("_sid"), "left")
           .join(a, (T("itemtype") == T("_it")) & (T("items_id") == T("_aid")), "left")
           .join(loc, T("_aloc") == T("_lid"), "left"))
    end = add_months_ts(T("buy_date"), T("warranty_duration"))
    name = (F.when(T("itemtype").isin("Computer", "NetworkEquipment", "Printer"), T("_aname"))
            .otherwise(F.concat(T("itemtype"), F.lit("#"), T("items_id"))))
    status = (F.when(T("warranty_duration") == 0, F.lit(D.WARRANTY_NONE))
              .when(end < today, F.lit(D.WARRANTY_EXPIRED))
              .when(end < F.add_months(today, 3), F.lit(D.WARRANTY_SOON)).otherwise(F.lit(D.WARRANTY_OK)))
    return j.select("itemtype", "items_id", name.alias("asset_name"), "location", "supplier", "buy_date", "use_date",
                    T("value").alias("purchase_value"), T("warranty_duration").alias("warranty_months"),
                    "warranty_info", end.alias("warranty_end_date"), status.alias("warranty_status"),
                    diff_units("MONTH", T("buy_date"), today).alias("age_months"))


# -------------------------------------------------------------------- V23
def build_vw_fact_supplier_contracts(src, as_of: datetime) -> DataFrame:
    """One row per contract x supplier name; ``assets_covered`` keeps the
    view's count over the (supplier link x item) rows."""
    today = date_lit(as_of)
    ct = src["contracts"].where(T("is_deleted") == 0)
    ctt = _lookup(src["contracttypes"], "_tid", "contract_type")
    cs = (src["contracts_suppliers"].join(_lookup(src["suppliers"], "_sid", "supplier"), T("suppliers_id") == T("_sid"), "left")
          .groupBy(T("contracts_id").alias("_cs"), "supplier").agg(F.count(F.lit(1)).alias("_links")))
    items = src["contracts_items"].groupBy(T("contracts_id").alias("_ci")).agg(F.count("id").alias("_items"))
    j = (ct.join(ctt, T("contracttypes_id") == T("_tid"), "left").join(cs, T("id") == T("_cs"), "left")
           .join(items, T("id") == T("_ci"), "left"))
    end = add_months_ts(T("begin_date"), T("duration"))
    status = (F.when(end < today, F.lit(D.CONTRACT_EXPIRED)).when(end < F.add_months(today, 3), F.lit(D.CONTRACT_SOON))
              .otherwise(F.lit(D.CONTRACT_OK)))
    return j.select(T("name").alias("contract_name"), T("num").alias("contract_num"), "contract_type", "supplier",
                    "begin_date", end.alias("end_date"), T("duration").alias("duration_months"),
                    status.alias("contract_status"),
                    (F.coalesce("_links", F.lit(1)) * F.coalesce("_items", F.lit(0))).cast("bigint").alias("assets_covered"),
                    "comment")


# -------------------------------------------------------------------- V24
def build_vw_fact_kb_usage(src, as_of: datetime | None = None) -> DataFrame:
    kb = src["knowbaseitems"]
    cat = _lookup(src["knowbaseitemcategories"], "_cid", "kb_category")
    links = src["knowbaseitems_items"].groupBy(T("knowbaseitems_id").alias("_kid")).agg(
        F.count("id").alias("linked_items_count"),
        F.sum(F.when(T("itemtype") == "Ticket", 1).otherwise(0)).cast("bigint").alias("linked_tickets"),
        F.sum(F.when(T("itemtype") == "Computer", 1).otherwise(0)).cast("bigint").alias("linked_assets"))
    u = src["users"].select(T("id").alias("_uid"), T("name").alias("author_login"), "firstname", "realname")
    j = (kb.join(cat, T("forms_categories_id") == T("_cid"), "left").join(links, T("id") == T("_kid"), "left")
           .join(u, T("users_id") == T("_uid"), "left"))
    return j.select(T("id").alias("kb_id"), T("name").alias("kb_title"), "kb_category", "is_faq",
                    T("view").alias("view_count"), "date_creation", T("date_mod").alias("last_modified"),
                    F.coalesce("linked_items_count", F.lit(0)).alias("linked_items_count"),
                    F.coalesce("linked_tickets", F.lit(0)).alias("linked_tickets"),
                    F.coalesce("linked_assets", F.lit(0)).alias("linked_assets"), "author_login",
                    full_name(T("firstname"), T("realname")).alias("author_name"))


# -------------------------------------------------------------------- V25
def build_vw_fact_ticket_enrichment(src, as_of: datetime) -> DataFrame:
    """All tickets, deleted ones included (as published)."""
    now = ntz(as_of)
    t = src["tickets"]
    fu = (src["itilfollowups"].where(T("itemtype") == "Ticket").groupBy(T("items_id").alias("_f"))
          .agg(F.count(F.lit(1)).alias("followup_count")))
    tasks = src["tickettasks"].groupBy(T("tickets_id").alias("_k")).agg(F.count(F.lit(1)).alias("task_count"))
    sat = src["ticketsatisfactions"].select(T("tickets_id").alias("_s"), "satisfaction", "satisfaction_scaled_to_5",
                                            T("comment").alias("satisfaction_comment"),
                                            T("date_answered").alias("satisfaction_date"))
    j = (t.join(sat, T("id") == T("_s"), "left").join(fu, T("id") == T("_f"), "left")
          .join(tasks, T("id") == T("_k"), "left"))
    return j.select(T("id").alias("ticket_id"), T("name").alias("ticket_title"), "status",
                    code_label(T("status"), D.STATUS_LABELS_PLAIN, D.STATUS_UNKNOWN).alias("status_label"),
                    T("date").alias("open_date"), "solvedate", "closedate",
                    diff_units("HOUR", T("date"), F.coalesce(T("solvedate"), now)).alias("resolution_hours"),
                    F.coalesce("followup_count", F.lit(0)).alias("followup_count"),
                    F.coalesce("task_count", F.lit(0)).alias("task_count"),
                    "satisfaction", "satisfaction_scaled_to_5", "satisfaction_comment", "satisfaction_date")


# -------------------------------------------------------------------- V26
def build_vw_dim_os_inventory(src, as_of: datetime | None = None) -> DataFrame:
    ios = src["items_operatingsystems"].where(T("itemtype") == "Computer")
    c = src["computers"].where(T("is_deleted") == 0).select(T("id").alias("_cid"), T("name").alias("computer_name"),
                                                            T("locations_id").alias("_loc"))
    j = (ios.join(c, T("items_id") == T("_cid"))
            .join(_lookup(src["operatingsystems"], "_os", "os_name"), T("operatingsystems_id") == T("_os"), "left")
            .join(_lookup(src["operatingsystemversions"], "_osv", "os_version"),
                  T("operatingsystemversions_id") == T("_osv"), "left")
            .join(_lookup(src["locations"], "_lid", "location"), T("_loc") == T("_lid"), "left"))
    return j.select(T("_cid").alias("computer_id"), "computer_name",
                    F.when(T("computer_name").like("SRV-%"), F.lit(D.OS_SERVER)).otherwise(F.lit(D.OS_WORKSTATION))
                     .alias("asset_type"), "location", "os_name", "os_version", "is_dynamic",
                    T("date_creation").alias("inventory_date"))


# -------------------------------------------------------------------- V27
def build_vw_fact_satisfaction_summary(src, as_of: datetime | None = None) -> DataFrame:
    """Answer month x group name.  The raw group link is used, so a ticket
    in two groups counts in both (unlike V7); deleted tickets are kept."""
    sat = src["ticketsatisfactions"].where(T("date_answered").isNotNull())
    t = src["tickets"].select(T("id").alias("_tid"))
    gt = src["groups_tickets"].where(T("type") == 2).select(T("tickets_id").alias("_gt"), "groups_id")
    g = _lookup(src["groups"], "_gid", "tech_group")
    j = (sat.join(t, T("tickets_id") == T("_tid")).join(gt, T("_tid") == T("_gt"), "left")
            .join(g, T("groups_id") == T("_gid"), "left"))
    s5 = T("satisfaction_scaled_to_5")
    return j.groupBy(year_month(T("date_answered")).alias("year_month"), F.year("date_answered").alias("year"),
                     F.month("date_answered").alias("month"), "tech_group").agg(
        F.count("id").alias("responses"), F.round(F.avg(s5), 2).alias("avg_satisfaction"),
        F.sum(F.when(s5 >= 4, 1).otherwise(0)).cast("bigint").alias("promoters"),
        F.sum(F.when(s5 == 3, 1).otherwise(0)).cast("bigint").alias("neutrals"),
        F.sum(F.when(s5 <= 2, 1).otherwise(0)).cast("bigint").alias("detractors"))

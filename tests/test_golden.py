"""Golden tests on hand-made contracts (edge cases of FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from tessera.plans import marts_cmdb as MC
from tessera.plans import marts_entity as ME
from tessera.plans import marts_finance as MF
from tessera.plans import marts_tickets as MT
from tessera.plans.measures import arg_max, evaluate
from tessera.plans.model import Model
from tessera.operators.ranking import rank_desc
from tests.fixtures import AS_OF, golden_sources


@pytest.fixture(scope="module")
def src(spark):
    return golden_sources(spark)


def by_id(df, key):
    return {r[key]: r for r in df.collect()}


def test_v1_dedupe_labels_and_sla(src):
    v1 = by_id(MT.build_vw_glpi_tickets(src, AS_OF), "ticket_id")
    assert set(v1) == {1, 2, 3, 4, 5, 6, 7, 9}                  # deleted ticket 8 dropped
    t1 = v1[1]
    assert (t1.technician_id, t1.technician_name, t1.technician_group) == (201, "Tec Um", "Redes")
    assert (t1.assigned_group_id, t1.assigned_group_name) == (1, "Suporte")
    assert (t1.requester_name, t1.requester_email) == ("Ana Souza", "a@x")
    assert (t1.category_name, t1.category_parent, t1.sla_name) == ("Email", "TI", "SLA 24h")
    assert (t1.sla_status, t1.sla_compliant, t1.resolution_time_min) == ("Dentro do SLA", 1, 1440)
    assert (v1[2].sla_status, v1[2].sla_compliant, v1[2].requester_name, v1[2].requester_email) == \
        ("Violado", 0, " Lima", "")
    assert v1[2].closure_time_min == 2880
    assert (v1[3].sla_status, v1[3].age_open_min) == ("Violado (aberto)", 20400)
    assert (v1[4].sla_status, v1[4].age_open_min) == ("Em risco", 1439)       # 1439.5 min truncated
    assert (v1[4].technician_name, v1[4].technician_group) == (" ", "(sem grupo)")
    assert (v1[6].sla_status, v1[6].sla_compliant) == ("Sem SLA", None)       # status 5 without solve date
    assert v1[7].sla_status == "Sem SLA"
    t9 = v1[9]
    assert (t9.status_label, t9.priority_label, t9.ticket_type_label, t9.category_name, t9.is_open) == \
        ("Desconhecido", "Não definida", "Desconhecido", "(sem categoria)", 0)


def test_v2_fallback_differs_from_v1(src):
    v2 = by_id(MT.build_vw_fact_tickets(src, AS_OF), "ticket_id")
    assert v2[6].sla_status == "Em risco"
    assert (v2[4].technician_id, v2[4].group_id, v2[9].category_id) == (0, 0, 999)


def test_v9_urgency_and_negative_remaining(src):
    v9 = by_id(MT.build_vw_backlog_open(src, AS_OF), "ticket_id")
    assert set(v9) == {3, 4, 5, 7, 9}
    assert (v9[4].sla_urgency, v9[4].sla_remaining_min) == ("SLA Crítico (< 4h)", 239)
    assert (v9[5].sla_urgency, v9[5].sla_remaining_min) == ("Dentro do Prazo", 240)
    assert (v9[3].sla_urgency, v9[3].sla_remaining_min) == ("SLA Violado", -7920)
    assert (v9[7].sla_urgency, v9[9].status_label, v9[9].priority_label) == ("Sem SLA", None, None)


def test_v7_group_name_merge_and_counts(src):
    rows = {(r.year_month, r.group_name, r.priority_label): r for r in MT.build_vw_sla_monthly(src, AS_OF).collect()}
    s = rows[("2025-06", "Suporte", "3-Média")]                 # groups 1 and 3 share the name
    assert (s.total_tickets, s.within_sla, s.breached_sla, s.sla_compliance_pct, s.avg_resolution_min) == \
        (2, 1, 1, 50.0, 1440.0)
    assert rows[("2025-06", "(sem grupo)", "3-Média")].total_tickets == 2
    may = rows[("2025-05", "(sem grupo)", "3-Média")]
    assert (may.tickets_with_sla_resolved, may.sla_compliance_pct) == (1, 0.0)
    assert ("2025-04", "(sem grupo)", "N/D") in rows
    assert sum(r.total_tickets for r in rows.values()) == 8         # each live ticket once


def test_v15_fanout_tasks_done(src):
    r = MC.build_vw_fact_changes(src, AS_OF).collect()
    assert len(r) == 1
    c = r[0]
    assert (c.total_tasks, c.tasks_done, c.tasks_done_distinct, c.linked_tickets, c.linked_assets) == (3, 8, 2, 2, 2)


def test_v21_licence_compliance(src):
    v = {r.software_id: r for r in MF.build_vw_fact_software_licenses(src, AS_OF).collect()}
    assert (v[1].compliance_status, v[1].installations_count) == ("OK", 0)
    assert v[2].compliance_status == "Open/Free"
    assert (v[3].installations_count, v[3].installations_distinct, v[3].compliance_status, v[3].license_status,
            v[3].available_qty) == (6, 3, "Over-licensed", "Vigente", -2)
    assert (v[4].installations_count, v[4].compliance_status, v[4].license_status) == \
        (9, "Near Limit (>=90%)", "Expirada")


def test_v27_raw_group_link_and_deleted_kept(src):
    rows = {r.tech_group: r for r in MF.build_vw_fact_satisfaction_summary(src, AS_OF).collect()}
    assert (rows["Redes"].responses, rows["Redes"].avg_satisfaction) == (1, 5.0)
    assert (rows["Suporte"].responses, rows["Suporte"].avg_satisfaction, rows["Suporte"].detractors) == (2, 3.5, 1)


def test_v30_predominant_type_tie(src):
    rows = {r.year_month: r for r in ME.build_vw_entity_sla_monthly(src, AS_OF).collect()}
    assert rows["2025-05"].predominant_type == 1                    # 1 vs 1 -> lowest type


def test_measures_blank_distinct_and_ratio(src):
    r = evaluate(Model(src, AS_OF), ["active_technicians", "total_tickets", "sla_compliance_rate"]).collect()[0]
    assert r.active_technicians == 2                                # technician 201 + BLANK
    assert r.total_tickets == 8
    assert r.sla_compliance_rate == pytest.approx(1 / 3)            # met 1 / (1 + breached 1 + open-late 1)


def test_arg_max_ties_take_largest_name(spark):
    df = spark.createDataFrame([("a", 5), ("c", 5), ("b", 3)], "n string, v int")
    assert arg_max(df, [], F.col("n"), F.col("v"), "top").collect()[0].top == "c"
    assert arg_max(df, [], F.col("n"), F.col("v"), "low", descending=False).collect()[0].low == "b"


def test_rank_desc_sql_rank(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 3), (4, 1)], "id int, v int")
    ranks = {r.id: r["rank"] for r in rank_desc(df, "v").collect()}
    assert ranks == {1: 1, 2: 1, 3: 3, 4: 4}


def test_month_spine_keeps_null_slice(spark):
    from tessera.operators import timeintel as TI
    df = spark.createDataFrame([(None, "2001-01", 3), (None, "2001-03", 5), ("a", "2001-02", 7)],
                               "g string, year_month string, n bigint")
    rows = {(r.g, r.year_month): r.n for r in TI.on_spine(df, ["n"], by=["g"], fill={"n": 0}).collect()}
    assert rows == {(None, "2001-01"): 3, (None, "2001-02"): 0, (None, "2001-03"): 5,
                    ("a", "2001-01"): 0, ("a", "2001-02"): 7, ("a", "2001-03"): 0}

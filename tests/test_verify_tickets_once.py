"""deploy_verify makes the tickets once, and the first technician of a ticket needs no distinct of its links."""

import datetime as dt
import re

import pytest

from tessera.operators.links import first_link, links_of_role
from tessera.plans.catalog import MARTS
from tessera.plans.jobs import verify
from tessera.sources.adapter import AS_OF, TECH_OFFSET, DriverSources
from tessera.sources.driver import DriverTables

DAY = dt.datetime(1997, 5, 1)

TABLES = {
    "region": ("r_regionkey int, r_name string", [(0, "AFRICA")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "ALGERIA", 0), (1, "KENYA", 0)]),
    "customer": ("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                 [(1, "c1", 0, 1.0, "BUILDING"), (2, "c2", 1, 1.0, None), (2, "c2", 1, 1.0, None), (None, "c", 0, 1.0, "x")]),
    "supplier": ("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
                 [(1, "s1", 0, 1.0), (2, "s2", 1, 1.0), (2, "s2", 1, 1.0), (3, "s3", None, 1.0)]),
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
             [(0, "p0", "Brand#11", "T", 5, 1.0), (1, "p1", "Brand#12", "T", 45, 2.0), (1, "p1", "Brand#12", "T", 45, 2.0)]),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
               "o_orderpriority string",
               [(1, 1, "F", 10.0, DAY, "1-URGENT"), (1, 1, "F", 10.0, DAY, "1-URGENT"), (2, 2, "P", 20.0, DAY, "2-HIGH"),
                (3, None, "O", 30.0, DAY, "3-MEDIUM"), (None, 1, "F", 40.0, DAY, "5-LOW"), (4, 2, "F", 50.0, None, "5-LOW"),
                (50, 1, "F", 60.0, DAY, "4-NOT SPECIFIED")]),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                 "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                 "l_shipdate timestamp_ntz",
                 [(k, p, s, n, 3.0, 1.0, 0.0, 0.0, "N", "O", DAY + dt.timedelta(d)) for k, p, s, n, d in
                  [(1, 1, 2, 1, -3), (1, 0, 2, 2, 4), (1, 1, 1, 3, 9), (2, 1, 3, 1, 2), (2, 1, 3, 1, 2), (3, 9, 2, 1, 5),
                   (4, 0, 1, 1, 1), (50, 0, 1, 1, 1), (None, 0, 1, 1, 1)]]),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
               [(1, DAY, 1, "error", 250.0, "{}"), (2, DAY, 2, "signup", 10.0, "{}")]),
    "documents": ("doc_id bigint, text string, lang string, source string, n_chars bigint", [(1, "a", "en", "web", 1)]),
    "labels": ("doc_id bigint, quality int, toxic int", [(1, 1, 0)]),
    "conversations": ("conv_id bigint, turn bigint, role string, text string", [(1, 1, "assistant", "a"), (1, 2, "user", "b")]),
}


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("tables")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{at}/{name}.parquet")
    return DriverSources(DriverTables(spark, str(at)))


def test_counts_are_those_of_the_marts(src):
    found = {r["mart"]: r["rows"] for r in verify(src, AS_OF).collect()}
    assert list(found) == [name for name, _, _ in MARTS]
    # orders 1 (twice), 3 and the one without a key once each, 2 and 4 twice by the repeated customer; 50 is deleted
    assert found["vw_fact_tickets"] == 8
    of_tickets = ("vw_glpi_tickets", "vw_fact_tickets", "vw_sla_monthly", "vw_tech_productivity", "vw_backlog_open", "vw_volume_trend",
                  "vw_fact_asset_tickets", "vw_fact_project_tasks", "vw_fact_ticket_enrichment", "vw_fact_satisfaction_summary")
    assert {n: found[n] for n in of_tickets} == {n: build(src, AS_OF).count() for n, build, _ in MARTS if n in of_tickets}


def test_orders_meet_lineitem_once(src):
    # only making a ticket compares ship and order dates: that is done before the counts start
    meets = lambda df: re.findall(r"l_shipdate#\d+ >= o_orderdate", df._jdf.queryExecution().optimizedPlan().toString())
    assert meets(src["tickets"]) and not meets(verify(src, AS_OF))


def test_first_technician_needs_no_distinct(src):
    first = first_link(links_of_role(src, "tickets_users", 2), "tickets_id", "users_id")
    assert first._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    assert {r["tickets_id"]: r["users_id"] - TECH_OFFSET for r in first.collect()} == {1: 1, 2: 3, 3: 2, 4: 1, 50: 1, None: 1}
    same = first_link(src["tickets_users"], "tickets_id", "users_id", 2)
    assert sorted(map(repr, same.collect())) == sorted(map(repr, first.collect()))
    # a source that holds no roles apart is filtered
    plain = links_of_role({"tickets_users": src["tickets_users"]}, "tickets_users", 1)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, links_of_role(src, "tickets_users", 1).collect()))

"""Deterministic adapter: driver tables -> service-desk source contracts.

The driver ships TPC-H-like tables, not a service-desk database.  Each
contract table below is *derived* from them with fixed rules, so every mart
grows with the input and the DuckDB oracle (``oracle/adapter_sql.py``) can
rebuild the same rows with plain SQL.

Scale notes
-----------
* Everything is lazy; a mart only pulls the contracts it reads, and the
  parquet scans only read the referenced columns.
* The order-level summary of ``lineitem`` (first ship date, lowest part,
  quantity of line 1) is one join on the order key followed by one
  aggregate on the same key, so the aggregate reuses the join's hash
  partitioning (no second exchange).  Most marts then join on ticket id =
  order key and stay co-partitioned.
* Only tables with a proven bound (nation: 25 rows, region: 5 rows) are
  broadcast explicitly; everything else is left to the planner/AQE, which
  broadcasts only when the measured size is under the threshold.
"""

from __future__ import annotations

from datetime import datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.time import add_days, add_minutes, date_lit, diff_units, ntz
from tessera.session import written
from tessera.sources.driver import DriverTables

# FIXED VALUES: adapter parameters (shared with the SQL oracle)
AS_OF = datetime(2001, 8, 1, 0, 0, 0)          # reference time for driver data
TECH_OFFSET = 1_000_000_000_000                 # supplier -> technician user id offset
NATION_ENTITY_OFFSET = 100                      # nation entity id = 100 + n_nationkey
ROOT_ENTITY_NAME = "Sede"
SLA_DAYS = {1: 1200, 2: 900, 3: 600, 4: 450, 5: 300, 6: 180}   # target by priority
HIGH_VALUE_ORDER = 450000.0                     # o_totalprice above -> priority 6
PROFILE_NAMES = {1: "Self-Service", 3: "Supervisor", 4: "Technician"}
STATE_NAMES = {1: "Em uso", 2: "Em estoque", 3: "Em manutenção"}
OS_NAMES = {1: "Windows", 2: "Linux", 3: "macOS"}
LICENSE_TYPE_NAMES = {1: "Perpétua", 2: "Assinatura", 3: "OEM"}
SUPPLIER_TYPE_NAMES = {1: "Distribuidor", 2: "Fabricante", 3: "Serviços"}
CONTRACT_TYPE_NAMES = {1: "Suporte", 2: "Manutenção", 3: "Locação"}
PROJECT_STATE_NAMES = {1: "Novo", 2: "Em andamento", 3: "Encerrado"}
KB_CATEGORY_NAMES = {1: "de", 2: "en", 3: "es", 4: "fr"}


def _case(code: Column, names: dict) -> Column:
    expr = None
    for k, v in names.items():
        expr = F.when(code == k, F.lit(v)) if expr is None else expr.when(code == k, F.lit(v))
    return expr


def _itemtype(key: Column) -> Column:
    """Part kind by key modulo 4 -> CMDB item type."""
    m = key % 4
    return (F.when(m == 0, "Computer").when(m == 1, "NetworkEquipment")
            .when(m == 2, "Monitor").otherwise("Printer"))


class DriverSources:
    """Source contracts (``glpi_*`` tables without prefix) over driver data."""

    def __init__(self, tables: DriverTables, as_of: datetime = AS_OF):
        self.t = tables
        self.as_of = as_of

    # dict-style access used by the mart builders
    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)

    def __contains__(self, name: str) -> bool:
        return hasattr(type(self), name)

    def tickets_once(self) -> "DriverSources":
        """The same contracts with the tickets written once and read back by every contract made from them, for jobs
        that build several ticket marts: else each mart joins orders and lineitem again."""
        once = DriverSources(self.t, self.as_of)
        once.tickets = written(self.tickets, "tickets")
        return once

    # ------------------------------------------------------------------ orgs
    @cached_property
    def entities(self) -> DataFrame:
        region = F.broadcast(self.t.region)
        nation = F.broadcast(self.t.nation)
        spark = self.t.spark
        root = spark.createDataFrame(
            [(0, ROOT_ENTITY_NAME, ROOT_ENTITY_NAME, 0, None)],
            "id bigint, name string, completename string, level int, entities_id bigint")
        regions = region.select(
            (F.col("r_regionkey") + 1).cast("bigint").alias("id"),
            F.col("r_name").alias("name"),
            F.concat(F.lit(ROOT_ENTITY_NAME + " > "), "r_name").alias("completename"),
            F.lit(1).alias("level"), F.lit(0).cast("bigint").alias("entities_id"))
        nations = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            (F.col("n_nationkey") + NATION_ENTITY_OFFSET).cast("bigint").alias("id"),
            F.col("n_name").alias("name"),
            F.concat(F.lit(ROOT_ENTITY_NAME + " > "), "r_name", F.lit(" > "), "n_name").alias("completename"),
            F.lit(2).alias("level"), (F.col("n_regionkey") + 1).cast("bigint").alias("entities_id"))
        return root.unionByName(regions).unionByName(nations)

    @cached_property
    def locations(self) -> DataFrame:
        return F.broadcast(self.t.nation).select(
            (F.col("n_nationkey") + 1).cast("bigint").alias("id"),
            F.concat(F.lit("Local "), "n_name").alias("name"))

    @cached_property
    def groups(self) -> DataFrame:
        return F.broadcast(self.t.nation).select(
            (F.col("n_nationkey") + 1).cast("bigint").alias("id"),
            F.col("n_name").alias("name"),
            F.concat(F.lit("GRP-"), "n_nationkey").alias("code"),
            F.concat(F.lit("Grupo "), "n_name").alias("comment"),
            F.when(F.col("n_nationkey") % 6 == 5, 0).otherwise(1).alias("is_assign"))

    @cached_property
    def users(self) -> DataFrame:
        c = self.t.customer.select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
            F.when(F.col("c_custkey") % 11 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.upper(F.substring("c_mktsegment", 1, 1)),
                                        F.lower(F.substring("c_mktsegment", 2, 1000)))).alias("firstname"),
            F.col("c_name").alias("realname"),
            (F.col("c_nationkey") + NATION_ENTITY_OFFSET).cast("bigint").alias("entities_id"),
            F.lit(1).alias("is_active"), F.lit(0).alias("is_deleted"))
        s = self.t.supplier.select(
            (F.col("s_suppkey") + TECH_OFFSET).alias("id"), F.col("s_name").alias("name"),
            F.when(F.col("s_suppkey") % 10 == 0, F.lit(None).cast("string"))
             .otherwise(F.lit("Tecnico")).alias("firstname"),
            F.col("s_name").alias("realname"),
            (F.col("s_nationkey") + NATION_ENTITY_OFFSET).cast("bigint").alias("entities_id"),
            F.when(F.col("s_suppkey") % 17 == 16, 0).otherwise(1).alias("is_active"),
            F.lit(0).alias("is_deleted"))
        return c.unionByName(s)

    @cached_property
    def useremails(self) -> DataFrame:
        c = self.t.customer.select(
            F.col("c_custkey").alias("users_id"),
            F.concat(F.lit("cliente"), "c_custkey", F.lit("@example.com")).alias("email"),
            F.lit(1).alias("is_default"))
        s = self.t.supplier
        uid = (F.col("s_suppkey") + TECH_OFFSET).alias("users_id")
        main = s.select(uid, F.concat(F.lit("tec"), "s_suppkey", F.lit("@example.com")).alias("email"),
                        F.lit(1).alias("is_default"))
        alt = s.where(F.col("s_suppkey") % 2 == 0).select(
            uid, F.concat(F.lit("a.tec"), "s_suppkey", F.lit("@example.com")).alias("email"),
            F.lit(1).alias("is_default"))
        old = s.select(uid, F.concat(F.lit("0ld"), "s_suppkey", F.lit("@example.com")).alias("email"),
                       F.lit(0).alias("is_default"))
        return c.unionByName(main).unionByName(alt).unionByName(old)

    @cached_property
    def profiles(self) -> DataFrame:
        return self.t.spark.createDataFrame(
            [(k, v) for k, v in PROFILE_NAMES.items()], "id bigint, name string")

    @cached_property
    def profiles_users(self) -> DataFrame:
        c = self.t.customer.select(F.col("c_custkey").alias("users_id"), F.lit(1).cast("bigint").alias("profiles_id"))
        s = self.t.supplier
        tech = s.select((F.col("s_suppkey") + TECH_OFFSET).alias("users_id"), F.lit(4).cast("bigint").alias("profiles_id"))
        twice = s.where(F.col("s_suppkey") % 5 == 0).select(
            (F.col("s_suppkey") + TECH_OFFSET).alias("users_id"), F.lit(4).cast("bigint").alias("profiles_id"))
        return c.unionByName(tech).unionByName(twice)

    @cached_property
    def groups_users(self) -> DataFrame:
        s = self.t.supplier
        uid = (F.col("s_suppkey") + TECH_OFFSET).alias("users_id")
        first = s.select(uid, (F.col("s_nationkey") + 1).cast("bigint").alias("groups_id"))
        second = s.where(F.col("s_suppkey") % 3 == 0).select(
            uid, ((F.col("s_nationkey") + 7) % 25 + 1).cast("bigint").alias("groups_id"))
        return first.unionByName(second)

    # --------------------------------------------------------------- tickets
    @cached_property
    def order_lines(self) -> DataFrame:
        """Per order: first ship date on/after the order date, lowest part,
        quantity of line 1.  The (key, date) projection of orders is the
        build side of the join (broadcast while small, else both sides are
        hash-partitioned on the order key); the aggregate on the same key
        then needs no further exchange and runs partially map-side."""
        o = self.t.orders.select("o_orderkey", "o_orderdate")
        li = self.t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_shipdate")
        j = li.join(o, li.l_orderkey == o.o_orderkey)
        return j.groupBy("l_orderkey").agg(
            F.min(F.when(F.col("l_shipdate") >= F.col("o_orderdate"), F.col("l_shipdate"))).alias("first_ship"),
            F.min("l_partkey").alias("min_part"),
            F.min(F.when(F.col("l_linenumber") == 1, F.col("l_quantity"))).alias("q1"))

    @cached_property
    def tickets(self) -> DataFrame:
        o = self.t.orders
        k = F.col("o_orderkey")
        per_order = o.join(self.order_lines, k == F.col("l_orderkey"), "left")
        cust = self.t.customer.select("c_custkey", "c_nationkey")
        status = (F.when(F.col("first_ship").isNull() | (F.col("o_orderstatus") == "O"), (k % 4 + 1))
                  .when(F.col("o_orderstatus") == "P", F.lit(5)).otherwise(F.lit(6))).cast("int")
        priority = (F.when(F.col("o_totalprice") > HIGH_VALUE_ORDER, F.lit(6))
                    .otherwise(6 - F.substring("o_orderpriority", 1, 1).cast("int"))).cast("int")
        days = _case(F.col("priority"), SLA_DAYS)
        base = (per_order.join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
                 .select(k.alias("id"),
                         (F.col("c_nationkey") + NATION_ENTITY_OFFSET).cast("bigint").alias("entities_id"),
                         F.concat(F.lit("Pedido "), k).alias("name"),
                         F.col("o_orderdate").alias("date"),
                         status.alias("status"), priority.alias("priority"),
                         (k % 2 + 1).cast("int").alias("type"),
                         F.coalesce("min_part", F.lit(0)).cast("bigint").alias("itilcategories_id"),
                         "first_ship", "q1",
                         F.when(k % 50 == 0, 1).otherwise(0).alias("is_deleted"),
                         (k % 120).cast("int").alias("_tto"),
                         (k % 5 == 0).alias("_nosla")))
        solve = F.when(F.col("status").isin(5, 6), F.col("first_ship"))
        t = base.withColumn("solvedate", solve)
        t = t.withColumn("closedate", F.when(F.col("status") == 6, add_days(F.col("solvedate"), 2)))
        return t.select(
            "id", "entities_id", "name", "date", "solvedate", "closedate",
            add_minutes(F.col("date"), F.col("_tto")).alias("takeintoaccountdate"),
            F.coalesce("closedate", "solvedate", add_minutes(F.col("date"), F.col("_tto"))).alias("date_mod"),
            "status", "priority", "type", "itilcategories_id",
            F.when(F.col("_nosla"), F.lit(0)).otherwise(F.col("priority")).cast("bigint").alias("slas_id_ttr"),
            F.when(F.col("_nosla"), F.lit(None)).otherwise(add_days(F.col("date"), days)).alias("time_to_resolve"),
            F.coalesce(diff_units("SECOND", F.col("date"), F.col("solvedate")), F.lit(0)).cast("int").alias("solve_delay_stat"),
            F.coalesce(diff_units("SECOND", F.col("date"), F.col("closedate")), F.lit(0)).cast("int").alias("close_delay_stat"),
            "is_deleted", "q1")

    @cached_property
    def order_suppliers(self) -> DataFrame:
        return self.t.lineitem.select("l_orderkey", "l_suppkey").distinct()

    @cached_property
    def _ticket_requesters(self) -> DataFrame:
        return self.t.orders.select(F.col("o_orderkey").alias("tickets_id"),
                                    F.col("o_custkey").alias("users_id"), F.lit(1).alias("type"))

    @cached_property
    def _ticket_technicians(self) -> DataFrame:
        return self.order_suppliers.select(F.col("l_orderkey").alias("tickets_id"),
                                           (F.col("l_suppkey") + TECH_OFFSET).alias("users_id"),
                                           F.lit(2).alias("type"))

    @cached_property
    def tickets_users(self) -> DataFrame:
        return self._ticket_requesters.unionByName(self._ticket_technicians)

    def role_links(self, table: str, role: int) -> DataFrame | None:
        """The rows of a link contract that carry ``role``, made apart (None: they are not)."""
        return {("tickets_users", 1): self._ticket_requesters, ("tickets_users", 2): self._ticket_technicians}.get((table, role))

    @cached_property
    def groups_tickets(self) -> DataFrame:
        """Distinct (order, supplier nation) pairs: one distinct after the
        supplier join (partial distinct runs map-side)."""
        s = self.t.supplier.select("s_suppkey", "s_nationkey")
        li = self.t.lineitem.select("l_orderkey", "l_suppkey")
        return (li.join(s, F.col("l_suppkey") == F.col("s_suppkey"))
                .select(F.col("l_orderkey").alias("tickets_id"),
                        (F.col("s_nationkey") + 1).cast("bigint").alias("groups_id"))
                .distinct().withColumn("type", F.lit(2)))

    @cached_property
    def itilcategories(self) -> DataFrame:
        p = self.t.part
        flat = F.col("p_partkey") % 10 == 0
        return p.select(
            F.col("p_partkey").alias("id"), F.col("p_brand").alias("name"),
            F.when(flat, F.col("p_brand")).otherwise(F.concat("p_type", F.lit(" > "), "p_brand")).alias("completename"),
            F.when(flat, 1).otherwise(2).alias("level"),
            F.lit(0).cast("bigint").alias("itilcategories_id"))

    @cached_property
    def slas(self) -> DataFrame:
        # priorities of orders that carry an SLA, straight from the orders
        # scan (same rule as the ticket contract, without rebuilding it)
        o = self.t.orders.where(F.col("o_orderkey") % 5 != 0)
        pr = o.select((F.when(F.col("o_totalprice") > HIGH_VALUE_ORDER, F.lit(6))
                       .otherwise(6 - F.substring("o_orderpriority", 1, 1).cast("int"))).cast("int")
                      .alias("priority")).distinct()
        days = _case(F.col("priority"), SLA_DAYS)
        hourly = F.col("priority") == 6
        return pr.select(
            F.col("priority").cast("bigint").alias("id"),
            F.concat(F.lit("SLA P"), "priority").alias("name"),
            F.lit(0).alias("type"),
            F.when(hourly, days * 24).otherwise(days).cast("int").alias("number_time"),
            F.when(hourly, F.lit("hour")).otherwise(F.lit("day")).alias("definition_time"))

    @cached_property
    def itilfollowups(self) -> DataFrame:
        c = self.t.conversations
        return c.select(F.lit("Ticket").alias("itemtype"), F.col("conv_id").alias("items_id"),
                        F.col("turn").alias("id"))

    @cached_property
    def tickettasks(self) -> DataFrame:
        c = self.t.conversations
        return c.where(F.col("role") == "assistant").select(F.col("conv_id").alias("tickets_id"),
                                                            F.col("turn").alias("id"))

    @cached_property
    def ticketsatisfactions(self) -> DataFrame:
        t = self.tickets.where(F.col("status").isin(5, 6) & F.col("q1").isNotNull())
        unanswered = F.col("id") % 9 == 0
        score = F.when(unanswered, F.lit(None)).otherwise(F.col("q1").cast("int") % 5 + 1).cast("int")
        return t.select(
            F.col("id").alias("id"), F.col("id").alias("tickets_id"),
            F.when(unanswered, F.lit(None)).otherwise(
                add_days(F.coalesce("closedate", "solvedate"), 1)).alias("date_answered"),
            score.alias("satisfaction"),
            score.cast("double").alias("satisfaction_scaled_to_5"),
            F.when(score <= 2, F.lit("Insatisfeito")).alias("comment"))

    # ------------------------------------------------------------------ CMDB
    def _parts_of_kind(self, kind: int) -> DataFrame:
        return self.t.part.where(F.col("p_partkey") % 4 == kind)

    def _asset(self, kind: int, prefix: Column, with_user: bool) -> DataFrame:
        p = self._parts_of_kind(kind)
        k = F.col("p_partkey")
        created = add_days(ntz("1995-01-01 00:00:00"), (k % 1000).cast("int"))
        cols = [
            k.alias("id"), (k % 25 + NATION_ENTITY_OFFSET).cast("bigint").alias("entities_id"),
            F.concat(prefix, k).alias("name"), F.concat(F.lit("SN"), k).alias("serial"),
            (F.expr("p_partkey div 20") + TECH_OFFSET).alias("users_id_tech"),
            (k % 25 + 1).cast("bigint").alias("locations_id"),
            (F.col("p_size") % 3 + 1).cast("bigint").alias("states_id"),
            F.substring("p_brand", 7, 3).cast("bigint").alias("manufacturers_id"),
            k.alias("models_id"), F.col("p_size").cast("bigint").alias("types_id"),
            F.when(k % 97 == 0, 1).otherwise(0).alias("is_deleted"),
            created.alias("date_creation"),
            add_days(created, F.col("p_size")).alias("date_mod"),
        ]
        if with_user:
            cols.append(k.alias("users_id"))
        return p.select(*cols)

    @cached_property
    def computers(self) -> DataFrame:
        size = F.col("p_size")
        prefix = F.when(size > 40, F.lit("SRV-")).when(size <= 30, F.lit("WS-")).otherwise(F.lit("PC-"))
        return self._asset(0, prefix, True)

    @cached_property
    def networkequipments(self) -> DataFrame:
        return self._asset(1, F.lit("NET-"), False)

    @cached_property
    def monitors(self) -> DataFrame:
        return self._asset(2, F.lit("MON-"), True)

    @cached_property
    def printers(self) -> DataFrame:
        return self._asset(3, F.lit("PRN-"), False)

    @cached_property
    def phones(self) -> DataFrame:
        c = self.t.customer.where(F.col("c_custkey") % 5 == 0)
        return c.select(F.col("c_custkey").alias("id"),
                        (F.col("c_nationkey") + NATION_ENTITY_OFFSET).cast("bigint").alias("entities_id"),
                        F.col("c_custkey").alias("users_id"),
                        F.when(F.col("c_custkey") % 45 == 0, 1).otherwise(0).alias("is_deleted"))

    @cached_property
    def peripherals(self) -> DataFrame:
        c = self.t.customer.where(F.col("c_custkey") % 7 == 0)
        return c.select(F.col("c_custkey").alias("id"),
                        (F.col("c_nationkey") + NATION_ENTITY_OFFSET).cast("bigint").alias("entities_id"),
                        F.col("c_custkey").alias("users_id"), F.lit(0).alias("is_deleted"))

    @cached_property
    def asset_types(self) -> DataFrame:
        """One lookup shared by the four ``<kind>types`` tables."""
        return self.t.part.select(F.col("p_size").cast("bigint").alias("id")).distinct().select(
            "id", F.concat(F.lit("Tipo-"), "id").alias("name"))

    @cached_property
    def asset_models(self) -> DataFrame:
        return self.t.part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))

    @property
    def computertypes(self) -> DataFrame:
        return self.asset_types

    networkequipmenttypes = monitortypes = printertypes = computertypes

    @property
    def computermodels(self) -> DataFrame:
        return self.asset_models

    networkequipmentmodels = monitormodels = printermodels = computermodels

    @cached_property
    def manufacturers(self) -> DataFrame:
        return self.t.part.select(F.substring("p_brand", 7, 3).cast("bigint").alias("id"),
                                  F.col("p_brand").alias("name")).distinct()

    @cached_property
    def states(self) -> DataFrame:
        ids = self.t.part.select((F.col("p_size") % 3 + 1).cast("bigint").alias("id")).distinct()
        return ids.select("id", _case(F.col("id"), STATE_NAMES).alias("name"))

    @cached_property
    def items_tickets(self) -> DataFrame:
        li = self.t.lineitem
        return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                         _itemtype(F.col("l_partkey")).alias("itemtype"),
                         F.col("l_partkey").alias("items_id"), F.col("l_orderkey").alias("tickets_id"))

    @cached_property
    def part_first_ship(self) -> DataFrame:
        return self.t.lineitem.groupBy("l_partkey").agg(F.min("l_shipdate").alias("first_ship"))

    @cached_property
    def infocoms(self) -> DataFrame:
        p = self.t.part.join(self.part_first_ship, F.col("p_partkey") == F.col("l_partkey"), "left")
        k = F.col("p_partkey")
        buy = F.to_date("first_ship")
        one = p.select((k * 2).alias("id"), _itemtype(k).alias("itemtype"), k.alias("items_id"),
                       F.expr("p_partkey div 20").alias("suppliers_id"), buy.alias("buy_date"),
                       F.date_add(buy, 7).alias("use_date"),
                       F.col("p_retailprice").alias("value"),
                       (F.col("p_size") % 37).alias("warranty_duration"),
                       F.concat((F.col("p_size") % 37).cast("string"), F.lit(" meses")).alias("warranty_info"))
        two = p.where(k % 50 == 7).select(
            (k * 2 + 1).alias("id"), _itemtype(k).alias("itemtype"), k.alias("items_id"),
            F.expr("p_partkey div 20 + 1").alias("suppliers_id"), buy.alias("buy_date"),
            F.date_add(buy, 30).alias("use_date"),
            (F.col("p_retailprice") / 2).alias("value"),
            F.lit(12).alias("warranty_duration"), F.lit("extensão").alias("warranty_info"))
        return one.unionByName(two)

    @cached_property
    def items_racks(self) -> DataFrame:
        p = self.t.part.where(F.col("p_partkey") % 8 < 3)
        k = F.col("p_partkey")
        return p.select(F.expr("p_partkey div 50 + 1").alias("racks_id"), _itemtype(k).alias("itemtype"), k.alias("items_id"),
                        F.col("p_size").alias("position"),
                        F.when(F.col("p_size") > 40, F.lit("#ff0000")).otherwise(F.lit("#00aa00")).alias("bgcolor"))

    @cached_property
    def racks(self) -> DataFrame:
        ids = self.t.part.select(F.expr("p_partkey div 50 + 1").alias("id")).distinct()
        return ids.select("id", F.concat(F.lit("RACK-"), F.lpad(F.col("id").cast("string"), 2, "0")).alias("name"),
                          (F.col("id") % 5 + 1).alias("entities_id"), (F.col("id") % 25 + 1).alias("locations_id"),
                          F.lit(42).alias("number_units"), (F.col("id") * 100 + 3000).cast("int").alias("max_power"))

    @cached_property
    def operatingsystems(self) -> DataFrame:
        ids = self._parts_of_kind(0).select((F.col("p_size") % 3 + 1).cast("bigint").alias("id")).distinct()
        return ids.select("id", _case(F.col("id"), OS_NAMES).alias("name"))

    @cached_property
    def operatingsystemversions(self) -> DataFrame:
        ids = self._parts_of_kind(0).select((F.col("p_size") % 5 + 1).cast("bigint").alias("id")).distinct()
        return ids.select("id", F.concat(F.lit("v"), "id").alias("name"))

    @cached_property
    def items_operatingsystems(self) -> DataFrame:
        c = self.computers.join(self._parts_of_kind(0).select("p_partkey", "p_size"),
                                F.col("id") == F.col("p_partkey"))
        return c.select(F.col("id").alias("items_id"), F.lit("Computer").alias("itemtype"),
                        (F.col("p_size") % 3 + 1).cast("bigint").alias("operatingsystems_id"),
                        (F.col("p_size") % 5 + 1).cast("bigint").alias("operatingsystemversions_id"),
                        (F.col("id") % 2).cast("int").alias("is_dynamic"),
                        F.col("date_mod").alias("date_creation"))

    # ---------------------------------------------------- software / finance
    @cached_property
    def softwares(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.t.part.select(k.alias("id"), F.col("p_name").alias("name"),
                                  F.substring("p_brand", 7, 3).cast("bigint").alias("manufacturers_id"),
                                  (k % 2).cast("int").alias("is_helpdesk_visible"),
                                  F.when(k % 89 == 0, 1).otherwise(0).alias("is_deleted"),
                                  (k % 25 + NATION_ENTITY_OFFSET).cast("bigint").alias("entities_id"))

    @cached_property
    def softwareversions(self) -> DataFrame:
        return self.t.part.select(F.col("p_partkey").alias("id"), F.col("p_partkey").alias("softwares_id"),
                                  F.concat(F.lit("v"), "p_size").alias("name"))

    @cached_property
    def softwarelicenses(self) -> DataFrame:
        p = self.t.part.where(F.col("p_partkey") % 7 != 0)
        k = F.col("p_partkey")
        number = F.when(k % 11 == 0, F.lit(0)).when(k % 11 == 1, F.lit(None)).otherwise(F.col("p_size")).cast("int")
        expire = F.when(k % 6 == 0, F.lit(None)).otherwise(
            F.date_add(date_lit(AS_OF), (F.col("p_size") * 7 - 175).cast("int")))
        cols = [k.alias("softwares_id"), number.alias("number"), (k % 2).cast("int").alias("allow_overquota"),
                expire.alias("expire"), F.concat(F.lit("LIC-"), k).alias("serial"),
                (k % 3 + 1).cast("bigint").alias("softwarelicensetypes_id")]
        one = p.select((k * 2).alias("id"), *cols)
        dup = p.where(k % 13 == 0).select((k * 2 + 1).alias("id"), *cols)
        return one.unionByName(dup)

    @cached_property
    def softwarelicensetypes(self) -> DataFrame:
        ids = self.t.part.select((F.col("p_partkey") % 3 + 1).cast("bigint").alias("id")).distinct()
        return ids.select("id", _case(F.col("id"), LICENSE_TYPE_NAMES).alias("name"))

    @cached_property
    def items_softwareversions(self) -> DataFrame:
        li = self.t.lineitem
        return li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"),
                         F.col("l_partkey").alias("softwareversions_id"), F.lit("Computer").alias("itemtype"),
                         F.col("l_suppkey").alias("items_id"),
                         F.when(F.col("l_linenumber") == 7, 1).otherwise(0).alias("is_deleted"))

    @cached_property
    def suppliers(self) -> DataFrame:
        s = self.t.supplier
        k = F.col("s_suppkey")
        return s.select(k.alias("id"), F.col("s_name").alias("name"),
                        (F.col("s_nationkey") % 3 + 1).cast("bigint").alias("suppliertypes_id"),
                        F.concat(F.lit("contato"), k, F.lit("@fornecedor.example")).alias("email"),
                        F.concat(F.lit("+55 11 9"), F.lpad(k.cast("string"), 7, "0")).alias("phonenumber"),
                        F.concat(F.lit("Cidade "), "s_nationkey").alias("town"),
                        F.lit("SP").alias("state"),
                        F.concat(F.lit("https://fornecedor"), k, F.lit(".example")).alias("website"),
                        F.when(k % 9 == 0, 0).otherwise(1).alias("is_active"),
                        F.when(k % 23 == 22, 1).otherwise(0).alias("is_deleted"),
                        (F.col("s_nationkey") + NATION_ENTITY_OFFSET).cast("bigint").alias("entities_id"))

    @cached_property
    def suppliertypes(self) -> DataFrame:
        ids = self.t.supplier.select((F.col("s_nationkey") % 3 + 1).cast("bigint").alias("id")).distinct()
        return ids.select("id", _case(F.col("id"), SUPPLIER_TYPE_NAMES).alias("name"))

    @cached_property
    def supplier_first_ship(self) -> DataFrame:
        return self.t.lineitem.groupBy("l_suppkey").agg(F.min("l_shipdate").alias("first_ship"))

    @cached_property
    def contracts(self) -> DataFrame:
        s = self.t.supplier.join(self.supplier_first_ship, F.col("s_suppkey") == F.col("l_suppkey"), "left")
        k = F.col("s_suppkey")
        return s.select(k.alias("id"), F.concat(F.lit("Contrato "), "s_name").alias("name"),
                        F.concat(F.lit("CT-"), k).alias("num"),
                        (k % 3 + 1).cast("bigint").alias("contracttypes_id"),
                        F.to_date("first_ship").alias("begin_date"),
                        (k % 60 + 1).cast("int").alias("duration"),
                        F.when(k % 4 == 0, F.lit(None)).otherwise(
                            F.concat(F.lit("Cobertura fornecedor "), k)).alias("comment"),
                        F.when(k % 31 == 30, 1).otherwise(0).alias("is_deleted"),
                        F.lit(0).cast("bigint").alias("entities_id"))

    @cached_property
    def contracttypes(self) -> DataFrame:
        ids = self.t.supplier.select((F.col("s_suppkey") % 3 + 1).cast("bigint").alias("id")).distinct()
        return ids.select("id", _case(F.col("id"), CONTRACT_TYPE_NAMES).alias("name"))

    @cached_property
    def contracts_suppliers(self) -> DataFrame:
        s = self.t.supplier
        one = s.select(F.col("s_suppkey").alias("contracts_id"), F.col("s_suppkey").alias("suppliers_id"))
        two = s.where(F.col("s_suppkey") % 5 == 0).select(
            F.col("s_suppkey").alias("contracts_id"), (F.col("s_suppkey") + 1).alias("suppliers_id"))
        return one.unionByName(two)

    @cached_property
    def contracts_items(self) -> DataFrame:
        d = self.t.lineitem.select("l_suppkey", "l_partkey").distinct()
        return d.select(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("contracts_id"),
                        _itemtype(F.col("l_partkey")).alias("itemtype"), F.col("l_partkey").alias("items_id"))

    # ------------------------------------------------------------- knowledge
    @cached_property
    def knowbaseitems(self) -> DataFrame:
        d = self.t.documents
        k = F.col("doc_id")
        created = add_days(ntz("2024-01-01 00:00:00"), (k % 365).cast("int"))
        return d.select(k.alias("id"), F.concat(F.lit("KB-"), k, F.lit(" ("), "lang", F.lit(")")).alias("name"),
                        F.when(k % 5 == 0, 1).otherwise(0).alias("is_faq"), F.col("n_chars").alias("view"),
                        k.alias("users_id"), F.lit(None).cast("bigint").alias("forms_categories_id"),
                        created.alias("date_creation"),
                        add_days(created, (F.col("n_chars") % 30).cast("int")).alias("date_mod"))

    @cached_property
    def knowbaseitemcategories(self) -> DataFrame:
        langs = self.t.documents.select("lang").distinct()
        code = None
        for k, v in KB_CATEGORY_NAMES.items():
            code = F.when(F.col("lang") == v, F.lit(k)) if code is None else code.when(F.col("lang") == v, F.lit(k))
        other = F.conv(F.substring(F.md5("lang"), 1, 12), 16, 10).cast("bigint") + 1000        # any further language
        return langs.where(F.col("lang").isNotNull()).select(
            F.coalesce(code.cast("bigint"), other).alias("id"), F.col("lang").alias("name"))

    @cached_property
    def knowbaseitems_items(self) -> DataFrame:
        lab = self.t.labels
        return lab.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("knowbaseitems_id"),
                          F.when(F.col("quality") == 1, F.lit("Ticket"))
                           .when(F.col("toxic") == 1, F.lit("Computer")).otherwise(F.lit("Software")).alias("itemtype"),
                          F.col("doc_id").alias("items_id"))

    # ------------------------------------------------------ problems/changes
    def _itil(self, event_type: str, prefix: str) -> DataFrame:
        e = self.t.events.where(F.col("event_type") == event_type)
        k = F.col("event_id")
        v = F.col("value")
        status = F.when(v > 200, F.lit(6)).when(v > 100, F.lit(5)).otherwise(k % 4 + 1).cast("int")
        solved = add_minutes(F.col("ts"), (v * 60).cast("int"))
        return e.select(
            k.alias("id"), (F.col("user_id") % 25 + NATION_ENTITY_OFFSET).cast("bigint").alias("entities_id"),
            F.concat(F.lit(prefix), k).alias("name"), F.col("ts").alias("date"),
            F.when(status.isin(5, 6), solved).alias("solvedate"),
            F.when(status == 6, add_days(solved, 1)).alias("closedate"),
            status.alias("status"), (k % 6 + 1).cast("int").alias("priority"),
            (k % 5 + 1).cast("int").alias("urgency"), (F.col("user_id") % 5 + 1).cast("int").alias("impact"),
            F.col("user_id").alias("itilcategories_id"),
            F.when(k % 40 == 0, 1).otherwise(0).alias("is_deleted"), v.alias("_value"))

    @cached_property
    def problems(self) -> DataFrame:
        return self._itil("error", "Problema ").drop("_value")

    @cached_property
    def changes(self) -> DataFrame:
        return self._itil("signup", "Mudança ").drop("_value")

    def _ticket_links(self, event_type: str, key: str) -> DataFrame:
        e = self.t.events.where(F.col("event_type") == event_type).select("event_id")
        # orders are 1.5x events at every scale factor: event_id*3 div 2 (and +1)
        # spreads the links over all tickets, whatever the data size
        a = e.select(F.col("event_id").alias(key), F.expr("(event_id * 3) div 2").alias("tickets_id"))
        b = e.select(F.col("event_id").alias(key), F.expr("(event_id * 3) div 2 + 1").alias("tickets_id"))
        return a.unionByName(b)

    def _tech_links(self, event_type: str, key: str) -> DataFrame:
        e = self.t.events.where(F.col("event_type") == event_type).select("event_id", "user_id")
        a = e.select(F.col("event_id").alias(key), (F.expr("event_id div 100") + TECH_OFFSET).alias("users_id"),
                     F.lit(2).alias("type"))
        b = e.where(F.col("event_id") % 3 == 0).select(
            F.col("event_id").alias(key), (F.expr("event_id div 100 + 1") + TECH_OFFSET).alias("users_id"),
            F.lit(2).alias("type"))
        req = e.select(F.col("event_id").alias(key), F.col("user_id").alias("users_id"), F.lit(1).alias("type"))
        return a.unionByName(b).unionByName(req)

    def _item_links(self, event_type: str, key: str) -> DataFrame:
        e = self.t.events.where(F.col("event_type") == event_type).select("event_id", "user_id", "value")
        a = e.select((F.col("event_id") * 2).alias("id"), F.col("event_id").alias(key),
                     F.lit("Computer").alias("itemtype"), (F.col("user_id") * 4).alias("items_id"))
        b = e.where(F.col("value") > 150).select(
            (F.col("event_id") * 2 + 1).alias("id"), F.col("event_id").alias(key),
            F.lit("NetworkEquipment").alias("itemtype"), (F.col("user_id") * 4 + 1).alias("items_id"))
        return a.unionByName(b)

    @cached_property
    def problems_tickets(self) -> DataFrame:
        return self._ticket_links("error", "problems_id")

    @cached_property
    def problems_users(self) -> DataFrame:
        return self._tech_links("error", "problems_id")

    @cached_property
    def groups_problems(self) -> DataFrame:
        e = self.t.events.where(F.col("event_type") == "error")
        return e.select(F.col("event_id").alias("problems_id"),
                        (F.col("user_id") % 25 + 1).cast("bigint").alias("groups_id"), F.lit(2).alias("type"))

    @cached_property
    def items_problems(self) -> DataFrame:
        return self._item_links("error", "problems_id")

    @cached_property
    def changes_tickets(self) -> DataFrame:
        return self._ticket_links("signup", "changes_id")

    @cached_property
    def changes_users(self) -> DataFrame:
        return self._tech_links("signup", "changes_id")

    @cached_property
    def changes_items(self) -> DataFrame:
        return self._item_links("signup", "changes_id")

    @cached_property
    def changetasks(self) -> DataFrame:
        e = self.t.events.where(F.col("event_type") == "signup").select("event_id")
        n = F.when(F.col("event_id") % 4 == 0, 3).otherwise(1)
        x = e.select("event_id", F.explode(F.sequence(F.lit(0), n - 1)).alias("k"))
        return x.select((F.col("event_id") * 4 + F.col("k")).alias("id"), F.col("event_id").alias("changes_id"),
                        F.when((F.col("event_id") + F.col("k")) % 2 == 0, 2).otherwise(1).alias("state"))

    # -------------------------------------------------------------- projects
    @cached_property
    def projects(self) -> DataFrame:
        c = self.t.customer
        k = F.col("c_custkey")
        start = add_days(ntz("1996-01-01 00:00:00"), (k % 1500).cast("int"))
        end = add_days(start, (k % 200 + 30).cast("int"))
        state = (k % 3 + 1).cast("bigint")
        return c.select(
            k.alias("id"), (F.col("c_nationkey") + NATION_ENTITY_OFFSET).cast("bigint").alias("entities_id"),
            F.concat(F.lit("Projeto "), "c_name").alias("name"), F.concat(F.lit("P"), k).alias("code"),
            (k % 6 + 1).cast("int").alias("priority"), state.alias("projectstates_id"),
            (F.expr("c_custkey div 15") + TECH_OFFSET).alias("users_id"), (F.col("c_nationkey") + 1).cast("bigint").alias("groups_id"),
            start.alias("plan_start_date"), end.alias("plan_end_date"),
            F.when(k % 4 == 0, F.lit(None)).otherwise(add_days(start, (k % 5).cast("int"))).alias("real_start_date"),
            F.when((state == 3) & (k % 4 != 0), add_days(end, (k % 40 - 10).cast("int"))).alias("real_end_date"),
            F.when(state == 3, F.lit(100)).otherwise((k * 7) % 100).cast("int").alias("percent_done"),
            F.when(k % 97 == 0, 1).otherwise(0).alias("is_deleted"))

    @cached_property
    def projectstates(self) -> DataFrame:
        ids = self.t.customer.select((F.col("c_custkey") % 3 + 1).cast("bigint").alias("id")).distinct()
        return ids.select("id", _case(F.col("id"), PROJECT_STATE_NAMES).alias("name"),
                          F.when(F.col("id") == 3, 1).otherwise(0).alias("is_finished"))

    @cached_property
    def projecttasks(self) -> DataFrame:
        t = self.tickets
        k = F.col("id")
        resolved = F.col("status").isin(5, 6)
        return t.select(
            k.alias("id"), F.col("id").alias("_ticket"), k.alias("projects_id_src"),
            F.concat(F.lit("Tarefa "), k).alias("name"),
            F.when(k % 10 == 0, 1).otherwise(0).alias("is_milestone"),
            F.col("date").alias("plan_start_date"),
            add_days(F.col("date"), (k % 30 + 7).cast("int")).alias("plan_end_date"),
            F.col("takeintoaccountdate").alias("real_start_date"),
            F.col("solvedate").alias("real_end_date"),
            F.when(resolved, F.lit(100)).otherwise((k % 10) * 10).cast("int").alias("percent_done"),
            F.when(resolved, F.lit(2)).otherwise(F.lit(1)).cast("bigint").alias("projectstates_id"),
            (F.expr("id div 150") + TECH_OFFSET).alias("users_id"),
            F.col("is_deleted")).join(
                self.t.orders.select("o_orderkey", "o_custkey"), F.col("_ticket") == F.col("o_orderkey")
            ).select("id", F.col("o_custkey").alias("projects_id"), "name", "is_milestone", "plan_start_date",
                     "plan_end_date", "real_start_date", "real_end_date", "percent_done", "projectstates_id",
                     "users_id", "is_deleted")

    @cached_property
    def projecttasks_tickets(self) -> DataFrame:
        o = self.t.orders
        return o.select(F.col("o_orderkey").alias("projecttasks_id"), F.col("o_orderkey").alias("tickets_id"))

    @cached_property
    def projectteams(self) -> DataFrame:
        c = self.t.customer
        x = c.select("c_custkey", F.explode(F.sequence(F.lit(0), (F.col("c_custkey") % 4).cast("int"))).alias("j"))
        return x.select(F.col("c_custkey").alias("projects_id"),
                        (F.expr("c_custkey div 15") + F.col("j") + TECH_OFFSET).alias("items_id"),
                        F.lit("User").alias("itemtype"))

    @cached_property
    def itils_projects(self) -> DataFrame:
        o = self.t.orders
        k = F.col("o_orderkey")
        return o.where((k % 3 == 0) | (k % 7 == 0)).select(
            F.col("o_custkey").alias("projects_id"),
            F.when(k % 3 == 0, F.lit("Ticket")).otherwise(F.lit("Problem")).alias("itemtype"),
            k.alias("items_id"))


_HANDLES: dict[tuple, DriverSources] = {}


def driver_sources(spark, sf_dir: str, as_of: datetime = AS_OF) -> DriverSources:
    """Source contracts over ``sf_dir``.  The object (table handles and
    contract *plans*, no data) is reused per (application, folder, as_of):
    building it re-lists files and re-analyses every plan, which costs
    seconds on the driver; execution still reads the files every time."""
    key = (spark.sparkContext.applicationId, sf_dir, as_of)
    if key not in _HANDLES:
        _HANDLES[key] = DriverSources(DriverTables(spark, sf_dir), as_of)
    return _HANDLES[key]

"""Semantic model: marts + relationships + filter context.

``Model`` builds marts lazily from the source contracts and caches the
DataFrame objects (plans, not data).  Relationships run from a mart with many
rows to one with a row for each key.  A filter walks them from the one side to
the many (left-semi joins, no row is multiplied), and both ways where that is
declared; a dimension's columns reach a mart the other way round, as look-ups.
Between two tables the shortest way counts; of several as short the declared
one, else the way is ambiguous and refused, as is a filter or a column that
reaches the mart on no way.
"""

from __future__ import annotations

import inspect
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.enrich import one_row_per_key
from tessera.plans.catalog import mart_builders
from tessera.sources.scope import ScopedSources


@dataclass(frozen=True)
class Edge:
    """``many.many_col`` refers to ``one.one_col``.  An edge with a ``role`` is inactive until the role is asked for;
    it then takes the place of the active edge between the same two marts."""
    many: str
    many_col: str
    one: str
    one_col: str
    both: bool = False
    role: str | None = None


# FIXED VALUES: the 24 published relationships, in their order
PUBLISHED = [
    Edge("vw_fact_tickets", "created_date", "dim_date", "date"),
    Edge("vw_fact_tickets", "category_id", "vw_dim_category", "id"),
    Edge("vw_fact_tickets", "technician_id", "vw_dim_technician", "id"),
    Edge("vw_fact_tickets", "group_id", "vw_dim_group", "id"),
    Edge("vw_fact_tickets", "sla_id", "vw_dim_sla", "id"),
    Edge("vw_fact_tickets", "ticket_id", "vw_fact_ticket_enrichment", "ticket_id", both=True),
    Edge("vw_fact_asset_incidents", "asset_key", "vw_dim_asset", "asset_key"),
    Edge("vw_fact_asset_tickets", "asset_key", "vw_dim_asset", "asset_key", both=True),
    Edge("vw_fact_asset_tickets", "ticket_id", "vw_fact_tickets", "ticket_id"),
    Edge("vw_fact_project_tasks", "project_id", "vw_fact_projects", "project_id"),
    Edge("vw_tech_productivity", "technician_id", "vw_dim_technician", "id"),
    Edge("vw_backlog_open", "ticket_id", "vw_fact_tickets", "ticket_id"),
    Edge("vw_fact_software_licenses", "software_id", "vw_dim_software", "software_id"),
    Edge("vw_fact_supplier_contracts", "supplier", "vw_dim_supplier", "supplier_name"),
    Edge("vw_fact_asset_financials", "supplier", "vw_dim_supplier", "supplier_name"),
    Edge("vw_fact_problems", "open_date", "dim_date", "date"),
    Edge("vw_fact_changes", "open_date", "dim_date", "date"),
    Edge("vw_entity_project_performance", "project_id", "vw_fact_projects", "project_id"),
    Edge("vw_fact_tickets", "entity_id", "vw_dim_entity", "entity_id"),
    Edge("vw_glpi_tickets", "entity_id", "vw_dim_entity", "entity_id"),
    Edge("vw_dim_asset", "entity_id", "vw_dim_entity", "entity_id"),
    Edge("vw_fact_problems", "entity_id", "vw_dim_entity", "entity_id"),
    Edge("vw_fact_changes", "entity_id", "vw_dim_entity", "entity_id"),
    Edge("vw_fact_projects", "entity_id", "vw_dim_entity", "entity_id"),
]
#: own edges: keys the marts hold besides the published ones, and the dates of inactive roles
ADDED = [
    *[Edge(m, "entity_id", "vw_dim_entity", "entity_id") for m in (
        "vw_entity_overview", "vw_entity_sla_monthly", "vw_entity_asset_distribution", "vw_entity_project_performance")],
    Edge("vw_glpi_tickets", "category_id", "vw_dim_category", "id"),
    Edge("vw_glpi_tickets", "technician_id", "vw_dim_technician", "id"),
    Edge("vw_glpi_tickets", "assigned_group_id", "vw_dim_group", "id"),
    Edge("vw_glpi_tickets", "sla_id", "vw_dim_sla", "id"),
    Edge("vw_glpi_tickets", "created_at", "dim_date", "date"),
    Edge("vw_glpi_tickets", "resolved_at", "dim_date", "date", role="resolved"),
    Edge("vw_glpi_tickets", "closed_at", "dim_date", "date", role="closed"),
    Edge("vw_fact_tickets", "resolved_date", "dim_date", "date", role="resolved"),
    Edge("vw_fact_tickets", "closed_date", "dim_date", "date", role="closed"),
    Edge("vw_fact_problems", "solve_date", "dim_date", "date", role="resolved"),
    Edge("vw_fact_changes", "solve_date", "dim_date", "date", role="resolved"),
]
RELATIONSHIPS = [*PUBLISHED, *ADDED]
# FIXED VALUES: of ways as short as each other the one through the asset (its relationship runs both ways)
PREFERRED = {("vw_dim_entity", "vw_fact_asset_tickets"): "vw_dim_asset"}


class NoPath(LookupError):
    """A filter or a dimension's column reaches a mart on no way."""


class AmbiguousPath(LookupError):
    """Several ways as short as each other, and none declared."""


@dataclass(frozen=True)
class Step:
    """One relationship walked from ``source`` to ``target``; ``down``: from the one side to the many."""
    source: str
    source_col: str
    target: str
    target_col: str
    down: bool


def active_edges(roles: Iterable[str] = (), edges: list[Edge] | None = None) -> list[Edge]:
    """The edges that count with these roles: an edge with one of the roles replaces the active one beside it."""
    edges, roles = RELATIONSHIPS if edges is None else edges, set(roles)
    unknown = roles - {e.role for e in edges}
    if unknown:
        raise NoPath(f"no relationship has the role {', '.join(sorted(unknown))}")
    chosen = [e for e in edges if e.role in roles]
    if len({(e.many, e.one) for e in chosen}) < len(chosen):
        raise AmbiguousPath("two roles for one relationship")
    replaced = {(e.many, e.one) for e in chosen}
    return [e for e in edges if e in chosen or (e.role is None and (e.many, e.one) not in replaced)]


def find_path(source: str, target: str, roles: Iterable[str] = (), edges: list[Edge] | None = None) -> list[Step] | None:
    """The way of a filter from ``source`` to ``target``; None if there is none."""
    on = active_edges(roles, edges)
    steps = [Step(e.one, e.one_col, e.many, e.many_col, True) for e in on] + [Step(e.many, e.many_col, e.one, e.one_col, False) for e in on if e.both]
    ways = [[s] for s in steps if s.source == source]
    while ways:
        there = [w for w in ways if w[-1].target == target]
        if there:
            through = PREFERRED.get((source, target))
            declared = [w for w in there if through in {s.target for s in w[:-1]}] if len(there) > 1 else there
            if len(declared) != 1:
                raise AmbiguousPath(f"{source} to {target}: " + "; ".join(" - ".join([source, *[f"{s.target}.{s.target_col}" for s in w]]) for w in there))
            return declared[0]
        ways = [[*w, s] for w in ways for s in steps if s.source == w[-1].target and s.target not in {source, *[x.target for x in w]}]
    return None


def _path(source: str, target: str) -> list[tuple[str, str, str, str]] | None:
    way = find_path(source, target)
    return None if way is None else [(s.source, s.source_col, s.target, s.target_col) for s in way]


def _key(table: str, column: str, other: str) -> Column:
    """A key column; beside the calendar a timestamp is its day."""
    return F.to_date(column) if "dim_date" in (table, other) else F.col(column)


class Model:
    """``scope`` (X5, row-level security): a DataFrame with one column ``entity_id`` of the entities the reader may
    see; it is pushed into the source contracts, so every mart is made of their rows only."""

    def __init__(self, src, as_of: datetime, extra_marts: dict | None = None, scope: DataFrame | None = None):
        self.src = src if scope is None else ScopedSources(src, scope)
        self.as_of = as_of
        self.scope = scope
        self._builders = {**mart_builders(), **(extra_marts or {})}
        self._cache: dict[tuple, DataFrame] = {}

    def mart(self, name: str, needs: Iterable[str] | None = None) -> DataFrame:
        """Mart plan; ``needs`` (join-provided columns the caller uses) lets
        column-aware builders skip unused joins.  ``None`` = every column."""
        builder = self._builders[name]
        aware = "needs" in inspect.signature(builder).parameters
        key = (name, frozenset(needs) if (needs is not None and aware) else None)
        if key not in self._cache:
            self._cache[key] = builder(self.src, self.as_of, needs=key[1]) if key[1] is not None else builder(self.src, self.as_of)
        return self._cache[key]

    def names(self):
        return list(self._builders)

    def star(self, name: str, columns: Iterable[str] = (), filters: dict | None = None, roles: Iterable[str] = ()) -> DataFrame:
        """A mart under ``filters`` with dimension columns (``dimension.column``) beside its own."""
        columns, roles = list(columns), list(roles)
        needs = linked_columns(name, [*columns, *(filters or {})], roles)
        df = apply_filters(self, name, self.mart(name, needs=None), filters, roles) if filters else self.mart(name)
        missing = needs - set(df.columns)
        if missing:
            raise NoPath(f"{name} lacks {', '.join(sorted(missing))}")
        return with_dimensions(self, name, df, columns, roles)


def _predicate(col: Column, value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, (list, tuple, set)):
        return col.isin(*value)
    return col == value


def linked_columns(mart: str, keys: Iterable[str], roles: Iterable[str] = ()) -> set[str]:
    """Columns of ``mart`` through which filters or dimension columns (``table.column``) reach it."""
    out = set()
    for key in keys:
        table = key.split(".", 1)[0] if "." in key else mart
        way = find_path(table, mart, roles) if table != mart else None
        if way:
            out.add(way[-1].target_col)
    return out


def apply_filters(model: Model, mart: str, df: DataFrame, filters: dict | None, roles: Iterable[str] = ()) -> DataFrame:
    """Filter ``df`` (built from ``mart``) by ``filters``.

    Keys are ``column`` (applies where the column exists) or ``mart.column``
    (applies to that mart, or along the relationships to the marts related to
    it, through left-semi joins).  A ``mart.column`` that reaches ``mart`` on
    no way raises ``NoPath``: a number that a slicer does not reach is not
    given as if it were sliced (``ignore`` in ``evaluate`` says so on purpose).
    """
    for key, value in (filters or {}).items():
        if "." in key:
            fmart, fcol = key.split(".", 1)
        else:
            fmart, fcol = None, key
        if fmart in (None, mart):
            if fcol in df.columns:
                df = df.where(_predicate(F.col(fcol), value))
            elif fmart:
                raise NoPath(f"{mart} has no column {fcol}")
            continue
        way = find_path(fmart, mart, roles)
        if way is None:
            raise NoPath(f"a filter on {key} does not reach {mart}")
        kept = model.mart(fmart, needs=None if isinstance(value, Column) else {fcol, way[0].source_col}).where(_predicate(F.col(fcol), value))
        for s, after in zip(way, [*way[1:], None], strict=True):
            keys = kept.select(_key(s.source, s.source_col, s.target).alias("_key"))
            kept = df if s.target == mart else model.mart(s.target, needs={s.target_col, after.source_col})
            kept = kept.join(keys, _key(s.target, s.target_col, s.source) == F.col("_key"), "left_semi")
        df = kept
    return df


def with_dimensions(model: Model, mart: str, df: DataFrame, columns: Iterable[str], roles: Iterable[str] = ()) -> DataFrame:
    """``df`` (built from ``mart``) with the named dimension columns under their own names; rows keep their number.

    Each dimension is one look-up, first brought to one row a key (of rows that repeat a key the least), so the join
    cannot multiply.  Rows without a match get NULL.
    """
    wanted: dict[str, list[str]] = {}
    for key in columns:
        table, column = key.split(".", 1)
        if table != mart:
            wanted.setdefault(table, []).append(column)
    for table, cols in wanted.items():
        way = find_path(table, mart, roles)
        if way is None or not all(s.down or _one_to_one(s) for s in way):
            raise NoPath(f"columns of {table} cannot stand beside rows of {mart}")
        clash = set(cols) & set(df.columns)
        if clash:
            df = df.drop(*clash)                                                    # the dimension's column is the one asked for
        first = way[0]
        found = one_row_per_key(model.mart(table, needs={first.source_col, *cols}).select(_key(table, first.source_col, first.target).alias("_key"), *cols), "_key")
        for at, nxt in zip(way, way[1:], strict=False):
            between = model.mart(at.target, needs={at.target_col, nxt.source_col}).select(_key(at.target, at.target_col, at.source).alias("_up"), _key(nxt.source, nxt.source_col, nxt.target).alias("_own"))
            found = one_row_per_key(between.join(found, F.col("_up") == F.col("_key")).select(F.col("_own").alias("_key"), *cols), "_key")
        last = way[-1]
        df = df.join(found, _key(mart, last.target_col, last.source) == F.col("_key"), "left").drop("_key")
    return df


def _one_to_one(step: Step) -> bool:
    return {step.source, step.target} == {"vw_fact_tickets", "vw_fact_ticket_enrichment"}

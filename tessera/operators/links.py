"""Dedupe-before-join sub-plans shared by many marts.

Each returns at most one row per key, so a following left join can never
fan out the fact table.  They are plain hash aggregates: partial
aggregation runs map-side, and the exchange is on the join key of the fact,
so the aggregate's output partitioning is reused by the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_link(links: DataFrame, key: str, actor: str, role: int | None = None,
               role_col: str = "type", out: str | None = None) -> DataFrame:
    """``SELECT key, MIN(actor) FROM links WHERE type = role GROUP BY key``."""
    df = links if role is None else links.where(F.col(role_col) == role)
    return df.groupBy(key).agg(F.min(actor).alias(out or actor))


def links_of_role(src, table: str, role: int, role_col: str = "type") -> DataFrame:
    """Links of one role.  A source that makes the roles apart (``role_links``) gives that role's rows alone: an
    aggregate which repeats do not change then drops the contract's distinct, which a union would keep."""
    apart = getattr(src, "role_links", None)
    one = apart(table, role) if apart is not None else None
    return src[table].where(F.col(role_col) == role) if one is None else one


def with_first_links(df: DataFrame, id_col: str, src, table: str, key: str, actor: str, roles: dict) -> DataFrame:
    """C1 for several roles: ``{role: out_col}`` -> left join to the lowest actor of each role per key, one aggregate a
    role, so that plans which read the same role share its exchange.  A key with no link of a role gets NULL."""
    for role, out in roles.items():
        one = first_link(links_of_role(src, table, role), key, actor, out=out).withColumnRenamed(key, f"_{out}_key")
        df = df.join(one, F.col(id_col) == F.col(f"_{out}_key"), "left")
    return df


def first_group_name(groups_users: DataFrame, groups: DataFrame, out: str = "group_name") -> DataFrame:
    """User -> lowest group *name* among the user's groups."""
    g = groups.select(F.col("id").alias("_gid"), F.col("name").alias("_gname"))
    return (groups_users.join(g, F.col("groups_id") == F.col("_gid"))
            .groupBy("users_id").agg(F.min("_gname").alias(out)))


def default_email(useremails: DataFrame, out: str = "email") -> DataFrame:
    """User -> lowest default e-mail."""
    return (useremails.where(F.col("is_default") == 1)
            .groupBy("users_id").agg(F.min("email").alias(out)))


def full_name_nullsafe(first: Column, last: Column) -> Column:
    """``CONCAT(COALESCE(first,''), ' ', COALESCE(last,''))``."""
    return F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))


def full_name(first: Column, last: Column) -> Column:
    """``CONCAT(first, ' ', last)`` - NULL when either part is NULL."""
    return F.concat(first, F.lit(" "), last)


def prefixed(df: DataFrame, prefix: str, cols: list[str]) -> DataFrame:
    """Select ``cols`` renamed ``prefix + col`` (avoids ambiguous self-joins)."""
    return df.select(*[F.col(c).alias(prefix + c) for c in cols])

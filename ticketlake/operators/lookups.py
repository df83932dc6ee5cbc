"""Joins of a large table with a reference table.

Small reference tables are left to Catalyst, which broadcasts them by their
measured size.  Above that size the join shuffles, and there the keys that hold
a large share of the rows are split over many tasks: their rows get a salt and
the matching reference rows are repeated once per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALTS = 64
# A key is hot from this share of the rows on, so at most 1 / HOT_SHARE keys are.
HOT_SHARE = 0.002


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan, from file sizes and column widths."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst would broadcast this side under the session's own threshold."""
    jconf = df.sparkSession._jsparkSession.sessionState().conf()
    return plan_bytes(df) <= int(jconf.autoBroadcastJoinThreshold())


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys with at least HOT_SHARE of the rows: a narrow, pre-aggregated pass."""
    counts = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    total = df.select((F.count(F.lit(1)) * HOT_SHARE).alias("_t")).scalar()
    return counts.where(F.col("_hot").isNotNull() & (F.col("_n") >= total)).select("_hot")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    how: str = "left",
    spread_by: list[str] | None = None,
    salted: bool | None = None,
) -> DataFrame:
    """``fact <how> dim`` on one key, for left, left_semi, left_anti and inner.

    Column names other than the keys must not clash.  ``dim_key`` is dropped
    from the result.  ``spread_by`` names columns that tell the rows of one hot
    key apart (default: all columns).
    """
    narrow = how in ("left_semi", "left_anti")
    dim_side = dim.withColumnRenamed(dim_key, "_dim_key")
    if narrow:
        dim_side = dim_side.select("_dim_key")
    if salted is None:
        salted = not fits_broadcast(dim_side)
    if not salted:
        out = fact.join(dim_side, F.col(fact_key) == F.col("_dim_key"), how)
        return out if narrow else out.drop("_dim_key")

    hot = F.broadcast(hot_keys(fact, fact_key))  # at most 1 / HOT_SHARE rows
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in (spread_by or fact.columns)]), F.lit(SALTS)).cast("int")
    # Rows without a key match nothing; they are spread as well.
    left = (
        fact.join(hot, F.col(fact_key) == F.col("_hot"), "left")
        .withColumn("_salt", F.when(F.col("_hot").isNotNull() | F.col(fact_key).isNull(), spread).otherwise(0))
        .drop("_hot")
    )
    right = (
        dim_side.join(hot, F.col("_dim_key") == F.col("_hot"), "left")
        .withColumn(
            "_dim_salt",
            F.explode(
                F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
            ),
        )
        .drop("_hot")
    )
    cond: Column = (F.col(fact_key) == F.col("_dim_key")) & (F.col("_salt") == F.col("_dim_salt"))
    return left.join(right, cond, how).drop("_salt", "_dim_salt", "_dim_key")


def resolve_roles(
    fact: DataFrame,
    dim: DataFrame,
    roles: dict[str, str],
    attributes: dict[str, str],
    id_column: str = "sys_id",
    narrow: bool | None = None,
) -> DataFrame:
    """Look up several id columns of ``fact`` in one reference table.

    ``roles`` maps an id column to the prefix of its output columns,
    ``attributes`` maps a reference column to an output suffix.

    A repeated reference id stands for one of its rows, the greatest by its
    attributes, so the result does not depend on the path taken.

    With a small reference table this is one broadcast used once per role.  With
    a large one the fact rows would be shuffled once per role, so only the ids
    travel: they are unpivoted, looked up in a single (salted) join, folded
    back per row, and joined to the full rows in one shuffle.
    """
    dim = dim.groupBy("sys_id").agg(F.max(F.struct(*attributes)).alias("_one")).select("sys_id", "_one.*")
    if narrow is None:
        narrow = not fits_broadcast(dim)
    if not narrow:
        out = fact
        for column, prefix in roles.items():
            side = dim.select(
                F.col("sys_id").alias(f"_{prefix}_id"),
                *[F.col(a).alias(f"{prefix}_{s}") for a, s in attributes.items()],
            )
            out = out.join(side, F.col(column) == F.col(f"_{prefix}_id"), "left").drop(f"_{prefix}_id")
        return out

    keys = list(dict.fromkeys([id_column, *roles]))
    ids = fact.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.explode(
            F.array(*[F.struct(F.lit(p).alias("role"), F.col(c).alias("ref")) for c, p in roles.items()])
        ).alias("_r"),
    ).select(*[f"_k_{k}" for k in keys], F.col("_r.role").alias("_role"), F.col("_r.ref").alias("_ref"))
    found = lookup_join(
        ids.where(F.col("_ref").isNotNull()),
        dim,
        "_ref",
        "sys_id",
        "inner",
        spread_by=[f"_k_{id_column}", "_role"],
        salted=True,
    )
    # All rows of one key tuple resolve to the same values, so max() merely picks them.
    folded = found.groupBy(*[f"_k_{k}" for k in keys]).agg(
        *[
            F.max(F.when(F.col("_role") == prefix, F.col(a))).alias(f"{prefix}_{s}")
            for prefix in roles.values()
            for a, s in attributes.items()
        ]
    )
    cond = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        cond = same if cond is None else cond & same
    return fact.join(folded, cond, "left").drop(*[f"_k_{k}" for k in keys])

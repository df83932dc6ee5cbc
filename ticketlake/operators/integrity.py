"""Referential integrity and missing references, as explicit anti-joins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlake.operators.lookups import lookup_join
from ticketlake.schemas import USER_ROLE_FIELDS


def _ids(df: DataFrame, column: str = "sys_id") -> DataFrame:
    return df.where(F.col(column).isNotNull()).select(F.col(column).alias("_id"))


def orphan_users(user: DataFrame, company: DataFrame) -> DataFrame:
    """Users whose company id (empty text too) has no company."""
    placed = user.where(F.col("company").isNotNull()).select("sys_id", "user_name", "name", "company")
    return lookup_join(placed, _ids(company), "company", "_id", "left_anti", spread_by=["sys_id"])


def orphan_incidents(incident: DataFrame, company: DataFrame) -> DataFrame:
    """Number of incidents whose company id has no company; counted per id before the join."""
    per_id = (
        incident.where(F.col("company").isNotNull())
        .groupBy("company")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    orphans = per_id.join(_ids(company), F.col("company") == F.col("_id"), "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_count"))


def childless_companies(company: DataFrame, user: DataFrame) -> DataFrame:
    """Companies without a single user."""
    used = _ids(user, "company").distinct()
    return (
        company.select("sys_id", "name")
        .join(used, F.col("sys_id") == F.col("_id"), "left_anti")
        .withColumn("user_count", F.lit(0).cast("long"))
    )


def distinct_ids(df: DataFrame, columns: Iterable[str], name: str, ignore_empty: bool = False) -> DataFrame:
    """Distinct non-NULL values of several id columns, from a single scan."""
    columns = list(columns)
    if len(columns) == 1:
        ids = df.select(F.col(columns[0]).alias(name))
    else:
        ids = df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(name))
    ids = ids.where(F.col(name).isNotNull())
    if ignore_empty:
        ids = ids.where(F.col(name) != "")
    return ids.distinct()


def missing_ids(df: DataFrame, columns: Iterable[str], reference: DataFrame, name: str, **kw) -> DataFrame:
    """Referenced ids the reference table lacks.  Ids are unique before the join."""
    ids = distinct_ids(df, columns, name, **kw)
    return ids.join(_ids(reference), F.col(name) == F.col("_id"), "left_anti")


def missing_company_ids(incident: DataFrame, company: DataFrame, **kw) -> DataFrame:
    return missing_ids(incident, ["company"], company, "company_id", **kw)


def missing_user_ids(
    incident: DataFrame, user: DataFrame, roles: Iterable[str] = USER_ROLE_FIELDS, **kw
) -> DataFrame:
    return missing_ids(incident, roles, user, "user_id", **kw)


def reference_integrity(user: DataFrame, company: DataFrame) -> DataFrame:
    """All issues in one report: issue, sys_id, name, company, user_count."""
    users = orphan_users(user, company).select(
        F.lit("users without a valid company").alias("issue"),
        "sys_id", "user_name", "name", "company",
        F.lit(None).cast("long").alias("user_count"),
    )
    companies = childless_companies(company, user).select(
        F.lit("companies without users").alias("issue"),
        "sys_id",
        F.lit(None).cast("string").alias("user_name"),
        "name",
        F.lit(None).cast("string").alias("company"),
        "user_count",
    )
    return users.unionByName(companies)
